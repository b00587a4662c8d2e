import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from newsprep.llm import conversation_repair
from newsprep.llm.conversation_repair import repair_conversations
from tests.llm.rows import collected

COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def damaged(rows):
    for conv, turn, role, text in rows:
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(name.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        for _ in range(2 if kind == 3 else 1):
            yield conv, turn, role, text


def brute(rows):
    """Each conversation by itself, by a search over rows, states and inserted rows."""
    out = []
    kept = list(damaged(rows))
    for conv in {r[0] for r in rows}:
        own = [r[1:] for r in kept if r[0] == conv]

        def place(r):
            role = hashlib.sha256(r[1].encode())
            content = hashlib.sha256(role.hexdigest().encode() + r[2].encode())
            return (r[0] is not None, r[0] or 0, role.digest(), content.digest())

        own.sort(key=place)
        faults, seen = [], set()
        for _, role, text in own:
            content = re.findall(r"[^\x20\x09-\x0D]", text)
            if not content:
                faults.append("blank")
            elif (role, text) in seen:
                faults.append("duplicate")
            else:
                faults.append("" if content[-1] in ".!?" else "truncated")
            seen.add((role, text))

        @lru_cache(None)
        def search(i, initials, inserted):
            """(cost, audit, repaired) of the rest; initials: none, s, u or a came last."""
            options = []
            if i == len(own) and initials in ("", "a"):
                options.append((0, "", ()))
            due = "a" if initials == "u" else "u"
            name = {"u": "user", "a": "assistant"}[due]
            if inserted < 3:
                c, a, r = search(i, due, inserted + 1)
                options.append((c + 2, "I" + a, ((name, ""), *r)))
            if i < len(own):
                _, role, text = own[i]
                c, a, r = search(i + 1, initials, 0)
                options.append((c + 3, "D" + a, r))
                if faults[i] in ("", "truncated"):
                    extra = faults[i] == "truncated"
                    if role[:1] == due or (role[:1] == "s" and initials == ""):
                        c, a, r = search(i + 1, role[:1], 0)
                        options.append((c + extra, "K" + a, ((role, text), *r)))
                    c, a, r = search(i + 1, due, 0)
                    options.append((c + extra + 2, "R" + a, ((name, text), *r)))
            return min(options) if options else (1 << 30, "", ())

        cost, audit, repaired = search(0, "", 0)
        turns = [t for t, _, _ in own if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        out.append((
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest(),
        ))
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))


def check(spark, rows, parts=4):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    clash = df.selectExpr("*", *(f"'x' AS {c}" for c in ("c", "cn", "at", "pos", "part", "audit", "cost", "digest")))
    assert collected(repair_conversations(clash), *COLUMNS) == brute(rows)


@pytest.mark.parametrize("segment", [3, 4096])
def test_random_conversations(spark, segment, monkeypatch):
    draw = random.Random(segment)
    roles = ["user", "assistant", "system", "user", "assistant", "unknown", "", None, "tool", "ä"]
    texts = ["Done.", "what?", "no end", "", " \t", None, "Yes! ", "x.\n", "same", "é ", "\U0001f600."]
    rows = [
        (conv, draw.choice([None, *range(-3, 12)]), draw.choice(roles), draw.choice(texts))
        for conv in range(150) for _ in range(draw.randrange(1, 12))
    ]
    rows += [(None, t, "user", "a null id.") for t in (1, 2, None)]
    monkeypatch.setattr(conversation_repair, "SEGMENT", segment)
    check(spark, rows)


def test_given_conversations(spark, small):
    df = spark.read.parquet(f"{small}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    check(spark, rows)


def test_one_long_conversation_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "SEGMENT", 16)
    draw = random.Random(5)
    rows = [(7, t, draw.choice(["user", "assistant"]), draw.choice(["ok.", f"text {t}", "hm"])) for t in range(220)]
    check(spark, rows, parts=8)


def test_dropped_rows_and_empty_table(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    check(spark, [(gone, 1, "user", "never seen.")])
    assert repair_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_nodes_are_shared(spark):
    """A further conversation costs only the rows by which it is longer or different."""
    import pyarrow as pa

    reverse = sorted(["au" * 40, "au" * 40 + "s", "au" * 39 + "sx"])
    made = []
    old = conversation_repair.step
    try:
        conversation_repair.step = lambda *a: made.append(1) or old(*a)
        batch = pa.RecordBatch.from_pydict({"after": [""] * 3, "reverse": reverse, "whole": [True] * 3})
        list(conversation_repair.repair_signatures(iter([batch])))
    finally:
        conversation_repair.step = old
    assert len(made) <= 80 + 1 + 2
