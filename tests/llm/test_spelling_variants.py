import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from newsprep.llm import spelling_variants as sv
from tests.llm.rows import AWKWARD, collected, documents, given

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def counted(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(rows):
    words, forms, near = counted(rows), {}, {}
    for w in words:
        near[w] = [v for v in words if is_near(w, v)]
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), words.get(forms[w])))
    return sorted(out)


def check(spark, rows, parts=3):
    df = documents(spark, rows).repartition(parts)
    assert collected(sv.spelling_variants(df), *COLUMNS) == brute(rows)


def variants(seed, n):
    """Words that differ by a letter or two, with counts that make chains of forms."""
    draw = random.Random(seed)
    letters = "abcdezàÿ×"
    rows = []
    for i in range(n):
        word = "".join(draw.choice(letters) for _ in range(draw.choice([7, 8, 9, 30])))
        for level in (1, 11, 130):
            rows.append((draw.randrange(10_000), " ".join([word] * (2 * level))))
            at = draw.randrange(len(word))
            word = draw.choice([
                word[:at] + draw.choice(letters) + word[at + 1 :],
                word[:at] + word[at + 1 :],
                word[:at] + draw.choice(letters) + word[at:],
                word[:at] + word[at] + word[at:],
            ])
    return rows


@pytest.mark.parametrize("limits", [{}, {"SEGMENT": 2, "PASS": 6, "PER_BLOCK": 4, "HELD": 3, "LONGEST": 8, "PROBES": 1}])
def test_against_every_pair(spark, small, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(sv, name, value)
    check(spark, variants(len(limits), 60) + given(spark, small, 25))


def test_awkward_rows(spark):
    long = "é" * 3000
    rows = AWKWARD + [(20, f"{long} {long} {long[1:]}x {long[1:]}x ABCDEFGH abcdefgh ABCDEFGÀ Étonnant étonnant")] * 3
    check(spark, rows)


def test_chains_are_followed_to_the_end(spark):
    rows = []
    for i, n in enumerate((2, 20, 200, 2000, 20000)):
        word = "aaaaaaa" + "bcdefgh"[:i]
        doc = next(d for d in range(1000) if zlib.crc32(f"{d}:{word}".encode()) % 31)
        rows.append((doc, " ".join([word] * n)))
    check(spark, rows)
    found = {r["word"]: r["root"] for r in sv.spelling_variants(documents(spark, rows)).collect()}
    assert set(found.values()) == {"aaaaaaabcde"}


def test_empty_table(spark):
    assert sv.spelling_variants(documents(spark, [])).count() == 0
    assert sv.spelling_variants(documents(spark, [(1, "nothing twice here")])).count() == 0


def test_filters_let_all_words_and_few_others_through():
    draw = np.random.default_rng(1)
    h = sv.mixed(draw.integers(0, 1 << 63, 40_000, dtype=np.uint64))
    blocks = 40_000 // sv.PER_BLOCK
    lanes = np.zeros((blocks, sv.LANES), dtype=np.uint32)
    block, bits = sv.places(h, blocks)
    for lane in range(sv.LANES):
        np.bitwise_or.at(lanes[:, lane], block, np.uint32(1) << ((bits * sv.SALTS[lane]) >> np.uint32(27)))
    assert len(sv.passed(lanes, block, bits)) == len(h)
    foreign = sv.mixed(draw.integers(0, 1 << 63, 400_000, dtype=np.uint64))
    assert len(sv.passed(lanes, *sv.places(foreign, blocks))) < 2_000
