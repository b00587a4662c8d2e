"""Cheapest repair of damaged conversations, on an automaton of shared suffixes.

A conversation's rows become a signature, one letter for the role and the fault of each
row. Signatures are read from their ends: an automaton node stands for one suffix and what
follows it, and all conversations that end alike share it. Cost-to-go and best edit are
worked out once for each node and state of the role grammar; a repair is a walk along them.

The grammar is ``(s?(ua)+)?`` over the initials of the roles. Its states: 0 nothing yet,
1 after system, 2 after user, 3 after assistant; 0 and 3 may end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsprep.llm.shared import in_order, written

#: Costs of the edits, and of leaving a truncated row in.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Rows of a signature at most; a longer conversation has several, chained by its states.
SEGMENT = 4096
WHITE = " \t\n\x0b\x0c\r"

STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: The state that the missing role leads to, and that role.
NEXT = (2, 2, 3, 2)
ROLE = ("user", "user", "assistant", "user")
#: Cost-to-go after the last row, and the edits there.
END = (0, 2 * INSERT, INSERT, 0)
END_MOVES = (None, "I", "I", None)

_step_cache: dict = {}


def step(symbol: str, after: tuple) -> tuple[tuple, tuple]:
    """Cost-to-go and best edit of each state before a row, from the costs after it.

    The symbol is x for a row that must go, else its role's initial (o for others), upper
    case if it is truncated. Edits of a state have different letters, so of edits that cost
    the same the least letter gives the least audit.
    """
    low = min(after)
    key = (symbol, *(v - low for v in after))
    if key not in _step_cache:
        after = key[1:]
        truncated = TRUNCATED if symbol.isupper() else 0
        used = []
        for q in range(4):
            options = [(DELETE + after[q], "D")]
            if symbol != "x":
                kept = STEP.get((q, symbol.lower()))
                if kept is not None:
                    options.append((truncated + after[kept], "K"))
                options.append((REROLE + truncated + after[NEXT[q]], "R"))
            used.append(min(options))
        # An insertion leads on within the same node; two in a row return to it.
        own = [cost for cost, _ in used]
        closed = [0, 0, min(own[2], INSERT + own[3]), min(own[3], INSERT + own[2])]
        closed[0], closed[1] = (min(own[q], INSERT + closed[2]) for q in (0, 1))
        best = [min(used[q], (INSERT + closed[NEXT[q]], "I")) for q in range(4)]
        _step_cache[key] = (tuple(c for c, _ in best), tuple(m for _, m in best))
    costs, moves = _step_cache[key]
    return tuple(c + low for c in costs), moves


def _walk(path: list, symbols: str, state: int, last: bool) -> tuple[str, int]:
    """The best edits from a node's state to the end of its suffix, and the state there."""
    audit, depth = [], len(path) - 1
    while depth >= 0:
        move = path[depth][1][state]
        if depth == 0 and not (last and move):
            break
        audit.append(move)
        if move == "K":
            state = STEP[state, symbols[depth - 1].lower()]
        elif move != "D":
            state = NEXT[state]
        depth -= move != "I"
    return "".join(audit), state


def repair_signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of each signature; the task's rows come sorted by what follows and reversed signature.

    The path of nodes of the signature at hand is all that is held: the next one keeps what
    its end shares with it, and adds a node for each further row.
    """
    tail, held, path = None, "", []
    for batch in batches:
        out = []
        for after, reverse, whole in zip(*(c.to_pylist() for c in batch.columns)):
            if after != tail:
                tail, held = after, ""
                costs = END if after == "" else tuple(int(v) for v in after.split(","))
                path = [(costs, END_MOVES)]
            shared = 0
            for a, b in zip(held, reverse):
                if a != b:
                    break
                shared += 1
            del path[shared + 1 :]
            for symbol in reverse[shared:]:
                path.append(step(symbol, path[-1][0]))
            held = reverse
            found = [_walk(path, reverse, q, after == "") for q in (range(1) if whole else range(4))]
            spent = [path[-1][0][q] - path[0][0][end] * (after != "") for q, (_, end) in enumerate(found)]
            out.append((after, reverse, [a for a, _ in found], [e for _, e in found], spent))
        columns = list(zip(*out)) or [()] * 5
        kinds = (pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["after", "reverse", "audits", "ends", "spent"]
        )


def _damaged(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows after damage, by the checksum of conversation and turn."""
    named = {n: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for n, c in
             (("conv", conv), ("turn", turn), ("role", role), ("text", text))}
    kind = F.crc32(F.concat_ws(":", named["conv"], named["turn"])) % 20
    rows = df.select(
        F.coalesce(F.col(conv).cast("string"), F.lit("")).alias("c"),
        F.col(conv).isNull().alias("cn"),
        F.col(turn).cast("bigint").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(named["role"]).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(named["text"], ".!?", ""))
        .otherwise(named["text"]).alias("text"),
        kind.alias("kind"),
    ).filter("kind <> 0")
    twice = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("copy", F.explode(twice)).drop("kind")


def _symbols(rows: DataFrame) -> DataFrame:
    """A row's place, fault and signature letter.

    Equal rows are found by an aggregation that is combined before the exchange; only those
    that occur more than once are joined back, and a join on a very common one is split.
    """
    slim = rows.select("c", "cn", "turn", "role_start", "digest", "at", "blank", "cut")
    firsts = slim.groupBy("c", "cn", "digest").agg(F.min("at").alias("earliest"), F.count("*").alias("times"))
    firsts = firsts.filter("times > 1").drop("times")
    joined = slim.join(firsts, ["c", "cn", "digest"], "left")
    again = F.col("earliest").isNotNull() & (F.col("at") > F.col("earliest"))
    fault = F.when(F.col("blank"), "blank").when(again, "duplicate").when(F.col("cut"), "truncated")
    letter = F.when(F.col("role_start").isin("s", "u", "a"), F.col("role_start")).otherwise("o")
    return joined.select(
        "c", "cn", "turn", "role_start", "at", F.coalesce(fault, F.lit("")).alias("fault")
    ).withColumn(
        "symbol",
        F.when(F.col("fault").isin("blank", "duplicate"), "x")
        .when(F.col("fault") == "truncated", F.upper(letter)).otherwise(letter),
    )


SEGMENT_FIELDS = (
    "c string, cn boolean, first_place binary, signature string, blank bigint, duplicate bigint, truncated bigint, "
    "illegal bigint, first_role string, last_role string, turns bigint, first_turn bigint, last_turn bigint"
)


def segments_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signatures of at most SEGMENT rows with their counts, from rows in order."""
    kinds = [pa.string(), pa.bool_(), pa.binary(), pa.string(), *[pa.int64()] * 4, *[pa.string()] * 2, *[pa.int64()] * 3]
    names = [f.split()[0] for f in SEGMENT_FIELDS.split(", ")]

    def close(key, place, symbols, faults, illegal, roles, turns, ends):
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        return (*key, place, "".join(symbols), *counts, illegal, *roles, turns, *ends)

    def batch_of(done):
        columns = list(zip(*done)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    key = place = None
    symbols, faults, illegal, roles, turns, ends = [], [], 0, ["", ""], 0, [None, None]
    for batch in batches:
        done = []
        for c, cn, turn, start, at, fault, symbol in zip(*(x.to_pylist() for x in batch.columns)):
            if key != (c, cn) or len(symbols) == SEGMENT:
                if key is not None:
                    done.append(close(key, place, symbols, faults, illegal, roles, turns, ends))
                key, place = (c, cn), at
                symbols, faults, illegal, roles, turns, ends = [], [], 0, [start, start], 0, [turn, turn]
                turns = int(turn is not None)
            else:
                illegal += roles[1] + start not in ("su", "ua", "au")
                turns += turn is not None and turn != ends[1]
                roles[1] = start
                ends = [ends[0] if ends[0] is not None else turn, turn if turn is not None else ends[1]]
            symbols.append(symbol)
            faults.append(fault)
        yield batch_of(done)
    if key is not None:
        yield batch_of([close(key, place, symbols, faults, illegal, roles, turns, ends)])


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What follows each segment of a long conversation; segments come last first."""
    key, costs, tail = None, END, ""
    for batch in batches:
        out = []
        for c, cn, place, signature in zip(*(x.to_pylist() for x in batch.columns)):
            if key != (c, cn):
                key, costs, tail = (c, cn), END, ""
            out.append((c, cn, place, signature, tail))
            for symbol in reversed(signature):
                costs, _ = step(symbol, costs)
            low = min(costs)
            costs = tuple(v - low for v in costs)
            tail = ",".join(map(str, costs))
        columns = list(zip(*out)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, k) for x, k in zip(columns, (pa.string(), pa.bool_(), pa.binary(), pa.string(), pa.string()))],
            ["c", "cn", "first_place", "signature", "after"],
        )


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of each segment, from the state that the one before it ends in."""
    key, state = None, 0
    for batch in batches:
        out = []
        for c, cn, place, audits, ends, spent in zip(*(x.to_pylist() for x in batch.columns)):
            if key != (c, cn):
                key, state = (c, cn), 0
            out.append((c, cn, place, audits[state], spent[state]))
            state = ends[state]
        columns = list(zip(*out)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, k) for x, k in zip(columns, (pa.string(), pa.bool_(), pa.binary(), pa.string(), pa.int64()))],
            ["c", "cn", "first_place", "audit", "spent"],
        )


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each repaired conversation, from its edits and rows in order.

    One digest state, one list of letters and one row are held at a time. A digest can
    only be taken in order, so a conversation's rows pass through one task.
    """
    key, digest, blank_start, state, moves, audit = None, None, True, 0, iter(""), []

    def add(role, text):
        nonlocal blank_start
        digest.update(("" if blank_start else "\n").encode() + f"{role}:{text}".encode())
        blank_start = False

    def edits_up_to_row():
        """Make the insertions due here; the edit of the row that follows, if any."""
        nonlocal state
        for move in moves:
            if move != "I":
                return move
            add(ROLE[state], "")
            state = NEXT[state]
        return None

    def finish():
        edits_up_to_row()
        return (*key, "".join(audit), digest.hexdigest())

    def batch_of(done):
        columns = list(zip(*done)) or [()] * 4
        kinds = (pa.string(), pa.bool_(), pa.large_string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], ["c", "cn", "audit", "repaired_sha256"])

    for batch in batches:
        done = []
        for c, cn, is_row, role, text in zip(*(batch.column(i) for i in range(5))):
            c, cn = c.as_py(), cn.as_py()
            if key != (c, cn):
                if key is not None:
                    done.append(finish())
                key, digest, blank_start, state, moves, audit = (c, cn), hashlib.sha256(), True, 0, iter(""), []
            if not is_row.as_py():
                edits_up_to_row()
                moves = iter(text.as_py())
                audit.append(text.as_py())
                continue
            move = edits_up_to_row()
            if move == "K":
                role = role.as_py()
                state = STEP[state, role[:1]]
                add(role, text.as_py())
            elif move == "R":
                add(ROLE[state], text.as_py())
                state = NEXT[state]
        yield batch_of(done)
    if key is not None:
        yield batch_of([finish()])


def repair_conversations(
    df: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Damage conversations by the fixed rule, then find the cheapest repair of each.

    One row per value of ``conv``, a null one included: gaps, blank, duplicate, truncated,
    illegal, cost, audit and repaired_sha256. Null roles and texts are one space, and so
    are null ids in the checksum. Rows of one turn are ordered by role and digest of the
    text, equal ones stay side by side; rows without turn come first. A conversation
    without rows after damage has zeros, an empty audit and the digest of nothing. An empty
    table gives no rows; other columns are ignored.
    """
    ids = df.select(
        F.coalesce(F.col(conv).cast("string"), F.lit("")).alias("c"), F.col(conv).isNull().alias("cn"),
        F.col(conv).alias("id"),
    ).groupBy("c", "cn").agg(F.first("id").alias(conv))
    rows = in_order(_damaged(df, conv, turn, role, text), "damaged-rows")
    stripped = F.rtrim(F.col("text"), F.lit(WHITE))
    digest = F.unhex(F.sha2(F.concat(F.sha2("role", 256), F.col("text")), 256))
    # The order of rows as bytes: they compare as the fields do, one after the other.
    turns = F.when(F.col("turn").isNull(), F.lit("0" * 17)).otherwise(
        F.concat(F.lit("1"), F.lpad(F.hex(F.col("turn").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")))
    place = F.concat(F.unhex(F.sha2("role", 256)), digest, F.unhex(F.lpad(F.hex("pos"), 16, "0")))
    rows = rows.select(
        "c", "cn", "turn", "role", "text", digest.alias("digest"),
        F.concat(F.encode(turns, "UTF-8"), place).alias("at"),
        F.substring("role", 1, 1).alias("role_start"),
        (stripped == "").alias("blank"), (~F.right(stripped, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )

    ordered = _symbols(rows).select("c", "cn", "turn", "role_start", "at", "fault", "symbol")
    ordered = ordered.repartitionByRange("c", "cn", "at").sortWithinPartitions("c", "cn", "at")
    segments = written(ordered.mapInArrow(segments_of, SEGMENT_FIELDS), "segments")

    parts = segments.groupBy("c", "cn").agg(F.count("*").alias("parts"))
    tagged = segments.select("c", "cn", "first_place", "signature").join(parts, ["c", "cn"])
    long = tagged.filter("parts > 1").select("c", "cn", "first_place", "signature")
    long = long.repartition("c", "cn").sortWithinPartitions("c", "cn", F.desc("first_place"))
    fields = "c string, cn boolean, first_place binary, signature string, after string"
    long = long.mapInArrow(_backward, fields)
    short = tagged.filter("parts = 1").select("c", "cn", "first_place", "signature", F.lit("").alias("after"))
    each = written(
        short.withColumn("whole", F.lit(True)).unionByName(long.withColumn("whole", F.lit(False)))
        .withColumn("reverse", F.reverse("signature")).drop("signature"),
        "signatures",
    )

    distinct = each.groupBy("after", "reverse").agg(F.min("whole").alias("whole"))
    distinct = distinct.repartitionByRange("after", "reverse").sortWithinPartitions("after", "reverse")
    fields = "after string, reverse string, audits array<string>, ends array<int>, spent array<bigint>"
    nodes = distinct.mapInArrow(repair_signatures, fields)
    repaired = written(each.join(nodes, ["after", "reverse"]).drop("after", "reverse"), "repairs")
    fields = "c string, cn boolean, first_place binary, audit string, spent bigint"
    short = repaired.filter("whole").select(
        "c", "cn", "first_place", F.col("audits")[0].alias("audit"), F.col("spent")[0].alias("spent"))
    long = repaired.filter("NOT whole").select("c", "cn", "first_place", "audits", "ends", "spent")
    long = long.repartition("c", "cn").sortWithinPartitions("c", "cn", "first_place")
    audits = written(short.unionByName(long.mapInArrow(_forward, fields)), "audits")

    edits = audits.select(
        "c", "cn", F.col("first_place").alias("at"), F.lit(False).alias("is_row"), F.lit("").alias("role"),
        F.col("audit").alias("text"))
    stream = edits.unionByName(rows.select("c", "cn", "at", F.lit(True).alias("is_row"), "role", "text"))
    stream = stream.repartition("c", "cn").sortWithinPartitions("c", "cn", "at", "is_row")
    stream = stream.select("c", "cn", "is_row", "role", "text")
    digests = stream.mapInArrow(_edited, "c string, cn boolean, audit string, repaired_sha256 string")

    return _assembled(ids, segments, audits, digests, conv)


def _assembled(ids: DataFrame, segments: DataFrame, audits: DataFrame, digests: DataFrame, conv: str) -> DataFrame:
    """Counts of segments added up, with what lies between neighbouring ones."""
    from pyspark.sql import Window

    order = Window.partitionBy("c", "cn").orderBy("first_place")
    # Few rows: one for each SEGMENT rows of a conversation, or for a partition's border.
    last_turn = F.last("last_turn", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    joined = segments.withColumns({
        "before": F.lag("last_role").over(order), "turn_before": last_turn,
    })
    pair = F.concat("before", "first_role")
    counts = joined.groupBy("c", "cn").agg(
        *(F.sum(n).alias(n) for n in ("blank", "duplicate", "truncated")),
        F.sum(F.col("illegal") + F.when(F.col("before").isNull() | pair.isin("su", "ua", "au"), 0).otherwise(1)).alias("illegal"),
        (F.max("last_turn") - F.min("first_turn") + 1
         - F.sum(F.col("turns") - F.when(F.col("turn_before") == F.col("first_turn"), 1).otherwise(0))).alias("gaps"),
    )
    cost = audits.groupBy("c", "cn").agg(F.sum("spent").alias("cost"))
    result = ids.join(counts, ["c", "cn"], "left").join(cost, ["c", "cn"], "left").join(digests, ["c", "cn"], "left")

    def number(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)

    return result.select(
        conv, *(number(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
