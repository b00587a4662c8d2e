"""Scores of an n-gram model kept as a backoff automaton with failure arcs."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsprep.llm.shared import LOWER, utf8, written

#: Tokens of a block (a longer document is a block of its own), and n-grams of a bucket.
BLOCK_TOKENS, BUCKET_KEYS = 1 << 20, 1 << 21
#: How the share of unseen followers falls with a context's count: count ** (NOVELTY - 1).
NOVELTY = 0.75
#: Hashes of the end and of the start; no word is empty or has a space.
END, START = xxhash.xxh64_intdigest(b""), xxhash.xxh64_intdigest(b" ")
#: Bytes of a longer n-gram's key that are sent, of 8; words are sent exactly. Within its
#: bucket an n-gram is mistaken for another with a chance of BUCKET_KEYS / 2 ** 48 or so.
SENT_LONG = 6


def pack(values: np.ndarray) -> bytes:
    """An array of unsigned numbers, the bytes of equal weight together, compressed."""
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpack(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).reshape(-1).view(kind)


def mix(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Keys of n-grams from those of their contexts and their last words."""
    x = context * np.uint64(0x9E3779B97F4A7C15) + word * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


BLOCKS = (
    "block bigint, n_tokens bigint, doc_id array<bigint>, train array<boolean>, "
    "lengths array<int>, words binary, tokens binary"
)


def blocks_of(docs: DataFrame) -> DataFrame:
    """Rows of documents (doc_id, train, text) as numbers of a block's own words."""
    out = pa.schema(
        [("block", pa.int64()), ("n_tokens", pa.int64()), ("doc_id", pa.list_(pa.int64()))]
        + [("train", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int32()))]
        + [("words", pa.binary()), ("tokens", pa.binary())]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, train, lengths, words = [], [], [], []

        def flush() -> pa.RecordBatch:
            local = {w: i for i, w in enumerate(dict.fromkeys(words))}
            tokens = np.fromiter(map(local.__getitem__, words), np.uint32, len(words))
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, local), np.uint64, len(local))
            row = [number, len(words), ids, train, lengths, pack(hashes), pack(tokens)]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(row, out, strict=True)], schema=out
            )

        for batch in batches:
            flags = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for (doc_id, learn), text in zip(flags, utf8(batch.column(2)), strict=True):
                found = text.translate(LOWER).split()
                ids.append(doc_id)
                train.append(learn)
                lengths.append(len(found) + 1)
                words += found
                words.append(b"")
                if len(words) >= BLOCK_TOKENS:
                    yield flush()
                    number += 1
                    ids, train, lengths, words = [], [], [], []
        if ids:
            yield flush()

    return docs.select("doc_id", "train", "text").mapInArrow(run, BLOCKS)


@dataclass
class Block:
    """The n-grams of a block of documents, each document with a start before it."""

    doc_id: list[int | None]
    train: np.ndarray
    #: Where each document's start stands among all tokens.
    begin: np.ndarray
    lengths: np.ndarray
    hashes: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Block:
        lengths = np.array(row["lengths"], np.int64)
        hashes = unpack(row["words"], "<u8")[unpack(row["tokens"], "<u4")]
        begin = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        whole = np.full(int(lengths.sum()) + len(lengths), START, np.uint64)
        place = np.arange(len(whole)) - np.repeat(begin, lengths + 1)
        whole[place > 0] = hashes
        return cls(row["doc_id"], np.array(row["train"]), begin, lengths, whole, place)

    def grams(self, order: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For n up to order: n, where n-grams end, their distinct keys, and which is where."""
        keys = self.hashes
        for n in range(1, order + 1):
            if n > 1:
                keys = np.concatenate([[np.uint64(0)], mix(keys[:-1], self.hashes[1:])])
            at = np.flatnonzero(self.place >= max(1, n - 1))
            distinct, which = np.unique(keys[at], return_inverse=True)
            yield n, at, distinct, which

    def learnt(self, at: np.ndarray, which: np.ndarray, size: int) -> np.ndarray:
        """How often each of the n-grams of grams() occurs in the documents learnt from."""
        learn = np.repeat(self.train, self.lengths + 1)[at]
        return np.bincount(which, weights=learn, minlength=size).astype(np.int64)


COUNTED = "n int, bucket bigint, block bigint, keys binary, counts binary"


def buckets_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each key; in order, as buckets are ranges of keys."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def sent_keys(keys: np.ndarray, n: int, bucket: int, buckets: int) -> bytes:
    """The ordered keys of a bucket's n-grams by their steps, or whole if that is less.

    Places are counted from the bucket's least key; those of longer n-grams lose their last
    bits where they would take more than SENT_LONG bytes.
    """
    widest, width = (1 << 64) // buckets + (1 << 32), 8 if n == 1 else SENT_LONG
    cut = max(0, min(64, widest.bit_length()) - 8 * width)
    places = (keys - np.uint64(-(-(bucket << 32) // buckets) << 32)) >> np.uint64(cut)
    steps = pack(np.diff(places, prepend=np.uint64(0)))
    if len(steps) < width * len(keys):
        return b"\1" + steps
    return b"\0" + places.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def received_keys(data: bytes, n: int) -> np.ndarray:
    """The numbers that sent_keys() has sent: the keys' places in their bucket."""
    if data[0]:
        return np.cumsum(unpack(data[1:], "<u8"), dtype=np.uint64)
    width = 8 if n == 1 else SENT_LONG
    parts = np.frombuffer(data, np.uint8, offset=1).reshape(-1, width)
    whole = np.zeros((len(parts), 8), np.uint8)
    whole[:, :width] = parts
    return whole.view("<u8").ravel()


def count_block(block: int, held: Block, order: int, buckets: int) -> Iterator[tuple]:
    """Rows of COUNTED: the block's n-grams, with counts in the documents learnt from."""
    for n, at, keys, which in held.grams(order):
        counts = held.learnt(at, which, len(keys)).astype("<u8")
        bucket = buckets_of(keys, buckets)
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            sent = sent_keys(keys[a:b], n, int(bucket[a]), buckets)
            yield n, int(bucket[a]), block, sent, pack(counts[a:b])


TOTALS = (
    "n int, bucket bigint, block bigint, others binary, "
    "tokens bigint, types bigint, once bigint, power double"
)


def add_up(rows: pa.Table) -> pa.Table:
    """Counts of one bucket's n-grams in other blocks, for each block in its keys' order.

    Most n-grams of a block are in no other, so these numbers take far less than totals,
    which a block gets by adding its own counts. The first row also has what the model needs of all: the sum of the totals, how many
    n-grams have one, how many have 1, and the sum of their powers NOVELTY.
    """
    n = rows.column("n")[0].as_py()
    parts = [received_keys(k.as_py(), n) for k in rows.column("keys")]
    counts = [unpack(c.as_py(), "<u8") for c in rows.column("counts")]
    keys, which = np.unique(np.concatenate(parts), return_inverse=True)
    totals = np.zeros(len(keys), np.int64)
    np.add.at(totals, which, np.concatenate(counts).astype(np.int64))
    ends = np.cumsum([len(p) for p in parts])
    back = [
        pack((totals[w] - own.astype(np.int64)).astype("<u8"))
        for w, own in zip(np.split(which, ends[:-1]), counts, strict=True)
    ]
    seen = totals[totals > 0]
    stats = [int(seen.sum()), len(seen), int((seen == 1).sum()), float((seen**NOVELTY).sum())]
    first = [[s] + [0] * (len(parts) - 1) for s in stats]
    return pa.table(
        {
            "n": rows.column("n"),
            "bucket": rows.column("bucket"),
            "block": rows.column("block"),
            "others": pa.array(back, pa.binary()),
            "tokens": pa.array(first[0], pa.int64()),
            "types": pa.array(first[1], pa.int64()),
            "once": pa.array(first[2], pa.int64()),
            "power": pa.array(first[3], pa.float64()),
        }
    )


@dataclass(frozen=True)
class Model:
    """What all blocks share of the automaton."""

    order: int
    tokens: int
    types: int
    documents: int
    #: By order, the factor of the share that a context leaves to unseen followers.
    factor: tuple[float, ...]

    def share(self, n: int, context: np.ndarray) -> np.ndarray:
        """The weight of the failure arc of a state for contexts of n - 1 words."""
        return np.clip(self.factor[n] * np.maximum(context, 1) ** (NOVELTY - 1), 1e-6, 0.999)


class Automaton:
    """The arcs that a block's texts can take.

    A state is a context of up to order - 1 words that occurs in the documents learnt
    from. arcs[n] has, for each token, the log-probability on the arc of the n-gram that
    ends there, or NaN where the state of its context has no such arc. fail[n] has the
    weight of that state's failure arc, to the state of the context without its first word.
    """

    def __init__(self, held: Block, others: dict[int, np.ndarray], model: Model):
        size = len(held.hashes)
        probability, before = np.ones(size), np.zeros(size, np.int64)
        self.known = np.zeros(size, bool)
        self.arcs, self.fail = [None], [None, None]
        for n, at, keys, which in held.grams(model.order):
            count = np.zeros(size, np.int64)
            count[at] = (others[n] + held.learnt(at, which, len(keys)))[which]
            if n == 1:
                self.known[at] = count[at] > 0
                smooth = model.tokens + 0.5 * (model.types + 1)
                probability[at] = (count[at] + 0.5) / smooth
                self.base = np.log10(probability)
                self.arcs.append(self.base)
            else:
                context = np.concatenate([[0], before[:-1]])
                share = model.share(n, context)
                state = np.zeros(size, bool)
                state[at] = context[at] > 0
                mixed = (1 - share) * count / np.maximum(context, 1) + share * probability
                probability = np.where(state, mixed, probability)
                self.arcs.append(np.where(state & (count > 0), np.log10(probability), np.nan))
                self.fail.append(np.log10(share))
            before = count
            if n == 1:
                before[held.begin] = model.documents
        self.longest = model.order - 1
        self.start = 1 if model.documents and model.order > 1 else 0

    def score(self, begin: int, length: int) -> float:
        """Walk one text from left to right, carrying the state as its context's length."""
        span = slice(begin + 1, begin + 1 + length)
        arcs = [a[span].tolist() if a is not None else [] for a in self.arcs]
        fail = [f[span].tolist() if f is not None else [] for f in self.fail]
        known, longest = self.known[span].tolist(), self.longest
        state, total = self.start, 0.0
        for i in range(length):
            n = state + 1
            while (arc := arcs[n][i]) != arc:
                total += fail[n][i]
                n -= 1
            total += arc
            state = min(n, longest) if known[i] else 0
        return total


SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)


def score_block(row: dict, others: dict[int, np.ndarray], model: Model) -> list[tuple]:
    held = Block.of(row)
    automaton = Automaton(held, others, model)
    rows = []
    for doc_id, train, begin, length in zip(
        held.doc_id, held.train.tolist(), held.begin.tolist(), held.lengths.tolist(), strict=True
    ):
        span = slice(begin + 1, begin + 1 + length)
        rows.append(
            (
                doc_id, not train, length, int(automaton.known[span].sum()), model.tokens,
                math.fsum(automaton.base[span]), automaton.score(begin, length),
            )
        )
    return rows


def backoff_scores(
    docs: DataFrame,
    *,
    order: int = 3,
    folds: int = 5,
    held_fold: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of docs, with the columns of SCORES.

    The model learns from rows whose crc32(doc_id as text) mod folds isn't held_fold, and
    scores all. With c the counts in these, N tokens and V distinct ones, a word has
    P1(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)), which leaves a share to one unknown word, and
    after a context h that occurs
        Pn(w | h) = (1 - g(h)) c(hw) / c(h) + g(h) Pn-1(w | h without its first word).
    g(h) = f c(h) ** (NOVELTY - 1), with f such that all contexts together leave as much
    as the n-grams that occur once make up: what Good and Turing expect of unseen ones. So
    each state's arcs and its failure arc are a distribution over all words and the
    unknown one. base_score sums log10 P1, score log10 of the whole model.

    Documents are packed into blocks, and written as such. A block sends its distinct
    n-grams to buckets, ranges of hashes whose number follows the corpus; a bucket adds up
    and returns the counts of other blocks in the order received; a block then has every
    arc that its texts can take, and walks them. An n-gram comes from a block once however often it occurs
    there, so no key is hot, and neither a bucket nor a block grows with the corpus. Words
    are told apart by 64 bits, longer n-grams by SENT_LONG bytes within their bucket.

    A null or empty text is its end alone. A row with a null id is learnt from. Repeated
    rows count and are scored once each, an empty table gives no rows, a table without
    rows to learn from gives every token the probability of the unknown word. Other
    columns are ignored.
    """
    fold = F.crc32(F.col(id_col).cast("string")) % folds
    learn = F.coalesce(fold != held_fold, F.lit(True))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), learn.alias("train"), F.col(text_col).alias("text")
    )
    blocks = written(blocks_of(rows), "blocks")
    sums = blocks.agg(
        F.sum("n_tokens").alias("tokens"),
        F.sum(F.size(F.filter("train", lambda t: t))).alias("documents"),
    ).first()
    buckets = 1 + (sums["tokens"] or 0) // BUCKET_KEYS
    counted = pa.schema(
        [("n", pa.int32()), ("bucket", pa.int64()), ("block", pa.int64())]
        + [("keys", pa.binary()), ("counts", pa.binary())]
    )

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = list(count_block(row["block"], Block.of(row), order, buckets))
                columns = [pa.array([r[k] for r in found], f.type) for k, f in enumerate(counted)]
                yield pa.RecordBatch.from_arrays(columns, schema=counted)

    totals = blocks.mapInArrow(count, COUNTED).groupBy("n", "bucket").applyInArrow(add_up, TOTALS)
    totals = written(totals, "totals")
    stats = {
        r["n"]: r
        for r in totals.groupBy("n")
        .agg(*(F.sum(c).alias(c) for c in ("tokens", "types", "once", "power")))
        .collect()
    }
    factor = [0.0, 0.0]
    for n in range(2, order + 1):
        power = stats[n - 1]["power"] if n - 1 in stats else 0.0
        power += (sums["documents"] or 0) ** NOVELTY if n == 2 else 0.0
        factor.append(stats[n]["once"] / power if power and n in stats else 0.5)
    words = stats.get(1)
    model = Model(
        order,
        words["tokens"] if words else 0,
        words["types"] if words else 0,
        sums["documents"] or 0,
        tuple(factor),
    )

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by([("n", "ascending"), ("bucket", "ascending")])
        held: dict[int, list[np.ndarray]] = {n: [] for n in range(1, order + 1)}
        for n, data in zip(right.column("n").to_pylist(), right.column("others"), strict=True):
            held[n].append(unpack(data.as_py(), "<u8").astype(np.int64))
        joined = {n: np.concatenate(v) if v else np.zeros(0, np.int64) for n, v in held.items()}
        rows = [r for row in left.to_pylist() for r in score_block(row, joined, model)]
        types = [pa.int64(), pa.bool_()] + [pa.int64()] * 3 + [pa.float64()] * 2
        names = [part.split()[0] for part in SCORES.split(", ")]
        return pa.table(
            {c: pa.array([r[k] for r in rows], types[k]) for k, c in enumerate(names)}
        )

    delivered = totals.select("n", "bucket", "block", "others")
    return blocks.groupBy("block").cogroup(delivered.groupBy("block")).applyInArrow(score, SCORES)
