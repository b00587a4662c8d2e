"""Toxicity by nearest labelled examples: exact TF-IDF cosine on a block-max index."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsprep.llm.decontamination import words_of
from newsprep.llm.shared import utf8, written

#: Examples of each label that are learnt from.
EXAMPLES = 4000
#: Words in more than this share of the examples also lie in a matrix.
FREQUENT = 0.06
#: Words with more blocks than this share of their postings are added up without bounds.
THIN = 0.35
#: What the weight of a word that is no rarer among clean examples than elsewhere is
#: multiplied by; one that is adds the logarithm of how much rarer.
LEAST_CONTRAST = 0.05
#: Neighbours that vote, examples in a block.
NEIGHBOURS, BLOCK = 50, 32
#: Texts that are scored together.
TOGETHER = 64
#: By how much sums in another order may differ.
SLACK = 1e-8


def training_ids(labels: DataFrame, id_col: str, label_col: str, examples: int) -> DataFrame:
    """(doc_id, toxic, total): at most so many ids of each label, chosen by a hash.

    Rows whose crc32(doc_id as text) mod 3 is 1 are never taken. An id with several labels
    is toxic if one says so; null ids and labels are passed over. total is the number of
    ids with that label.
    """
    usable = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
        .dropna()
        .filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    totals = usable.groupBy("toxic").agg(F.count("*").alias("total"))
    chosen = [
        usable.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id")).limit(examples)
        for label in (0, 1)
    ]
    return chosen[0].union(chosen[1]).join(F.broadcast(totals), "toxic")


def spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from each start to before its end, and how many these are."""
    n = end - start
    before = np.cumsum(n)
    found = np.arange(int(before[-1]) if len(n) else 0)
    found += np.repeat(start - (before - n), n)
    return found, n


#: Numbers of terms, and how often a text has them.
Counts = tuple[np.ndarray, np.ndarray]


class Index:
    """Every word of the examples with postings, in blocks whose greatest weights are known.

    Only what the examples have is held by the driver and sent to tasks; weights,
    postings, blocks and the matrix of frequent words are laid out there. Examples of one
    label that owe most of their length to the same word lie side by side, so that few
    blocks have much in common with a text.
    """

    def __init__(
        self, words: pa.Array, idf: np.ndarray, label: np.ndarray,
        doc_id: np.ndarray, sizes: np.ndarray, has: np.ndarray, times: np.ndarray,
    ):
        self.words, self.idf = words, idf
        self.label, self.doc_id = label, doc_id
        #: Blocks that searches have scored, and those they could have.
        self.blocks_scored = self.blocks_seen = 0
        #: By example: where its terms begin; by term of an example: its number and count.
        self.has_start = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        self.has, self.times = has, times

    def __setstate__(self, state: dict) -> None:
        self.__dict__ = state
        self.lay_out()

    def lay_out(self) -> None:
        n, terms = len(self.label), len(self.idf)
        self.terms = _numbers(self.words)
        example = np.repeat(np.arange(n, dtype=np.int32), np.diff(self.has_start))
        weight = (1 + np.log(self.times)) * self.idf[self.has]
        length = np.sqrt(np.bincount(example, weight * weight, n))
        self.has_weight = weight / np.maximum(length, 1e-12)[example]
        order = np.argsort(self.has, kind="stable")
        term = self.has[order]
        #: By term: where its postings begin; by posting: example and weight. What numpy
        #: takes as an index has the width of its own, so that no search converts it.
        self.start = np.searchsorted(term, np.arange(terms + 1))
        self.example, self.weight = example[order].astype(np.intp), self.has_weight[order]
        key = term.astype(np.int64) * (n // BLOCK + 1) + self.example // BLOCK
        first = np.flatnonzero(np.diff(key, prepend=-1))
        #: By term: where its blocks begin; by block: its number, greatest weight and postings.
        self.block_start = np.searchsorted(term[first], np.arange(terms + 1))
        self.block = self.example[first] // BLOCK
        self.block_max = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)
        self.block_from = np.append(first, len(term))
        #: By term: does a block hold so few of its postings that a bound saves nothing?
        self.thin = THIN * np.diff(self.start) < np.diff(self.block_start)
        #: By term: its row of the matrix, or -1.
        often = np.flatnonzero(np.diff(self.start) > FREQUENT * n)
        self.row = np.full(terms, -1)
        self.row[often] = np.arange(len(often))
        self.matrix = np.zeros((len(often), n))
        at = self.row[term] >= 0
        self.matrix[self.row[term[at]], self.example[at]] = self.weight[at]

    def counts(self, example: int) -> Counts:
        at = slice(self.has_start[example], self.has_start[example + 1])
        return self.has[at], self.times[at]

    def weights(self, counts: Counter | Counts) -> Counts:
        """Terms and weights of a text of unit length."""
        if isinstance(counts, Counter):
            ids = np.fromiter(counts.keys(), np.int64, len(counts))
            counts = ids, np.fromiter(counts.values(), np.int64, len(counts))
        ids, times = counts
        w = (1 + np.log(times)) * self.idf[ids]
        return ids, w / max(1e-12, math.sqrt(float(w @ w)))

    def frequent(self, texts: list[Counts]) -> np.ndarray:
        """By text and example, what frequent terms add to the cosine."""
        queries = np.zeros((len(texts), len(self.matrix)))
        for i, (ids, w) in enumerate(texts):
            row = self.row[ids]
            queries[i, row[row >= 0]] = w[row >= 0]
        return queries @ self.matrix

    def nearest(
        self,
        ids: np.ndarray,
        w: np.ndarray,
        k: int,
        without: int = -1,
        frequent: np.ndarray | None = None,
    ) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of greatest cosine above 0, and their cosines; least first on ties.

        What frequent words add is known for every example, and words whose postings lie
        alone in their blocks are added outright; bounds of blocks are summed for the
        others. Blocks are scored by falling bound until no other's reaches the
        k-th cosine. What is left out can't be among the k, so the result is that of a full
        comparison, cosines being equal if their first nine digits are.
        """
        n = len(self.label)
        blocks = -(-n // BLOCK)
        score = np.zeros(blocks * BLOCK)
        score[:n] = whole = self.frequent([(ids, w)])[0] if frequent is None else frequent
        rare = self.row[ids] < 0
        thin = rare & self.thin[ids]
        place, times = spans(self.start[ids[thin]], self.start[ids[thin] + 1])
        gains = np.repeat(w[thin], times)
        gains *= self.weight[place]
        score += np.bincount(self.example[place], gains, len(score))
        rare &= ~thin
        at, times = spans(self.block_start[ids[rare]], self.block_start[ids[rare] + 1])
        q, block = np.repeat(w[rare], times), self.block[at]
        bound = score.reshape(blocks, BLOCK).max(axis=1)
        bound += np.bincount(block, q * self.block_max[at], blocks)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        scored = np.zeros(blocks, bool)

        def add(chosen: np.ndarray) -> float:
            """Score these blocks too, and return the k-th score of all so far."""
            wanted = np.zeros(blocks, bool)
            wanted[chosen] = scored[chosen] = True
            inside = wanted[block]
            entry = at[inside]
            place, times = spans(self.block_from[entry], self.block_from[entry + 1])
            gains = np.repeat(q[inside], times)
            gains *= self.weight[place]
            score[:] += np.bincount(self.example[place], gains, len(score))
            if without >= 0:
                score[without] = 0
            held = score.reshape(blocks, BLOCK)[scored].ravel()
            return np.partition(held, -k)[-k] if len(held) >= k else 0.0

        # A few blocks, then all that can still hold a neighbour.
        least, done, few = 0.0, 0, 8 + 4 * k // BLOCK
        for step in (few, blocks):
            some = order[done : done + step]
            if not len(some) or bound[some[0]] < least - SLACK:
                break
            least = add(some[bound[some] >= least - SLACK])
            done += step
        self.blocks_scored, self.blocks_seen = self.blocks_scored + int(scored.sum()), self.blocks_seen + blocks
        score.reshape(blocks, BLOCK)[~scored] = 0
        found = np.flatnonzero((score > 0) & (score >= least - SLACK))
        # Sums in another order differ in their last digits, which must not decide.
        best = np.lexsort((found, -np.round(score[found], 9)))[:k]
        return found[best], score[found[best]]


def vote(index: Index, near: np.ndarray, cosine: np.ndarray) -> float:
    """The logit of the share that label 1 has of the neighbours, each counted by its cosine."""
    toxic = float((cosine * index.label[near]).sum())
    slack = 0.01 * float(cosine.sum())
    return math.log((toxic + slack) / (float(cosine.sum()) - toxic + slack))


def votes_of(
    index: Index, texts: list[Counts], k: int, without: list[int] | None = None
) -> Iterator[tuple[float | None, list]]:
    """(vote, evidence) of each text, TOGETHER at a time; without has their own numbers.

    The vote is None if no example has a word of the text.
    """
    for start in range(0, len(texts), TOGETHER):
        some = texts[start : start + TOGETHER]
        weighed = [index.weights(counts) for counts in some]
        frequent = index.frequent(weighed)
        for i, (ids, w) in enumerate(weighed):
            own = without[start + i] if without else -1
            near, cosine = index.nearest(ids, w, k, own, frequent[i])
            if len(near):
                evidence = zip(index.doc_id[near].tolist(), cosine.tolist(), strict=True)
                yield vote(index, near, cosine), list(evidence)
            else:
                yield None, []


@dataclass
class Scorer:
    index: Broadcast | None
    weights: np.ndarray
    #: The score of texts without a word of an example.
    empty: float
    k: int

    def score(self, texts: list[Counts]) -> Iterator[tuple[float, list]]:
        if self.index is None:
            yield from ((self.empty, []) for _ in texts)
            return
        for x, evidence in votes_of(self.index.value, texts, self.k):
            if x is None:
                yield self.empty, []
                continue
            z = float(self.weights @ (1.0, x))
            yield 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), evidence


def _vocabulary(examples: DataFrame) -> pa.Table:
    """(term, a, b): every word, and how many examples of label 1 and 0 have it."""
    out = pa.schema([("term", pa.string()), ("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(utf8(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                counts[label].update({w.decode("utf-8", "replace") for w in words_of(text)})
        terms = list(counts[0] | counts[1])
        columns = [
            pa.array(terms, pa.string()),
            pa.array([counts[1][t] for t in terms], pa.int64()),
            pa.array([counts[0][t] for t in terms], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=out)

    found = examples.select("text", "toxic").mapInArrow(run, "term string, a bigint, b bigint")
    found = found.groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return found.toArrow().sort_by("term")


def contrast(clean: np.ndarray, n_clean: int, totals: np.ndarray, documents: int) -> np.ndarray:
    """By word, the logarithm of how much rarer it is in clean examples than in all
    documents, 0 if it is not, and LEAST_CONTRAST more."""
    rarer = np.log((1 + n_clean) / (1 + clean)) - np.log((1 + documents) / (1 + totals.astype(float)))
    return LEAST_CONTRAST + np.maximum(rarer, 0)


def _counter(terms: dict[bytes, int]):
    """A function from a text to the numbers and counts of the words that are terms."""

    def count(text: bytes) -> Counts:
        held = [i for i in map(terms.get, words_of(text)) if i is not None]
        ids, times = np.unique(np.array(held, np.int32), return_counts=True)
        return ids, times

    return count


def _numbers(words: pa.Array) -> dict[bytes, int]:
    return {w: i for i, w in enumerate(words.cast(pa.binary()).to_pylist())}


def _document_counts(texts: DataFrame, terms: Broadcast) -> tuple[np.ndarray, int]:
    """By term, the rows of texts that have it; and the number of rows."""
    out = pa.schema([("term", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows = _numbers(terms.value).get, 0
        totals = np.zeros(len(terms.value), np.int64)
        for batch in batches:
            rows += batch.num_rows
            for text in utf8(batch.column(0)):
                totals[[i for i in map(number, set(words_of(text))) if i is not None]] += 1
        has = np.flatnonzero(totals)
        columns = [pa.array([-1, *has], pa.int32()), pa.array([rows, *totals[has]], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, schema=out)

    found = texts.select("text").mapInArrow(run, "term int, n bigint")
    found = found.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    totals = np.zeros(len(terms.value) + 1, np.int64)
    totals[found.column("term").to_numpy()] = found.column("n").to_numpy()
    return totals[:-1], int(totals[-1])


def weights_of_terms(documents: int, totals: np.ndarray) -> np.ndarray:
    return np.log((1 + documents) / (1 + totals.astype(float))) + 1


def _postings(rows: list[tuple[int, int, Counter]], terms: list[tuple[str, int]]) -> Index:
    """An index of rows that are all documents there are, laid out."""
    columns = [np.array([r[c] for r in rows]) for c in (1, 0)]
    sizes = np.array([len(r[2]) for r in rows])
    has = np.array([t for r in rows for t in r[2]], np.int32)
    times = np.array([c for r in rows for c in r[2].values()], np.int32)
    idf = weights_of_terms(len(rows), np.array([n for _, n in terms]))
    words = pa.array([t for t, _ in terms], pa.string())
    index = Index(words, idf, *columns, sizes, has, times)
    index.lay_out()
    return index


#: What the driver gets of an example: numbers of terms and counts as 32-bit numbers.
EXAMPLE = "doc_id bigint, toxic int, size bigint, terms binary, counts binary"


def _example_rows(examples: DataFrame, terms: Broadcast) -> pa.Table:
    """EXAMPLE of each example: a term once, however often the text has it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(_numbers(terms.value))
        for batch in batches:
            found = [count(t) for t in utf8(batch.column(2))]
            columns = [
                batch.column(0),
                batch.column(1),
                pa.array([len(ids) for ids, _ in found], pa.int64()),
                pa.array([ids.astype("<i4").tobytes() for ids, _ in found], pa.binary()),
                pa.array([times.astype("<i4").tobytes() for _, times in found], pa.binary()),
            ]
            names = [part.split()[0] for part in EXAMPLE.split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names)

    selected = examples.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic", "text")
    return selected.mapInArrow(run, EXAMPLE).toArrow().sort_by("doc_id")


def in_blocks(rows: pa.Table, weights: np.ndarray) -> pa.Table:
    """The examples by label and by the word that most of their length comes from."""
    main = []
    for ids, times in zip(rows.column("terms"), rows.column("counts")):
        own = np.frombuffer(ids.as_buffer(), "<i4")
        gain = (1 + np.log(np.frombuffer(times.as_buffer(), "<i4"))) * weights[own]
        main.append(int(own[np.argmax(gain)]) if len(own) else -1)
    return rows.take(np.lexsort((rows.column("doc_id").to_numpy(), main, rows.column("toxic").to_numpy())))


def fit(examples: DataFrame, texts: DataFrame, k: int = NEIGHBOURS) -> Scorer:
    """Fit to examples (doc_id, text, toxic, total), whose number training_ids() bounds.

    Words are counted by Spark, in the examples and in all of texts, whose counts weigh
    them. The index holds all examples and all their terms; it reaches the driver as
    numbers of terms with counts, at most 2 * EXAMPLES rows of a text's distinct terms.
    Votes are calibrated on the examples, each scored without itself, by a logistic
    regression in which an example stands for total / examples rows of its label.
    """
    n = {0: 0, 1: 0}
    weight = {0: 0.0, 1: 0.0}
    for r in examples.groupBy("toxic").agg(F.count("*").alias("n"), F.max("total").alias("t")).collect():
        n[r["toxic"]], weight[r["toxic"]] = r["n"], r["t"] / r["n"]
    base = n[1] * weight[1] / max(1.0, n[0] * weight[0] + n[1] * weight[1])
    if not (n[0] and n[1]) or not (found := _vocabulary(examples)).num_rows:
        return Scorer(None, np.zeros(2), base, k)
    words = found.column("term").combine_chunks()
    context = examples.sparkSession.sparkContext
    sent = context.broadcast(words)
    totals, documents = _document_counts(texts, sent)
    rows = _example_rows(examples, sent)
    idf = weights_of_terms(documents, totals)
    idf *= contrast(found.column("b").to_numpy(), n[0], totals, documents)
    rows = in_blocks(rows, idf)
    label, doc_id, sizes = (rows.column(c).to_numpy() for c in ("toxic", "doc_id", "size"))
    has, times = (
        np.concatenate([np.frombuffer(v.as_buffer(), "<i4") for v in rows.column(c)])
        for c in ("terms", "counts")
    )
    index = context.broadcast(Index(words, idf, label, doc_id, sizes, has, times))
    del rows, has, times

    def calibrate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            values = [x for x, _ in votes_of(own, [own.counts(i) for i in ids], k, ids)]
            columns = [batch.column(0), pa.array(values, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["example", "x"])

    numbers = examples.sparkSession.range(0, len(label), 1, context.defaultParallelism)
    seen = numbers.mapInArrow(calibrate, "example bigint, x double").toArrow()
    x, y, s, without = [], [], [], {0: 0, 1: 0}
    for i, values in sorted(zip(seen.column("example").to_pylist(), seen.column("x").to_pylist(), strict=True)):
        if values is not None:
            x.append([1.0, values])
            y.append(int(label[i]))
            s.append(weight[int(label[i])])
        else:
            without[int(label[i])] += 1
    held = [(without[label] + 0.5) * weight[label] for label in (0, 1)]
    empty = held[1] / sum(held)
    x, y, s = np.array(x).reshape(-1, 2), np.array(y, float), np.array(s)
    weights, penalty = np.zeros(2), np.diag([1e-6, 1e-2])
    for _ in range(40 if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (s * (y - p)) - penalty @ weights
        curve = (x * (s * p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        weights += step / max(1.0, np.abs(step).max() / 5)
    return Scorer(index, weights, empty, k)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    threshold: float = 0.7,
    examples: int = EXAMPLES,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    evidence: int = 3,
) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted, neighbours.

    A text's terms are its words, as far as an example has them. Their weights follow from
    how often the text has them, from the number of all rows of docs with them, and from
    how much rarer they are among clean examples than in all rows: words of a subject say
    little here, words that clean text avoids say much. The NEIGHBOURS nearest examples by
    cosine of these TF-IDF weights vote, each by its cosine; of examples equally near the
    one that comes first in the index, by label, main word and id, is nearer. The share of
    label 1 in the vote is all that a score sees; it is calibrated to a probability.
    neighbours names the nearest examples and their cosines. held_out says that the row's
    label could not be learnt from.

    At most examples ids of each label are learnt from; every document is scored by all of
    these, exactly. The model is broadcast: its size is bounded by the examples' texts and
    nothing that grows with docs. Shuffled are the examples, and for each task the number
    of its rows with each of their terms.

    A null or empty text, or one without a word of an example, gets the share of toxic among such
    examples; without examples of both labels all get the share of label 1. A row of docs
    with a null id is scored and not held out. Repeated rows get equal scores, an empty
    table gives no rows, other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    chosen = written(training_ids(labels, id_col, label_col, examples), "chosen")
    # One row for each id: a document that repeats is one example.
    learnt = rows.join(F.broadcast(chosen), "doc_id")
    learnt = learnt.groupBy("doc_id", "toxic", "total").agg(F.max("text").alias("text"))
    scorer = fit(written(learnt, "examples"), rows)
    pair = pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64())])
    out = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())]
        + [("predicted", pa.int32()), ("neighbours", pa.list_(pair))]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(scorer.index.value.terms if scorer.index else {})
        for batch in batches:
            scores, near = [], []
            texts = utf8(batch.column(2))
            while some := [count(t) for t in islice(texts, TOGETHER)]:
                for score, found in scorer.score(some):
                    scores.append(score)
                    near.append([{"doc_id": d, "cosine": c} for d, c in found[:evidence]])
            columns = [batch.column(0), batch.column(1), pa.array(scores, pa.float64())]
            columns.append(pa.array([int(s >= threshold) for s in scores], pa.int32()))
            columns.append(pa.array(near, out.field(4).type))
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return rows.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), held_out.alias("held_out"), "text"
    ).mapInArrow(
        run,
        "doc_id bigint, held_out boolean, score double, predicted int, "
        "neighbours array<struct<doc_id: bigint, cosine: double>>",
    )
