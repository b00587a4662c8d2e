import math
import zlib
from collections import Counter

import pytest

from newsprep.llm import lm_scoring
from newsprep.llm.queries import QUERIES
from tests.llm.rows import AWKWARD, approx, documents, given


def tokens_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = lower.encode().split()
    return [*words, b"</s>"]


def learns(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 != 1


class Brute:
    """The definition of the model, by dictionaries of whole n-grams."""

    def __init__(self, rows, order):
        self.order, self.counts = order, [Counter() for _ in range(order + 1)]
        train = [t for d, t in rows if learns(d)]
        for text in train:
            seq = [b"<s>", *tokens_of(text)]
            for i in range(1, len(seq)):
                for n in range(1, min(order, i + 1) + 1):
                    self.counts[n][tuple(seq[i - n + 1 : i + 1])] += 1
        self.n, self.v = sum(self.counts[1].values()), len(self.counts[1])
        contexts = Counter(self.counts[1])
        if train:
            contexts[(b"<s>",)] = len(train)
        self.contexts = [None, None, contexts, *self.counts[2:]]
        self.factor = [0, 0]
        for n in range(2, order + 1):
            power = sum(c**lm_scoring.NOVELTY for c in self.contexts[n].values())
            once = sum(c == 1 for c in self.counts[n].values())
            self.factor.append(once / power if power else 0.5)

    def p(self, context, word):
        if not context:
            return (self.counts[1][(word,)] + 0.5) / (self.n + 0.5 * (self.v + 1))
        lower = self.p(context[1:], word)
        n = len(context) + 1
        held = self.contexts[n][context]
        if not held:
            return lower
        share = min(0.999, max(1e-6, self.factor[n] * held ** (lm_scoring.NOVELTY - 1)))
        return (1 - share) * self.counts[n][(*context, word)] / held + share * lower

    def row(self, doc_id, text):
        seq = [b"<s>", *tokens_of(text)]
        score = base = 0.0
        for i in range(1, len(seq)):
            base += math.log10(self.p((), seq[i]))
            score += math.log10(self.p(tuple(seq[max(0, i - self.order + 1) : i]), seq[i]))
        known = sum(self.counts[1][(w,)] > 0 for w in seq[1:])
        return doc_id, not learns(doc_id), len(seq) - 1, known, self.n, base, score


def key(row):
    return tuple((v is not None, round(v, 6) if v is not None else 0) for v in row)


@pytest.mark.parametrize(("order", "parts"), [(1, 2), (2, 1), (2, 6), (3, 3)])
def test_against_definition(spark, small, order, parts, monkeypatch):
    rows = AWKWARD + given(spark, small, 60)
    brute = Brute(rows, order)
    scored = lm_scoring.backoff_scores(documents(spark, rows).repartition(parts), order=order)
    ours = sorted((tuple(r) for r in scored.collect()), key=key)
    theirs = sorted((brute.row(*r) for r in rows), key=key)
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs, strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == approx(b[5:], rel=1e-9)


def test_each_state_is_a_distribution(spark, small):
    rows = given(spark, small, 20)
    brute = Brute(rows, 3)
    words = [w for (w,) in brute.counts[1]]
    for context in list(brute.counts[2])[:5] + [(b"<s>",), (b"never",)]:
        # All words, and once the unknown one.
        total = sum(brute.p(context, w) for w in words) + brute.p(context, b"\xff")
        assert total == approx(1)


def test_small_blocks_and_buckets_change_nothing(spark, small, monkeypatch):
    """A block's and a bucket's share of the work is not to be seen in the result."""
    monkeypatch.setattr(lm_scoring, "BUCKET_KEYS", 500)
    rows = given(spark, small, 40)
    docs = documents(spark, rows)
    one = sorted(map(tuple, lm_scoring.backoff_scores(docs.repartition(1)).collect()))
    many = sorted(map(tuple, lm_scoring.backoff_scores(docs.repartition(13)).collect()))
    for a, b in zip(one, many, strict=True):
        assert a == approx(b, rel=1e-9)


def test_buckets_add_up():
    import numpy as np
    import pyarrow as pa

    keys = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 1000, np.uint64))
    bucket = lm_scoring.buckets_of(keys, 7)
    assert (np.diff(bucket) >= 0).all() and 0 <= bucket.min() and bucket.max() < 7
    sent = lm_scoring.sent_keys(keys[:6], 1, 0, 1), lm_scoring.sent_keys(keys[3:9], 1, 0, 1)
    counts = np.arange(6, dtype="<u8"), np.ones(6, "<u8")
    table = pa.table(
        {
            "n": [1, 1], "bucket": [0, 0], "block": [8, 9],
            "keys": list(sent), "counts": [lm_scoring.pack(c) for c in counts],
        }
    )
    out = lm_scoring.add_up(table).to_pylist()
    assert lm_scoring.unpack(out[0]["others"], "<u8").tolist() == [0, 0, 0, 1, 1, 1]
    assert lm_scoring.unpack(out[1]["others"], "<u8").tolist() == [3, 4, 5, 0, 0, 0]
    assert (out[0]["tokens"], out[0]["types"], out[0]["once"]) == (21, 8, 4)


def test_empty_and_nothing_to_learn(spark):
    assert lm_scoring.backoff_scores(documents(spark, [])).count() == 0
    held = next(i for i in range(100) if not learns(i))
    rows = lm_scoring.backoff_scores(documents(spark, [(held, "a b")])).collect()
    assert [tuple(r)[1:5] for r in rows] == [(True, 3, 0, 0)]
    assert rows[0]["score"] == approx(rows[0]["base_score"]) == approx(0.0)


def test_query_scores_with_two_words_of_context(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    brute = Brute(rows, 3)
    found = {r["doc_id"]: tuple(r) for r in QUERIES["op2_backoff_automaton"](spark, small).collect()}
    for doc_id, text in rows[::20]:
        assert found[doc_id] == approx(brute.row(doc_id, text), rel=1e-9)


@pytest.mark.parametrize("buckets", [1, 7, 1000, 1 << 20])
def test_sent_keys_come_back(buckets):
    import numpy as np

    keys = np.unique(np.random.default_rng(2).integers(0, 1 << 64, 5000, np.uint64))
    bucket = lm_scoring.buckets_of(keys, buckets)
    for b in np.unique(bucket)[:50]:
        own = keys[bucket == b]
        # Words come back exactly, as places in their bucket.
        words = lm_scoring.received_keys(lm_scoring.sent_keys(own, 1, int(b), buckets), 1)
        least = -(-(int(b) << 32) // buckets) << 32
        assert (words + np.uint64(least)).tolist() == own.tolist()
        sent = lm_scoring.sent_keys(own, 3, int(b), buckets)
        back = lm_scoring.received_keys(sent, 3)
        assert len(sent) <= 1 + lm_scoring.SENT_LONG * len(own)
        assert len(back) == len(own) and (np.diff(back.astype(object)) > 0).all()
        assert int(back.max()) < 1 << 48
