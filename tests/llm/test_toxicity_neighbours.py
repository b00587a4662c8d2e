import math
import pickle
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsprep.llm import toxicity_neighbours as N
from tests.llm.rows import AWKWARD, CLASHING, documents


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def tables(spark, folder):
    return (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))


def test_held_out_accuracy(spark, small):
    docs, labels = tables(spark, small.replace("sf0.001", "sf0.1"))
    scored = N.score_toxicity(docs, labels).join(labels, "doc_id").toPandas()
    own = scored[scored["held_out"]]
    assert (own["held_out"] == own["doc_id"].map(held)).all()
    toxic, clean = own[own["toxic"] == 1], own[own["toxic"] == 0]
    assert (toxic["predicted"] == 1).mean() > 0.8
    assert (clean["predicted"] == 1).mean() < 0.01
    assert (scored["predicted"] == (scored["score"] >= 0.7)).all()
    # Scores are probabilities: about as many are toxic as they say.
    assert abs(own["score"].mean() - own["toxic"].mean()) < 0.03


def test_labels_of_other_folds_are_not_used(spark, small):
    docs, labels = tables(spark, small.replace("sf0.001", "sf0.01"))
    learnt = labels.filter("crc32(CAST(doc_id AS STRING)) % 3 <> 1")
    changed = labels.selectExpr(
        "doc_id", "quality",
        "CASE WHEN crc32(CAST(doc_id AS STRING)) % 3 = 1 THEN 1 - toxic ELSE toxic END AS toxic",
    )
    scores = [
        {r["doc_id"]: r["score"] for r in N.score_toxicity(docs, other).collect()}
        for other in (labels, learnt, changed)
    ]
    assert scores[0] == scores[1] == scores[2]


def small_index(seed=1, n=700, terms=40):
    rng = random.Random(seed)
    names = [(f"t{i}", rng.randrange(1, n)) for i in range(terms)]
    rows = []
    for i in range(n):
        picked = rng.choices(range(terms), weights=range(1, terms + 1), k=rng.randrange(1, 9))
        rows.append((i, rng.randrange(2), Counter(picked)))
    rows[10:20] = [(i, 1, rows[10][2]) for i in range(10, 20)]
    return N._postings(rows, names), rows


@pytest.mark.parametrize(("thin", "frequent"), [(0, 0.06), (0, 1), (0.35, 0.06), (0.35, 1), (2, 1)])
def test_block_max_search_is_exact(thin, frequent, monkeypatch):
    """With bounds for no word, for some and for all."""
    monkeypatch.setattr(N, "THIN", thin)
    monkeypatch.setattr(N, "FREQUENT", frequent)
    index, rows = small_index()
    assert thin == 0.35 or index.thin.any() == (thin == 0)
    dense = np.zeros((len(rows), len(index.idf)))
    for i, (_, _, counts) in enumerate(rows):
        ids, w = index.weights(counts)
        dense[i, ids] = w
    for i in range(0, len(rows), 7):
        ids, w = index.weights(rows[i][2])
        for k, without in ((1, -1), (25, -1), (25, i), (5000, -1)):
            query = np.zeros(len(index.idf))
            query[ids] = w
            cosine = np.round(dense @ query, 9)
            if without >= 0:
                cosine[without] = 0
            order = [j for j in np.lexsort((np.arange(len(rows)), -cosine)) if cosine[j] > 0][:k]
            near, found = index.nearest(ids, w, k, without)
            assert near.tolist() == order
            assert np.allclose(found, cosine[order])


def test_block_maxima_bound_their_blocks():
    index, _ = small_index(3)
    for t in range(len(index.idf)):
        at = slice(index.start[t], index.start[t + 1])
        blocks = index.example[at] // N.BLOCK
        own = slice(index.block_start[t], index.block_start[t + 1])
        assert index.block[own].tolist() == sorted(set(blocks.tolist()))
        for block, most in zip(index.block[own], index.block_max[own], strict=True):
            assert most == index.weight[at][blocks == block].max()


def test_awkward_rows(spark):
    rows = AWKWARD + [(1000 + i, f"vile nasty words {i % 7} here" if i % 3 == 0 else f"kind words {i}") for i in range(300)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame(
        [(1000 + i, int(i % 3 == 0)) for i in range(300)]
        + [(None, 1), (1, None), (2, 0), (5, 0), (5, 0), (99_999, 1)],
        "doc_id bigint, toxic int",
    ).selectExpr("*", *(f"'{c}' AS {c}" for c in CLASHING if c != "toxic"))
    scored = N.score_toxicity(docs, labels).collect()
    assert len(scored) == len(rows)
    assert all(0 <= r["score"] <= 1 and not math.isnan(r["score"]) for r in scored)
    by_id = {r["doc_id"]: r for r in scored if (r["doc_id"] or 0) >= 1000}
    assert all(r["predicted"] == int((d - 1000) % 3 == 0) for d, r in by_id.items())
    assert by_id[1000]["neighbours"][0]["cosine"] > 0.9
    assert len({(r["score"]) for r in scored if r["doc_id"] == 5}) == 1
    assert {r["held_out"] for r in scored if r["doc_id"] is None} == {False}


def test_one_label_or_none(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r["score"] for r in N.score_toxicity(docs, none).collect()} == {0.0}
    one = spark.createDataFrame([(3, 0), (5, 0), (6, 0)], "doc_id bigint, toxic int")
    assert {r["predicted"] for r in N.score_toxicity(docs, one).collect()} == {0}
    assert N.score_toxicity(documents(spark, []), one).count() == 0


def test_scores_are_those_of_a_full_comparison(spark):
    """Neighbours, votes, their calibration and the scores, from every pair of texts."""
    rng = random.Random(5)
    words = [f"word{i}x" for i in range(60)]
    rows = [(i, " ".join(rng.choices(words, k=12) + ["vile"] * (i % 4 == 0 and i % 3 > 0))) for i in range(160)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(130)], "doc_id bigint, toxic int")
    counts = [Counter(w.decode() for w in N.words_of(x.encode())) for _, x in rows]
    frequency = Counter(t for c in counts for t in c)
    examples = [i for i in range(130) if not held(i)]
    toxic = {i for i in examples if i % 4 == 0}
    clean = Counter(t for i in examples if i not in toxic for t in counts[i])
    known = sorted({t for i in examples for t in counts[i]})

    def weight(t):
        seen = (1 + len(rows)) / (1 + frequency[t])
        rarer = math.log((1 + len(examples) - len(toxic)) / (1 + clean[t])) - math.log(seen)
        return (math.log(seen) + 1) * (N.LEAST_CONTRAST + max(rarer, 0))

    weights = {t: weight(t) for t in known}

    def vector(i):
        w = {t: (1 + math.log(c)) * weights[t] for t, c in sorted(counts[i].items()) if t in weights}
        length = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / length for t, x in w.items()}

    vectors = [vector(i) for i in range(len(rows))]
    main = {i: max(vectors[i], key=lambda t: (round(vectors[i][t], 12), [-ord(c) for c in t])) for i in examples}
    order = sorted(examples, key=lambda j: (j in toxic, main[j], j))

    def near(i, without=None):
        own = vectors[i]
        cosine = {j: sum(x * vectors[j].get(t, 0) for t, x in own.items()) for j in order if j != without}
        best = sorted(cosine, key=lambda j: (-round(cosine[j], 9), order.index(j)))[: N.NEIGHBOURS]
        return [(j, cosine[j]) for j in best]

    def vote(found):
        yes, all_ = sum(c for j, c in found if j in toxic), sum(c for _, c in found)
        return math.log((yes + 0.01 * all_) / (all_ - yes + 0.01 * all_))

    x = np.array([[1.0, vote(near(i, without=i))] for i in sorted(examples)])
    y = np.array([float(i in toxic) for i in sorted(examples)])
    fitted = np.zeros(2)
    for _ in range(200):
        p = 1 / (1 + np.exp(-x @ fitted))
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-6, 1e-2])
        fitted += np.linalg.solve(curve, x.T @ (y - p) - np.diag([1e-6, 1e-2]) @ fitted)
    for r in N.score_toxicity(documents(spark, rows), labels, evidence=60).collect():
        wanted = near(r["doc_id"])
        assert sorted(n["doc_id"] for n in r["neighbours"]) == sorted(j for j, _ in wanted)
        assert np.allclose([n["cosine"] for n in r["neighbours"]], [c for _, c in wanted])
        assert abs(r["score"] - 1 / (1 + math.exp(-float(fitted @ (1.0, vote(wanted)))))) < 1e-6


def test_blocks_are_passed_over(spark, small):
    """On given texts most blocks are never scored, and the result is the same."""
    docs, labels = tables(spark, small.replace("sf0.001", "sf0.1"))
    rows = docs.select("doc_id", "text")
    chosen = N.training_ids(labels, "doc_id", "toxic", N.EXAMPLES)
    scorer = N.fit(rows.join(chosen, "doc_id").groupBy("doc_id", "toxic", "total").agg(F.max("text").alias("text")), rows)
    index = pickle.loads(pickle.dumps(scorer.index.value))
    count = N._counter(index.terms)
    for text in [(r["text"] or "").encode() for r in rows.filter("doc_id % 50 = 0").collect()]:
        ids, w = index.weights(count(text))
        found, cosine = index.nearest(ids, w, N.NEIGHBOURS)
        query = np.zeros(len(index.idf))
        query[ids] = w
        whole = np.add.reduceat(np.append(index.has_weight * query[index.has], 0), index.has_start[:-1])
        whole[np.diff(index.has_start) == 0] = 0
        best = np.sort(whole[whole > 0])[::-1][: N.NEIGHBOURS]
        assert np.allclose(cosine, best)
    share = index.blocks_scored / index.blocks_seen
    print("share of blocks scored", share)
    assert share < SHARE


#: Blocks that searches may score at most in the test above.
SHARE = 0.7


def test_words_that_clean_text_avoids_weigh_most():
    clean, totals = np.array([0, 5, 40, 0]), np.array([280, 280, 400, 1])
    found = N.contrast(clean, 1000, totals, 10_000)
    assert found[0] > found[1] > found[2] >= N.LEAST_CONTRAST and found[3] == N.LEAST_CONTRAST


def test_a_frequent_term_reaches_the_driver_once(spark):
    examples = spark.createDataFrame([(7, 1, "vile " * 50_000)], "doc_id bigint, toxic int, text string")
    row = N._example_rows(examples, spark.sparkContext.broadcast(pa.array(["vile"]))).to_pylist()[0]
    assert row["size"] == 1 and len(row["terms"]) == len(row["counts"]) == 4
    assert set(np.frombuffer(row["counts"], "<i4").tolist()) == {50_000}
