import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from newsprep.llm import simhash_tiles as S
from tests.llm.rows import AWKWARD, collected, documents, given, ordered


def brute_print(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = lower.encode().split()
    grams = [words[i : i + 3] for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(b" ".join(g), seed=42) for g in grams]
    votes = [sum(h >> b & 1 for h in hashes) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(hashes))


def brute_components(nodes, near):
    """Least reachable id by repeated relabelling over all pairs."""
    label = list(range(len(nodes)))
    changed = True
    while changed:
        changed = False
        for i in range(len(nodes)):
            for j in range(len(nodes)):
                if label[j] < label[i] and near(nodes[i], nodes[j]):
                    label[i], changed = label[j], True
    return label


def expected(rows):
    prints = [brute_print(t) for _, t in rows]
    label = brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for (doc_id, _), k in zip(rows, label, strict=True):
        if doc_id is not None:
            least[k] = min(doc_id, least.get(k, doc_id))
    return ordered(
        (d, f"{p:016x}", least.get(k)) for (d, _), p, k in zip(rows, prints, label, strict=True)
    )


@pytest.mark.parametrize("parts", [1, 5])
def test_against_all_pairs(spark, small, parts):
    text = "some words that make a text of a fair length so that few bits change with one word " * 4
    near = [(500 + i, text + f"end{i}") for i in range(25)] + [(700, None), (701, "")]
    rows = AWKWARD + given(spark, small, 100) + near
    found = S.simhash_components(documents(spark, rows).repartition(parts))
    assert collected(found, "doc_id", "fingerprint", "component_id") == expected(rows)
    assert S.simhash_components(documents(spark, [])).count() == 0


@pytest.mark.parametrize("tile", [3, 4096])
def test_tiles_lose_no_link(spark, tile, monkeypatch):
    """Chains and clusters of fingerprints, in tiles of a few and in whole cells."""
    monkeypatch.setattr(S, "TILE", tile)
    rng = random.Random(5)
    values = []
    for _ in range(30):
        x = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            values.append(x)
            for bit in rng.sample(range(64), rng.randrange(1, 4)):
                x ^= 1 << bit
    values = sorted({*values, 0, (1 << 64) - 1, 1, 3})
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    links = S.tile_links(spark.createDataFrame([(v,) for v in signed], "fp bigint")).collect()
    pairs = {(r["a"], r["b"]) for r in links}
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 2 for a, b in pairs)
    label = brute_components(values, lambda a, b: (a ^ b).bit_count() <= 2)
    by_links = brute_components(signed, lambda a, b: (a, b) in pairs or (b, a) in pairs)
    assert label == by_links
    # A forest inside each pair of tiles, not all pairs.
    if tile > 100:
        assert len(pairs) < 3 * len(values)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(1, 60)]
    star = [(1000, i) for i in range(1001, 1200)] + [(1100, 1001)]
    edges = chain + star + [(7, 7), (2, 1)]
    found = S.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    roots = {r["node"]: r["root"] for r in found}
    assert len(found) == len(roots) == 60 + 200
    assert {roots[i] for i in range(1, 61)} == {1}
    assert {roots[i] for i in range(1000, 1200)} == {1000}


def test_one_document_of_each_group_stays(spark, small):
    rows = AWKWARD + [(1000 + d, t) for d, t in given(spark, small, 60)]
    docs = documents(spark, rows)
    kept = S.keep_one_each(docs)
    assert kept.columns == docs.columns
    groups = {(c,) for _, _, c in expected(rows)}
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {(i,) for i in ids} == groups
    assert S.keep_one_each(documents(spark, [])).count() == 0


def test_rows_that_repeat_id_and_text_are_one(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (5, "x y z w"), (6, "a b c d")]
    kept = S.keep_one_each(documents(spark, rows))
    assert collected(kept, "doc_id", "text") == [(5, "a b c d"), (5, "x y z w")]


def test_rows_are_taken_where_they_lie(spark):
    """Bitmaps find exactly the chosen places, over pieces and beyond one bitmap."""
    rows = spark.range(0, 200_000, 1, 3).withColumn("place", F.monotonically_increasing_id())
    chosen = rows.filter("id % 7 = 3 OR id IN (0, 32767, 32768, 199999)")
    found = S.only_at(rows, chosen.select("place"), "place")
    assert found.columns == rows.columns
    assert sorted(r["id"] for r in found.collect()) == sorted(r["id"] for r in chosen.collect())
    assert S.only_at(rows, chosen.select("place").limit(0), "place").count() == 0


def test_ties_of_id_and_fingerprint_go_by_the_text(spark):
    """Case does not count for the fingerprint: of these two texts one stays, always the same."""
    texts = ["a b c d", "A B C D"]
    least = min(texts, key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    for some in (texts, texts[::-1]):
        kept = S.keep_one_each(documents(spark, [(5, t) for t in some]))
        assert [r["text"] for r in kept.collect()] == [least]
