import zlib

import pytest

from newsprep.llm import shared
from newsprep.llm.byte_shards import byte_shards
from tests.llm.rows import AWKWARD, documents, given, ordered


@pytest.mark.parametrize(("parts", "shards"), [(1, 16), (7, 16), (3, 1), (4, 500)])
def test_shards(spark, small, parts, shards, monkeypatch):
    monkeypatch.setattr(shared, "FAN", 3)
    rows = [r for r in AWKWARD if r[0] != 4] + given(spark, small, 100)
    found = byte_shards(documents(spark, rows).repartition(parts), shards=shards).collect()
    sizes = ((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert ordered((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == ordered(sizes)
    total, largest = sum(r["size"] for r in found), max(r["size"] for r in found)
    assert {(r["law"], r["grown_shard"]) for r in found} == {("bytes", None)}
    for k in range(shards):
        own = [r for r in found if r["shard"] == k]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / shards) <= largest


def test_shards_are_runs_of_the_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = {r["doc_id"]: (r["shard"], r["slot"]) for r in byte_shards(docs).collect()}
    places = [found[r["doc_id"]] for r in docs.select("doc_id").collect()]
    assert places == sorted(places)


def test_empty_table_and_one_huge_row(spark):
    assert byte_shards(documents(spark, [])).count() == 0
    found = byte_shards(documents(spark, [(1, "x" * 10000), (2, "y"), (3, None)])).collect()
    assert sum(r["size"] for r in found) == 10004
    assert sorted((r["shard"], r["slot"]) for r in found)[0][1] == 0


def test_nothing_leaves_the_jvm(spark, small):
    plan = byte_shards(spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution()
    assert "Python" not in plan.toString() and "Arrow" not in plan.toString()
