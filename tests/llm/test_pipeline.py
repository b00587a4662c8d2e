"""The pipeline's stages against brute force, each on what the one before has kept."""

import re

import pytest

import corpus_pipeline as P
from newsprep.llm.queries import ORACLES, QUERIES
from newsprep.llm.shared import written
from tests.llm import test_compression_bands, test_decontamination, test_packing, test_pii_votes
from tests.llm import test_simhash_tiles
from tests.llm.rows import AWKWARD, CLASHING, documents, given

MORE = [
    (300, "Write to ann@mail.example.com or +1 (524) 555-7373. " + "Some plain words here. " * 3),
    (301, "the quick brown fox " * 60),
]


@pytest.fixture(scope="module")
def folder(spark, small, tmp_path_factory):
    """A folder of small tables: given documents and awkward rows, the given benchmark."""
    folder = str(tmp_path_factory.mktemp("tables"))
    texts = given(spark, small, 200)
    long = [(1000 + d, t + f" Reach me at a{d}@b.example.org, card 4539148803436467.") for d, t in texts[:30]]
    copies = [(2000 + d, t) for d, t in texts[:40]] + [(d, t) for d, t in texts[:5]]
    rows = [r for r in AWKWARD if r[0] != 4] + [(100 + d, t) for d, t in texts] + long + copies + MORE
    docs = documents(spark, rows).selectExpr("*", "length(text) AS n_chars", "'x' AS source")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{small}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_stages(spark, small, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in P.STAGES] == [
        "quality rules", "near-duplicate removal", "benchmark decontamination", "personal data", "packing",
    ]
    stages = [f for _, f in P.STAGES]

    kept = written(stages[0](spark, docs, folder), "t0")
    assert kept.columns == docs.columns
    before, after = rows_of(docs), rows_of(kept)
    assert set(after) <= set(before)
    assert not any(test_compression_bands.base(t)[-1] for _, t in after)
    passing = [r for r in before if not test_compression_bands.base(r[1])[-1]]
    assert len(after) > 0.8 * len(passing)

    single = written(stages[1](spark, kept, folder), "t1")
    assert single.columns == docs.columns
    groups = {c for _, _, c in test_simhash_tiles.expected(after)}
    assert {d for d, _ in rows_of(single)} == groups
    assert len(rows_of(single)) == len(set(rows_of(single)))

    clean = written(stages[2](spark, single, folder), "t2")
    assert clean.columns == docs.columns
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    judged = test_decontamination.brute(rows_of(single), items)
    assert any(r[5] for r in judged)
    assert sorted(d for d, _ in rows_of(clean)) == sorted(r[0] for r in judged if not r[5])

    private = written(stages[3](spark, clean, folder), "t3")
    assert private.columns == docs.columns and private.dtypes == clean.dtypes
    old, new = dict(rows_of(clean)), dict(rows_of(private))
    assert old.keys() == new.keys() and old != new
    for doc_id, text in new.items():
        assert test_pii_votes.base(text) == []
        if not re.search("[0-9@]", old[doc_id]):
            assert text == old[doc_id]
    assert private.filter("n_chars <> length(text)").count() == 0

    packed = stages[4](spark, private, folder)
    ours = sorted(tuple(r[c] for c in test_packing.COLUMNS) for r in packed.collect())
    assert ours == test_packing.expected(rows_of(private))
    whole = P.run(spark, folder)
    assert sorted(tuple(r[c] for c in test_packing.COLUMNS) for r in whole.collect()) == ours


def test_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        docs = written(stage(spark, docs, folder), "empty")
        assert docs.count() == 0


def test_registered():
    import __spark_entry__

    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))
    assert __spark_entry__.queries().keys() >= QUERIES.keys() | {"pipeline"}
    assert set(__spark_entry__.oracle_sql()) >= set(ORACLES)
    assert "n_words" in CLASHING
