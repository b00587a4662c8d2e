"""Cleaning, copies, sampling, splitting."""

import hashlib
import random
from decimal import ROUND_CEILING, Decimal

import pytest
from pyspark.sql import functions as F

from newsprep.operators import cleaning, dedup, splitting
from newsprep.operators.ordering import positions
from newsprep.plans import prepare

ARTICLE = "row_id long, Content string, Summary string, Sentiment string"


def make(spark, data):
    return spark.createDataFrame(data, ARTICLE)


def ids(df, key="row_id"):
    return sorted(r[key] for r in df.select(key).collect())


def order(seed, key):
    return hashlib.sha256(f"{seed}:{key}".encode()).hexdigest(), key


def test_empty_rows_and_null_policies(spark):
    df = make(spark, [
        (1, "text", "sum", "positive"), (2, " \n", "sum", "positive"), (3, "text", "", "positive"),
        (4, None, "sum", "neutral"), (5, None, "other", "neutral"), (6, "text", "sum", None),
    ])
    assert ids(cleaning.drop_empty_rows(df)) == [1]
    literal = cleaning.clean_articles(df, null_policy="literal")
    assert ids(literal) == [1, 4, 5, 6]
    # A null label becomes a text that the domain check finds; null contents are copies.
    assert [r["label"] for r in cleaning.unexpected_labels(literal).collect()] == ["None"]
    assert ids(dedup.dedup_keep_first(literal)) == [1, 4]
    with pytest.raises(ValueError, match="None"):
        cleaning.clean_articles(df, null_policy="literal", strict=True)


def test_unexpected_labels_are_sorted_and_counted(spark):
    df = make(spark, [(i, "t", "s", l) for i, l in enumerate(
        ["zeta", "alpha", "alpha", "Positive", "Negative"])])
    rows = [tuple(r) for r in cleaning.unexpected_labels(df).collect()]
    assert rows == [("alpha", 2), ("zeta", 1)]


def test_encode_counts_only_present_labels(spark):
    df = make(spark, [(1, "t", "s", "Positive"), (2, "t", "s", "Negative")])
    encoded = {r["Sentiment"]: r["label_id"] for r in cleaning.encode_labels(df).collect()}
    assert encoded == {"Negative": 0, "Positive": 1}
    back = cleaning.decode_labels(cleaning.encode_labels(df), cleaning.label_names(df))
    assert {(r["row_id"], r["Sentiment"]) for r in back.collect()} == {
        (1, "Positive"), (2, "Negative")}


def test_dedup_keeps_the_first_of_respelled_copies(spark):
    df = make(spark, [
        (5, "Revenue   Increased", "a", "Positive"), (3, " revenue\nincreased ", "b", "Neutral"),
        (9, "REVENUE INCREASED", "c", "Negative"), (4, "other", "d", "Neutral"),
    ])
    assert ids(dedup.dedup_keep_first(df)) == [3, 4]
    report = [tuple(r) for r in dedup.dedup_report(df).collect()]
    assert report == [(1, 1, 1, 0), (3, 1, 3, 2)]


def test_hot_copy_collapses_before_the_shuffle(spark):
    df = spark.range(9000).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("Content"),
    ).repartition(6)
    assert dedup.dedup_keep_first(df).count() == 6001
    plan = dedup.dedup_keep_first(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "SortAggregate" not in plan and "Window" not in plan


@pytest.mark.parametrize("n", [0, 1, 7, 399, 400, 1000])
def test_sample_is_the_head_of_the_full_order(spark, n):
    df = spark.range(400).withColumnRenamed("id", "row_id")
    wanted = sorted(range(400), key=lambda k: order(42, k))[: n or 400]
    for parts in (1, 4, 16):
        assert ids(splitting.seeded_sample(df.repartition(parts), n=n)) == sorted(wanted)


def quotas(counts, share):
    total = sum(counts.values())
    target = int((total * Decimal(str(share))).to_integral_value(ROUND_CEILING))
    if min(counts.values()) < 2 or target < len(counts) or total - target < len(counts):
        return None, target
    whole = {c: target * n // total for c, n in counts.items()}
    rest = sorted(counts, key=lambda c: (-(target * counts[c] % total), c))
    for c in rest[: target - sum(whole.values())]:
        whole[c] += 1
    return whole, target


@pytest.mark.parametrize(
    "counts,share",
    [
        ({"Positive": 287, "Negative": 50, "Neutral": 48}, 0.1),
        ({"Positive": 5, "Negative": 3, "Neutral": 3}, 0.3),
        ({"Positive": 100, "Negative": 1}, 0.1),
        ({"Positive": 20, "Negative": 20, "Neutral": 20}, 0.01),
        ({"Positive": 4, "Negative": 4}, 0.9),
        ({"Positive": 10}, 0.25),
        ({"Positive": 1000, "Negative": 2, "Neutral": 2}, 0.1),
    ],
)
def test_split_against_full_ranking(spark, counts, share):
    labels = [c for c, n in counts.items() for _ in range(n)]
    random.Random(3).shuffle(labels)
    df = spark.createDataFrame(list(enumerate(labels)), "row_id long, Sentiment string")
    per_class, target = quotas(counts, share)
    ranked = sorted(range(len(labels)), key=lambda k: order(42, k))
    if per_class is None:
        wanted = set(ranked[:target])
    else:
        wanted = {
            k for c, n in per_class.items() for k in [i for i in ranked if labels[i] == c][:n]
        }
    for parts in (1, 4, 16):
        split = splitting.stratified_split(df.repartition(parts), test_size=share)
        assert {r["row_id"] for r in split.filter("split = 'test'").collect()} == wanted
        assert split.count() == len(labels)
    plain = splitting.random_split(df, test_size=share).filter("split = 'test'")
    assert {r["row_id"] for r in plain.collect()} == set(ranked[:target])


@pytest.mark.parametrize("share", [0, 1, -0.1, 1.5])
def test_test_size_is_checked(spark, share):
    df = spark.createDataFrame([(1, "Positive")], "row_id long, Sentiment string")
    with pytest.raises(ValueError):
        splitting.stratified_split(df, test_size=share)


def test_positions_and_subset(spark):
    df = spark.range(500).withColumnRenamed("id", "row_id").repartition(7)
    ranked = sorted(range(500), key=lambda k: order(43, k))
    got = {r["row_id"]: r["index"] for r in positions(df, key="row_id", seed=43).collect()}
    assert [k for k, _ in sorted(got.items(), key=lambda e: e[1])] == ranked
    assert sorted(got.values()) == list(range(500))
    few = splitting.eval_subset(df, max_examples=20).orderBy("index").collect()
    assert [r["row_id"] for r in few] == ranked[:20]


def test_whole_preparation_is_a_function_of_the_data(spark):
    rng = random.Random(1)
    data = [
        (i, f"Article number {i % 150}", "s", rng.choice(["positive", "Neutral ", "NEGATIVE"]))
        for i in range(200)
    ] + [(1000, "", "s", "positive")]
    df = make(spark, data)
    results = []
    for parts in (1, 4, 16):
        split = prepare.load_and_split(df.repartition(parts), limit=120, test_size=0.2)
        results.append(sorted((r["row_id"], r["split"]) for r in split.collect()))
        assert dedup.split_leakage(split).count() == 0
    assert results[0] == results[1] == results[2]
    assert len(results[0]) == 120
    assert sum(s == "test" for _, s in results[0]) == 24
    kept = prepare.load_and_split(df, limit=0, deduplicate=False)
    assert kept.count() == 200
    assert dedup.split_leakage(kept).count() > 0


def test_split_fingerprint_ignores_order_and_sees_changes(spark):
    data = [(i, f"text {i}", "s", "Positive", "train") for i in range(50)]
    schema = ARTICLE + ", split string"
    df = spark.createDataFrame(data, schema)

    def identity(d):
        return splitting.split_fingerprint(d).collect()

    assert identity(df) == identity(df.repartition(5).orderBy(F.desc("row_id")))
    changed = df.withColumn("Summary", F.when(F.col("row_id") == 7, "x").otherwise("s"))
    assert identity(df) != identity(changed)
    doubled = df.unionByName(df.filter("row_id < 2")).unionByName(df.filter("row_id < 2"))
    assert identity(df) != identity(doubled)


def test_split_plan_moves_no_texts(spark):
    df = make(spark, [(i, "text", "sum", "Positive") for i in range(50)])
    plan = splitting.stratified_split(df)._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line or "Exchange SinglePartition" in line:
            assert "Content" not in line
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan


def test_plans_without_nested_loops_or_text_joins(spark, tmp_path):
    """One stratum is no join, and without removal of copies the texts stay in place."""
    from newsprep.plans import prepare

    rows = [(i, f"text {i}", "s", ("Positive", "Negative", "Neutral")[i % 3]) for i in range(90)]
    spark.createDataFrame(
        rows, "row_id bigint, Content string, Summary string, Sentiment string"
    ).write.parquet(str(tmp_path / "a"))
    df = spark.read.parquet(str(tmp_path / "a"))
    for result, size in (
        (splitting.seeded_sample(df, n=10), 10),
        (splitting.random_split(df, test_size=0.1).filter("split = 'test'"), 9),
        (splitting.eval_subset(df, max_examples=7), 7),
        (prepare.load_and_split(df, deduplicate=False, limit=0, test_size=0.1).filter("split = 'test'"), 9),
    ):
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "REPARTITION" not in plan
        assert result.count() == size
    assert "Join [row_id" not in plan


def test_temporal_holdout(spark):
    days = ["2024-01-01"] * 5 + ["2024-01-02"] * 3 + ["2024-01-03"] * 1 + [None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "row_id int, day string")
    found = splitting.temporal_holdout(df, date="day", test_size=0.2)
    splits = {r["row_id"]: r["split"] for r in found.collect()}
    assert splits == {i: "train" for i in range(5)} | {i: "test" for i in range(5, 9)} | {9: None}
    assert splitting.temporal_holdout(df.limit(0), date="day").count() == 0
    one = splitting.temporal_holdout(df.filter("day = '2024-01-01'"), date="day")
    assert {r["split"] for r in one.collect()} == {"test"}


def test_length_distribution(spark):
    from newsprep.operators.formatting import length_distribution

    df = spark.createDataFrame([(i,) for i in [10] * 98 + [20, 2000, None]], "n int")
    row = length_distribution(df, length="n", max_length=1024).collect()[0]
    assert (row["rows"], row["p50"], row["max_length"], row["over_budget"]) == (100, 10.0, 2000, 0.01)
    assert length_distribution(df.limit(0), length="n", max_length=9).collect()[0]["rows"] is None


def test_all_offenders_are_counted(spark):
    rows = [(f"bad{i:03d}",) for i in range(120)] + [("bad000",), ("Positive",)]
    df = spark.createDataFrame(rows, "Sentiment string")
    with pytest.raises(ValueError, match="120 labels outside the domain on 121 rows.* 70 more, not shown"):
        cleaning.require_known_labels(df)
