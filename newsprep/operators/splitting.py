"""Seeded sampling, stratified splitting, evaluation subset, split identity."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsprep.functions.fixed_values import (
    DEFAULT_MAX_EXAMPLES,
    DEFAULT_SEED,
    DEFAULT_TEST_SIZE,
    LABELS,
    REQUIRED_COLUMNS,
    SENTIMENT,
)
from newsprep.functions.text import literal_none
from newsprep.operators.ordering import (
    boundary_keys,
    positions,
    upto,
    whole_boundary,
    within_boundary,
)

_WHOLE = "*"


def check_test_size(test_size: float) -> Decimal:
    exact = Decimal(str(test_size))
    if not 0 < exact < 1:
        raise ValueError("test_size must lie between 0 and 1")
    return exact


def seeded_sample(
    df: DataFrame, *, n: int, seed: int = DEFAULT_SEED, key: str = "row_id"
) -> DataFrame:
    """A uniform sample of n rows that depends on data and seed only.

    ``n=0`` means every row, as does an n not below the row count.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    if n == 0:
        return df
    cut = whole_boundary(df.select(key), F.lit(n), key=key, seed=seed)
    # Without an n-th row there is no boundary, and every row is taken.
    return df.filter(F.coalesce(upto(cut, key=key, seed=seed), F.lit(True)))


def _test_rows(rows: Column, test_size: Decimal) -> Column:
    """ceil(rows * test_size), in decimal arithmetic."""
    share = F.lit(test_size).cast("decimal(18,12)")
    return F.ceil(rows.cast("decimal(20,0)") * share).cast("decimal(19,0)")


def split_quotas(class_rows: DataFrame, *, test_size: float, stratify: bool = True) -> DataFrame:
    """Stratum and test rows per class, from the rows per class (``label``, ``n``).

    Every class is a stratum and gets the whole part of its share; what is left
    over goes to the largest fractions, ties by label. Where that is impossible
    (a class with one row, or fewer test or train rows than classes) all classes
    share the one stratum ``*``. ``class_rows`` is tiny: one row per label.
    """
    exact = check_test_size(test_size)
    everything = Window.partitionBy(F.lit(0))
    rows, classes = F.sum("n").over(everything), F.count(F.lit(1)).over(everything)
    target = _test_rows(rows, exact)
    possible = (
        (F.min("n").over(everything) >= 2) & (target >= classes) & (rows - target >= classes)
    )
    shares = class_rows.select(
        "label",
        F.col("n").cast("decimal(19,0)").alias("n"),
        rows.cast("decimal(19,0)").alias("rows"),
        target.alias("target"),
        (F.lit(stratify) & possible).alias("stratified"),
    ).select(
        "*",
        F.expr("(target * n) div rows").alias("whole"),
        F.expr("(target * n) % rows").alias("fraction"),
    )
    by_fraction = Window.partitionBy(F.lit(0)).orderBy(F.desc("fraction"), "label")
    left_over = F.col("target").cast("bigint") - F.sum("whole").over(everything)
    extra = (F.row_number().over(by_fraction) <= left_over).cast("bigint")
    return shares.select(
        "label",
        F.when(F.col("stratified"), F.col("label")).otherwise(F.lit(_WHOLE)).alias("stratum"),
        F.when(F.col("stratified"), F.col("whole") + extra)
        .otherwise(F.col("target").cast("bigint"))
        .alias("quota"),
    )


def stratified_split(
    df: DataFrame,
    *,
    label: str = SENTIMENT,
    labels: Sequence[str] = LABELS,
    test_size: float = DEFAULT_TEST_SIZE,
    seed: int = DEFAULT_SEED,
    key: str = "row_id",
    stratify: bool = True,
    split: str = "split",
    keys: DataFrame | None = None,
) -> DataFrame:
    """Add a ``train``/``test`` column that keeps the class shares.

    Falls back to an unstratified split where stratification is impossible. The
    rows themselves are never shuffled: small aggregates over key and label
    yield one boundary per class, which is compared on the map side. Labels
    outside ``labels`` form one class, so what is broadcast has at most
    ``len(labels) + 1`` rows.

    Key and label are read three times, from ``keys`` if given: a narrow written table of
    the same rows. Otherwise give a table or the output of ``materialize``, not a plan
    that is costly to repeat.
    """
    known = F.when(F.col(label).isin(*labels), F.col(label)).otherwise(F.lit("~other"))
    keys = (df if keys is None else keys).select(known.alias("label"), key)
    if not stratify:
        share = check_test_size(test_size)
        quota = keys.agg(_test_rows(F.count(F.lit(1)), share).cast("bigint")).scalar()
        cut = whole_boundary(keys, quota, key=key, seed=seed)
        is_test = F.coalesce(upto(cut, key=key, seed=seed), F.lit(False))
        return df.withColumn(split, F.when(is_test, F.lit("test")).otherwise(F.lit("train")))
    class_rows = keys.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    quotas = split_quotas(class_rows, test_size=test_size, stratify=stratify)
    strata = keys.join(F.broadcast(quotas.select("label", "stratum")), "label")
    cut = boundary_keys(
        strata, quotas.select("stratum", "quota").distinct(), key=key, seed=seed
    )
    per_label = quotas.join(F.broadcast(cut), "stratum").select(
        F.col("label").alias("stratum"), "boundary"
    )
    marked = within_boundary(
        df, per_label, stratum=known, key=key, seed=seed, flag="_test"
    )
    return marked.withColumn(
        split, F.when(F.col("_test"), F.lit("test")).otherwise(F.lit("train"))
    ).drop("_test")


def random_split(df: DataFrame, **options) -> DataFrame:
    """The unstratified form of ``stratified_split``."""
    return stratified_split(df, stratify=False, **options)


def temporal_holdout(
    df: DataFrame, *, date: str, test_size: float = DEFAULT_TEST_SIZE, split: str = "split"
) -> DataFrame:
    """Split by time: the newest whole days are the test rows.

    They are the fewest days that hold at least the test share of the dated rows, so no
    day is in both splits and nothing in ``train`` is newer than anything in ``test``. A
    table of one day is all test. A row without a date has a null split.

    Days are counted, the counts added up from the newest, and the cut is compared where
    the rows are read: nothing but one row per day is shuffled.
    """
    share = check_test_size(test_size)
    days = df.filter(F.col(date).isNotNull()).groupBy(F.col(date).alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # One row per day, in one task.
    newest = Window.orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, 0)
    reached = days.withColumn("upto", F.sum("n").over(newest)).filter(
        F.col("upto") >= days.agg(_test_rows(F.sum("n"), share).cast("bigint")).scalar()
    )
    cut = reached.agg(F.max("day")).scalar()
    return df.withColumn(
        split, F.when(F.col(date) >= cut, F.lit("test")).when(F.col(date) < cut, F.lit("train"))
    )


def split_class_counts(
    df: DataFrame, *, split: str = "split", label: str = SENTIMENT
) -> DataFrame:
    """Rows per split and class, with a total per split (label null) and overall.

    The table is counted once per split and class; the totals are rolled up from
    that handful of rows.
    """
    fine = df.groupBy(split, label).agg(F.count(F.lit(1)).alias("n"))
    return (
        fine.rollup(split, label)
        .agg(F.sum("n").alias("rows"), F.grouping_id().cast("int").alias("level"))
        .orderBy(F.col(split).asc_nulls_last(), F.col(label).asc_nulls_last())
    )


def eval_subset(
    df: DataFrame,
    *,
    max_examples: int = DEFAULT_MAX_EXAMPLES,
    seed: int = DEFAULT_SEED,
    key: str = "row_id",
) -> DataFrame:
    """Reshuffle a test split, keep the first ``max_examples`` and number them from 0.

    The order must differ from that of the split, so the seed is extended.
    ``max_examples=0`` keeps every row.
    """
    if max_examples < 0:
        raise ValueError("max_examples must not be negative")
    order = seed + 1
    return positions(
        seeded_sample(df, n=max_examples, seed=order, key=key), key=key, seed=order
    )


def split_fingerprint(
    df: DataFrame, *, split: str = "split", columns: Sequence[str] = REQUIRED_COLUMNS
) -> DataFrame:
    """The content identity of each split, whatever the order of its rows.

    Count, xor and sum of 60-bit row digests together: xor alone would cancel
    pairs of equal rows. All three combine on the map side.
    """
    text = F.concat_ws("\x1f", *(literal_none(F.col(c).cast("string")) for c in columns))
    digest = F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint")
    modulus = F.lit(1_000_000_007)
    return (
        df.select(F.col(split), digest.alias("digest"))
        .groupBy(split)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.bit_xor("digest").alias("digest_xor"),
            (F.sum(F.col("digest") % modulus) % modulus).alias("digest_sum"),
        )
    )
