"""Exact duplicates by content fingerprint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsprep.functions.fixed_values import CONTENT
from newsprep.functions.text import content_fingerprint


def with_fingerprint(
    df: DataFrame, *, content: str = CONTENT, fingerprint: str = "fingerprint"
) -> DataFrame:
    return df.withColumn(fingerprint, content_fingerprint(F.col(content)))


def first_rows(
    df: DataFrame, *, fingerprint: str = "fingerprint", order_by: str = "row_id"
) -> DataFrame:
    """The smallest key of every fingerprint.

    Only digest and key travel, and copies collapse on the map side: if a third
    of the table is one article, each task still sends a single row for it.
    """
    return df.groupBy(F.unhex(F.col(fingerprint)).alias("digest")).agg(
        F.min(order_by).alias(order_by)
    ).select(order_by)


def dedup_keep_first(
    df: DataFrame, *, content: str = CONTENT, order_by: str = "row_id"
) -> DataFrame:
    """One row per fingerprint, the one with the smallest key.

    The texts move at most once, in the join on the unique key, and not at all
    when the keys of the survivors are few enough to be sent to every executor.
    """
    keys = df.select(order_by, content_fingerprint(F.col(content)).alias("fingerprint"))
    return df.join(first_rows(keys, order_by=order_by), order_by, "left_semi")


def dedup_report(df: DataFrame, *, content: str = CONTENT) -> DataFrame:
    """How many groups of copies of each size there are, and the rows they remove."""
    groups = df.groupBy(F.unhex(content_fingerprint(F.col(content))).alias("digest")).agg(
        F.count(F.lit(1)).alias("copies")
    )
    return groups.groupBy("copies").agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum("copies").alias("rows"),
        F.sum(F.col("copies") - 1).alias("removed"),
    ).orderBy("copies")


def split_leakage(
    df: DataFrame, *, content: str = CONTENT, split: str = "split"
) -> DataFrame:
    """Fingerprints that occur in both splits, with their rows on each side.

    Must be empty after ``dedup_keep_first``. A single grouping decides it, so
    no row is joined with its copies.
    """
    counts = df.groupBy(F.unhex(content_fingerprint(F.col(content))).alias("digest")).agg(
        F.count_if(F.col(split) == "train").alias("train_rows"),
        F.count_if(F.col(split) == "test").alias("test_rows"),
    )
    return counts.filter((F.col("train_rows") > 0) & (F.col("test_rows") > 0)).select(
        F.lower(F.hex("digest")).alias("fingerprint"), "train_rows", "test_rows"
    )
