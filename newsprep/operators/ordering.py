"""Exact cut-offs in a seeded order, without a global sort.

Rows are ordered by a hash of seed and key. The order depends on nothing else:
not on the partitioning, the file layout or the number of executors.

To find the n-th row, rows are counted per hash prefix (``BUCKETS`` of them at
most), a running sum names the prefix in which the n-th row lies, and only the
rows with that prefix are ranked. The result is one boundary key per stratum.

Keys must be unique, as row ids are: rows that share the key of a boundary lie on the
same side of it, so a sample could exceed its size by them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

PREFIX_DIGITS = 4
BUCKETS = 16**PREFIX_DIGITS


def order_key(key: Column, seed: int) -> Column:
    """A hash of seed and key. Rows sort by it, then by the key itself."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)


def _prefix(hashed: Column) -> Column:
    return F.substring(hashed, 1, PREFIX_DIGITS)


def boundary_keys(keys: DataFrame, quotas: DataFrame, *, key: str, seed: int) -> DataFrame:
    """Per stratum, the last key that still belongs to the first ``quota`` rows.

    ``keys`` has the columns ``stratum`` and ``key``; ``quotas`` has ``stratum``
    and ``quota``, one row per stratum. The caller guarantees that the strata are
    few. A stratum with quota 0 has no boundary and no row in the result.
    """
    hashed = keys.select("stratum", key, order_key(F.col(key), seed).alias("hashed"))
    # At most BUCKETS rows per stratum from here on, whatever the table size.
    counts = hashed.groupBy("stratum", _prefix(F.col("hashed")).alias("prefix")).agg(
        F.count(F.lit(1)).alias("n")
    )
    running = F.sum("n").over(
        Window.partitionBy("stratum").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
    )
    boundary = (
        counts.withColumn("upto", running)
        .join(F.broadcast(quotas), "stratum")
        .filter((F.col("upto") >= F.col("quota")) & (F.col("upto") - F.col("n") < F.col("quota")))
        .select(
            "stratum", "prefix", (F.col("quota") - (F.col("upto") - F.col("n"))).alias("rank")
        )
    )
    edge = (
        hashed.withColumn("prefix", _prefix(F.col("hashed")))
        .join(F.broadcast(boundary), ["stratum", "prefix"])
        .withColumn(
            "position",
            F.row_number().over(Window.partitionBy("stratum").orderBy("hashed", key)),
        )
    )
    return edge.filter(F.col("position") == F.col("rank")).select(
        "stratum", F.struct("hashed", key).alias("boundary")
    )


def whole_boundary(keys: DataFrame, quota: Column, *, key: str, seed: int) -> Column:
    """The boundary of a table that is one stratum, as a scalar subquery.

    ``quota`` is the number of rows up to it. No join: a constant stratum would make one a
    nested loop over the table.
    """
    hashed = keys.select(key, order_key(F.col(key), seed).alias("hashed"))
    counts = hashed.groupBy(_prefix(F.col("hashed")).alias("prefix")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # At most BUCKETS rows in one task.
    running = F.sum("n").over(
        Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
    )
    edge = (
        counts.withColumn("upto", running)
        .withColumn("rank", quota - (F.col("upto") - F.col("n")))
        .filter((F.col("rank") > 0) & (F.col("rank") <= F.col("n")))
    )
    position = F.row_number().over(Window.partitionBy("prefix").orderBy("hashed", key))
    return (
        hashed.withColumn("prefix", _prefix(F.col("hashed")))
        .filter(F.col("prefix") == edge.select("prefix").scalar())
        .withColumn("position", position)
        .filter(F.col("position") == edge.select("rank").scalar())
        .select(F.struct("hashed", key))
        .scalar()
    )


def upto(boundary: Column, *, key: str, seed: int) -> Column:
    """Whether a row lies at or before a boundary; null if there is none."""
    return F.struct(order_key(F.col(key), seed).alias("hashed"), F.col(key)) <= boundary


def within_boundary(
    df: DataFrame, boundaries: DataFrame, *, stratum: Column, key: str, seed: int, flag: str
) -> DataFrame:
    """Mark the rows up to the boundary of their stratum: a map-side comparison."""
    marked = F.coalesce(upto(F.col("boundary"), key=key, seed=seed), F.lit(False))
    return (
        df.withColumn("stratum", stratum)
        .join(F.broadcast(boundaries), "stratum", "left")
        .withColumn(flag, marked)
        .drop("stratum", "boundary")
    )


def positions(df: DataFrame, *, key: str, seed: int, position: str = "index") -> DataFrame:
    """Number the rows from 0 in the seeded order, in parallel.

    Each prefix is ranked on its own and starts where the smaller prefixes end.
    Hash prefixes are even in size, so no task gets more than its share.
    """
    keyed = df.withColumn("hashed", order_key(F.col(key), seed)).withColumn(
        "prefix", _prefix(F.col("hashed"))
    )
    counts = keyed.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))
    starts = counts.select(
        "prefix",
        F.coalesce(
            F.sum("n").over(Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("start"),
    )
    rank = F.row_number().over(Window.partitionBy("prefix").orderBy("hashed", key))
    return (
        keyed.join(F.broadcast(starts), "prefix")
        .withColumn(position, (F.col("start") + rank - 1).cast("bigint"))
        .drop("hashed", "prefix", "start")
    )
