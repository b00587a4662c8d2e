"""The formatted train/test dataset on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AUDIT_COLUMNS = ("sequence_length", "was_truncated")


def write_sft_dataset(
    formatted: DataFrame, path: str, *, keep_audit: bool = False, rebalance: bool = False
) -> None:
    """Write one folder per split, so a reader of one split never lists the other.

    ``rebalance`` moves rows once, so that files come out near the advisory partition size
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``): a large split is spread over many
    tasks, a small one is one file. Without it every task writes a file for each split.
    """
    if not keep_audit:
        formatted = formatted.drop(*AUDIT_COLUMNS)
    if rebalance:
        formatted = formatted.hint("rebalance", "split")
    formatted.write.partitionBy("split").parquet(path)


def read_sft_dataset(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    dataset = spark.read.parquet(path)
    return dataset if split is None else dataset.filter(dataset["split"] == split)


def save_sft_table(
    formatted: DataFrame, name: str, *, key: str = "row_id", buckets: int, path: str | None = None
) -> None:
    """Save the dataset as a table in buckets of the key, audit columns included.

    Tables with the same number of buckets of the same key join without moving their rows,
    as the answers to a split do with its examples. Each bucket is gathered first, so it is
    one file; a key's rows are few, so no bucket is much larger than another. A bucket is
    what a task of such a join holds: give as many as the table has GB times ten.
    """
    spread = formatted.repartition(buckets, key)
    writer = spread.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
