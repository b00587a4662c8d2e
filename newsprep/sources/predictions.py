"""Stored prediction records (JSON Lines)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsprep.sources.quarantine import quarantine, with_line

RECORD_SCHEMA = (
    "index bigint, reference_sentiment string, predicted_sentiment string, "
    "reference_summary string, predicted_summary string, rouge_l_f1 double, "
    "article_truncated boolean, raw_response string"
)


def write_predictions(records: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """One JSON object per line; null fields are kept as explicit nulls."""
    records.write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_predictions_with_errors(
    spark: SparkSession, path: str, schema: str = RECORD_SCHEMA
) -> tuple[DataFrame, DataFrame]:
    """The records of a path, and its lines that are none (see ``quarantine``)."""
    return quarantine(spark.read.schema(with_line(schema)).json, path)


def read_predictions(spark: SparkSession, path: str, schema: str = RECORD_SCHEMA) -> DataFrame:
    """Read with a given schema: nothing is inferred, so nothing is scanned twice."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def append_predictions(
    records: DataFrame, path: str, run: str, batch: str | None = None
) -> None:
    """Add a batch of records of a run, in a folder of the run's and the batch's name.

    Jobs of different runs, and batches of one run, write side by side. A job that runs
    again under the same name of a batch replaces that and nothing else, so no record is
    there twice. Without a name the batch is a new one.
    """
    batch = batch or uuid.uuid4().hex
    keyed = records.withColumns({"run_id": F.lit(run), "batch": F.lit(batch)})
    writer = keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run_id", "batch").option("ignoreNullFields", "false").json(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The records of all runs of a folder, with ``run_id`` and ``batch``."""
    return read_predictions(spark, path, f"{RECORD_SCHEMA}, run_id string, batch string")


def resume_unscored(
    examples: DataFrame,
    stored: DataFrame,
    *,
    key: str = "row_id",
    stored_key: str = "index",
    run: str | None = None,
) -> DataFrame:
    """Examples that have no stored prediction yet, of the given run if there is one.

    A row that only another run has scored is unscored. Records name a row by ``index``.
    """
    own = stored if run is None else stored.filter(F.col("run_id") == run)
    return examples.join(own.select(F.col(stored_key).alias(key)), key, "left_anti")
