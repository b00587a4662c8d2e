"""A registry of runs that takes in new files and leaves old ones alone.

Manifests and job statuses are file streams: what has been read is in the progress folder.
Each batch is reduced to its latest entry per run and kept in a folder of the batch's
number, which a batch that runs again replaces. The registry is the latest of these.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsprep.sources import runs
from newsprep.streaming.monitors import replace_groups, run_available


def _files(spark: SparkSession, path: str, schema: str, one_per_file: bool) -> DataFrame:
    reader = spark.readStream.schema(schema).option("mode", "FAILFAST")
    return reader.json(path, multiLine=one_per_file)


def _taken_in(entries: DataFrame, reduce: Callable[[DataFrame], DataFrame], table: str, progress: str):
    # A batch is one group, of as many rows as it has runs.
    replace = replace_groups(table, ("batch_id",), False)

    def write(batch: DataFrame, batch_id: int) -> None:
        replace(reduce(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint")), batch_id)

    return run_available(entries, mode="append", progress=progress, each=write)


def take_in_manifests(
    spark: SparkSession, path: str, *, folder: str, one_per_file: bool = True
):
    """Read the manifest files that are new since the last call; returns the finished query.

    A manifest without ``run_id`` belongs to the run that its folder is named after. A
    malformed file is an error: the batch is not taken in, and is tried again next time.
    """
    manifests = _files(spark, path, runs.MANIFEST_SCHEMA, one_per_file)
    if one_per_file:
        named = F.coalesce("run_id", runs.run_of_path(F.col("_metadata.file_path")))
        manifests = manifests.select("*", "_metadata.file_path").withColumn("run_id", named).drop("file_path")
    return _taken_in(manifests, runs.latest_manifests, f"{folder}/manifests", f"{folder}/manifests-progress")


def take_in_jobs(
    spark: SparkSession, path: str, *, folder: str, run_id: Column | None = None, one_per_file: bool = True
):
    """Read the job status files that are new; the run is the last part of ``output_dir``."""
    jobs = _files(spark, path, runs.JOB_STATUS_SCHEMA, one_per_file)
    own = F.element_at(F.split("output_dir", "/"), -1) if run_id is None else run_id
    return _taken_in(jobs.withColumn("run_id", own), runs.latest_jobs, f"{folder}/jobs", f"{folder}/jobs-progress")


def read_registry(spark: SparkSession, folder: str) -> DataFrame:
    """The registry of all files taken in so far, as ``run_registry`` gives it.

    Reads one row per run and batch and none of the files. Both kinds must have been taken
    in at least once.
    """
    def kept(name: str, reduce: Callable[[DataFrame], DataFrame], schema: str) -> DataFrame:
        empty = spark.createDataFrame([], schema)
        return spark.read.schema(reduce(empty).schema).parquet(f"{folder}/{name}")

    return runs.joined_registry(
        kept("manifests", runs.latest_manifests, runs.MANIFEST_SCHEMA),
        kept("jobs", runs.latest_jobs, f"run_id string, {runs.JOB_STATUS_SCHEMA}"),
    )
