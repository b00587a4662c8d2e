"""Monitors over a prediction log stream.

A log row has ``event_time`` (timestamp), ``key``, ``user_id``, ``latency_ms`` and
``predicted`` (null where the answer did not parse). Every monitor takes and
returns a DataFrame and works on batches and streams alike. ``append_to_table`` keeps
what is final, that is, windows whose end the watermark has passed; ``upsert_table`` and
``bursts_so_far`` also show what is open. In both, state ends at the watermark.
``late_rows`` counts what came too late.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsprep.functions.fixed_values import UNPARSED


def read_log_stream(
    spark: SparkSession, path: str, schema, *, files_per_trigger: int | None = None
) -> DataFrame:
    """A parquet folder, or the files of a pattern, as a stream. The schema is
    given, not inferred."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def parse_failures(log: DataFrame, *, window: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Rows and parse failures per tumbling window."""
    counted = log.withWatermark("event_time", delay).groupBy(F.window("event_time", window)).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("predicted").isNull()).alias("failures"),
    )
    return counted.select(
        F.col("window.start").alias("window_start"),
        "rows",
        "failures",
        (F.col("failures") / F.col("rows")).alias("failure_rate"),
    )


def class_mix(
    log: DataFrame, *, window: str = "2 days", slide: str = "1 day", delay: str = "1 hour"
) -> DataFrame:
    """Predicted labels per sliding window."""
    counted = log.withWatermark("event_time", delay).groupBy(
        F.window("event_time", window, slide),
        F.coalesce("predicted", F.lit(UNPARSED)).alias("predicted"),
    ).agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(F.col("window.start").alias("window_start"), "predicted", "rows")


def class_shares(mix: DataFrame) -> DataFrame:
    """Shares within each window of a finished ``class_mix`` table."""
    totals = mix.groupBy("window_start").agg(F.sum("rows").alias("total"))
    return mix.join(totals, "window_start").select(
        "window_start", "predicted", "rows", (F.col("rows") / F.col("total")).alias("share")
    )


def latency(log: DataFrame, *, window: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Count, mean, maximum and approximate 95th percentile per window."""
    summed = log.withWatermark("event_time", delay).groupBy(F.window("event_time", window)).agg(
        F.count("latency_ms").alias("rows"),
        F.avg("latency_ms").alias("mean_ms"),
        F.max("latency_ms").alias("max_ms"),
        F.percentile_approx("latency_ms", 0.95, 1000).alias("p95_ms"),
    )
    return summed.select(
        F.col("window.start").alias("window_start"), "rows", "mean_ms", "max_ms", "p95_ms"
    )


def drop_replays(log: DataFrame, *, key: str = "key", delay: str = "1 hour") -> DataFrame:
    """Keep the first record of each key seen within the watermark."""
    return log.withWatermark("event_time", delay).dropDuplicatesWithinWatermark([key])


def failure_bursts(log: DataFrame, *, gap: str = "6 hours", delay: str = "1 hour") -> DataFrame:
    """Parse failures of a user that follow each other within the gap."""
    failures = log.filter(F.col("predicted").isNull()).withWatermark("event_time", delay)
    bursts = failures.groupBy("user_id", F.session_window("event_time", gap)).agg(
        F.count(F.lit(1)).alias("failures")
    )
    return bursts.select(
        "user_id",
        F.col("session_window.start").alias("burst_start"),
        F.col("session_window.end").alias("burst_end"),
        "failures",
    )


def run_available(stream: DataFrame, *, mode: str, progress: str, table=None, each=None):
    """Start a query over what is there, wait for it and return it with its progress.

    Either rows are appended to a parquet table, or each batch and its number go to a function.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", progress)
    writer = writer.format("parquet") if each is None else writer.foreachBatch(each)
    query = writer.trigger(availableNow=True).start(*([table] if each is None else []))
    query.awaitTermination()
    return query


def append_to_table(stream: DataFrame, *, table: str, progress: str) -> DataFrame:
    """Process what is available; a row is appended once it is final.

    Give the same two paths again to go on: progress holds what has been read, the open
    windows and the keys seen, and the file sink commits each batch once, so a query that
    is stopped and started neither loses nor repeats rows. Windows that the watermark
    hasn't passed stay open in progress until later rows close them.
    """
    run_available(stream, mode="append", table=table, progress=progress)
    return stream.sparkSession.read.schema(stream.schema).parquet(table)


def replace_groups(table: str, keys: Sequence[str], one_file: bool = True):
    """A batch writer that replaces the folder of every group in the batch, and no other.

    A folder's name is the group's key, so a batch that is written again, whole or after
    half of it, leaves the same rows. New files are complete before old ones go. A group's
    rows go through one task and into one file, unless ``one_file`` is off, for large groups.
    """
    def write(batch: DataFrame, _: int) -> None:
        # One file for each folder; a batch has few groups, all of open windows.
        writer = (batch.repartition(*keys) if one_file else batch).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(table)

    return write


def upsert_table(
    stream: DataFrame, *, table: str, progress: str, keys: Sequence[str] = ("window_start",)
) -> DataFrame:
    """Process what is available; the table then holds every window, the open ones too.

    For aggregations over windows, of which ``keys`` name a group. Each batch replaces the
    groups that it changed; a window that the watermark has passed leaves the state and
    stays in the table as it is. Give the same two paths again to go on.
    """
    run_available(stream, mode="update", progress=progress, each=replace_groups(table, keys))
    return read_table(stream, table)


def read_table(stream: DataFrame, table: str) -> DataFrame:
    """What ``upsert_table`` has written so far, with the stream's columns."""
    return stream.sparkSession.read.schema(stream.schema).parquet(table).select(stream.columns)


def open_bursts(spark: SparkSession, progress: str) -> DataFrame:
    """The bursts that a stopped ``failure_bursts`` query has not closed yet, from its state."""
    state = spark.read.format("statestore").load(progress)
    window = F.col("value.session_window")
    return state.select(
        "value.user_id", window["start"].alias("burst_start"), window["end"].alias("burst_end"),
        F.col("value.count").alias("failures"),
    )


def bursts_so_far(stream: DataFrame, *, table: str, progress: str) -> DataFrame:
    """Process what is available; closed bursts and, behind them, those still open.

    Closed bursts are appended once and leave the state. The open ones are read from the
    state and not from the table, so they are never written twice.
    """
    closed = append_to_table(stream, table=table, progress=progress)
    return closed.unionByName(open_bursts(stream.sparkSession, progress))


def count_arrivals(
    log: DataFrame, *, table: str, progress: str, window: str = "1 day", slide: str | None = None
) -> DataFrame:
    """Process what is available; how many rows of each window have arrived, late or not.

    Needs no state: every batch keeps its own counts, in a folder of its number, and a batch
    that runs again replaces them. One row per window and batch.
    """
    counts = replace_groups(table, ("batch_id",))

    def count(batch: DataFrame, batch_id: int) -> None:
        spans = batch.groupBy(F.window("event_time", window, slide)["start"].alias("window_start"))
        counted = spans.agg(F.count(F.lit(1)).alias("rows"))
        counts(counted.withColumn("batch_id", F.lit(batch_id).cast("bigint")), batch_id)

    run_available(log, mode="append", progress=progress, each=count)
    schema = "window_start timestamp, rows bigint, batch_id bigint"
    return log.sparkSession.read.schema(schema).parquet(table)


def late_rows(windows: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Windows with ``late_rows``: what arrived for them and isn't in their ``rows``.

    Both tables must have taken in the same log. A window of which all rows came late has
    a row too, with no rows counted.
    """
    arrived = arrivals.groupBy("window_start").agg(F.sum("rows").alias("arrived"))
    counted = windows.groupBy("window_start").agg(F.sum("rows").alias("counted"))
    late = arrived.join(counted, "window_start", "left").select(
        "window_start", (F.col("arrived") - F.coalesce("counted", F.lit(0))).alias("late_rows"))
    joined = late.join(windows, "window_start", "left")
    return joined.withColumn("rows", F.coalesce("rows", F.lit(0))).select(*windows.columns, "late_rows")


def latency_sketches(log: DataFrame, *, window: str = "1 day", delay: str = "1 hour", size: int = 1024) -> DataFrame:
    """Count, maximum and a quantile sketch of the latencies per window.

    Sketches of neighbouring windows merge (``rolled_up``), which percentiles do not.
    ``size`` bounds a sketch: the rank of a quantile is off by about 2.3 / size.
    """
    summed = log.withWatermark("event_time", delay).groupBy(F.window("event_time", window)).agg(
        F.count("latency_ms").alias("rows"),
        F.max("latency_ms").alias("max_ms"),
        F.kll_sketch_agg_double("latency_ms", size).alias("sketch"),
    )
    return summed.select(F.col("window.start").alias("window_start"), "rows", "max_ms", "sketch")


def rolled_up(sketches: DataFrame, period: str, quantiles: Mapping[str, float]) -> DataFrame:
    """Windows put together to longer ones (``day``, ``week``, ``month``), with quantiles.

    Reads one row per window and none of the log. A period without latencies has nulls.
    """
    merged = sketches.groupBy(F.date_trunc(period, "window_start").alias("window_start")).agg(
        F.count("*").alias("windows"), F.sum("rows").alias("rows"), F.max("max_ms").alias("max_ms"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )
    return merged.select("window_start", "windows", "rows", "max_ms", *(
        F.when(F.col("rows") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(q))).alias(name)
        for name, q in quantiles.items()
    ))
