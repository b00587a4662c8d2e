"""Run manifests and job status files as tables."""

from __future__ import annotations

import contextlib
import os
import re
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from newsprep.sources.many_files import alone, mounted, read_documents

_COUNTS = "map<string, bigint>"

MANIFEST_SCHEMA = (
    "run_id string, status string, created_at string, training_started_at string, "
    "completed_at string, failed_at string, command_arguments map<string, string>, "
    "model struct<id: string, requested_revision: string, resolved_revision: string>, "
    "dataset struct<id: string, requested_revision: string, resolved_revision: string, "
    "split: string, train_rows: bigint, eval_rows: bigint, train_fingerprint: string, "
    f"eval_fingerprint: string, train_class_counts: {_COUNTS}, eval_class_counts: {_COUNTS}>, "
    "resume_events array<struct<resumed_at: string, checkpoint: string>>, "
    "error_type string, error string"
)

JOB_STATUS_SCHEMA = (
    "status string, exit_code int, started_at string, finished_at string, host string, "
    "output_dir string"
)


def run_of_path(path: Column) -> Column:
    """The run a file belongs to: the folder it lies in."""
    return F.element_at(F.split(path, "/"), -2)


#: What Spark writes otherwise in names of folders, and the name for no value.
_ESCAPED, _NO_VALUE = re.compile(r"""[\x01-\x1f"#%'*/:=?\\{[\]^\x7f]"""), "__HIVE_DEFAULT_PARTITION__"


def _folder_name(key: str, value: str | None) -> str:
    escaped = _NO_VALUE if value is None else _ESCAPED.sub(lambda c: f"%{ord(c[0]):02X}", value)
    return f"{key}={escaped}"


#: Rows whose folders a task makes before it lets another one do so, and fills them meanwhile.
TURN = 500


def write_manifest_files(manifests: DataFrame, path: str, *, folder: str) -> None:
    """A file of manifests for each value of ``folder``, in the folder ``<folder>=<value>``.

    ``path`` is a new one. Every folder is written by one task, and a task that runs again
    writes the same files. On a mounted file system tasks open the files themselves: Hadoop
    starts a process for the permissions of each folder, file and checksum there, and the
    driver moves one folder after the other. Folders of one parent come into being one after the
    other anyway; tasks take turns at it, which is faster than all at once.
    """
    named = manifests.withColumn(folder, F.nullif(F.col(folder).cast("string"), F.lit("")))
    dealt = named.repartition(folder)
    top = mounted(manifests.sparkSession, path)
    if top is None:
        dealt.write.partitionBy(folder).json(path)
        return
    os.makedirs(top)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        with contextlib.ExitStack() as opened:
            for some in (b.slice(at, TURN) for b in batches for at in range(0, len(b), TURN)):
                values, lines = (c.to_pylist() for c in some.columns)
                names = [_folder_name(folder, v) for v in values]
                with alone(top):
                    for name in dict.fromkeys(names):
                        with contextlib.suppress(FileExistsError):
                            os.mkdir(f"{top}/{name}")
                for name, own in groupby(zip(names, lines), key=itemgetter(0)):
                    if name != last:  # the last folder of a turn may go on in the next
                        opened.close()
                        file = opened.enter_context(
                            open(f"{top}/{name}/run_manifest.json", "w", encoding="utf-8"))
                        last = name
                    file.writelines(f"{line}\n" for _, line in own)
        yield from ()

    content = F.struct(*(c for c in manifests.columns if c != folder))
    lines = dealt.select(folder, F.to_json(content).alias("line")).sortWithinPartitions(folder)
    lines.mapInArrow(write, "files bigint").write.format("noop").mode("overwrite").save()


#: Entries of a compressed file. One task reads it whole, and some others beside it, since
#: Spark puts small files together; their entries are sorted in the task's memory.
FILE_ENTRIES = 50_000


def write_entries(entries: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """Manifests or job statuses as compressed JSON Lines, in files of bounded size."""
    writer = entries.write.mode(mode).option("maxRecordsPerFile", FILE_ENTRIES)
    writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").json(path)


def read_manifests(
    spark: SparkSession, path: str, *, one_per_file: bool = True, schema: str = MANIFEST_SCHEMA
) -> DataFrame:
    """Many manifests, either one indented document per file or JSON Lines.

    Argument values of any JSON type are read as strings. A malformed document is an error.
    Of very many folders that a pattern at the end of ``path`` names, on a mounted file system,
    tasks make the list and read the files (``many_files``). Otherwise the driver has the list,
    and for a pattern of files it looks into one folder after the other.
    """
    documents = read_documents(spark, path) if one_per_file else None
    if documents is None:
        reader = spark.read.schema(schema).option("mode", "FAILFAST")
        manifests = reader.json(path, multiLine=one_per_file)
        if not one_per_file:
            return manifests
        return manifests.withColumn("run_id", F.coalesce("run_id", run_of_path(F.input_file_name())))
    # As in Spark's reader, a file may hold an array of documents.
    fields = StructType.fromDDL(schema)
    parsed = F.from_json("document", ArrayType(fields), {"mode": "FAILFAST"})
    each = documents.select("folder", F.explode(parsed).alias("m"))
    content = {name: F.col("m")[name] for name in fields.names}
    content["run_id"] = F.coalesce(content["run_id"], "folder")
    return each.select(*(column.alias(name) for name, column in content.items()))


def read_job_statuses(
    spark: SparkSession, path: str, *, one_per_file: bool = True, schema: str = JOB_STATUS_SCHEMA
) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path, multiLine=one_per_file)


def micros(text: Column) -> Column:
    """An ISO-8601 time, with ``Z`` or an offset, in microseconds; null if it is none."""
    return F.unix_micros(F.try_to_timestamp(text))


MANIFEST_FIELDS = ("status", "created_at", "ended_at", "train_rows", "eval_rows", "resumes")


def latest_manifests(manifests: DataFrame) -> DataFrame:
    """(run_id, manifest): the latest manifest of each run, with the time it is ordered by.

    A manifest is as late as the latest time in it, that of a resumption included; times are
    compared as times, whatever their zone is written like. ``ended_at`` belongs to the
    state: a run that goes on after a resumption has not ended. Of entries of one time the
    one with more resumptions counts, then the one with the greatest values.
    """
    resumed = F.array_max(
        F.transform(F.col("resume_events"), lambda e: micros(e["resumed_at"]))
    )
    names = ("created_at", "training_started_at", "completed_at", "failed_at")
    times = [micros(F.col(c)) for c in names if c in manifests.columns]
    resumes = F.greatest(F.size("resume_events"), F.lit(0))
    values = {
        "status": F.col("status"),
        "created_at": F.col("created_at"),
        "ended_at": F.when(F.col("status") == "completed", F.col("completed_at"))
        .when(F.col("status") == "failed", F.col("failed_at")),
        "train_rows": F.col("dataset.train_rows"),
        "eval_rows": F.col("dataset.eval_rows"),
        "resumes": resumes,
    }
    order = F.struct(F.greatest(*times, resumed).alias("at"), resumes.alias("resumed"),
                     *(v.alias(n) for n, v in values.items()))
    return manifests.groupBy("run_id").agg(F.max(order).alias("manifest"))


def latest_jobs(jobs: DataFrame) -> DataFrame:
    """(run_id, attempts, job): the number of job statuses of each run, and the latest."""
    order = F.struct(
        micros(F.col("started_at")).alias("started"), micros(F.col("finished_at")).alias("finished"),
        "exit_code", "host", "status",
    )
    return jobs.groupBy("run_id").agg(F.count(F.lit(1)).alias("attempts"), F.max(order).alias("job"))


def joined_registry(manifests: DataFrame, jobs: DataFrame) -> DataFrame:
    """The registry from any number of ``latest_manifests`` and ``latest_jobs`` put together.

    Rows are dealt out before they are reduced: their runs hardly repeat within a file, and a
    task would sort all that it reads of these dense files in memory, to no use.
    """
    manifests, jobs = manifests.repartition("run_id"), jobs.repartition("run_id")
    last = manifests.groupBy("run_id").agg(F.max("manifest").alias("m"))
    job = jobs.groupBy("run_id").agg(F.sum("attempts").alias("attempts"), F.max("job").alias("j"))
    return _registry(last, job)


def _registry(last: DataFrame, job: DataFrame) -> DataFrame:
    return last.join(job, "run_id", "left").select(
        "run_id",
        *(f"m.{c}" for c in MANIFEST_FIELDS),
        F.coalesce("attempts", F.lit(0)).alias("job_attempts"),
        F.col("j.status").alias("job_status"),
        F.col("j.exit_code").alias("job_exit_code"),
        F.col("j.host").alias("job_host"),
    )


def run_registry(manifests: DataFrame, jobs: DataFrame) -> DataFrame:
    """One row per run: its latest manifest and the latest job status of its output folder.

    ``jobs`` carries a ``run_id``. Both inputs are read once and reduced within tasks, so
    one row per run and task moves, however many entries a run has. See
    ``latest_manifests`` for what is latest; ``streaming.registry`` keeps a registry up to
    date without reading old files again.
    """
    last = latest_manifests(manifests).withColumnRenamed("manifest", "m")
    return _registry(last, latest_jobs(jobs).withColumnRenamed("job", "j"))
