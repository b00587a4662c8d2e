"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings a job should run with. Partition counts and join strategies are left
#: to adaptive execution, which decides on measured sizes.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join whose build side turns out small per partition need not sort the article
    # texts of the other side. Compared with compressed bytes; the hash table can't spill.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Sessions are merged before the exchange, so a very busy user sends few rows.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session."""
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees, as the session names it in spark.checkpoint.dir.

    Only a session of one local process without one, as in a first try, gets a temporary
    folder, which goes with the process; on a cluster a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="newsprep-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_folder(spark: SparkSession) -> str:
    """What this application writes for itself lies below one folder."""
    name = f"newsprep-{spark.sparkContext.applicationId}"
    return f"{shared_folder(spark).rstrip('/')}/{name}"


def clean_up(spark: SparkSession) -> None:
    """Delete all intermediate tables and stream folders of this application.

    Results are lazy and read these tables, so this comes after the last use of any.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(path, True)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the application's part of the shared folder."""
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Used for narrow tables (keys and labels) that several later steps scan, so
    that a lost executor costs a file read and not the whole lineage.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
