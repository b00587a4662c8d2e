"""Very many folders of a few small JSON files each, on a mounted file system."""

from __future__ import annotations

import contextlib
import fcntl
import json
import os
import re
from collections.abc import Iterator
from fnmatch import fnmatchcase
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: So few folders are left to Spark's reader, whose driver looks into as many itself.
FEW_FOLDERS = 32
#: Folders for a task to read, and bytes of documents that it holds at a time.
TASK_FOLDERS, HELD_BYTES = 5_000, 4 << 20

#: A folder's path with a pattern for its folders, of such signs as mean the same everywhere.
_PATTERN = re.compile(r"([^*?{}\[\]\\]+)/([^/{}\[\]\\]*\*[^/{}\[\]\\]*)")

#: What Spark writes otherwise in the addresses of files: signs that these have not, controls, spaces.
_QUOTED = re.compile(
    r"[^-\w!.~'()*,;:$&+=@\u00a1-\U0010ffff]|[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]", re.ASCII)


def mounted(spark: SparkSession, path: str) -> str | None:
    """The path by which tasks can open what lies there, if the file system is a mounted one."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.makeQualified(at).toUri().getPath() if files.getUri().getScheme() == "file" else None


@contextlib.contextmanager
def alone(folder: str) -> Iterator[None]:
    """One task of a machine is in here at a time; where folders can't be locked, all are."""
    at = os.open(folder, os.O_RDONLY)
    try:
        with contextlib.suppress(OSError):
            fcntl.flock(at, fcntl.LOCK_EX)
        yield
    finally:
        os.close(at)


def _quoted(name: str) -> str:
    return _QUOTED.sub(lambda c: "".join(f"%{b:02X}" for b in c[0].encode()), name)


def _hidden(name: str) -> bool:
    return name.startswith((".", "_")) and "=" not in name


def _files(folder: str) -> Iterator[tuple[str, bool]]:
    """(path, plain) of a folder's files; what is not plain only Spark's reader knows how to take.

    That are folders of a column's value, checksums, compressed files, whatever else is not
    named .json, and files and hidden folders that a pattern names.
    """
    if _hidden(os.path.basename(folder)):
        yield folder, False
        return
    try:
        found = os.scandir(folder)
    except NotADirectoryError:
        yield folder, False
        return
    with found:
        for entry in found:
            if entry.is_dir():
                if "=" in entry.name:
                    yield entry.path, False
            elif not _hidden(entry.name):
                yield entry.path, entry.name.endswith(".json")
            elif entry.name.endswith(".crc") or "_metadata" in entry.name:
                yield entry.path, False


def _folders(spark: SparkSession, top: str, pattern: str) -> DataFrame:
    """The paths that fit; one task reads the names in ``top`` and passes them on."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            with os.scandir(top) as found:
                # Files are no folders, but Spark reads them unless they are hidden.
                paths = (e.path for e in found if fnmatchcase(e.name, pattern)
                         and (e.is_dir() or not _hidden(e.name)))
                while some := list(islice(paths, 10_000)):
                    yield pa.record_batch({"folder": pa.array(some, pa.string())})

    return spark.range(0, 1, 1, 1).mapInArrow(look, "folder string")


def _looked_into(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        others = sum(not plain for f in batch.column(0).to_pylist() for _, plain in _files(f))
        yield pa.record_batch([pa.array([len(batch)]), pa.array([others])], ["folders", "others"])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def held(rows: list[tuple[str, str]]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else ([], [])
        return pa.record_batch([pa.array(c, pa.string()) for c in columns], ["folder", "document"])

    rows, size = [], 0
    for folder in (f for b in batches for f in b.column(0).to_pylist()):
        name = _quoted(os.path.basename(folder))
        for path, plain in _files(folder):
            if not plain:
                raise ValueError(f"{path} came after the folders were looked into")
            with open(path, "rb", buffering=0) as file:
                content = file.read()
            rows.append((name, content.decode(json.detect_encoding(content))))
            size += len(content)
            if size > HELD_BYTES or len(rows) == 10_000:
                yield held(rows)
                rows, size = [], 0
    yield held(rows)


def read_documents(spark: SparkSession, path: str) -> DataFrame | None:
    """(folder, document): the files in the folders that a pattern at the end of ``path`` names.

    Tasks look into the folders and read them; the driver gets two numbers, not a list of
    files. None where Spark's own reader is to be used: for few folders, for a file system that
    is not mounted, other patterns, and where other things than plain .json files lie.
    """
    at = mounted(spark, path)
    fits = at and _PATTERN.fullmatch(at)
    if not fits:
        return None
    top, pattern = fits.groups()
    try:
        with os.scandir(top) as found:
            few = sum(1 for _ in islice(found, FEW_FOLDERS + 1)) <= FEW_FOLDERS
    except OSError:
        return None
    if few:
        return None
    folders = _folders(spark, top, pattern)
    looked = folders.repartition(2 * spark.sparkContext.defaultParallelism, "folder").mapInArrow(
        _looked_into, "folders bigint, others bigint")
    n, others = looked.agg(F.sum("folders"), F.sum("others")).first()
    if others or not n:
        return None
    tasks = 1 + n // TASK_FOLDERS
    return folders.repartition(tasks, "folder").mapInArrow(_read, "folder string, document string")
