"""Lines of JSON and CSV files that don't parse, set aside instead of failing the job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Holds a line that doesn't fit the schema, as it is, and is null for others.
LINE = "_malformed_line"


def with_line(schema: str) -> str:
    return f"{schema}, `{LINE}` string"


def quarantine(read: Callable[..., DataFrame], path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, malformed lines) of a path. ``read`` has a schema made by ``with_line``.

    A malformed line keeps the file it is in, where in the file's bytes the piece begins
    that a task read it in, and its text. Both results read the files by themselves and
    hold nothing; together they have every line that is not blank.
    """
    lines = read(path, mode="PERMISSIVE", columnNameOfCorruptRecord=LINE)
    lines = lines.select("*", "_metadata.file_path", "_metadata.file_block_start")
    # A line is only judged by the columns that are asked for. Asking for all of them in
    # the condition keeps the verdict the same whatever a later step selects.
    asked = sum((F.col(f"`{c}`").isNull().cast("int") for c in lines.columns), F.lit(0))
    tagged = lines.withColumn("malformed", F.col(LINE).isNotNull() & (asked >= 0))
    good = tagged.filter("NOT malformed").drop(LINE, "file_path", "file_block_start", "malformed")
    bad = tagged.filter("malformed").select("file_path", "file_block_start", F.col(LINE).alias("line"))
    return good, bad
