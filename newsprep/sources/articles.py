"""Article tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsprep.functions.fixed_values import REQUIRED_COLUMNS
from newsprep.sources.quarantine import quarantine, with_line


def schema_contract(
    df: DataFrame, *, required: Sequence[str] = REQUIRED_COLUMNS, strict: bool = False
) -> DataFrame:
    """One row per required column, sorted, saying whether the table has it.

    Reads the schema only. Extra columns are allowed. ``strict`` raises instead
    of reporting.
    """
    missing = sorted(set(required) - set(df.columns))
    if strict and missing:
        raise ValueError(f"required columns are missing: {missing}")
    rows = [(name, name not in missing) for name in sorted(set(required))]
    return df.sparkSession.createDataFrame(rows, "column string, present boolean")


def load_articles(
    source: DataFrame,
    *,
    row_id: str | Column = "row_id",
    keep: Sequence[str] = (),
    required: Sequence[str] = REQUIRED_COLUMNS,
) -> DataFrame:
    """The contract columns as strings, with an explicit row key."""
    schema_contract(source, required=required, strict=True)
    key = F.col(row_id) if isinstance(row_id, str) else row_id
    return source.select(
        key.alias("row_id"), *(F.col(c).cast("string").alias(c) for c in required), *keep
    )


def _string_schema(
    spark: SparkSession, path: str, format: str, options: dict, needed: Sequence[str]
) -> str:
    """All columns as strings, in the file's order where that counts."""
    if format == "csv":
        # Columns of a CSV file are found by place; its first line says which is where.
        names = spark.read.options(**options).csv(path, enforceSchema=False).columns
        schema_contract(spark.createDataFrame([], ", ".join(f"`{c}` string" for c in names)),
                        required=needed, strict=True)
        needed = names
    return ", ".join(f"`{c}` string" for c in dict.fromkeys(needed))


def _text_reader(spark: SparkSession, path: str, format: str, options: dict | None, columns: dict):
    """(options, schema) of a JSON or CSV path."""
    if format not in ("json", "csv"):
        raise ValueError(f"unsupported format: {format!r}")
    key = columns.get("row_id", "row_id")
    if not isinstance(key, str):
        raise ValueError("name the key column of a JSON or CSV path")
    needed = (key, *columns.get("required", REQUIRED_COLUMNS), *columns.get("keep", ()))
    options = ({"header": True} if format == "csv" else {}) | (options or {})
    return options, _string_schema(spark, path, format, options, needed)


def read_articles(
    spark: SparkSession, path: str, *, format: str = "parquet", options: dict | None = None,
    **columns,
) -> DataFrame:
    """``load_articles`` over a parquet, JSON Lines or CSV path.

    JSON and CSV are read as strings by a given schema: the contract's columns, the key
    and what to keep. So nothing is read twice to guess types; a CSV file's header must
    name these columns, in any order and among others.
    """
    if format == "parquet":
        return load_articles(spark.read.options(**(options or {})).parquet(path), **columns)
    options, schema = _text_reader(spark, path, format, options, columns)
    reader = spark.read.format(format).options(**options).schema(schema)
    return load_articles(reader.load(path), **columns)


def read_articles_with_errors(
    spark: SparkSession, path: str, *, format: str, options: dict | None = None, **columns
) -> tuple[DataFrame, DataFrame]:
    """``read_articles`` over a JSON Lines or CSV path, and the lines that are no rows.

    The second table has file_path, file_block_start and line: lines that are no JSON
    object, or have fewer or more fields than the CSV header.
    """
    options, schema = _text_reader(spark, path, format, options, columns)
    reader = spark.read.options(**options).schema(with_line(schema))
    good, bad = quarantine(getattr(reader, format), path)
    return load_articles(good, **columns), bad
