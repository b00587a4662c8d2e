"""Run queries and their SQL twins side by side and compare the rows."""

from __future__ import annotations

import glob
import math
import os
import time

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


# Spark type: the DuckDB type that a twin must return.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def _cell(value):
    if value is None or value is pd.NaT:
        return ("", "null")
    if isinstance(value, float):
        return ("", "null") if math.isnan(value) else (type(value).__name__, repr(value))
    return (type(value).__name__, str(value))


def compare(spark, sf_dir: str, build, sql: str) -> str | None:
    """None when rows and types agree, otherwise what differs."""
    started = time.time()
    df = build(spark, sf_dir)
    names = sorted(df.columns)
    ours = [tuple(_cell(r[c]) for c in names) for r in df.collect()]
    middle = time.time()
    cursor = connect(sf_dir).execute(sql)
    described = {d[0]: str(d[1]) for d in cursor.description}
    if sorted(described) != names:
        return f"columns: {names} against {sorted(described)}"
    fetched = cursor.fetchall()
    order = [list(described).index(c) for c in names]
    theirs = [tuple(_cell(r[i]) for i in order) for r in fetched]
    compare.seconds = (middle - started, time.time() - middle, len(ours))
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wrong = {c: (types[c], described[c]) for c in names if TYPES[types[c]] != described[c]}
    if wrong:
        return f"types: {wrong}"
    if len(ours) != len(theirs):
        return f"rows: {len(ours)} against {len(theirs)}"
    extra = sorted(set(ours) - set(theirs))[:2]
    lacking = sorted(set(theirs) - set(ours))[:2]
    if sorted(ours) != sorted(theirs):
        return f"values: {str(extra)[:600]} against {str(lacking)[:600]}"
    return None
