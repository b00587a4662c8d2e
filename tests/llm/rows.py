"""Rows for the tests: ordinary texts from the given tables, and awkward ones."""

from __future__ import annotations

import pytest

#: Columns whose names the operators use for themselves.
CLASHING = (
    "n_words kept reason score predicted toxic fp cell tile fps part pos size shard slot "
    "block train digest payload first n pre_token pieces rare row known spans redacted "
    "contaminated removal_spans total label term component_id sequence_id before_size"
).split()

LONG = " ".join(f"w{i % 977} x{i * i % 1009}" for i in range(60_000))

AWKWARD = [
    (1, None),
    (2, ""),
    (None, "no identity here but words"),
    (None, None),
    (3, " \t\n\x0b\x0c\r "),
    (4, LONG),
    (5, "same text twice"),
    (5, "same text twice"),
    (6, "same text twice"),
    (7, "naïve Ünïcode text with ​odd \x1cspaces\x85 and \U0001f600 emoji"),
    (8, "a"),
    (9, "one\n\none\nTwo\n one\nTwo\n"),
    (-10, "x" * 5000),
    (11, "the cat sat on the mat and the cat sat on the mat again " * 9),
    (12, "don't  stop \n\n  now'll 12345 ab12  <|endoftext|> tail<|endoftext|>"),
    (13, "  leading and trailing  "),
]


def documents(spark, rows=AWKWARD, clash=True):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    if clash:
        df = df.selectExpr("*", *(f"'{c}' AS {c}" for c in CLASHING))
    return df


def given(spark, small, n=120):
    df = spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").limit(n)
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def collected(df, *columns):
    """Rows as tuples, sorted with nulls first."""
    rows = [tuple(r[c] for c in columns) for r in df.select(*columns).collect()]
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


approx = pytest.approx
