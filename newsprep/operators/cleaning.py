"""Drop empty rows, normalise labels, check the label domain."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsprep.functions.fixed_values import CONTENT, LABELS, REQUIRED_COLUMNS, SENTIMENT, SUMMARY
from newsprep.functions.text import literal_none, normalize_label, not_blank


def apply_null_policy(
    df: DataFrame, *, columns: Sequence[str] = REQUIRED_COLUMNS, null_policy: str = "drop"
) -> DataFrame:
    """``drop`` treats a null cell as empty; ``literal`` reads it as the text ``None``."""
    if null_policy == "drop":
        return df
    if null_policy == "literal":
        return df.withColumns({c: literal_none(F.col(c)) for c in columns})
    raise ValueError(f"unknown null policy: {null_policy!r}")


def drop_empty_rows(
    df: DataFrame, *, columns: Sequence[str] = REQUIRED_COLUMNS, null_policy: str = "drop"
) -> DataFrame:
    """Keep the rows in which every column still has text after stripping."""
    df = apply_null_policy(df, columns=columns, null_policy=null_policy)
    return df.filter(reduce(and_, [not_blank(F.col(c)) for c in columns]))


def unexpected_labels(
    df: DataFrame, *, label: str = SENTIMENT, labels: Sequence[str] = LABELS
) -> DataFrame:
    """Labels outside the domain with their row counts.

    The rows are counted per label first (combined on the map side), the domain
    is taken away from the small result.
    """
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("rows"))
    return counts.filter(F.col("label").isNull() | ~F.col("label").isin(*labels)).orderBy("label")


def require_known_labels(
    df: DataFrame, *, label: str = SENTIMENT, labels: Sequence[str] = LABELS, show: int = 50
) -> DataFrame:
    """Raise when a label lies outside the domain.

    The message counts all offenders and names the first; ``unexpected_labels`` is the
    whole report, which may be of any length.
    """
    report = unexpected_labels(df, label=label, labels=labels)
    found = report.agg(
        F.count(F.lit(1)).alias("labels"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
    ).first()
    if found["labels"]:
        named = [str(r["label"]) for r in report.take(show)]
        rest = found["labels"] - len(named)
        raise ValueError(
            f"{found['labels']} labels outside the domain on {found['rows']} rows: {named}"
            + (f" and {rest} more, not shown" if rest else "")
        )
    return df


def clean_articles(
    df: DataFrame,
    *,
    content: str = CONTENT,
    summary: str = SUMMARY,
    label: str = SENTIMENT,
    labels: Sequence[str] = LABELS,
    null_policy: str = "drop",
    strict: bool = False,
) -> DataFrame:
    """Drop empty rows, normalise the label and, in strict mode, check its domain."""
    kept = drop_empty_rows(df, columns=(content, summary, label), null_policy=null_policy)
    cleaned = kept.withColumn(label, normalize_label(F.col(label)))
    return require_known_labels(cleaned, label=label, labels=labels) if strict else cleaned


def class_counts(df: DataFrame, *, label: str = SENTIMENT) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("rows")).orderBy(label)


def label_names(
    df: DataFrame, *, label: str = SENTIMENT, labels: Sequence[str] = LABELS
) -> DataFrame:
    """One row: the sorted labels of the domain that are present, the decoder of
    ``encode_labels``. Never longer than the domain."""
    return df.filter(F.col(label).isin(*labels)).agg(
        F.array_sort(F.collect_set(label)).alias("label_names")
    )


def encode_labels(
    df: DataFrame,
    *,
    label: str = SENTIMENT,
    labels: Sequence[str] = LABELS,
    code: str = "label_id",
) -> DataFrame:
    """Add the dense integer of each present label, in alphabetical order from 0."""
    dimension = label_names(df, label=label, labels=labels).select(
        F.posexplode("label_names").alias(code, label)
    )
    return df.join(F.broadcast(dimension), label, "left")


def decode_labels(
    encoded: DataFrame,
    names: DataFrame,
    *,
    code: str = "label_id",
    label: str = SENTIMENT,
) -> DataFrame:
    """Turn codes back into labels with the row that ``label_names`` gave."""
    dimension = names.select(F.posexplode("label_names").alias(code, label))
    return encoded.drop(label).join(F.broadcast(dimension), code, "left")


def dataset_preflight(
    df: DataFrame,
    *,
    columns: Sequence[str] = REQUIRED_COLUMNS,
    content: str = CONTENT,
    label: str = SENTIMENT,
    labels: Sequence[str] = LABELS,
) -> DataFrame:
    """Row count, null and blank cells per column, usable rows, rows with a bad
    label and the lengths of the texts, in one pass over the table."""
    usable = reduce(and_, [F.coalesce(not_blank(F.col(c)), F.lit(False)) for c in columns])
    checks = [F.count(F.lit(1)).alias("rows")]
    for c in columns:
        checks.append(F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"))
        checks.append(F.count_if(~not_blank(F.col(c))).alias(f"{c}_blanks"))
    known = normalize_label(F.col(label)).isin(*labels)
    checks.append(F.count_if(usable).alias("usable_rows"))
    checks.append(F.count_if(usable & ~known).alias("unexpected_label_rows"))
    size = F.length(content)
    checks += [
        F.min(size).alias(f"{content}_min_length"),
        F.avg(size).alias(f"{content}_mean_length"),
        F.max(size).alias(f"{content}_max_length"),
    ]
    return df.agg(*checks)
