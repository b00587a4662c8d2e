"""ROUGE-L on word tokens."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from newsprep.functions.text import word_tokens


def common_subsequence_length(left: list[str], right: list[str]) -> int:
    """Length of the longest common subsequence, one big integer per row of the
    table: bit i of ``row`` is 0 where the length grows at ``right[i]``."""
    positions: dict[str, int] = {}
    for i, token in enumerate(right):
        positions[token] = positions.get(token, 0) | (1 << i)
    full = (1 << len(right)) - 1
    row = full
    for token in left:
        matches = row & positions.get(token, 0)
        if matches:
            row = ((row + matches) | (row - matches)) & full
    return len(right) - row.bit_count()


@F.pandas_udf(IntegerType())
def _lcs_of_joined(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series(
        [
            0 if not a or not b else common_subsequence_length(a.split(" "), b.split(" "))
            for a, b in zip(left, right)
        ],
        dtype="int32",
    )


def lcs_length(left: Column, right: Column) -> Column:
    """LCS length of two word arrays of any size.

    Words hold no spaces, so each array crosses to Python as one string, which
    Arrow moves far cheaper than a list of strings.
    """
    return _lcs_of_joined(F.array_join(left, " "), F.array_join(right, " "))


def lcs_length_native(left: Column, right: Column) -> Column:
    """The same by the textbook table, without Python: a cross-check for small inputs."""
    zeros = F.transform(right, lambda _: F.lit(0))
    first = F.concat(F.array(F.lit(0)), zeros)

    def next_row(previous: Column, token: Column) -> Column:
        return F.aggregate(
            F.arrays_zip(
                right.alias("t"), F.slice(previous, 1, F.size(right)).alias("diag"),
                F.slice(previous, F.lit(2), F.size(right)).alias("up"),
            ),
            F.array(F.lit(0)),
            lambda row, cell: F.concat(
                row,
                F.array(
                    F.when(cell["t"] == token, cell["diag"] + 1).otherwise(
                        F.greatest(cell["up"], F.element_at(row, -1))
                    )
                ),
            ),
        )

    return F.aggregate(left, first, next_row, lambda row: F.element_at(row, -1))


def prf(lcs: Column, reference_size: Column, prediction_size: Column) -> Column:
    """Precision, recall and F1 from a match length; all 0 when it is 0."""
    hit = lcs > 0
    precision = F.when(hit, lcs / prediction_size).otherwise(F.lit(0.0))
    recall = F.when(hit, lcs / reference_size).otherwise(F.lit(0.0))
    f1 = F.when(
        hit, F.lit(2.0) * precision * recall / (precision + recall)
    ).otherwise(F.lit(0.0))
    return F.struct(precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def rouge_l(reference: Column, prediction: Column) -> Column:
    """Precision, recall and F1 of the longest common word subsequence."""
    left = word_tokens(F.coalesce(reference, F.lit("")))
    right = word_tokens(F.coalesce(prediction, F.lit("")))
    return prf(lcs_length(left, right), F.size(left), F.size(right))
