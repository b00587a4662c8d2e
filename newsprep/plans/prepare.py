"""The two jobs: prepare a split dataset, evaluate responses on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsprep.functions.fixed_values import (
    CONTENT,
    DEFAULT_LIMIT,
    DEFAULT_MAX_LENGTH,
    DEFAULT_SEED,
    DEFAULT_TEST_SIZE,
    LABELS,
    SENTIMENT,
)
from newsprep.functions.text import content_fingerprint
from newsprep.operators.cleaning import clean_articles
from newsprep.operators.evaluation import prediction_records
from newsprep.operators.formatting import fit_labelled
from newsprep.operators.splitting import seeded_sample, stratified_split
from newsprep.session import materialize


def split_assignment(
    cleaned: DataFrame,
    *,
    deduplicate: bool = True,
    limit: int = DEFAULT_LIMIT,
    test_size: float = DEFAULT_TEST_SIZE,
    seed: int = DEFAULT_SEED,
    content: str = CONTENT,
    label: str = SENTIMENT,
    labels: Sequence[str] = LABELS,
    key: str = "row_id",
    stratify: bool = True,
) -> DataFrame:
    """(key, label, split) of every row that is kept; the label is null outside
    the domain. If all rows are kept, it is the cleaned table with ``split``.

    All decisions are taken on key, label and digest. That narrow table is
    written once, because counting and ranking read it several times; the texts
    are read once for the digests and are never shuffled here. The label travels
    as its number, so that with a numeric key the grouping is a hash aggregation
    with fixed-size state.
    """
    names = F.array(*map(F.lit, labels))
    number = F.coalesce(F.array_position(names, F.col(label)).cast("int"), F.lit(0))
    numbered = cleaned.select(key, number.alias("number"))
    if deduplicate:
        digest = F.unhex(content_fingerprint(F.col(content)))
        numbered = (
            cleaned.select(digest.alias("digest"), key, number.alias("number"))
            .groupBy("digest")
            .agg(F.min_by("number", key).alias("number"), F.min(key).alias(key))
        )
    kept = numbered.select(key, F.get(names, F.col("number") - 1).alias(label))
    keys = materialize(kept, "keys")
    split = dict(
        label=label, labels=labels, test_size=test_size, seed=seed, key=key, stratify=stratify
    )
    if not deduplicate and limit == 0:
        # Every row stays, so the texts can be marked where they are.
        return stratified_split(cleaned, keys=keys, **split)
    return stratified_split(seeded_sample(keys, n=limit, seed=seed, key=key), **split)


def load_and_split(
    articles: DataFrame, *, null_policy: str = "drop", strict: bool = False, **options
) -> DataFrame:
    """Clean, drop copies, sample and split: the texts with a ``split`` column.

    A pure function of data and settings, so training and evaluation that call it
    with the same settings see the same split. The texts move once, in the join
    of the kept keys, and stay where they are when the kept keys are few.
    """
    cleaned = clean_articles(articles, null_policy=null_policy, strict=strict)
    assignment = split_assignment(cleaned, **options)
    if not options.get("deduplicate", True) and options.get("limit", DEFAULT_LIMIT) == 0:
        return assignment
    key = options.get("key", "row_id")
    return cleaned.join(assignment.select(key, "split"), key)


def evaluate(
    references: DataFrame,
    responses: DataFrame,
    *,
    max_length: int = DEFAULT_MAX_LENGTH,
    unit: str = "char",
    keep: tuple[str, ...] = (),
    index: str = "row_id",
) -> DataFrame:
    """Prediction records of cleaned reference rows.

    Whether an article was cut depends on the length of the reference completion
    too, as the budget of a row is what its completion leaves over.
    """
    fitted = fit_labelled(references, unit=unit, max_length=max_length)
    return prediction_records(fitted, responses, index=index, keep=keep)
