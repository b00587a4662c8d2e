"""From labelled articles to chat examples that fit a token budget."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsprep.functions.chat import (
    PromptTemplate,
    build_completion,
    build_prompt,
    chat_overhead,
)
from newsprep.functions.fitting import (
    closed_form_keep_words,
    head_tail_chars,
    head_tail_words,
    search_keep_chars,
)
from newsprep.functions.fixed_values import (
    CONTENT,
    DEFAULT_MAX_LENGTH,
    HEAD_SHARE,
    SENTIMENT,
    SUMMARY,
    TRUNCATION_MARKER,
)
from newsprep.functions.text import has_runs, plain_spaces, spaced_word_count


class ArticleDoesNotFit(ValueError):
    """Even an empty article exceeds the maximum length."""


def fit_article(
    df: DataFrame,
    *,
    content: str = CONTENT,
    overhead: Column,
    max_length: int = DEFAULT_MAX_LENGTH,
    unit: str = "char",
    head_share: float = HEAD_SHARE,
    marker: str = TRUNCATION_MARKER,
    strict: bool = False,
) -> DataFrame:
    """Add ``article``, ``sequence_length``, ``was_truncated`` and ``overflow``.

    ``overhead`` is the rendered length of everything but the article. Text that
    fits is left untouched. A row that cannot fit at all, or whose article or completion
    is null, has ``overflow`` set and null results, so it can be routed aside; ``strict``
    raises instead.
    Everything is a narrow transformation inside the scan's stage.
    """
    if max_length <= 0:
        raise ValueError("max_length must be positive")
    text, spaced = F.col(content), F.col("_spaced")
    budget, size, keep = F.col("_budget"), F.col("_size"), F.col("_keep")
    shape = {"head_share": head_share, "marker": marker}
    if unit == "char":
        measured = df.withColumns(
            {"_budget": F.lit(max_length) - overhead, "_size": F.length(text)}
        )
        search = search_keep_chars(text, size, has_runs(plain_spaces(text)), budget, **shape)
        cut = head_tail_chars(text, size, keep, **shape)
        cut_size = F.length(F.col("article"))
    else:
        measured = df.withColumn("_spaced", plain_spaces(text)).withColumns(
            {"_budget": F.lit(max_length) - overhead, "_size": spaced_word_count(spaced)}
        )
        search = closed_form_keep_words(budget, marker=marker)
        cut = head_tail_words(text, spaced, size, keep, **shape)
        cut_size = keep + F.lit(len(marker.split()))
    # null: the text fits as it is; -1: nothing fits.
    fitted = (
        measured.withColumn("_keep", F.when(size > budget, search))
        .withColumn("article", F.when(size <= budget, text).when(keep >= 0, cut))
        .select(
            *df.columns,
            "article",
            (
                F.when(size <= budget, size).when(keep >= 0, cut_size)
                + F.lit(max_length)
                - budget
            )
            .cast("int")
            .alias("sequence_length"),
            (size > budget).alias("was_truncated"),
            F.coalesce(keep < 0, size.isNull() | budget.isNull()).alias("overflow"),
        )
    )
    if strict and fitted.filter("overflow").limit(1).count():
        raise ArticleDoesNotFit(f"some rows do not fit {max_length} even without an article")
    return fitted


def fit_labelled(
    df: DataFrame,
    *,
    summary: str = SUMMARY,
    label: str = SENTIMENT,
    unit: str = "char",
    template: PromptTemplate = PromptTemplate(),
    **options,
) -> DataFrame:
    """``fit_article`` with the overhead of each row's own completion."""
    overhead = chat_overhead(F.col(summary), F.col(label), unit=unit, template=template)
    return fit_article(df, overhead=overhead, unit=unit, **options)


def fit_overflow(fitted: DataFrame) -> DataFrame:
    """The rows that cannot fit, for the quarantine table."""
    return fitted.filter("overflow")


def format_sft(
    df: DataFrame,
    *,
    summary: str = SUMMARY,
    label: str = SENTIMENT,
    template: PromptTemplate = PromptTemplate(),
    **options,
) -> DataFrame:
    """Prompt, completion, template arguments and the two audit columns.

    Rows that cannot fit are left to ``fit_overflow``. ``row_id`` and ``split``
    pass through when present.
    """
    fitted = fit_labelled(df, summary=summary, label=label, template=template, **options)
    passed = [c for c in ("row_id", "split") if c in df.columns]
    return fitted.filter("not overflow").select(
        *passed,
        build_prompt(F.col("article"), template).alias("prompt"),
        build_completion(F.col(summary), F.col(label)).alias("completion"),
        F.struct(F.lit(False).alias("enable_thinking")).alias("chat_template_kwargs"),
        "sequence_length",
        "was_truncated",
    )


def format_stats(formatted: DataFrame, *, split: str = "split") -> DataFrame:
    """Rows, truncated rows and greatest length per split. An empty split has no row."""
    return formatted.groupBy(split).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("was_truncated").alias("truncated"),
        F.max("sequence_length").alias("max_length"),
    )


def length_distribution(
    df: DataFrame, *, length: str, max_length: int, percentages: Sequence[float] = (0.5, 0.9, 0.99)
) -> DataFrame:
    """Rows, percentiles, greatest length and the share over a budget: one row.

    To choose a maximum length by. Rows are counted per length first, so the exact
    percentiles are taken of one row per length. Rows without a length are left out.
    """
    counts = df.filter(F.col(length).isNotNull()).groupBy(F.col(length).alias("length")).agg(
        F.count(F.lit(1)).alias("n")
    )
    over = F.sum(F.when(F.col("length") > max_length, F.col("n")).otherwise(0))
    return counts.agg(
        F.sum("n").alias("rows"),
        *(
            F.percentile("length", F.lit(p), F.col("n")).alias(f"p{round(100 * p)}")
            for p in percentages
        ),
        F.max("length").alias("max_length"),
        F.try_divide(over, F.sum("n")).alias("over_budget"),
    )
