"""Reports for reviewers: gates, error slices, unsupported words, worst examples,
comparison of two evaluations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsprep.functions.fixed_values import CONTENT, GATED_METRICS
from newsprep.functions.text import word_tokens


class ThresholdFailed(ValueError):
    """A metric is below its required minimum."""


def thresholds_table(df: DataFrame, minimums: Mapping[str, float | None]) -> DataFrame:
    """(metric, minimum) of a handful of thresholds; None means not set."""
    for metric, minimum in minimums.items():
        if minimum is not None and not 0 <= minimum <= 1:
            raise ValueError(f"the threshold of {metric} must lie between 0 and 1")
    return df.sparkSession.createDataFrame(
        [(m, None if v is None else float(v)) for m, v in minimums.items()],
        "metric string, minimum double",
    )


def threshold_gate(
    metrics: DataFrame,
    thresholds: DataFrame,
    *,
    by: Sequence[str] = (),
    strict: bool = False,
    gated: Sequence[str] = GATED_METRICS,
) -> DataFrame:
    """The verdict per gated metric: ``passed``, ``failed`` or ``skipped``.

    A value equal to the minimum passes; a metric whose threshold is not set is
    skipped. A threshold that is set for a metric the report lacks is failed. ``strict``
    raises on the first failure, in the order of ``gated``.

    Thresholds are a handful. With ``by`` columns each group of the report is held against
    all of them.
    """
    wanted = thresholds
    if by:
        each = [
            F.struct(F.lit(r["metric"]).alias("metric"), F.lit(r["minimum"]).cast("double").alias("minimum"))
            for r in thresholds.select("metric", "minimum").collect()
        ]
        wanted = metrics.select(*by).distinct().select(*by, F.inline(F.array(*each)))
    judged = wanted.join(metrics, [*by, "metric"], "left").select(
        *by,
        "metric",
        "value",
        "minimum",
        F.when(F.col("minimum").isNull(), "skipped")
        .when(F.col("value") >= F.col("minimum"), "passed")
        .otherwise("failed")
        .alias("verdict"),
    )
    if strict:
        order = F.array_position(F.array(*map(F.lit, gated)), F.col("metric"))
        failed = judged.filter("verdict = 'failed'")
        for row in failed.orderBy(F.when(order > 0, order).asc_nulls_last(), "metric").take(1):
            value = "missing" if row["value"] is None else f"{row['value']:.4f}"
            raise ThresholdFailed(
                f"{row['metric']} is {value}, required is {row['minimum']:.4f}"
            )
    return judged


def release_readiness(
    runs: DataFrame,
    metrics: DataFrame,
    thresholds: DataFrame,
    *,
    run: str = "run_id",
    gated: Sequence[str] = GATED_METRICS,
) -> DataFrame:
    """Per run, whether it may be released and everything that speaks against it.

    Every gated threshold must be set for the run, a missing metric counts as -1,
    and all failures are listed. ``metrics`` and ``thresholds`` are long tables
    (run, metric, value) and (run, metric, minimum). Of several values of a metric the
    least counts, of several thresholds the greatest: no evaluation is left out that
    speaks against a release.
    """
    def wide(table: DataFrame, value: str, prefix: str, pick) -> DataFrame:
        return table.groupBy(run).agg(
            *(pick(F.when(F.col("metric") == m, F.col(value))).alias(prefix + m) for m in gated)
        )

    joined = (
        runs.select(run)
        .join(wide(metrics, "value", "_v_", F.min), run, "left")
        .join(wide(thresholds, "minimum", "_m_", F.max), run, "left")
    )

    def failure(metric: str) -> Column:
        value = F.coalesce(F.col(f"_v_{metric}"), F.lit(-1.0))
        minimum = F.col(f"_m_{metric}")
        return F.when(value < minimum, F.lit(metric))

    def unset(metric: str) -> Column:
        return F.when(F.col(f"_m_{metric}").isNull(), F.lit(metric))

    ordered = sorted(gated)
    return joined.select(
        run,
        F.array_compact(F.array(*map(unset, ordered))).alias("unset_thresholds"),
        F.array_compact(F.array(*map(failure, ordered))).alias("failed_metrics"),
    ).withColumn(
        "ready", (F.size("unset_thresholds") == 0) & (F.size("failed_metrics") == 0)
    )


def length_bucket(text: Column, *, edges: Sequence[int] = (500, 2000, 8000)) -> Column:
    """A readable length class of a text."""
    size = F.length(text)
    lows = [0, *edges]
    names = [f"{a}-{b - 1}" for a, b in zip(lows, edges)] + [f"{edges[-1]}+"]
    result = F.when(size < edges[0], names[0])
    for edge, name in zip(edges[1:], names[1:]):
        result = result.when(size < edge, name)
    return result.otherwise(names[-1])


def error_slices(
    records: DataFrame,
    *,
    by: Sequence[str] = ("reference_sentiment", "length_bucket", "news_date"),
) -> DataFrame:
    """Error rates over every combination of the slicing columns.

    Rows are counted at the finest grain first; the cube then unfolds only those
    counts and not the records.
    """
    wrong = ~F.col("reference_sentiment").eqNullSafe(F.col("predicted_sentiment"))
    # Plain names, so that a slicing column may be one of the columns counted.
    fine = records.select(
        *(F.col(c).alias(f"_by_{c}") for c in by),
        wrong.alias("_wrong"),
        F.col("predicted_sentiment").isNull().alias("_unparsed"),
    ).groupBy(*(f"_by_{c}" for c in by)).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if("_wrong").alias("_errors"),
        F.count_if("_unparsed").alias("_failures"),
    )
    cubed = fine.cube(*(f"_by_{c}" for c in by)).agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("_rows").alias("rows"),
        F.sum("_errors").alias("errors"),
        F.sum("_failures").alias("unparsed"),
    )
    return cubed.select(
        *(F.col(f"_by_{c}").alias(c) for c in by),
        "level",
        "rows",
        "errors",
        "unparsed",
        (F.col("errors") / F.col("rows")).alias("error_rate"),
    )


def unsupported_claims(
    df: DataFrame, *, content: str = CONTENT, summary: str = "predicted_summary"
) -> DataFrame:
    """Per row, the share of distinct summary words that the article lacks."""
    words = F.array_distinct(word_tokens(F.coalesce(F.col(summary), F.lit(""))))
    counted = df.withColumn("_words", words).withColumn(
        "_missing", F.size(F.array_except("_words", word_tokens(F.col(content))))
    )
    return counted.withColumns(
        {
            "summary_words": F.size("_words"),
            "unsupported_words": F.col("_missing"),
            "unsupported_share": F.when(
                F.size("_words") > 0, F.col("_missing") / F.size("_words")
            ).otherwise(F.lit(0.0)),
        }
    ).drop("_words", "_missing")


def unsupported_by_class(claims: DataFrame, *, label: str = "reference_sentiment") -> DataFrame:
    return claims.groupBy(label).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg("unsupported_share").alias("mean_unsupported_share"),
        F.count_if(F.col("unsupported_words") > 0).alias("rows_with_unsupported"),
    )


def review_queue(
    records: DataFrame,
    *,
    k: int = 20,
    label: str = "reference_sentiment",
    key: str = "index",
) -> DataFrame:
    """The k worst examples of each class: unparsed first, then lowest ROUGE-L.

    The rank limit is applied before the exchange too, so each task passes on at
    most k rows per class, however unevenly the classes are filled.
    """
    worst_first = Window.partitionBy(label).orderBy(
        F.col("predicted_sentiment").isNotNull(), "rouge_l_f1", key
    )
    return records.withColumn("rank", F.row_number().over(worst_first)).filter(
        F.col("rank") <= k
    )


def compare_runs(
    before: DataFrame,
    after: DataFrame,
    *,
    key: str = "index",
    tolerance: float = 0.0,
) -> DataFrame:
    """Metrics of two evaluations on their common rows, and what got worse.

    Rows of only one evaluation are counted but not compared.
    """
    def side(records: DataFrame, name: str) -> DataFrame:
        return records.select(
            key,
            F.struct(
                F.col("reference_sentiment").eqNullSafe(F.col("predicted_sentiment"))
                .cast("double").alias("sentiment_accuracy"),
                F.col("predicted_sentiment").isNotNull()
                .cast("double").alias("sentiment_parse_rate"),
                F.col("predicted_summary").isNotNull()
                .cast("double").alias("summary_parse_rate"),
                F.col("rouge_l_f1").alias("mean_rouge_l_f1"),
            ).alias(name),
        )

    names = ("sentiment_accuracy", "sentiment_parse_rate", "summary_parse_rate", "mean_rouge_l_f1")
    joined = side(before, "a").join(side(after, "b"), key, "full")
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    totals = joined.agg(
        F.count_if(both).alias("common_rows"),
        F.count_if(F.col("b").isNull()).alias("only_before"),
        F.count_if(F.col("a").isNull()).alias("only_after"),
        *(F.avg(F.when(both, F.col(f"{s}.{m}"))).alias(f"_{s}_{m}") for m in names for s in "ab"),
    )
    rows = ", ".join(f"'{m}', _a_{m}, _b_{m}" for m in names)
    return totals.select(
        F.expr(f"stack({len(names)}, {rows})").alias("metric", "before", "after"),
        "common_rows",
        "only_before",
        "only_after",
    ).withColumns(
        {
            "delta": F.col("after") - F.col("before"),
            "regressed": F.col("after") < F.col("before") - F.lit(float(tolerance)),
        }
    )
