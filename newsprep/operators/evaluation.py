"""Prediction records and the metrics over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsprep.functions.fixed_values import LABELS, SENTIMENT, SUMMARY, UNPARSED
from newsprep.functions.parsing import parse_sentiment, parse_summary
from newsprep.functions.rouge import lcs_length, prf
from newsprep.functions.text import strip, word_tokens

METRICS = (
    "sentiment_accuracy", "sentiment_macro_f1", "sentiment_parse_rate",
    "summary_parse_rate", "mean_rouge_l_f1",
)


def with_rouge(df: DataFrame, *, reference: str, prediction: str, name: str = "rouge") -> DataFrame:
    """Add the struct (precision, recall, f1) and keep the token work in one place.

    Words are extracted once per row, counted on the JVM, and cross to Python as
    one string per side.
    """
    def tokens(column: str) -> Column:
        return word_tokens(F.coalesce(F.col(column), F.lit("")))

    split = df.withColumns({"_ref": tokens(reference), "_pred": tokens(prediction)})
    matched = split.withColumn("_lcs", lcs_length(F.col("_ref"), F.col("_pred")))
    return matched.withColumn(
        name, prf(F.col("_lcs"), F.size("_ref"), F.size("_pred"))
    ).drop("_ref", "_pred", "_lcs")


def parse_responses(df: DataFrame, *, response: str = "raw_response") -> DataFrame:
    return df.withColumns(
        {
            "predicted_summary": parse_summary(F.col(response)),
            "predicted_sentiment": parse_sentiment(F.col(response)),
        }
    )


def align_predictions(
    references: DataFrame,
    responses: DataFrame,
    *,
    key: str = "row_id",
    summary: str = SUMMARY,
    label: str = SENTIMENT,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Pair every reference row with its parsed response, null where there is none."""
    left = references.select(
        key,
        F.col(label).alias("reference_sentiment"),
        strip(F.col(summary)).alias("reference_summary"),
        *keep,
    )
    return left.join(parse_responses(responses.select(key, "raw_response")), key, "left")


def prediction_records(
    references: DataFrame,
    responses: DataFrame,
    *,
    key: str = "row_id",
    index: str = "row_id",
    truncated: str = "was_truncated",
    keep: Sequence[str] = (),
    **columns: str,
) -> DataFrame:
    """The eight-field record of every evaluated example.

    ``index`` names the position column (``eval_subset`` adds one); without one
    the row key serves. An example without a response gets an empty one.
    """
    carried = list(dict.fromkeys([truncated, *keep, *([] if index == key else [index])]))
    pairs = align_predictions(references, responses, key=key, keep=carried, **columns)
    scored = with_rouge(pairs, reference="reference_summary", prediction="predicted_summary")
    return scored.select(
        F.col(index).cast("bigint").alias("index"),
        "reference_sentiment",
        "predicted_sentiment",
        "reference_summary",
        "predicted_summary",
        F.col("rouge.f1").alias("rouge_l_f1"),
        F.col(truncated).alias("article_truncated"),
        F.coalesce("raw_response", F.lit("")).alias("raw_response"),
        *keep,
    )


def _dimension(df: DataFrame, **columns: Sequence[str]) -> DataFrame:
    """Every combination of a few literal values, generated from one row."""
    rows = df.sparkSession.range(1).select()
    for name, values in columns.items():
        rows = rows.select("*", F.explode(F.array(*map(F.lit, values))).alias(name))
    return rows


def confusion_counts(records: DataFrame, *, labels: Sequence[str] = LABELS) -> DataFrame:
    """Rows per reference and predicted label, zeros included."""
    counted = records.groupBy(
        F.col("reference_sentiment").alias("reference"),
        F.coalesce("predicted_sentiment", F.lit(UNPARSED)).alias("predicted"),
    ).agg(F.count(F.lit(1)).alias("n"))
    cells = _dimension(records, reference=labels, predicted=[*labels, UNPARSED])
    return cells.join(counted, ["reference", "predicted"], "left").select(
        "reference", "predicted", F.coalesce("n", F.lit(0)).alias("rows")
    )


def _ratio(part: Column, whole: Column) -> Column:
    """A quotient that is 0 where the denominator is."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2 * precision * recall, precision + recall)


def class_prf(records: DataFrame, *, labels: Sequence[str] = LABELS) -> DataFrame:
    """Hits, misses, precision, recall and F1 per label, from the confusion matrix.

    An unparsed prediction is a miss of its reference label and nothing else.
    """
    cells = confusion_counts(records, labels=labels)
    # A cell counts towards its reference label and towards its predicted one.
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(F.col("reference").alias("label"), F.lit("ref").alias("side")),
                F.struct(F.col("predicted").alias("label"), F.lit("pred").alias("side")),
            )
        ).alias("s"),
        (F.col("reference") == F.col("predicted")).alias("hit"),
        "rows",
    ).select("s.label", "s.side", "hit", "rows")
    counted = sides.filter(F.col("label") != UNPARSED).groupBy("label").agg(
        F.sum(F.when(F.col("hit") & (F.col("side") == "ref"), F.col("rows")).otherwise(0))
        .alias("true_positive"),
        F.sum(F.when(~F.col("hit") & (F.col("side") == "pred"), F.col("rows")).otherwise(0))
        .alias("false_positive"),
        F.sum(F.when(~F.col("hit") & (F.col("side") == "ref"), F.col("rows")).otherwise(0))
        .alias("false_negative"),
    )
    tp, fp, fn = F.col("true_positive"), F.col("false_positive"), F.col("false_negative")
    return counted.withColumns(
        {"precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn)}
    ).withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def macro_f1(records: DataFrame, *, labels: Sequence[str] = LABELS) -> DataFrame:
    """The plain mean over all labels; an absent one counts as 0."""
    return class_prf(records, labels=labels).agg(F.avg("f1").alias("sentiment_macro_f1"))


def _share(condition: Column) -> Column:
    return F.avg(condition.cast("double"))


def _correct() -> Column:
    return F.col("reference_sentiment").eqNullSafe(F.col("predicted_sentiment"))


def accuracy(records: DataFrame) -> DataFrame:
    return records.agg(_share(_correct()).alias("sentiment_accuracy"))


def parse_rates(records: DataFrame) -> DataFrame:
    return records.agg(
        _share(F.col("predicted_sentiment").isNotNull()).alias("sentiment_parse_rate"),
        _share(F.col("predicted_summary").isNotNull()).alias("summary_parse_rate"),
    )


def mean_rouge(records: DataFrame) -> DataFrame:
    return records.agg(F.avg("rouge_l_f1").alias("mean_rouge_l_f1"))


def label_distributions(records: DataFrame) -> DataFrame:
    """Rows per reference label and per predicted label, in long form.

    Counted per pair of labels first, so only a dozen rows are unfolded.
    """
    pairs = records.groupBy(
        "reference_sentiment", F.coalesce("predicted_sentiment", F.lit(UNPARSED)).alias("predicted")
    ).agg(F.count(F.lit(1)).alias("n"))
    return (
        pairs.select(
            F.expr("stack(2, 'reference', reference_sentiment, 'predicted', predicted)").alias(
                "side", "label"
            ),
            "n",
        )
        .groupBy("side", "label")
        .agg(F.sum("n").alias("rows"))
        .orderBy("side", "label")
    )


def metrics_report(
    records: DataFrame, *, labels: Sequence[str] = LABELS, by: Sequence[str] = ()
) -> DataFrame:
    """All metrics in one pass, one row (or one per group of ``by``).

    Macro-F1 needs only conditional counts per label, so there is one
    aggregation, combined on the map side, and no join. Class counts are maps of
    the labels that occur, in order.
    """
    ref = F.col("reference_sentiment")
    pred = F.coalesce("predicted_sentiment", F.lit(UNPARSED))
    counts = [F.count(F.lit(1)).alias("examples")]
    for label in labels:
        counts += [
            F.count_if(ref == label).alias(f"_ref_{label}"),
            F.count_if(pred == label).alias(f"_pred_{label}"),
            F.count_if((ref == label) & (pred == label)).alias(f"_hit_{label}"),
        ]
    counts += [
        F.count_if(pred == UNPARSED).alias(f"_pred_{UNPARSED}"),
        F.count_if(F.col("predicted_summary").isNotNull()).alias("_summaries"),
        F.avg("rouge_l_f1").alias("mean_rouge_l_f1"),
    ]
    totals = records.groupBy(*by).agg(*counts)

    def label_f1(label: str) -> Column:
        hit = F.col(f"_hit_{label}")
        return _f1(
            _ratio(hit, F.col(f"_pred_{label}")), _ratio(hit, F.col(f"_ref_{label}"))
        )

    def counts_map(prefix: str, names: Sequence[str]) -> Column:
        entries = F.array(
            *(F.struct(F.lit(n).alias("k"), F.col(prefix + n).alias("v")) for n in sorted(names))
        )
        return F.map_from_entries(F.filter(entries, lambda e: e["v"] > 0))

    n = F.col("examples")
    hits = sum((F.col(f"_hit_{label}") for label in labels), F.lit(0))
    total_f1 = sum((label_f1(label) for label in labels), F.lit(0.0))
    return totals.filter(n > 0).select(
        *by,
        "examples",
        (hits / n).alias("sentiment_accuracy"),
        (total_f1 / len(labels)).alias("sentiment_macro_f1"),
        ((n - F.col(f"_pred_{UNPARSED}")) / n).alias("sentiment_parse_rate"),
        (F.col("_summaries") / n).alias("summary_parse_rate"),
        "mean_rouge_l_f1",
        counts_map("_ref_", labels).alias("reference_class_counts"),
        counts_map("_pred_", [*labels, UNPARSED]).alias("predicted_class_counts"),
    )


def metrics_long(report: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """One row per metric: (metric, value)."""
    pairs = ", ".join(f"'{m}', {m}" for m in METRICS)
    return report.select(
        *by, F.expr(f"stack({len(METRICS)}, {pairs})").alias("metric", "value")
    )
