"""Parsing, ROUGE-L, metrics and review reports against plain Python."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from newsprep.functions import parsing, rouge
from newsprep.functions.fixed_values import LABELS
from newsprep.operators import evaluation, review

RECORD = (
    "index long, reference_sentiment string, predicted_sentiment string, "
    "predicted_summary string, rouge_l_f1 double"
)


def parse(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    r = df.select(parsing.parse_response(F.col("t")).alias("p")).collect()[0]["p"]
    return r["summary"], r["sentiment"]


@pytest.mark.parametrize(
    "text,wanted",
    [
        ("<SUMMARY>Revenue increased.</SUMMARY><SENTIMENT>positive</SENTIMENT>",
         ("Revenue increased.", "Positive")),
        ("invalid", (None, None)),
        ("", (None, None)),
        ("<SUMMARY></SUMMARY>", ("", None)),
        ("<SUMMARY> \n </SUMMARY>", ("", None)),
        ("<summary>\xa0two\nlines </Summary>", ("two\nlines", None)),
        ("<SENTIMENT>\nPositive, Negative, or Neutral\n</SENTIMENT>"
         "<SENTIMENT> NEUTRAL </SENTIMENT>", (None, "Neutral")),
        ("<SENTIMENT>Negative</SENTIMENT><SENTIMENT>Positive</SENTIMENT>", (None, "Negative")),
        ("<SUMMARY>open <SUMMARY>again</SUMMARY>", ("open <SUMMARY>again", None)),
        ("<SUMMARY>never closed", (None, None)),
    ],
)
def test_parse(spark, text, wanted):
    assert parse(spark, text) == wanted


def table_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_lcs_against_table(spark):
    rng = random.Random(11)
    pairs = [([], []), (["a"], []), ([], ["b"])]
    for size in (3, 20, 70, 130, 400):
        for _ in range(12):
            pairs.append(tuple(
                [rng.choice("abcdefgh")] * 1 + rng.choices("abcdefghijkl", k=rng.randint(0, size))
                for _ in range(2)
            ))
    for a, b in pairs:
        assert rouge.common_subsequence_length(a, b) == table_lcs(a, b)
    df = spark.createDataFrame(
        [(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a array<string>, b array<string>"
    )
    got = df.select(
        "i", "a", "b", rouge.lcs_length(F.col("a"), F.col("b")).alias("lcs")
    ).collect()
    assert all(r["lcs"] == table_lcs(r["a"], r["b"]) for r in got)
    small = df.filter(F.size("a") < 25)
    native = small.select("i", "a", "b", rouge.lcs_length_native(F.col("a"), F.col("b")).alias("n"))
    assert all(r["n"] == table_lcs(r["a"], r["b"]) for r in native.collect())


def test_rouge_values(spark):
    cases = [("same summary", "same summary", 1.0), ("", "prediction", 0.0), ("a", "", 0.0),
             ("a", None, 0.0), ("x y", "a b", 0.0)]
    df = spark.createDataFrame(cases, "r string, p string, wanted double")
    for r in evaluation.with_rouge(df, reference="r", prediction="p").collect():
        assert r["rouge"]["f1"] == r["wanted"]
    df = spark.createDataFrame([("Revenue increased today", "revenue, increased!")], "r string, p string")
    row = df.select(rouge.rouge_l(F.col("r"), F.col("p")).alias("s")).collect()[0]["s"]
    assert row["precision"] == 1.0 and row["recall"] == 2 / 3
    assert row["f1"] == pytest.approx(0.8) and row["f1"] > 0.7


def make_records(spark, n=300, labels=LABELS, seed=5):
    rng = random.Random(seed)
    data = [
        (i, rng.choice(labels), rng.choice([*LABELS, None]), rng.choice(["s", "", None]),
         rng.random())
        for i in range(n)
    ]
    return data, spark.createDataFrame(data, RECORD)


def python_metrics(data):
    scores = []
    for label in LABELS:
        hit = sum(r == p == label for _, r, p, *_ in data)
        said = sum(p == label for _, _, p, *_ in data)
        real = sum(r == label for _, r, *_ in data)
        scores.append(2 * hit / (said + real) if hit else 0.0)
    n = len(data)
    return {
        "sentiment_accuracy": sum(r == p for _, r, p, *_ in data) / n,
        "sentiment_macro_f1": sum(scores) / 3,
        "sentiment_parse_rate": sum(p is not None for _, _, p, *_ in data) / n,
        "summary_parse_rate": sum(s is not None for *_, s, _ in data) / n,
        "mean_rouge_l_f1": sum(d[-1] for d in data) / n,
    }


@pytest.mark.parametrize("labels", [LABELS, ("Positive",), ("Negative", "Positive")])
def test_metrics_report(spark, labels):
    data, records = make_records(spark, labels=labels)
    wanted = python_metrics(data)
    row = evaluation.metrics_report(records).collect()[0]
    for name, value in wanted.items():
        assert row[name] == pytest.approx(value), name
    assert row["examples"] == len(data)
    report = evaluation.metrics_report(records).select(F.to_json("predicted_class_counts"))
    predicted = json.loads(report.collect()[0][0])
    assert list(predicted) == sorted(predicted) and sum(predicted.values()) == len(data)
    assert set(row["reference_class_counts"]) == set(labels)
    assert evaluation.macro_f1(records).collect()[0][0] == pytest.approx(
        wanted["sentiment_macro_f1"])
    assert evaluation.accuracy(records).collect()[0][0] == pytest.approx(
        wanted["sentiment_accuracy"])
    cells = evaluation.confusion_counts(records).collect()
    assert len(cells) == 12 and sum(c["rows"] for c in cells) == len(data)


def test_report_is_one_aggregation(spark):
    _, records = make_records(spark, 10)
    plan = evaluation.metrics_report(records)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert evaluation.metrics_report(records.filter("index < 0")).count() == 0


def test_records_of_missing_responses(spark):
    refs = spark.createDataFrame(
        [(1, " sum ", "Positive", True), (2, "other", "Neutral", False)],
        "row_id long, Summary string, Sentiment string, was_truncated boolean",
    )
    answers = spark.createDataFrame(
        [(1, "<SUMMARY>sum</SUMMARY><SENTIMENT>neutral</SENTIMENT>")],
        "row_id long, raw_response string",
    )
    rows = {r["index"]: r for r in evaluation.prediction_records(refs, answers).collect()}
    assert rows[1]["reference_summary"] == "sum" and rows[1]["rouge_l_f1"] == 1.0
    assert rows[1]["predicted_sentiment"] == "Neutral" and rows[1]["article_truncated"]
    assert rows[2]["predicted_sentiment"] is None and rows[2]["raw_response"] == ""


def test_gate(spark):
    metrics = spark.createDataFrame(
        [("sentiment_accuracy", 0.8), ("sentiment_parse_rate", 0.9), ("mean_rouge_l_f1", 0.1)],
        "metric string, value double",
    )

    def verdicts(**minimums):
        table = review.thresholds_table(metrics, minimums)
        return {r["metric"]: r["verdict"] for r in review.threshold_gate(metrics, table).collect()}

    assert verdicts(sentiment_accuracy=0.8, sentiment_parse_rate=0.95, mean_rouge_l_f1=None) == {
        "sentiment_accuracy": "passed", "sentiment_parse_rate": "failed",
        "mean_rouge_l_f1": "skipped"}
    with pytest.raises(review.ThresholdFailed):
        review.threshold_gate(
            metrics, review.thresholds_table(metrics, {"sentiment_accuracy": 0.81}), strict=True)
    with pytest.raises(ValueError):
        review.thresholds_table(metrics, {"sentiment_accuracy": 1.1})


def test_release(spark):
    runs = spark.createDataFrame([("a",), ("b",), ("c",)], "run_id string")
    names = ("sentiment_accuracy", "sentiment_parse_rate", "mean_rouge_l_f1")
    metrics = spark.createDataFrame(
        [("a", m, 0.5) for m in names] + [("b", names[0], 0.5), ("b", names[1], 0.2),
                                          ("c", names[0], 0.9)],
        "run_id string, metric string, value double")
    thresholds = spark.createDataFrame(
        [(r, m, 0.5) for r in "ab" for m in names] + [("c", names[0], 0.5)],
        "run_id string, metric string, minimum double")
    rows = {r["run_id"]: r for r in review.release_readiness(runs, metrics, thresholds).collect()}
    assert rows["a"]["ready"]
    assert rows["b"]["failed_metrics"] == ["mean_rouge_l_f1", "sentiment_parse_rate"]
    assert rows["c"]["unset_thresholds"] == ["mean_rouge_l_f1", "sentiment_parse_rate"]
    assert not rows["b"]["ready"] and not rows["c"]["ready"]


def test_error_slices_total(spark):
    data, records = make_records(spark)
    sliced = records.withColumns(
        {"length_bucket": F.when(F.col("index") < 100, "a").otherwise("b"),
         "news_date": (F.col("index") % 5).cast("string")})
    rows = review.error_slices(sliced).collect()
    grand = [r for r in rows if r["level"] == 7]
    assert len(grand) == 1 and grand[0]["rows"] == len(data)
    assert grand[0]["errors"] == sum(r != p for _, r, p, *_ in data)
    by_class = {r["reference_sentiment"]: r["rows"] for r in rows if r["level"] == 3}
    assert by_class == {l: sum(d[1] == l for d in data) for l in LABELS}


def test_review_queue_limits_before_the_exchange(spark):
    data, records = make_records(spark)
    queue = review.review_queue(records.repartition(6), k=4)
    plan = queue._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    rows = queue.collect()
    for label in LABELS:
        wanted = sorted((d for d in data if d[1] == label),
                        key=lambda d: (d[2] is not None, d[4], d[0]))[:4]
        got = sorted((r for r in rows if r["reference_sentiment"] == label),
                     key=lambda r: r["rank"])
        assert [r["index"] for r in got] == [d[0] for d in wanted]


def test_compare_runs(spark):
    data, before = make_records(spark, 100)
    other, after = make_records(spark, 120, seed=6)
    rows = {r["metric"]: r for r in review.compare_runs(
        before.filter("index >= 10"), after).collect()}
    wanted_a, wanted_b = python_metrics(data[10:]), python_metrics(other[10:100])
    for name, row in rows.items():
        assert row["before"] == pytest.approx(wanted_a[name])
        assert row["after"] == pytest.approx(wanted_b[name])
        assert row["regressed"] == (wanted_b[name] < wanted_a[name])
        assert (row["common_rows"], row["only_before"], row["only_after"]) == (90, 0, 30)


def test_unsupported_words(spark):
    df = spark.createDataFrame(
        [("Profit rose in May.", "profit fell in may"), ("x", None)],
        "Content string, predicted_summary string")
    rows = review.unsupported_claims(df).collect()
    assert (rows[0]["summary_words"], rows[0]["unsupported_words"]) == (4, 1)
    assert rows[0]["unsupported_share"] == 0.25 and rows[1]["unsupported_share"] == 0.0
    assert re.fullmatch(r"\w+", "profit")


def test_a_threshold_without_its_metric_fails(spark):
    metrics = spark.createDataFrame([("sentiment_accuracy", 0.9)], "metric string, value double")
    wanted = review.thresholds_table(
        metrics, {"mean_rouge_l_f1": 0.9, "sentiment_parse_rate": 0.5, "sentiment_accuracy": 0.95}
    )
    verdicts = {r["metric"]: r["verdict"] for r in review.threshold_gate(metrics, wanted).collect()}
    assert set(verdicts.values()) == {"failed"} and len(verdicts) == 3
    with pytest.raises(review.ThresholdFailed, match="sentiment_accuracy is 0.9000"):
        review.threshold_gate(metrics, wanted, strict=True)
    lacking = review.thresholds_table(metrics, {"mean_rouge_l_f1": 0.1, "sentiment_accuracy": 0.1})
    with pytest.raises(review.ThresholdFailed, match="mean_rouge_l_f1 is missing"):
        review.threshold_gate(metrics, lacking, strict=True)
    runs = metrics.selectExpr("'a' AS run", "*").union(metrics.selectExpr("'b' AS run", "*"))
    assert review.threshold_gate(runs, lacking, by=["run"]).count() == 4


def test_the_worst_evaluation_decides_a_release(spark):
    runs = spark.createDataFrame([("r",)], "run_id string")
    values = [("r", "sentiment_accuracy", 0.2), ("r", "sentiment_accuracy", 0.9),
              ("r", "sentiment_parse_rate", 1.0), ("r", "mean_rouge_l_f1", 1.0)]
    metrics = spark.createDataFrame(values, "run_id string, metric string, value double")
    minimums = spark.createDataFrame(
        [("r", m, 0.8) for m in ("sentiment_accuracy", "sentiment_parse_rate", "mean_rouge_l_f1")],
        "run_id string, metric string, minimum double",
    )
    row = review.release_readiness(runs, metrics, minimums).collect()[0]
    assert not row["ready"] and row["failed_metrics"] == ["sentiment_accuracy"]
