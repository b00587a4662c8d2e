"""Views of the test tables in the shape that the operators expect.

Nothing is made up: articles are the documents with their labels, responses are
written from the texts themselves, runs are the orders, job attempts the line
items, and the prediction log is the event table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsprep.operators.plugins import Message
from newsprep.sources.articles import load_articles

SENTENCE = r"[^.\n]+[.]?"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with label; the summary is the first sentence, as a whole.

    Labels are spelled as differently as they come in practice; unlabelled
    documents have an empty one.
    """
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    label = (
        F.when(F.col("toxic") == 1, " negative ")
        .when(F.col("quality") == 1, "POSITIVE")
        .when(F.col("quality") == 0, "neutral")
        .otherwise("")
    )
    joined = documents.join(labels, "doc_id", "left").select(
        "doc_id",
        F.col("text").alias("Content"),
        F.regexp_extract("text", SENTENCE, 0).alias("Summary"),
        label.alias("Sentiment"),
        "source",
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("doc_id", F.lit(365)).cast("int"))
        .cast("string")
        .alias("news_date"),
    )
    return load_articles(joined, row_id="doc_id", keep=("source", "news_date"))


def responses(articles: DataFrame, *, shift: int = 0) -> DataFrame:
    """One answer per article; its shape goes by the news source.

    The ten shapes: no tags, summary tag only, lower-case tags, empty summary,
    label tag that lists all labels, two label tags, wrong label, first line,
    second line, and the summary without its first word.
    """
    shape = F.pmod(F.substring("source", 4, 10).cast("int") + shift, F.lit(10))
    label = F.initcap(F.trim("Sentiment"))
    summary, text = F.col("Summary"), F.col("Content")

    def answer(inner: Column, tag: Column) -> Column:
        return F.concat(
            F.lit("<SUMMARY>\n"), inner, F.lit("\n</SUMMARY>\n<SENTIMENT>\n"), tag,
            F.lit("\n</SENTIMENT>"),
        )

    wrong = (
        F.when(label == "Positive", "Negative").when(label == "Negative", "Neutral")
        .otherwise("Positive")
    )
    return articles.select(
        "row_id",
        F.when(shape == 0, F.concat(F.lit("No structured answer: "), summary))
        .when(shape == 1, F.concat(F.lit("<SUMMARY>"), summary, F.lit("</SUMMARY>")))
        .when(
            shape == 2,
            F.concat(
                F.lit("<summary> "), summary, F.lit(" </summary>\n<sentiment> neutral </sentiment>")
            ),
        )
        .when(
            shape == 3,
            F.concat(F.lit("<SUMMARY>  </SUMMARY><SENTIMENT>"), label, F.lit("</SENTIMENT>")),
        )
        .when(shape == 4, answer(summary, F.lit("Positive, Negative, or Neutral")))
        .when(
            shape == 5,
            F.concat(
                answer(summary, F.lit("Negative")), F.lit("<SENTIMENT>"), label,
                F.lit("</SENTIMENT>"),
            ),
        )
        .when(shape == 6, answer(summary, wrong))
        .when(shape == 7, answer(F.split_part(text, F.lit("\n"), F.lit(1)), label))
        .when(shape == 8, answer(F.split_part(text, F.lit("\n"), F.lit(2)), label))
        .otherwise(answer(F.regexp_replace(summary, "^[^ ]* ", ""), label))
        .alias("raw_response"),
    )


def log_columns(events: DataFrame) -> DataFrame:
    """Events as a prediction log; an error is an answer that did not parse."""
    kind = F.col("event_type")
    return events.select(
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_id").alias("key"),
        "user_id",
        F.col("value").alias("latency_ms"),
        F.when(kind == "view", "Neutral")
        .when(kind.isin("click", "purchase"), "Positive")
        .when(kind == "signup", "Negative")
        .alias("predicted"),
    )


#: Loads that the log arrives in, and the days in each.
LOADS, LOAD_DAYS = 4, 8


def loads(events: DataFrame) -> DataFrame:
    """Events with the load that they arrive in; one in 23 arrives three days late."""
    late = F.when(F.pmod("event_id", F.lit(23)) == 0, 3).otherwise(0)
    days = F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) + late
    return events.withColumn("load", F.least(F.lit(LOADS - 1), F.floor(days / LOAD_DAYS).cast("int")))


def raw_labels(events: DataFrame) -> DataFrame:
    """Labels as an annotation tool might export them, with a bad one among them."""
    kind = F.col("event_type")
    return events.select(
        F.col("event_id").alias("row_id"),
        F.when(kind == "view", " neutral ")
        .when(kind == "click", "POSITIVE")
        .when(kind == "purchase", "mostly-positive")
        .when(kind == "signup", "Negative\n")
        .otherwise(" unparsed ")
        .alias("Sentiment"),
    )


def _iso(timestamp: Column) -> Column:
    return F.concat(
        F.date_format(timestamp.cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")
    )


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as run manifests."""
    orders = table(spark, sf_dir, "orders")
    priority, state = F.col("o_orderpriority"), F.col("o_orderstatus")
    seconds = F.floor("o_totalprice").cast("bigint")
    ended = _iso(
        F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + seconds)
    )
    status = (
        F.when(state == "F", "completed").when(state == "P", "failed")
        .when(priority.isin("1-URGENT", "2-HIGH"), "training").otherwise("preparing")
    )
    arguments = {
        "dataset_id": F.lit("articles"),
        "dataset_split": F.lit("train"),
        "limit": F.when(priority == "2-HIGH", "0").otherwise("5000"),
        "test_size": F.lit("0.1"),
        "seed": F.when(state == "P", "7").otherwise("42"),
        "max_length": F.when(priority == "5-LOW", "512").otherwise("1024"),
        "learning_rate": F.when(priority != "4-NOT SPECIFIED", "0.0002"),
        "no_deduplicate": F.lit("false"),
    }
    entries = F.array(*(F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in arguments.items()))
    fingerprint = F.sha2(F.concat_ws(":", F.col("o_custkey").cast("string"), priority), 256)
    return orders.select(
        F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("run_id"),
        F.concat(F.lit("line-"), F.col("o_custkey").cast("string")).alias("lineage"),
        status.alias("status"),
        _iso(F.col("o_orderdate")).alias("created_at"),
        F.when(state == "F", ended).alias("completed_at"),
        F.when(state == "P", ended).alias("failed_at"),
        F.map_from_entries(F.filter(entries, lambda e: e["v"].isNotNull())).alias(
            "command_arguments"
        ),
        F.struct(
            F.lit("articles").alias("id"),
            seconds.alias("train_rows"),
            F.floor(seconds / 10).cast("bigint").alias("eval_rows"),
            fingerprint.alias("train_fingerprint"),
            F.when(state != "O", F.sha2(F.col("o_custkey").cast("string"), 256)).alias(
                "eval_fingerprint"
            ),
        ).alias("dataset"),
        F.when(
            priority == "1-URGENT",
            F.array(F.struct(_iso(F.col("o_orderdate")).alias("resumed_at"))),
        ).alias("resume_events"),
    )


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as the status files of job attempts."""
    items = table(spark, sf_dir, "lineitem")
    failed = F.col("l_returnflag") == "R"
    run = F.concat(F.lit("run-"), F.col("l_orderkey").cast("string"))
    finished = F.timestamp_seconds(
        F.unix_seconds(F.col("l_shipdate").cast("timestamp"))
        + F.col("l_quantity").cast("bigint") * 3600
    )
    return items.select(
        F.when(failed, "failed").otherwise("completed").alias("status"),
        F.when(failed, 7).otherwise(0).alias("exit_code"),
        _iso(F.col("l_shipdate")).alias("started_at"),
        _iso(finished).alias("finished_at"),
        F.concat(F.lit("host-"), F.col("l_suppkey").cast("string")).alias("host"),
        F.concat(F.lit("outputs/"), run).alias("output_dir"),
    )


def run_pairs(runs: DataFrame) -> DataFrame:
    """Every run with the first run of its lineage, which it resumes from."""
    first = runs.groupBy("lineage").agg(
        F.min(F.struct("created_at", "run_id"))["run_id"].alias("saved_run")
    )
    return (
        runs.select("lineage", F.col("run_id").alias("current_run"))
        .join(first, "lineage")
        .filter(F.col("saved_run") != F.col("current_run"))
        .select("saved_run", "current_run")
    )


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long metrics per run, from the line items of the order."""
    totals = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.round(1 - F.avg("l_discount"), 6).alias("a"),
        F.round(1 - F.avg("l_tax"), 6).alias("p"),
        F.round(F.avg("l_quantity") / 50, 6).alias("r"),
    )
    return totals.select(
        F.concat(F.lit("run-"), F.col("l_orderkey").cast("string")).alias("run_id"),
        F.expr(
            "stack(3, 'sentiment_accuracy', a, 'sentiment_parse_rate', p, 'mean_rouge_l_f1', r)"
        ).alias("metric", "value"),
    )


def run_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long thresholds per run; some runs leave one unset."""
    priority = F.col("o_orderpriority")
    wide = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("run_id"),
        F.when(priority == "1-URGENT", 0.96).otherwise(0.93).alias("a"),
        F.lit(0.95).alias("p"),
        F.when(priority != "4-NOT SPECIFIED", 0.5).alias("r"),
    )
    return wide.select(
        "run_id",
        F.expr(
            "stack(3, 'sentiment_accuracy', a, 'sentiment_parse_rate', p, 'mean_rouge_l_f1', r)"
        ).alias("metric", "minimum"),
    )


class CharacterTokenizer:
    """One token per character; stands in for a model's tokenizer."""

    def encode(self, text: str, add_special_tokens: bool = False) -> str:
        return text

    def decode(self, token_ids: str, skip_special_tokens: bool = True) -> str:
        return token_ids

    def apply_chat_template(self, messages: list[Message], **options) -> str:
        return "".join(f"<{m['role']}>{m['content']}</{m['role']}>" for m in messages)


class LeadPredictor:
    """A rule in place of a model: the first sentence, and a label by layout and size."""

    def __call__(self, prompts: list[list[Message]]) -> list[str]:
        return [self._answer(p[-1]["content"]) for p in prompts]

    def _answer(self, user: str) -> str:
        import re

        article = user[user.index("<ARTICLE>\n") + 10 : user.rindex("\n</ARTICLE>")]
        sentence = re.search(SENTENCE, article)
        label = (
            "Negative" if "|" in article else "Positive" if len(article) > 500 else "Neutral"
        )
        lead = sentence.group(0) if sentence else ""
        return f"<SUMMARY>{lead}</SUMMARY><SENTIMENT>{label}</SENTIMENT>"
