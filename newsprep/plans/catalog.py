"""The queries by name. Every one reads whole tables and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsprep.functions import chat, fitting, parsing, rouge, text
from newsprep.operators import (
    cleaning,
    dedup,
    evaluation,
    formatting,
    governance,
    plugins,
    review,
    splitting,
)
from newsprep.plans import derived, prepare
from newsprep.session import configure, materialize, new_path
from newsprep.sources import articles as article_source
from newsprep.sources import datasets, predictions, runs
from newsprep.streaming import monitors, registry

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(configure(spark), sf_dir)

    QUERIES[build.__name__] = run
    return run


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_articles(derived.articles(spark, sf_dir))


def _split(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return prepare.load_and_split(derived.articles(spark, sf_dir), limit=0, **options)


def _records(spark: SparkSession, sf_dir: str, *, shift: int = 0, keep=()) -> DataFrame:
    """Every labelled article is evaluated, not just a held-out part of them."""
    articles = derived.articles(spark, sf_dir)
    return prepare.evaluate(
        cleaning.clean_articles(articles), derived.responses(articles, shift=shift), keep=keep
    )


def _round(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# Sources and sinks


@query
def load_articles(spark, sf_dir):
    return derived.articles(spark, sf_dir).select("row_id", "Content", "Summary", "Sentiment")


@query
def schema_contract(spark, sf_dir):
    documents = derived.table(spark, sf_dir, "documents")
    required = ("text", "lang", "Summary", "Sentiment")
    return article_source.schema_contract(documents, required=required)


@query
def sft_dataset_roundtrip(spark, sf_dir):
    path = new_path(spark, "sft-dataset")
    datasets.write_sft_dataset(
        formatting.format_sft(_split(spark, sf_dir)), path, keep_audit=True
    )
    rendered = chat.render_chat(F.concat("prompt", "completion"))
    digest = F.conv(F.substring(F.sha2(rendered, 256), 1, 15), 16, 10).cast("bigint")
    return datasets.read_sft_dataset(spark, path).groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.bit_xor(digest).alias("digest"),
        F.sum("sequence_length").alias("total_length"),
    )


@query
def predictions_jsonl_roundtrip(spark, sf_dir):
    path = new_path(spark, "predictions")
    predictions.write_predictions(_records(spark, sf_dir), path)
    return _round(predictions.read_predictions(spark, path), "rouge_l_f1")


@query
def run_registry(spark, sf_dir):
    manifests, jobs = new_path(spark, "manifests"), new_path(spark, "jobs")
    runs.write_entries(derived.manifests(spark, sf_dir).drop("lineage"), manifests)
    runs.write_entries(derived.jobs(spark, sf_dir), jobs)
    attempts = runs.read_job_statuses(spark, jobs, one_per_file=False)
    return runs.run_registry(
        runs.read_manifests(spark, manifests, one_per_file=False),
        attempts.withColumn("run_id", F.element_at(F.split("output_dir", "/"), -1)),
    )


@query
def run_registry_in_parts(spark, sf_dir):
    """Manifests and jobs arrive in two loads; each file is read by one of two runs."""
    path = new_path(spark, "registry")
    second = F.pmod(F.xxhash64("run_id"), F.lit(3)) == 0
    manifests = derived.manifests(spark, sf_dir).drop("lineage")
    jobs = derived.jobs(spark, sf_dir).withColumn("run_id", F.element_at(F.split("output_dir", "/"), -1))
    late = F.col("finished_at") > "1995-01-01"
    for manifest_load, job_load in ((~second, ~late), (second, late)):
        runs.write_entries(manifests.filter(manifest_load), f"{path}/manifests", mode="append")
        runs.write_entries(jobs.filter(job_load).drop("run_id"), f"{path}/jobs", mode="append")
        registry.take_in_manifests(spark, f"{path}/manifests", folder=f"{path}/kept", one_per_file=False)
        registry.take_in_jobs(spark, f"{path}/jobs", folder=f"{path}/kept", one_per_file=False)
    return registry.read_registry(spark, f"{path}/kept")


def _good_and_bad(good: DataFrame, bad: DataFrame) -> DataFrame:
    digests = good.select(
        F.lit("row").alias("kind"), "row_id",
        F.sha2(F.concat_ws("|", "Content", "Summary", "Sentiment"), 256).alias("digest"))
    return digests.unionByName(bad.select(
        F.lit("line").alias("kind"), F.lit(None).cast("string").alias("row_id"), F.sha2("line", 256).alias("digest")))


@query
def quarantined_json(spark, sf_dir):
    """Articles as JSON Lines of which some are cut off: rows and, beside them, lines."""
    path = new_path(spark, "json-lines")
    whole = derived.articles(spark, sf_dir)
    line = F.to_json(F.struct(F.col("row_id").cast("string").alias("row_id"), "Content", "Summary", "Sentiment"))
    cut = F.concat(F.lit('{"row_id": "'), F.col("row_id").cast("string"), F.lit('", "Content": "cut off'))
    whole.select(F.when(F.pmod("row_id", F.lit(7)) == 0, cut).otherwise(line).alias("value")).write.text(path)
    return _good_and_bad(*article_source.read_articles_with_errors(spark, path, format="json"))


@query
def quarantined_csv(spark, sf_dir):
    """Articles as CSV without quotes; an article with a comma makes a field too many."""
    path = new_path(spark, "csv-lines")
    plain = F.trim(F.translate("text", ',"\n\r\t\\', " " * 6))
    comma = F.when(F.pmod("doc_id", F.lit(7)) == 0, F.lit("one, two ")).otherwise(F.lit("one "))
    content = F.concat(comma, F.coalesce(plain, F.lit("")), F.lit("|"))
    lines = derived.table(spark, sf_dir, "documents").select(
        F.concat_ws(",", "doc_id", content, "source", "lang").alias("row_id,Content,Summary,Sentiment"))
    # One column with a header that is the whole first line.
    lines.write.csv(path, header=True, sep="\x01", ignoreTrailingWhiteSpace=False)
    return _good_and_bad(*article_source.read_articles_with_errors(spark, path, format="csv"))


@query
def append_again(spark, sf_dir):
    """Two batches of a run's records, one of them written twice: every record is there once."""
    path = new_path(spark, "batches")
    records = materialize(_records(spark, sf_dir), "records")
    for batch in ("0", "1", "0"):
        own = records.filter(F.pmod("index", F.lit(2)) == int(batch))
        predictions.append_predictions(own, path, "run", batch)
    return predictions.read_runs(spark, path).groupBy("run_id", "batch").agg(
        F.count("*").alias("records"), F.count_distinct("index").alias("rows"))


@query
def sft_table_join(spark, sf_dir):
    """Examples and answers in buckets of their key, joined where they lie."""
    path = new_path(spark, "sft-table")
    name = f"sft_{path[-8:]}"
    examples = formatting.format_sft(_split(spark, sf_dir)).select("row_id", "split", "sequence_length")
    answers = derived.responses(derived.articles(spark, sf_dir))
    datasets.save_sft_table(examples, f"{name}_examples", buckets=8, path=f"{path}/examples")
    datasets.save_sft_table(answers, f"{name}_answers", buckets=8, path=f"{path}/answers")
    joined = spark.table(f"{name}_examples").join(spark.table(f"{name}_answers"), "row_id")
    return joined.groupBy("split").agg(
        F.count("*").alias("rows"), F.sum("sequence_length").alias("total_length"),
        F.sum(F.length("raw_response")).alias("answer_chars"))


@query
def manifest_files(spark, sf_dir):
    """A manifest file for each lineage, in a folder of its name, of its first run."""
    path = new_path(spark, "manifest-files")
    manifests = derived.manifests(spark, sf_dir)
    first = derived.run_pairs(manifests).select(F.col("saved_run").alias("run_id")).distinct()
    named = manifests.join(first, "run_id").withColumn("folder", F.col("lineage"))
    runs.write_manifest_files(named.drop("run_id", "lineage"), path, folder="folder")
    found = runs.read_manifests(spark, f"{path}/*")
    return found.select(
        F.replace("run_id", F.lit("folder="), F.lit("")).alias("lineage"),
        "status",
        "created_at",
        F.col("dataset.train_rows").alias("train_rows"),
        F.col("command_arguments")["limit"].alias("row_limit"),
    )


@query
def resume_unscored(spark, sf_dir):
    """Two runs over the same rows: one has scored all, the other all but the copies,
    which remain to be done."""
    cleaned = _cleaned(spark, sf_dir)
    path = new_path(spark, "scored")
    records = materialize(_records(spark, sf_dir), "records")
    predictions.append_predictions(records, path, "first")
    single = dedup.dedup_keep_first(cleaned).select(F.col("row_id").alias("index"))
    predictions.append_predictions(records.join(single, "index", "left_semi"), path, "second")
    stored = predictions.read_runs(spark, path)
    return predictions.resume_unscored(cleaned, stored, run="second").select("row_id", "Sentiment")


# Cleaning, duplicates, splitting


@query
def drop_empty_rows(spark, sf_dir):
    return cleaning.drop_empty_rows(derived.articles(spark, sf_dir)).select(
        "row_id", "Content", "Summary", "Sentiment"
    )


@query
def normalize_sentiment(spark, sf_dir):
    labels = derived.raw_labels(derived.table(spark, sf_dir, "events"))
    return labels.select("row_id", text.normalize_label(F.col("Sentiment")).alias("Sentiment"))


@query
def unexpected_labels(spark, sf_dir):
    labels = derived.raw_labels(derived.table(spark, sf_dir, "events"))
    return cleaning.unexpected_labels(
        labels.withColumn("Sentiment", text.normalize_label(F.col("Sentiment")))
    )


@query
def content_fingerprint(spark, sf_dir):
    documents = derived.table(spark, sf_dir, "documents")
    return documents.select(
        F.col("doc_id").alias("row_id"),
        text.content_fingerprint(F.col("text")).alias("fingerprint"),
    )


@query
def dedup_keep_first(spark, sf_dir):
    documents = derived.table(spark, sf_dir, "documents")
    return dedup.dedup_keep_first(documents, content="text", order_by="doc_id").select(
        "doc_id", "text", "source"
    )


@query
def dedup_report(spark, sf_dir):
    return dedup.dedup_report(derived.table(spark, sf_dir, "documents"), content="text")


@query
def seeded_sample(spark, sf_dir):
    documents = derived.table(spark, sf_dir, "documents").select("doc_id", "text")
    return splitting.seeded_sample(documents, n=500, key="doc_id")


@query
def class_counts(spark, sf_dir):
    return cleaning.class_counts(_cleaned(spark, sf_dir))


@query
def encode_labels(spark, sf_dir):
    """Encoded and decoded again."""
    cleaned = _cleaned(spark, sf_dir).select("row_id", "Sentiment")
    encoded = cleaning.encode_labels(cleaned)
    return cleaning.decode_labels(encoded, cleaning.label_names(cleaned)).select(
        "row_id", "label_id", "Sentiment"
    )


@query
def stratified_split(spark, sf_dir):
    return _split(spark, sf_dir).select("row_id", "Sentiment", "split")


@query
def random_split_fallback(spark, sf_dir):
    """A test share too small for one row per class cannot be stratified."""
    return _split(spark, sf_dir, test_size=0.00001).select("row_id", "Sentiment", "split")


@query
def random_split(spark, sf_dir):
    return _split(spark, sf_dir, stratify=False).select("row_id", "split")


@query
def temporal_holdout(spark, sf_dir):
    cleaned = _cleaned(spark, sf_dir)
    return splitting.temporal_holdout(cleaned, date="news_date").select("row_id", "split")


@query
def split_class_counts(spark, sf_dir):
    return splitting.split_class_counts(_split(spark, sf_dir))


@query
def eval_subset(spark, sf_dir):
    test = _split(spark, sf_dir).filter("split = 'test'").select("row_id", "Sentiment")
    return splitting.eval_subset(materialize(test, "test"), max_examples=25)


@query
def split_fingerprint(spark, sf_dir):
    return splitting.split_fingerprint(_split(spark, sf_dir))


@query
def split_leakage(spark, sf_dir):
    """Without removal of copies, so that there is something to find."""
    return dedup.split_leakage(_split(spark, sf_dir, deduplicate=False))


@query
def split_leakage_after_dedup(spark, sf_dir):
    return dedup.split_leakage(_split(spark, sf_dir)).agg(F.count(F.lit(1)).alias("leaks"))


@query
def dataset_preflight(spark, sf_dir):
    return _round(
        cleaning.dataset_preflight(derived.articles(spark, sf_dir)), "Content_mean_length"
    )


# Formatting and fitting


@query
def build_prompt(spark, sf_dir):
    prompt = chat.build_prompt(F.col("Content"))
    return derived.articles(spark, sf_dir).select("row_id", prompt.alias("p")).select(
        "row_id",
        F.col("p")[0]["content"].alias("system"),
        F.col("p")[1]["content"].alias("user_text"),
        F.array_join(F.transform("p", lambda m: m["role"]), ",").alias("roles"),
    )


@query
def build_completion(spark, sf_dir):
    completion = chat.build_completion(F.col("Summary"), F.col("Sentiment"))
    return _cleaned(spark, sf_dir).select(
        "row_id",
        completion[0]["role"].alias("role"),
        completion[0]["content"].alias("content"),
    )


@query
def render_chat(spark, sf_dir):
    messages = F.concat(
        chat.build_prompt(F.col("Content")),
        chat.build_completion(F.col("Summary"), F.col("Sentiment")),
    )
    return _cleaned(spark, sf_dir).select(
        "row_id", F.sha2(chat.render_chat(messages), 256).alias("rendered")
    )


@query
def rendered_length(spark, sf_dir):
    prompt = chat.build_prompt(F.col("Content"))
    completion = chat.build_completion(F.col("Summary"), F.col("Sentiment"))
    return _cleaned(spark, sf_dir).select(
        "row_id",
        chat.rendered_length(prompt, completion, "char").alias("chars"),
        chat.rendered_length(prompt, completion, "word").alias("words"),
    )


@query
def head_tail_truncate(spark, sf_dir):
    """Half of every article is kept."""
    size = F.length("text")
    half = F.shiftright(size, 1)
    return derived.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"),
        fitting.head_tail_chars(F.col("text"), size, half).alias("article"),
    )


def _fitted_all(spark, sf_dir, unit):
    """All articles, labelled or not."""
    return formatting.fit_labelled(
        derived.articles(spark, sf_dir), unit=unit,
        max_length=1024 if unit == "char" else 400,
    )


@query
def fit_article_char(spark, sf_dir):
    return _fitted_all(spark, sf_dir, "char").select(
        "row_id", "article", "sequence_length", "was_truncated", "overflow"
    )


@query
def fit_article_word(spark, sf_dir):
    return _fitted_all(spark, sf_dir, "word").select(
        "row_id", "article", "sequence_length", "was_truncated", "overflow"
    )


@query
def fit_overflow(spark, sf_dir):
    return formatting.fit_overflow(_fitted_all(spark, sf_dir, "char")).select("row_id", "source")


@query
def format_sft(spark, sf_dir):
    return formatting.format_sft(_split(spark, sf_dir)).select(
        "row_id",
        "split",
        F.col("prompt")[1]["content"].alias("user_text"),
        F.col("completion")[0]["content"].alias("assistant_text"),
        F.col("chat_template_kwargs.enable_thinking").alias("enable_thinking"),
        "sequence_length",
        "was_truncated",
    )


@query
def format_stats(spark, sf_dir):
    return formatting.format_stats(formatting.format_sft(_split(spark, sf_dir)))


@query
def length_distribution(spark, sf_dir):
    prompt = chat.build_prompt(F.col("Content"))
    completion = chat.build_completion(F.col("Summary"), F.col("Sentiment"))
    measured = _cleaned(spark, sf_dir).select(
        chat.rendered_length(prompt, completion, "char").alias("chars")
    )
    spread = formatting.length_distribution(measured, length="chars", max_length=1024)
    return _round(spread, "p50", "p90", "p99", "over_budget")


@query
def tokenize_batches(spark, sf_dir):
    return plugins.tokenize_batches(
        derived.articles(spark, sf_dir), tokenizer_factory=derived.CharacterTokenizer
    )


@query
def score_prompts(spark, sf_dir):
    fitted = formatting.fit_labelled(_cleaned(spark, sf_dir)).filter("not overflow")
    prompts = fitted.select("row_id", chat.build_prompt(F.col("article")).alias("prompt"))
    return plugins.score_prompts(prompts, predictor_factory=derived.LeadPredictor)


# Parsing and metrics


def _parsed(spark, sf_dir):
    return evaluation.parse_responses(derived.responses(derived.articles(spark, sf_dir)))


@query
def parse_summary(spark, sf_dir):
    return _parsed(spark, sf_dir).select("row_id", "predicted_summary")


@query
def parse_sentiment(spark, sf_dir):
    return _parsed(spark, sf_dir).select("row_id", "predicted_sentiment")


@query
def align_predictions(spark, sf_dir):
    """The responses come from the articles without copies, so some are missing."""
    articles = derived.articles(spark, sf_dir)
    first = dedup.dedup_keep_first(articles)
    return evaluation.align_predictions(
        cleaning.clean_articles(articles), derived.responses(first)
    ).select(
        "row_id", "reference_sentiment", "predicted_sentiment", "reference_summary",
        "predicted_summary",
    )


@query
def rouge_tokens(spark, sf_dir):
    tokens = text.word_tokens(F.col("text"))
    return derived.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"), tokens.alias("t")
    ).select(
        "row_id", F.size("t").alias("tokens"), F.sha2(F.array_join("t", " "), 256).alias("digest")
    )


def _summary_pairs(spark, sf_dir):
    """Summaries and answers of all articles, labelled or not."""
    articles = derived.articles(spark, sf_dir).select("row_id", "Summary", "Content", "Sentiment",
                                                      "source")
    parsed = evaluation.parse_responses(derived.responses(articles))
    return articles.select("row_id", "Summary").join(
        parsed.select("row_id", F.coalesce("predicted_summary", F.lit("")).alias("predicted")),
        "row_id",
    )


@query
def lcs_length(spark, sf_dir):
    pairs = _summary_pairs(spark, sf_dir).select(
        "row_id",
        text.word_tokens(F.col("Summary")).alias("a"),
        text.word_tokens(F.col("predicted")).alias("b"),
    )
    return pairs.select("row_id", rouge.lcs_length(F.col("a"), F.col("b")).alias("lcs"))


@query
def rouge_l(spark, sf_dir):
    scored = evaluation.with_rouge(
        _summary_pairs(spark, sf_dir), reference="Summary", prediction="predicted"
    )
    return _round(
        scored.select("row_id", "rouge.precision", "rouge.recall", "rouge.f1"),
        "precision", "recall", "f1",
    )


def _turns(spark, sf_dir):
    """Turns of conversations and the ones that follow, whole."""
    turns = derived.table(spark, sf_dir, "conversations")
    later = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply"))
    return turns.join(later, ["conv_id", "turn"])


@query
def rouge_l_turns(spark, sf_dir):
    scored = evaluation.with_rouge(_turns(spark, sf_dir), reference="text", prediction="reply")
    return _round(
        scored.select("conv_id", "turn", "rouge.precision", "rouge.recall", "rouge.f1"),
        "precision", "recall", "f1",
    )


@query
def parse_turns(spark, sf_dir):
    """Answers with a whole turn as the summary and the rest of it as a label."""
    answer = F.concat(
        F.lit("Well. <summary>"), "text", F.lit("</SUMMARY>\n<Sentiment> "), "role",
        F.lit(" </sentiment><SENTIMENT>\tnegative\n</SENTIMENT>"), "reply",
    )
    parsed = evaluation.parse_responses(
        _turns(spark, sf_dir).select(
            F.struct("conv_id", "turn").alias("row_id"), answer.alias("raw_response")
        )
    )
    return parsed.select("row_id.conv_id", "row_id.turn", "predicted_summary", "predicted_sentiment")


@query
def prediction_records(spark, sf_dir):
    return _round(_records(spark, sf_dir), "rouge_l_f1")


@query
def confusion_counts(spark, sf_dir):
    return evaluation.confusion_counts(_records(spark, sf_dir))


@query
def class_prf(spark, sf_dir):
    return _round(
        evaluation.class_prf(_records(spark, sf_dir)), "precision", "recall", "f1"
    )


@query
def macro_f1(spark, sf_dir):
    return _round(evaluation.macro_f1(_records(spark, sf_dir)), "sentiment_macro_f1")


@query
def accuracy(spark, sf_dir):
    return _round(evaluation.accuracy(_records(spark, sf_dir)), "sentiment_accuracy")


@query
def parse_rates(spark, sf_dir):
    return _round(
        evaluation.parse_rates(_records(spark, sf_dir)),
        "sentiment_parse_rate", "summary_parse_rate",
    )


@query
def mean_rouge(spark, sf_dir):
    return _round(evaluation.mean_rouge(_records(spark, sf_dir)), "mean_rouge_l_f1")


@query
def label_distributions(spark, sf_dir):
    return evaluation.label_distributions(_records(spark, sf_dir))


@query
def metrics_report(spark, sf_dir):
    report = evaluation.metrics_report(_records(spark, sf_dir))
    return _round(report, *evaluation.METRICS).withColumns(
        {c: F.to_json(c) for c in ("reference_class_counts", "predicted_class_counts")}
    )


@query
def holdout_report(spark, sf_dir):
    """End to end: clean, drop copies, split, then score the held-out rows only."""
    articles = derived.articles(spark, sf_dir)
    holdout = _split(spark, sf_dir).filter("split = 'test'")
    records = prepare.evaluate(holdout, derived.responses(articles))
    report = evaluation.metrics_report(records)
    return _round(report, *evaluation.METRICS).withColumns(
        {c: F.to_json(c) for c in ("reference_class_counts", "predicted_class_counts")}
    )


@query
def threshold_gate(spark, sf_dir):
    metrics = evaluation.metrics_long(evaluation.metrics_report(_records(spark, sf_dir)))
    minimums = review.thresholds_table(
        metrics,
        {"sentiment_accuracy": 0.5, "sentiment_parse_rate": 0.99, "mean_rouge_l_f1": None},
    )
    return _round(review.threshold_gate(metrics, minimums), "value")


@query
def error_slices(spark, sf_dir):
    articles = derived.articles(spark, sf_dir)
    cleaned = cleaning.clean_articles(articles).withColumn(
        "length_bucket", review.length_bucket(F.col("Content"))
    )
    records = prepare.evaluate(
        cleaned, derived.responses(articles), keep=("length_bucket", "news_date")
    )
    return _round(review.error_slices(records), "error_rate")


def _claims(spark, sf_dir):
    articles = derived.articles(spark, sf_dir)
    pairs = evaluation.align_predictions(
        cleaning.clean_articles(articles), derived.responses(articles), keep=("Content",)
    )
    return review.unsupported_claims(pairs)


@query
def unsupported_claims(spark, sf_dir):
    return _round(
        _claims(spark, sf_dir).select(
            "row_id", "summary_words", "unsupported_words", "unsupported_share"
        ),
        "unsupported_share",
    )


@query
def unsupported_by_class(spark, sf_dir):
    return _round(
        review.unsupported_by_class(_claims(spark, sf_dir)), "mean_unsupported_share"
    )


@query
def review_queue(spark, sf_dir):
    worst = review.review_queue(_round(_records(spark, sf_dir), "rouge_l_f1"), k=20)
    return worst.select(
        "reference_sentiment", "rank", "index", "predicted_sentiment", "rouge_l_f1"
    )


@query
def compare_runs(spark, sf_dir):
    """The later evaluation used other answers and left out the copies."""
    articles = derived.articles(spark, sf_dir)
    later = prepare.evaluate(
        cleaning.clean_articles(dedup.dedup_keep_first(articles)),
        derived.responses(articles, shift=3),
    )
    compared = review.compare_runs(_records(spark, sf_dir), later, tolerance=0.001)
    return _round(compared, "before", "after", "delta")


# Runs


@query
def config_diff(spark, sf_dir):
    manifests = derived.manifests(spark, sf_dir)
    return governance.config_diff(derived.run_pairs(manifests), manifests)


@query
def config_diff_evaluation(spark, sf_dir):
    from newsprep.functions.fixed_values import EVALUATION_KEYS

    manifests = derived.manifests(spark, sf_dir)
    return governance.config_diff(
        derived.run_pairs(manifests), manifests, keys=EVALUATION_KEYS
    )


@query
def fingerprint_drift(spark, sf_dir):
    """Each run against the fingerprints that the first run of its lineage saved."""
    manifests = derived.manifests(spark, sf_dir).select(
        "run_id", "lineage", "created_at", "dataset.train_fingerprint", "dataset.eval_fingerprint"
    )
    saved = manifests.join(
        derived.run_pairs(manifests), F.col("run_id") == F.col("saved_run")
    ).select(F.col("current_run").alias("run_id"), "train_fingerprint", "eval_fingerprint")
    return governance.fingerprint_drift(manifests, saved)


@query
def release_readiness(spark, sf_dir):
    judged = review.release_readiness(
        derived.manifests(spark, sf_dir).filter("status = 'completed'"),
        derived.run_metrics(spark, sf_dir),
        derived.run_thresholds(spark, sf_dir),
    )
    return judged.select(
        "run_id",
        "ready",
        F.array_join("unset_thresholds", ",").alias("unset_thresholds"),
        F.array_join("failed_metrics", ",").alias("failed_metrics"),
    )


@query
def run_status_summary(spark, sf_dir):
    return _round(
        governance.run_status_summary(derived.manifests(spark, sf_dir)), "mean_seconds"
    )


@query
def class_drift(spark, sf_dir):
    return _round(
        governance.class_drift(
            _cleaned(spark, sf_dir), _parsed(spark, sf_dir),
            expected_label="Sentiment", observed_label="predicted_sentiment",
        ),
        "total_variation", "stability_index", "unlabelled_share",
    )


# Streams over the prediction log


def _log_stream(spark, sf_dir):
    schema = derived.table(spark, sf_dir, "events").schema
    # A pattern, because the table may be one file or a folder of them.
    stream = monitors.read_log_stream(spark, f"{sf_dir}/{{events.parquet}}", schema)
    return derived.log_columns(stream)


def _plain_time(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _all_windows(spark, stream: DataFrame, name: str, *keys: str) -> DataFrame:
    path = new_path(spark, name)
    return monitors.upsert_table(
        stream, table=f"{path}/table", progress=f"{path}/progress", keys=("window_start", *keys)
    )


@query
def stream_parse_failures(spark, sf_dir):
    result = _all_windows(
        spark, monitors.parse_failures(_log_stream(spark, sf_dir)), "parse-failures"
    )
    return _round(_plain_time(result, "window_start"), "failure_rate")


@query
def stream_class_mix(spark, sf_dir):
    mix = _all_windows(
        spark, monitors.class_mix(_log_stream(spark, sf_dir)), "class-mix", "predicted"
    )
    return _round(_plain_time(monitors.class_shares(mix), "window_start"), "share")


@query
def stream_latency(spark, sf_dir):
    """The approximate percentile is compared with the exact one, in rank: the share of
    the window's rows below it and up to it must enclose 95 %, within a thousandth."""
    result = _all_windows(spark, monitors.latency(_log_stream(spark, sf_dir)), "latency")
    log = derived.log_columns(derived.table(spark, sf_dir, "events")).select(
        F.date_trunc("day", "event_time").alias("window_start"), "latency_ms"
    )
    ranks = log.join(result.select("window_start", "p95_ms"), "window_start").groupBy(
        "window_start"
    ).agg(
        F.count_if(F.col("latency_ms") < F.col("p95_ms")).alias("below"),
        F.count_if(F.col("latency_ms") <= F.col("p95_ms")).alias("upto"),
    )
    slack = F.greatest(F.lit(1), F.ceil(F.col("rows") / 1000))
    right = (F.col("below") - slack <= F.col("rows") * 0.95) & (
        F.col("upto") + slack >= F.col("rows") * 0.95
    )
    checked = result.join(ranks, "window_start").withColumn("p95_in_rank", right)
    return _round(_plain_time(checked, "window_start"), "mean_ms").drop("p95_ms", "below", "upto")


@query
def stream_dedup(spark, sf_dir):
    """The log arrives twice; the replay is dropped."""
    twice = _log_stream(spark, sf_dir).withColumn(
        "copy", F.explode(F.array(F.lit(1), F.lit(2)))
    ).drop("copy")
    path = new_path(spark, "replays")
    once = monitors.append_to_table(
        monitors.drop_replays(twice), table=f"{path}/table", progress=f"{path}/progress"
    )
    return _plain_time(once, "event_time")


@query
def stream_sessions(spark, sf_dir):
    path = new_path(spark, "failure-bursts")
    bursts = monitors.bursts_so_far(
        monitors.failure_bursts(_log_stream(spark, sf_dir)),
        table=f"{path}/table", progress=f"{path}/progress",
    )
    return _plain_time(bursts, "burst_start", "burst_end")


@query
def stream_late_data(spark, sf_dir):
    """The log arrives in loads of eight days, some rows three days late; each load is
    taken in by itself. Rows of closed windows are left out and counted beside the result."""
    events = derived.table(spark, sf_dir, "events")
    path = new_path(spark, "late-data")
    loads = derived.loads(events)
    loads.write.partitionBy("load").parquet(f"{path}/loads")
    schema = events.schema
    for load in range(derived.LOADS):
        # A load is what has come into the folder since the last run.
        own = spark.read.schema(schema).parquet(f"{path}/loads/load={load}")
        own.write.mode("append").parquet(f"{path}/log")
        log = derived.log_columns(monitors.read_log_stream(spark, f"{path}/log", schema))
        windows = monitors.upsert_table(
            monitors.parse_failures(log), table=f"{path}/windows", progress=f"{path}/progress")
        arrivals = monitors.count_arrivals(
            log, table=f"{path}/arrivals", progress=f"{path}/arrivals-progress")
    return _round(_plain_time(monitors.late_rows(windows, arrivals), "window_start"), "failure_rate")


@query
def stream_latency_rollup(spark, sf_dir):
    """Sketches by day, put together by week. The quantile is compared with the exact one
    in rank, within a hundredth."""
    sketches = _all_windows(
        spark, monitors.latency_sketches(_log_stream(spark, sf_dir)), "latency-sketches"
    )
    weeks = materialize(monitors.rolled_up(sketches, "week", {"p95_ms": 0.95}), "weeks")
    log = derived.log_columns(derived.table(spark, sf_dir, "events")).select(
        F.date_trunc("week", "event_time").alias("window_start"), "latency_ms"
    )
    ranks = log.join(weeks.select("window_start", "p95_ms"), "window_start").groupBy("window_start").agg(
        F.count_if(F.col("latency_ms") < F.col("p95_ms")).alias("below"),
        F.count_if(F.col("latency_ms") <= F.col("p95_ms")).alias("upto"),
    )
    slack = F.greatest(F.lit(1), F.ceil(F.col("rows") / 100))
    right = (F.col("below") - slack <= F.col("rows") * 0.95) & (
        F.col("upto") + slack >= F.col("rows") * 0.95
    )
    checked = weeks.join(ranks, "window_start").withColumn("p95_in_rank", right)
    return _plain_time(checked, "window_start").drop("p95_ms", "below", "upto")
