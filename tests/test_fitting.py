"""Length fitting against a plain Python search."""

import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from newsprep.functions import chat
from newsprep.functions.fixed_values import TRUNCATION_MARKER
from newsprep.operators import formatting, plugins
from newsprep.plans.derived import CharacterTokenizer

# The tokenizer below travels to the workers with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class WordTokenizer:
    """One token per word with the whitespace before it."""

    def encode(self, text, add_special_tokens=False):
        import re

        return re.findall(r"\s*\S+", text)

    def decode(self, tokens, skip_special_tokens=True):
        return "".join(tokens)

    def apply_chat_template(self, messages, **options):
        return "".join(f"<{m['role']}>{m['content']}</{m['role']}>" for m in messages).split()


class Chat:
    """Measures whole chats of one tokenizer around an article."""

    def __init__(self, tokenizer, limit):
        self.tokenizer, self.limit, self.calls = tokenizer, limit, 0

    def length(self, text, summary, label):
        template = chat.PromptTemplate()
        answer = f"<SUMMARY>\n{summary.strip()}\n</SUMMARY>\n<SENTIMENT>\n{label}\n</SENTIMENT>"
        return len(self.tokenizer.apply_chat_template([
            {"role": "system", "content": template.system},
            {"role": "user", "content": template.user_prefix + text + template.user_suffix},
            {"role": "assistant", "content": answer},
        ]))

    def possible(self, article):
        """What each number of kept tokens gives, all of them."""
        tokens = self.tokenizer.encode(article)
        texts = {0: TRUNCATION_MARKER.strip(), len(tokens): article}
        for kept in range(1, len(tokens)):
            ends = [tokens[: max(1, kept * 3 // 4)]]
            ends.append(tokens[len(tokens) - (kept - len(ends[0])) :])
            ends = [self.tokenizer.decode(e).strip() for e in ends]
            texts[kept] = TRUNCATION_MARKER.join(ends).strip()
        return texts

    def check(self, article, summary, label, row):
        """A result is untouched text that fits, or a cut that fits and whose next larger
        cut doesn't; or nothing, where not even the marker fits."""
        whole = self.length(article, summary, label)
        result = row["article"], row["sequence_length"], row["was_truncated"], row["overflow"]
        if whole <= self.limit:
            assert result == (article, whole, False, False)
            return
        texts = self.possible(article)
        lengths = {k: self.length(t, summary, label) for k, t in texts.items()}
        if row["overflow"]:
            assert result == (None, None, True, True)
            assert lengths[0] > self.limit
            return
        assert row["was_truncated"] and row["sequence_length"] <= self.limit
        assert TRUNCATION_MARKER.strip() in row["article"]
        kept = [k for k, t in texts.items() if t == row["article"]]
        assert kept and row["sequence_length"] == lengths[kept[0]]
        assert max(kept) + 1 == len(texts) or lengths[max(kept) + 1] > self.limit


def make_articles():
    rng = random.Random(7)
    articles = ["A" * 5000, "short", "   padded   " * 40, "\n\n" * 300 + "x" * 300, " " * 2000]
    for _ in range(150):
        pieces = []
        for _ in range(rng.randint(1, 160)):
            pieces.append("wörd"[: rng.randint(1, 4)])
            pieces.append(rng.choice([" ", " ", " ", "\n", "  ", " \n\t ", " ", "      "]))
        articles.append("".join(pieces) if rng.random() < 0.6 else " ".join(pieces[::2]))
    return articles


@pytest.mark.parametrize("unit,limit", [("char", 700), ("char", 630), ("word", 95), ("word", 66)])
def test_fit_matches_search(spark, unit, limit):
    data = [(i, a, f" summary {i} ", "Neutral") for i, a in enumerate(make_articles())]
    df = spark.createDataFrame(data, "row_id int, Content string, Summary string, Sentiment string")
    fitted = formatting.fit_labelled(df.repartition(5), unit=unit, max_length=limit)
    judge = Chat(CharacterTokenizer() if unit == "char" else WordTokenizer(), limit)
    seen = set()
    for r in fitted.collect():
        judge.check(r["Content"], r["Summary"], r["Sentiment"], r)
        seen.add((r["was_truncated"], r["overflow"]))
    assert (True, False) in seen and (False, False) in seen


def test_long_article_keeps_marker_and_completion(spark):
    df = spark.createDataFrame(
        [(1, "A" * 5000, "Revenue increased.", "Positive")],
        "row_id int, Content string, Summary string, Sentiment string",
    )
    row = formatting.format_sft(df, max_length=700).collect()[0]
    assert row["was_truncated"] and row["sequence_length"] <= 700
    assert TRUNCATION_MARKER.strip() in row["prompt"][1]["content"]
    assert "<SENTIMENT>\nPositive\n</SENTIMENT>" in row["completion"][0]["content"]
    assert row["chat_template_kwargs"]["enable_thinking"] is False


def test_overflow_is_routed_or_raised(spark):
    df = spark.createDataFrame(
        [(1, "text " * 200, "s" * 2000, "Positive"), (2, "text", "s", "Positive")],
        "row_id int, Content string, Summary string, Sentiment string",
    )
    fitted = formatting.fit_labelled(df)
    assert [r["row_id"] for r in formatting.fit_overflow(fitted).collect()] == [1]
    assert formatting.format_sft(df).count() == 1
    with pytest.raises(formatting.ArticleDoesNotFit):
        formatting.fit_labelled(df, strict=True)


def test_empty_split_has_no_statistics(spark):
    empty = spark.createDataFrame(
        [], "split string, was_truncated boolean, sequence_length int"
    )
    assert formatting.format_stats(empty).count() == 0


def test_placeholder_in_article_stays(spark):
    df = spark.createDataFrame([("profit {article} of {0}",)], "a string")
    prompt = df.select(chat.build_prompt(F.col("a")).alias("p")).collect()[0]["p"]
    assert "profit {article} of {0}" in prompt[1]["content"]


@pytest.mark.parametrize("factory,limit", [(CharacterTokenizer, 700), (WordTokenizer, 95)])
def test_tokenizer_plugin(spark, factory, limit):
    data = [(i, a, "summary", "Positive") for i, a in enumerate(make_articles())]
    df = spark.createDataFrame(data, "row_id int, Content string, Summary string, Sentiment string")
    fitted = plugins.tokenize_batches(df, tokenizer_factory=factory, max_length=limit)
    judge, texts = Chat(factory(), limit), {i: a for i, a, *_ in data}
    rows = fitted.collect()
    assert len(rows) == len(data)
    for r in rows:
        judge.check(texts[r["row_id"]], "summary", "Positive", r)


def test_rows_without_text_are_set_aside(spark):
    data = [(1, None, "s", "Positive"), (2, "text", None, "Positive"), (3, "text", "s", None), (4, "a", "s", "Positive")]
    df = spark.createDataFrame(data, "row_id int, Content string, Summary string, Sentiment string")
    for fitted in (
        formatting.fit_labelled(df),
        plugins.tokenize_batches(df, tokenizer_factory=CharacterTokenizer),
    ):
        rows = {r["row_id"]: r for r in fitted.collect()}
        assert [i for i in rows if rows[i]["overflow"]] == [1, 2, 3]
        assert all(rows[i]["article"] is None and rows[i]["sequence_length"] is None for i in (1, 2, 3))
    assert [r["row_id"] for r in formatting.format_sft(df.withColumn("split", F.lit("train"))).collect()] == [4]


class Counting(WordTokenizer):
    def __init__(self):
        self.measured = self.encoded = 0

    def encode(self, text, add_special_tokens=False):
        self.encoded += 1
        return super().encode(text)

    def apply_chat_template(self, messages, **options):
        self.measured += 1
        return super().apply_chat_template(messages)


def test_few_calls_of_the_tokenizer():
    """A long article is encoded once and rendered near the budget only."""
    template, tokenizer = chat.PromptTemplate(), Counting()
    shape = template.system, template.user_prefix, template.user_suffix, 4000, 0.75, TRUNCATION_MARKER
    fitter = plugins._Fitter(tokenizer, *shape)
    tokenizer.encoded = 0
    article = " ".join(f"word{i}" for i in range(60_000))
    text, length, truncated = fitter.fit(article, [{"role": "assistant", "content": "s"}])
    assert truncated and length == 4000 and text.startswith("word0 ") and text.endswith("word59999")
    # A bisection over 60,000 sizes alone would render 16 times.
    assert tokenizer.encoded == 1 and tokenizer.measured <= 10


class Dropping(WordTokenizer):
    """Some tokens are special: decoding leaves them out."""

    def decode(self, token_ids, skip_special_tokens=True):
        return super().decode([t for t in token_ids if t != "<special>"])


class Growing(WordTokenizer):
    """A text that was cut is encoded to more tokens than it was cut to."""

    def apply_chat_template(self, messages, **options):
        return [t for m in messages for w in self.encode(m["content"]) for t in ([w, w] if w.startswith("odd") else [w])]


@pytest.mark.parametrize("factory", [Dropping, Growing, WordTokenizer])
@pytest.mark.parametrize("limit", [95, 120, 200])
def test_what_is_returned_is_measured(factory, limit):
    """Within the limit, and the next larger cut is not; whatever the estimate says."""
    template = chat.PromptTemplate()
    shape = template.system, template.user_prefix, template.user_suffix, limit, 0.75, TRUNCATION_MARKER
    fitter = plugins._Fitter(factory(), *shape)
    answer = [{"role": "assistant", "content": "s"}]
    articles = [
        " ".join(["<special>"] * 300 + [f"w{i}" for i in range(400)]),
        " ".join(f"{'odd' if i % 3 else 'w'}{i}" for i in range(500)),
        " ".join("<special>" if i % 2 else f"odd{i}" for i in range(700)),
        " ".join(f"w{i}" for i in range(90)) + " <special>" * 500,
    ]
    for article in articles:
        text, length, truncated = fitter.fit(article, answer)
        assert length == fitter.measure(text, answer) <= limit
        if truncated:
            tokens = fitter.tokenizer.encode(article)
            texts = [fitter.candidate(tokens, d) for d in range(len(tokens) + 1)]
            sizes = [fitter.measure(t, answer) for t in texts]
            at = texts.index(text)
            assert at == 0 or sizes[at - 1] > limit
            # Sizes fall steadily here, so this is the longest text that fits.
            assert length == max(s for s in sizes if s <= limit)


@pytest.mark.parametrize("last", [0, 1, 7, 100])
def test_the_search_finds_the_border_from_anywhere(last):
    for border in range(last + 2):
        for first in range(last + 1):
            found = plugins._least(lambda d: d >= border, first, last)
            assert found == (border if border <= last else None)
