"""Places where a user's Python object plugs in: a tokenizer and a predictor.

Both objects are built once per task by a factory, which is what travels to the
executors, and then see one Arrow batch after the other. They must be
deterministic, because a lost task runs again.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsprep.functions.chat import PromptTemplate, build_completion
from newsprep.functions.fixed_values import (
    CONTENT,
    DEFAULT_MAX_LENGTH,
    HEAD_SHARE,
    SENTIMENT,
    SUMMARY,
    TRUNCATION_MARKER,
)

Message = dict[str, str]


class Tokenizer(Protocol):
    def encode(self, text: str, add_special_tokens: bool = False) -> Sequence[int]: ...

    def decode(self, token_ids: Sequence[int], skip_special_tokens: bool = True) -> str: ...

    def apply_chat_template(self, messages: list[Message], **options) -> Sequence[int]: ...


class Predictor(Protocol):
    def __call__(self, prompts: list[list[Message]]) -> list[str]: ...


def _messages(cell) -> list[Message] | None:
    """The messages of a cell; None where one of them has no text."""
    if cell is None or any(m["content"] is None for m in cell):
        return None
    return [{"role": m["role"], "content": m["content"]} for m in cell]


class _Fitter:
    """Cuts articles to what a chat leaves over, with few calls of the tokenizer.

    A chat without article, the marker and the kept tokens are expected to add up. That sum
    only says where to look first: decoding can drop tokens and a tokenizer can make more of
    a decoded text, so sizes around it are rendered, in growing steps, until one that fits
    and one that doesn't enclose the answer.
    """

    def __init__(self, tokenizer, system: str, prefix: str, suffix: str, limit: int,
                 head_share: float, marker: str):
        self.tokenizer, self.limit = tokenizer, limit
        self.system = {"role": "system", "content": system}
        self.prefix, self.suffix = prefix, suffix
        self.head_share, self.marker = head_share, marker
        self.marker_tokens = len(tokenizer.encode(marker, add_special_tokens=False))

    def measure(self, article: str, answer: list[Message]) -> int:
        user = {"role": "user", "content": self.prefix + article + self.suffix}
        ids = self.tokenizer.apply_chat_template(
            [self.system, user, *answer],
            tokenize=True, return_dict=False, add_generation_prompt=False, enable_thinking=False,
        )
        return len(ids)

    def candidate(self, tokens, dropped: int) -> str:
        """The article without so many tokens of its middle."""
        spans = [slice(0, len(tokens))]
        if dropped:
            kept = len(tokens) - dropped
            head = min(kept, max(1, int(kept * self.head_share)))
            spans = [slice(0, head), slice(head + dropped, len(tokens))]
        ends = [self.tokenizer.decode(tokens[s], skip_special_tokens=True) for s in spans]
        return self.marker.join(e.strip() for e in ends).strip() if dropped else ends[0]

    def fit(self, article: str | None, answer: list[Message] | None):
        """(article, length, truncated), Nones where there is nothing to fit or no room."""
        if article is None or answer is None:
            return None, None, None
        whole = self.measure(article, answer)
        if whole <= self.limit:
            return article, whole, False
        tokens = self.tokenizer.encode(article, add_special_tokens=False)
        fixed = self.measure("", answer) + self.marker_tokens
        found: dict[int, tuple[str, int]] = {}

        def fits(dropped: int) -> bool:
            if dropped not in found:
                text = self.candidate(tokens, dropped)
                found[dropped] = text, self.measure(text, answer)
            return found[dropped][1] <= self.limit

        best = _least(fits, min(max(fixed + len(tokens) - self.limit, 0), len(tokens)), len(tokens))
        if best is None:
            return None, None, True
        return *found[best], True


def _least(fits: Callable[[int], bool], first: int, last: int) -> int | None:
    """The least number up to last that fits while the one below does not, looking from first on."""
    step = 1
    if fits(first):
        low, high = first - 1, first
        while low >= 0 and fits(low):
            high, low, step = low, max(low - 2 * step, -1), 2 * step
    else:
        low, high = first, min(first + 1, last)
        while not fits(high):
            if high == last:
                return None
            low, high, step = high, min(high + 2 * step, last), 2 * step
    # low does not fit, or is below all; high fits.
    return bisect.bisect_left(range(low + 1, high), True, key=fits) + low + 1


def tokenize_batches(
    df: DataFrame,
    *,
    tokenizer_factory: Callable[[], Tokenizer],
    key: str = "row_id",
    content: str = CONTENT,
    summary: str = SUMMARY,
    label: str = SENTIMENT,
    max_length: int = DEFAULT_MAX_LENGTH,
    head_share: float = HEAD_SHARE,
    marker: str = TRUNCATION_MARKER,
    template: PromptTemplate = PromptTemplate(),
) -> DataFrame:
    """Fit every article with a subword tokenizer: ``fit_article`` for units that
    only the tokenizer can count.

    Only the article and the completion reach Python; batches are bounded by rows and, by
    ``spark.sql.execution.arrow.maxBytesPerBatch``, by bytes. A row without article or
    completion has ``overflow`` set and null results.
    """
    rows = df.select(
        F.col(key).alias("row_id"),
        F.col(content).alias("text"),
        build_completion(F.col(summary), F.col(label)).alias("completion"),
    )
    shape = (template.system, template.user_prefix, template.user_suffix, max_length, head_share, marker)

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fitter = _Fitter(tokenizer_factory(), *shape)
        for batch in batches:
            fitted = [
                fitter.fit(text, _messages(cell))
                for text, cell in zip(batch["text"], batch["completion"])
            ]
            article, length, truncated = zip(*fitted) if fitted else ((), (), ())
            yield pd.DataFrame(
                {
                    "row_id": batch["row_id"],
                    "article": article,
                    "sequence_length": pd.array(length, dtype="Int32"),
                    "was_truncated": pd.array(truncated, dtype="boolean"),
                    "overflow": [a is None for a in article],
                }
            )

    key_type = df.schema[key].dataType.simpleString()
    return rows.mapInPandas(
        fit,
        f"row_id {key_type}, article string, sequence_length int, "
        "was_truncated boolean, overflow boolean",
    )


def score_prompts(
    df: DataFrame,
    *,
    predictor_factory: Callable[[], Predictor],
    key: str = "row_id",
    prompt: str = "prompt",
    batch_size: int = 64,
    profile=None,
) -> DataFrame:
    """Apply a predictor to prompts; the result holds the generated text only.

    The predictor sees prompts of like length together, since a batch costs what its longest
    prompt costs: those of an Arrow batch are sorted by length before they are dealt into
    batches. An answer belongs to its key, so the order in which rows come does not matter.
    A prompt without text, or with a message without one, has a null answer and is not sent.
    ``profile`` is a resource profile for this stage, such as one that asks for a GPU.
    """
    rows = df.select(F.col(key).alias("row_id"), F.col(prompt).alias("prompt"))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = predictor_factory()
        for batch in batches:
            prompts = [_messages(p) for p in batch["prompt"]]
            sizes = {i: sum(len(m["content"]) for m in p) for i, p in enumerate(prompts) if p}
            order = sorted(sizes, key=sizes.get)
            answers: list[str | None] = [None] * len(prompts)
            for start in range(0, len(order), batch_size):
                part = order[start : start + batch_size]
                given = predict([prompts[i] for i in part])
                if len(given) != len(part):
                    raise ValueError("the predictor must answer every prompt")
                for i, answer in zip(part, given):
                    answers[i] = answer
            yield pd.DataFrame({"row_id": batch["row_id"], "raw_response": answers})

    key_type = df.schema[key].dataType.simpleString()
    return rows.mapInPandas(score, f"row_id {key_type}, raw_response string", profile=profile)
