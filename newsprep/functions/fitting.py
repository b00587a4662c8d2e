"""Cut the middle out of an article so that the rendered chat fits a budget.

``budget`` is always what is left for the article: the maximum length minus the
rendered length of everything else.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsprep.functions.fixed_values import (
    HEAD_SHARE,
    NON_WHITESPACE_CLASS,
    TRUNCATION_MARKER,
    WHITESPACE_CLASS,
)
from newsprep.functions.text import has_runs, strip


def _head_size(keep: Column, head_share: float) -> Column:
    return F.greatest(F.lit(1), F.floor(keep * F.lit(head_share)).cast("int"))


def head_tail_chars(
    article: Column,
    size: Column,
    keep: Column,
    *,
    head_share: float = HEAD_SHARE,
    marker: str = TRUNCATION_MARKER,
) -> Column:
    """The article, ``size`` characters long, with ``keep`` of them left around the marker."""
    head_size = _head_size(keep, head_share)
    tail_size = keep - head_size
    head = strip(F.substring(article, F.lit(1), head_size))
    tail = F.when(tail_size > 0, strip(F.right(article, tail_size))).otherwise(F.lit(""))
    return (
        F.when(keep >= size, article)
        .when(keep <= 0, F.lit(marker.strip()))
        .otherwise(strip(F.concat(head, F.lit(marker), tail)))
    )


def search_keep_chars(
    article: Column,
    size: Column,
    runs: Column,
    budget: Column,
    *,
    head_share: float = HEAD_SHARE,
    marker: str = TRUNCATION_MARKER,
) -> Column:
    """How many characters a binary search keeps; -1 when nothing fits.

    Stripping makes the candidate length not quite monotone, so the search is
    replayed step by step rather than solved. It runs as a fold inside the
    expression: no Python, no shuffle, log2(length) steps per row.

    A candidate is seldom built. Without stripping it has ``keep`` characters and
    the marker; if that fits, so does the candidate. In a text without whitespace
    runs, stripping takes at most one character at each of four ends, and what
    surrounds the marker. Only in between is the candidate itself measured.

    ``size`` is the length of the article and ``runs`` whether two whitespace
    characters follow each other in it. Both enter the state of the fold, so that
    no step computes them again.
    """
    steps = F.sequence(F.lit(1), F.ceil(F.log2(size + F.lit(2))).cast("int") + 1)
    slack = 4 + len(marker) - len(marker.strip())
    start = F.struct(
        F.lit(0).alias("low"),
        size.alias("high"),
        F.lit(-1).alias("best"),
        size.alias("size"),
        budget.alias("budget"),
        # How far beyond the budget a candidate must be measured.
        F.when(runs, size + F.lit(len(marker))).otherwise(F.lit(slack)).alias("slack"),
    )

    def step(state: Column, _: Column) -> Column:
        def moved(low: Column, high: Column, best: Column) -> Column:
            return F.struct(
                low.alias("low"), high.alias("high"), best.alias("best"),
                *(state[name].alias(name) for name in ("size", "budget", "slack")),
            )

        middle = F.shiftright(state["low"] + state["high"], 1)
        excess = middle + F.lit(len(marker)) - state["budget"]
        candidate = head_tail_chars(
            article, state["size"], middle, head_share=head_share, marker=marker
        )
        fits = (excess <= 0) | (
            (excess <= state["slack"]) & (F.length(candidate) <= state["budget"])
        )
        return (
            F.when(state["low"] > state["high"], state)
            .when(fits, moved(middle + 1, state["high"], middle))
            .otherwise(moved(state["low"], middle - 1, state["best"]))
        )

    return F.aggregate(steps, start, step, lambda state: state["best"])


def head_tail_words(
    article: Column,
    spaced: Column,
    size: Column,
    keep: Column,
    *,
    head_share: float = HEAD_SHARE,
    marker: str = TRUNCATION_MARKER,
) -> Column:
    """Head and tail words around the marker, with the whitespace between them.

    ``spaced`` is the article with plain spaces, ``size`` its word count. Where
    no two spaces meet, the n-th space ends the n-th word, and its place in
    ``spaced`` is its place in the article. Other texts are taken apart.
    """
    head_size = _head_size(keep, head_share)
    tail_size = keep - head_size
    regular = ~has_runs(spaced) & (F.trim(spaced) == spaced)

    head = F.substring(
        article, F.lit(1), F.length(F.call_function("substring_index", spaced, F.lit(" "), head_size))
    )
    tail = F.right(
        article, F.length(F.call_function("substring_index", spaced, F.lit(" "), -tail_size))
    )
    pattern = f"({WHITESPACE_CLASS}*{NON_WHITESPACE_CLASS}+)"
    pieces = F.regexp_extract_all(article, F.lit(pattern), F.lit(1))
    loose_head = F.array_join(F.slice(pieces, F.lit(1), head_size), "")
    loose_tail = F.array_join(F.slice(pieces, size - tail_size + 1, tail_size), "")

    kept_head = strip(F.when(regular, head).otherwise(loose_head))
    kept_tail = F.when(
        tail_size > 0, strip(F.when(regular, tail).otherwise(loose_tail))
    ).otherwise(F.lit(""))
    return (
        F.when(keep >= size, article)
        .when(keep <= 0, F.lit(marker.strip()))
        .otherwise(strip(F.concat(kept_head, F.lit(marker), kept_tail)))
    )


def closed_form_keep_words(budget: Column, *, marker: str = TRUNCATION_MARKER) -> Column:
    """What the search finds for words: their count is monotone, so it is the
    budget less the words of the marker; -1 when not even the marker fits."""
    left = budget - F.lit(len(marker.split()))
    return F.greatest(left, F.lit(-1)).cast("int")
