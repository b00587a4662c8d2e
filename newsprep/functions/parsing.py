"""Read a tagged answer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsprep.functions.fixed_values import LABELS, WHITESPACE_CLASS
from newsprep.functions.text import strip

_OPEN, _CLOSE = "<SUMMARY>", "</SUMMARY>"
_SUMMARY_PATTERN = f"(?isu){_OPEN}.*?{_CLOSE}"
_LABEL_PATTERN = (
    f"(?iu)<SENTIMENT>{WHITESPACE_CLASS}*(Positive|Negative|Neutral){WHITESPACE_CLASS}*</SENTIMENT>"
)
assert set(LABELS) == {"Positive", "Negative", "Neutral"}


def parse_summary(response: Column) -> Column:
    """The text of the first summary tag, ``''`` for an empty one, null for none.

    The whole tag is matched once. It is never empty, so an empty match means
    "no tag", and its ends have a fixed length.
    """
    tagged = F.nullif(F.regexp_extract(response, _SUMMARY_PATTERN, 0), F.lit(""))
    inner = F.length(tagged) - F.lit(len(_OPEN) + len(_CLOSE))
    return strip(F.substring(tagged, F.lit(len(_OPEN) + 1), inner))


def parse_sentiment(response: Column) -> Column:
    """The first valid label tag, normalised; null for none.

    The labels are those of the fixed answer format, which the prompt spells out; a
    label domain of one's own takes a prompt and a parser of one's own.
    """
    found = F.nullif(F.regexp_extract(response, _LABEL_PATTERN, 1), F.lit(""))
    return F.initcap(F.lower(found))


def parse_response(response: Column) -> Column:
    return F.struct(
        parse_summary(response).alias("summary"), parse_sentiment(response).alias("sentiment")
    )
