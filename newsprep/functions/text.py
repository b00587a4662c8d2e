"""Text normalisation as native column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsprep.functions.fixed_values import (
    LABELS,
    NON_WHITESPACE_CLASS,
    WHITESPACE,
    WHITESPACE_CLASS,
    WORD_PATTERN,
)

# Whitespace of ordinary text, and the rest of it by its place in ASCII.
_COMMON = "\n\t\r"
_RARE = [c for c in WHITESPACE if c not in _COMMON + " "]
_RARE_ASCII = [c for c in _RARE if c.isascii()]
# The others by the first two bytes of their encoding, which few texts contain.
_RARE_BY_LEAD = {
    lead: [c for c in _RARE if c.encode()[:2] == lead]
    for lead in sorted({c.encode()[:2] for c in _RARE if not c.isascii()})
}


def strip(text: Column) -> Column:
    """Remove Unicode whitespace at both ends (SQL ``trim`` knows only the space)."""
    return F.btrim(text, F.lit(WHITESPACE))


def _contains_any(text: Column, characters: list[str]) -> Column:
    return reduce(or_, [F.contains(text, F.lit(c)) for c in characters])


def plain_spaces(text: Column) -> Column:
    """Every whitespace character as a space, one for one.

    A regular expression over the full whitespace class costs more than anything
    else that is done to a text. Byte searches tell whether it is needed: most
    texts hold spaces and line ends only, which plain replacement handles.
    """
    encoded = text.cast("binary")
    wide = reduce(
        or_,
        [
            F.contains(encoded, F.lit(lead)) & _contains_any(text, characters)
            for lead, characters in _RARE_BY_LEAD.items()
        ],
    )
    rare = _contains_any(text, _RARE_ASCII) | ((F.octet_length(text) != F.length(text)) & wide)
    spaced = text
    for c in _COMMON:
        spaced = F.replace(spaced, F.lit(c), F.lit(" "))
    return F.when(rare, F.regexp_replace(text, WHITESPACE_CLASS, " ")).otherwise(spaced)


def has_runs(spaced: Column) -> Column:
    """Whether a text with plain spaces has two in a row."""
    return F.contains(spaced, F.lit("  "))


def collapse_whitespace(text: Column) -> Column:
    """Turn every whitespace run into one space, none at the ends."""
    spaced = plain_spaces(text)
    return F.trim(
        F.when(has_runs(spaced), F.regexp_replace(spaced, " {2,}", " ")).otherwise(spaced)
    )


def spaced_word_count(spaced: Column) -> Column:
    """``word_count`` of a text whose whitespace is plain spaces."""
    return F.size(F.array_remove(F.split(spaced, " "), ""))


def word_count(text: Column) -> Column:
    """Number of words between whitespace."""
    return spaced_word_count(plain_spaces(text))


def not_blank(text: Column) -> Column:
    """Whether anything is left after stripping; looks no further than that."""
    return text.rlike(NON_WHITESPACE_CLASS)


def normalize_label(label: Column) -> Column:
    """Strip and title-case; letters after any non-letter start upper-case."""
    stripped = F.lower(strip(label))
    pieces = F.regexp_extract_all(stripped, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    titled = F.array_join(F.transform(pieces, F.initcap), "")
    # initcap alone is right, and stays in generated code, for one plain word.
    return F.when(F.initcap(stripped).isin(*LABELS), F.initcap(stripped)).otherwise(titled)


def content_fingerprint(text: Column) -> Column:
    """SHA-256 of the text with case and whitespace differences removed."""
    return F.sha2(F.lower(collapse_whitespace(text)), 256)


def word_tokens(text: Column) -> Column:
    """Lower-cased words, as ROUGE-L counts them."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD_PATTERN})"), F.lit(1))


def literal_none(text: Column) -> Column:
    """The text ``None`` for a null cell: the literal null policy."""
    return F.coalesce(text, F.lit("None"))
