"""Text functions against plain Python."""

import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsprep.functions import text
from newsprep.functions.fixed_values import WHITESPACE

SPACES = "".join(c for c in map(chr, range(0x110000)) if c.isspace())
SAMPLES = [
    "Revenue   Increased", " revenue increased ", "", " ", "\n\t", "a", "a b", "a  b", "a\nb",
    "a\x1cb", "a\x85\x85b", "\xa0Ünïcode  text　", "x y\r\nz", "Straße ÉCOLE",
    "–dash– “quotes”  and​zero", "tab\tand\x0bvertical", *(f"a{c}b{c}{c}c" for c in SPACES),
]


def rows(spark, values, schema="v string"):
    return spark.createDataFrame([(v,) for v in values], schema)


def apply(spark, values, function):
    made = rows(spark, values).select("v", function(F.col("v")).alias("r")).collect()
    return [(r["v"], r["r"]) for r in made]


def python_fingerprint(value):
    folded = re.sub(r"\s+", " ", value).strip().lower()
    return hashlib.sha256(folded.encode()).hexdigest()


def test_whitespace_is_that_of_python():
    assert sorted(WHITESPACE) == sorted(SPACES)


def test_strip(spark):
    for value, result in apply(spark, SAMPLES, text.strip):
        assert result == value.strip(), repr(value)


def test_collapse_and_count(spark):
    for value, result in apply(spark, SAMPLES, text.collapse_whitespace):
        assert result == " ".join(value.split()), repr(value)
    for value, result in apply(spark, SAMPLES, text.word_count):
        assert result == len(value.split()), repr(value)


def test_fingerprint(spark):
    for value, result in apply(spark, SAMPLES, text.content_fingerprint):
        assert result == python_fingerprint(value), repr(value)
    assert python_fingerprint(SAMPLES[0]) == python_fingerprint(SAMPLES[1])


def test_not_blank(spark):
    for value, result in apply(spark, SAMPLES, text.not_blank):
        assert result == bool(value.strip()), repr(value)


@pytest.mark.parametrize(
    "value", [" positive ", "POSITIVE", "neutral\n", "mostly-positive", "it's bad", "a b", "x2y"]
)
def test_normalize_label(spark, value):
    assert apply(spark, [value], text.normalize_label)[0][1] == value.strip().title()


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(alphabet=st.sampled_from("abé \n\t\x1c\x85 -–"), max_size=30),
                min_size=1, max_size=20))
def test_random_texts(spark, values):
    for value, result in apply(spark, values, text.content_fingerprint):
        assert result == python_fingerprint(value)
    for value, result in apply(spark, values, text.word_tokens):
        assert result == re.findall(r"\w+", value.lower())
