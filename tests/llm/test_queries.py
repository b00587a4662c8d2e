"""The queries that SQL can express, against it."""

import pytest

from newsprep.llm.queries import ORACLES, QUERIES
from tests.oracle_check import compare


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, small, name):
    assert compare(spark, small, QUERIES[name], ORACLES[name]) is None
