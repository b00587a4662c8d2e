"""Every query against its SQL twin, on the smallest tables."""

import pytest

import __spark_entry__ as entry_point
from newsprep.plans.catalog import QUERIES
from newsprep.plans.oracles import ORACLES
from tests.oracle_check import compare



def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, name):
    assert compare(spark, small, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    rows = entry_point.entry(spark).collect()
    assert len(rows) == 1 and rows[0]["examples"] > 0
