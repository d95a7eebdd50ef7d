"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect
from skytrace.plans.oracles import ORACLES
from skytrace.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= entry.queries().items()
    assert ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, tables, name):
    assert compare(spark, tables, SF, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
