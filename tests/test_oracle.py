"""Every query with an SQL equivalent, on the small tables."""

import pytest

import __spark_entry__ as contract
from compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("key", sorted(contract.oracle_sql()))
def test_same_as_sql(spark, con, key):
    ok, note = compare(spark, con, SF, key)
    assert ok, note


def test_every_statement_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
