"""Every registered query against DuckDB on the smallest scale, values compared exactly."""

import pytest

import __spark_entry__ as contract
from harness.compare import connect, differences
from harness.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_duckdb(spark, duck, name):
    _, problem = differences(spark, duck, SF, name)
    assert problem is None, problem
