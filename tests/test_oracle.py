"""Every query with SQL returns what the SQL returns."""

import os

import pytest
from compare import compare, connect

import __spark_entry__ as entry_points

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, tables, name):
    difference = compare(QUERIES[name](spark, SF_DIR), tables.sql(ORACLES[name]))
    assert difference is None, difference


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_returns_rows(spark, name):
    assert not QUERIES[name](spark, SF_DIR).isEmpty()


def test_entry_runs(spark):
    result = entry_points.entry(spark)
    assert result.columns[:2] == ["ticker", "date"]
    assert result.count() > 0
