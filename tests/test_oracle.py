"""Every registered query with SQL against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect
from indipanel.catalog.spark_queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, SF)
    assert ok, note


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) - set(entry.oracle_sql()) == {"rf_fit_predict"}


def test_entry(spark):
    assert entry.entry(spark).count() == 1383
