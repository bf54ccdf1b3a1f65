"""Every query with SQL against DuckDB on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, con, name):
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    assert differences(got, con.execute(entry.oracle_sql()[name]).df()) == []


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    rows = entry.entry(spark)
    assert rows.count() > 0
    assert {"benchmark_source", "forecast_status"} <= set(rows.columns)
