"""Every query with SQL against DuckDB on the smallest tables; the others return rows."""

from collections import Counter

import pytest

import __spark_entry__ as driver
from compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_returns_rows(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert df.limit(1).count() == 1 and len(Counter(df.columns)) == len(df.columns)


def test_entry(spark):
    assert driver.entry(spark).count() > 0
