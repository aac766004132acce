"""Every bound query against its SQL in DuckDB."""

import os

import pytest
from compare import differences, duck

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert df.take(1), "no rows"
    assert differences(df, con, SQL[name]) == []


def test_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0
