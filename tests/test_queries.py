"""Every registered query against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

SF_DIR = entry.SMOKE_DIR
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_query(spark, duck, name):
    assert compare(spark, duck, QUERIES[name], SQL[name], SF_DIR) == []


def test_entry(spark):
    assert not entry.entry(spark).isEmpty()
