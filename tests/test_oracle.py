"""Every registered query on the smallest test tables, against its SQL where it has one."""

import math

import pytest

import __spark_entry__ as entry_point
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, connection, name):
    assert compare(connection, QUERIES[name](spark, FOLDER), SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_without_sql(spark, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    assert rows
    numbers = [v for r in rows for v in r if isinstance(v, float)]
    assert all(math.isfinite(v) for v in numbers)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    rows = entry_point.entry(spark).collect()
    assert {r["hue"] for r in rows} == {0, 1}
