"""Every catalog query against its SQL twin on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_point
import check
from tillflow.plans.catalog import QUERIES
from tillflow.plans.oracle import SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in check.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sql, name):
    good, note = check.compare(spark, sql, SF, name)
    assert good, note


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.items() <= entry_point.queries().items()
    assert SQL.items() <= entry_point.oracle_sql().items()


def test_entry_ranks_the_brands(spark):
    rows = entry_point.entry(spark).collect()
    assert rows and [r.amount for r in rows] == sorted((r.amount for r in rows), reverse=True)
