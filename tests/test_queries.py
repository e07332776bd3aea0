"""Every registered query against DuckDB on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare
from hoardline.plans.views import BASE_TABLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    connection = duckdb.connect()
    for table in BASE_TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, connection, name):
    rows, state = compare(spark, connection, SF_DIR, name)
    assert state in ("ok", "rows only"), state
    assert rows > 0


def test_every_check_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
