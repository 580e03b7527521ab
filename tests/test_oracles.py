"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from ordermill.catalog import all_queries

FOLDER = os.environ.get("ORDERMILL_TEST_TABLES", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "part", "orders", "lineitem"]

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables absent")

# How the SQL engine names the types Spark reports.
TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_a_twin():
    assert set(all_queries()) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, sql, name):
    got = contract.queries()[name](spark, FOLDER)
    expected = sql.sql(contract.oracle_sql()[name])
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: TYPE_NAMES.get(t, t.upper()) for c, t in got.dtypes} == types
    columns = sorted(types)
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected_rows = sql.sql(f"SELECT {quoted} FROM ({contract.oracle_sql()[name]})").fetchall()
    got_rows = [tuple(r) for r in got.select(*[f"`{c}`" for c in columns]).collect()]
    assert len(got_rows) == len(expected_rows) > 0
    assert sorted(got_rows, key=str) == sorted(expected_rows, key=str)


def test_entry(spark):
    assert contract.entry(spark).count() == 5
