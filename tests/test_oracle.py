"""Every registered query against its SQL in DuckDB, on whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = ("orders", "customer")
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "string": "VARCHAR",
}
QUERIES = {n: q for n, q in entry.queries().items() if n not in entry.EXTRA}
SQL = {n: q for n, q in entry.oracle_sql().items() if n not in entry.EXTRA}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as from '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    expected = duck.sql(SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    want_types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == want_types
    got = sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect())))
    picked = expected.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert got == sorted(map(repr, picked))
    assert got
