"""Every registered query against its SQL, at the smallest scale."""

import importlib

import duckdb
import pytest

from conftest import TABLES

FOLDER = "/root/testdata/sf0.001"
entry = importlib.import_module("__spark_entry__")
QUERIES, SQL = entry.queries(), entry.oracle_sql()
TYPES = {"tinyint": "TINYINT", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
         "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_check_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_equals_sql(spark, duck, key):
    result = QUERIES[key](spark, FOLDER)
    columns = sorted(result.columns)
    cursor = duck.execute(SQL[key])
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    assert sorted(names) == columns
    assert {c: TYPES[t] for c, t in result.dtypes} == types
    ours = sorted(str(tuple(row[c] for c in columns)) for row in result.collect())
    picks = [names.index(c) for c in columns]
    theirs = sorted(str(tuple(row[i] for i in picks)) for row in cursor.fetchall())
    assert ours == theirs


ROWS_ONLY = sorted(set(QUERIES) - set(SQL))


@pytest.mark.parametrize("key", ROWS_ONLY)
def test_model_query_returns_rows(spark, key):
    assert QUERIES[key](spark, FOLDER).count() > 0
