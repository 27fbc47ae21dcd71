"""The queries that a second engine can state, against it."""

import os

import duckdb
import pytest

from lectern.llm import queries


@pytest.fixture(scope="module")
def engine(data):
    connection = duckdb.connect()
    for file in os.listdir(data):
        connection.sql(f"create view {file.removesuffix('.parquet')} as select * from '{data}/{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, data, engine, name):
    df = queries.queries()[name](spark, data)
    other = engine.sql(queries.oracle_sql()[name])
    columns = sorted(df.columns)
    assert sorted(other.columns) == columns
    at = [other.columns.index(c) for c in columns]
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    assert got and got == sorted((tuple(r[k] for k in at) for r in other.fetchall()), key=repr)
