"""Every core query against its SQL in a second engine, at the smallest scale."""

import math
import os

import duckdb
import pytest

from lectern.plans import core


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, float):
        return round(value, 6)
    return value.replace(tzinfo=None) if hasattr(value, "tzinfo") else value


@pytest.fixture(scope="module")
def engine(data):
    connection = duckdb.connect()
    for file in os.listdir(data):
        connection.sql(f"create view {file.removesuffix('.parquet')} as select * from '{data}/{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_query(spark, data, engine, name):
    df = core.QUERIES[name](spark, data)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    other = engine.sql(core.ORACLE[name])
    assert sorted(other.columns) == columns
    at = [other.columns.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[k]) for k in at) for r in other.fetchall()), key=repr)
    assert got, "an empty result proves nothing"


def test_the_core_does_not_import_the_llm_subpackage():
    import subprocess
    import sys

    code = "import sys, lectern.plans.core, lectern.streaming.arrivals, lectern.sources.sinks; sys.exit(any(m.startswith('lectern.llm') for m in sys.modules))"
    assert subprocess.run([sys.executable, "-c", code], check=False).returncode == 0
