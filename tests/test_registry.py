"""Every registered query against its SQL twin, on the smallest given tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from asterloom import registry
from asterloom.registry.base import TABLE_NAMES

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}

# Joins without a key, and rows handed to Python.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLE_NAMES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def shown(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else repr(value)


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]
    columns = sorted(df.columns)
    want = duck.sql(SQL[name])
    assert sorted(want.columns) == columns
    kinds = dict(zip(want.columns, map(str, want.types)))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == kinds
    places = [want.columns.index(c) for c in columns]
    assert sorted(tuple(shown(r[c]) for c in columns) for r in df.collect()) == sorted(
        tuple(shown(r[i]) for i in places) for r in want.fetchall()
    )


@pytest.mark.parametrize("name", ["log_star", "star_reload", "star_users", "star_time", "versioned_upsert", "query_tables"])
def test_loads_equal_sql_on_more_rows(spark, name):
    """Repeated keys first turn up here."""
    folder, connection = FOLDER.replace("0.001", "0.01"), duckdb.connect()
    for table in TABLE_NAMES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    df, want = QUERIES[name](spark, folder), connection.sql(SQL[name])
    places = [want.columns.index(c) for c in df.columns]
    assert sorted(tuple(map(shown, r)) for r in df.collect()) == sorted(tuple(shown(r[i]) for i in places) for r in want.fetchall())


def test_every_query_has_its_sql():
    """Queries of other origin may do without."""
    assert set(registry.QUERIES) == set(registry.SQL)
    assert set(registry.QUERIES) <= set(SQL) <= set(QUERIES)


def test_entry(spark):
    got = entry_points.entry(spark).collect()
    assert len(got) == 5 and [r.n for r in got] == sorted((r.n for r in got), reverse=True)
