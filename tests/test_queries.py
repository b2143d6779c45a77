"""Every registered query against its SQL twin in DuckDB."""

from __future__ import annotations

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from ebbtide import schema
from ebbtide.queries.base import Inputs
from ebbtide.queries.registry import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer part orders events".split()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def inputs(spark):
    """Inputs whose weekly table is stored once for all queries."""
    shared = Inputs(spark, SF)
    shared.__dict__["weekly"] = shared.weekly.checkpoint()
    return shared


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql is not None])
def test_query_equals_sql(inputs, con, name):
    df = QUERIES[name].on(inputs)
    twin = con.execute(oracle_sql()[name])
    columns = [d[0] for d in twin.description]
    assert sorted(df.columns) == sorted(columns)
    got, expected = as_rows(df.columns, df.collect()), as_rows(columns, twin.fetchall())
    assert len(got) == len(expected)
    assert got == expected


def test_matrix_shape(inputs):
    rows = inputs.sequence.collect()
    assert len(rows) == 150
    assert all(len(r["X"]) == 4 and {len(w) for w in r["X"]} == {38} for r in rows)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["user_id", "week_num", *schema.names()]
    assert df.count() == 600


def test_every_query_with_a_twin_is_registered():
    assert set(oracle_sql()) <= set(queries())
