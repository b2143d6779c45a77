"""Queries with a SQL twin against DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries

SF = "/root/testdata/sf0.01"
NAMES = [n for n in oracle_sql() if n.startswith("op")]


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in "documents embeddings pages benchmark conversations".split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = queries()[name](spark, SF)
    twin = con.execute(oracle_sql()[name])
    columns = [d[0] for d in twin.description]
    assert sorted(columns) == sorted(df.columns)
    expected = sorted((tuple(r) for r in twin.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=repr) == expected
