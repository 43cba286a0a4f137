"""The queries that SQL can express, against DuckDB on the smallest tables."""

import os

import pytest

from foliate.llm import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query(spark, data, name):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(data):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{data}/{f}'")
    want = con.sql(registry.ORACLES[name])
    columns = sorted(want.columns)
    got = registry.QUERIES[name](spark, data)
    assert sorted(got.columns) == columns
    rows = lambda found: sorted(map(repr, found))
    assert rows(tuple(r) for r in got.select(*columns).collect()) == rows(want.select(", ".join(f'"{c}"' for c in columns)).fetchall())
