"""Every registered query with SQL against DuckDB on the smallest tables."""

import os

import pytest

from foliate.plans import catalogue


def rows(df):
    df = df[sorted(df.columns)]
    text = lambda x: "null" if x is None or x != x else f"{float(x):.4f}" if isinstance(x, float) else str(x)
    return sorted(tuple(map(text, r)) for r in df.itertuples(index=False))


@pytest.fixture(scope="module")
def duck(data):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(data):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{data}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query(spark, data, duck, name):
    got, want = catalogue.QUERIES[name](spark, data).toPandas(), duck.sql(catalogue.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["a", "b", "score", "rank"]
