"""Every query against its SQL in DuckDB, on the smallest tables."""

import datetime
import math

import pytest

import __spark_entry__ as entry
from bylinelake.plans import catalogue

duckdb = pytest.importorskip("duckdb")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return str(v) if isinstance(v, (datetime.date, datetime.datetime)) else v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=str)


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_matches_sql(spark, sf, duck, name):
    df = catalogue.QUERIES[name](spark, sf)
    want = duck.sql(catalogue.SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_query_runs(spark, sf, name):
    assert catalogue.QUERIES[name](spark, sf).count() > 0


def test_entry(spark, sf):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
