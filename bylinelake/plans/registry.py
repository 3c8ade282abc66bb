"""Queries and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function of (spark, sf_dir), and the SQL that gives the same rows."""

    def add(f):
        if (name or f.__name__) in QUERIES:
            raise ValueError(f"query {name or f.__name__} is registered twice")
        QUERIES[name or f.__name__] = f
        if sql:
            SQL[name or f.__name__] = sql
        return f

    return add


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
