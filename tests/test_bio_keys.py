"""The second dialect on tables repeated with shifted keys, where supplier names repeat, and with an order that is listed twice."""

import pytest
from pyspark.sql import functions as F

from bylinelake.plans import catalogue

TABLES = ("orders", "lineitem", "supplier")


def repeated(spark, sf, k):
    """The tables k times with shifted keys; the rolled-up and the allowed supplier and their copies have raw strings only."""
    shift = {"orders": ("o_orderkey",), "lineitem": ("l_orderkey", "l_suppkey"), "supplier": ("s_suppkey",)}
    out = {t: spark.read.parquet(f"{sf}/{t}.parquet").crossJoin(spark.range(k).withColumnRenamed("id", "__k")) for t in TABLES}
    out["supplier"] = out["supplier"].withColumn("s_acctbal", F.when(F.col("s_suppkey").isin(2, 4), -700.0).otherwise(F.col("s_acctbal")))
    return {t: df.withColumns({c: F.col(c) + F.col("__k") * 100_000 for c in shift[t]}).drop("__k") for t, df in out.items()}


def differences(spark, tables, at, name):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t, df in tables.items():
        df.coalesce(1).write.parquet(f"{at}/{t}.parquet")
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{at}/{t}.parquet/*.parquet'")
    df = catalogue.QUERIES[name](spark, str(at))
    want = c.sql(f"SELECT {', '.join(df.columns)} FROM ({catalogue.SQL[name]})").fetchall()
    got = list(map(tuple, df.collect()))
    assert len(got) == len(want)
    return set(got) ^ set(want)


@pytest.mark.parametrize("name", ["bio_credit", "bio_summary"])
def test_slots_belong_to_their_supplier_where_names_repeat(spark, sf, tmp_path, name):
    assert not differences(spark, repeated(spark, sf, 3), tmp_path, name)


@pytest.mark.parametrize("name", ["bio_credit", "bio_summary"])
def test_an_order_listed_twice_counts_as_in_the_sql(spark, sf, tmp_path, name):
    tables = repeated(spark, sf, 1)
    tables["orders"] = tables["orders"].union(tables["orders"].filter("o_orderkey % 5 = 0"))
    assert not differences(spark, tables, tmp_path, name)
