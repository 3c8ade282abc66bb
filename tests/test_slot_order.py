"""Credit where byline slots may be numbered anew whenever they are computed, as on a cluster where lines arrive in any order."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from bylinelake.operators import biology
from bylinelake.plans import catalogue, facts


@pytest.fixture
def renumbered(spark):
    """Four slots of a work; each run gives them other numbers."""
    fresh = F.udf(lambda i: f"{i}-{uuid.uuid4()}", "string").asNondeterministic()
    inst = "institutions array<struct<id:string,name:string,type:string,country:string>>"
    rows = [(1, "v", 2020, 4, i, [(f"I{i % 2}", "n", "education", "US")]) for i in range(4)]
    spark.conf.set("spark.sql.exchange.reuse", "false")  # else one shuffle of the small input serves both runs
    yield spark.createDataFrame(rows, f"work int, venue string, year int, n_slots int, i int, {inst}").withColumn("slot", fresh("i")).drop("i")
    spark.conf.unset("spark.sql.exchange.reuse")


def biology_of(spark, slots):
    areas = spark.createDataFrame([("v", "x", 0)], "venue string, area string, position int")
    return biology.credit(slots, areas, spark.createDataFrame([], "child string, parent string, parent_name string"))


def test_biology_credit_keeps_renumbered_slots(spark, renumbered):
    assert sorted(map(tuple, biology_of(spark, renumbered)["area"].collect())) == [("I0", "x", 2020, 2, 0.5), ("I1", "x", 2020, 2, 0.5)]


def test_biology_summary_keeps_renumbered_slots(spark, renumbered):
    out = biology.summary(biology_of(spark, renumbered)["area"]).select("area", "id", "adjusted_count", "pub_count", "rank").collect()
    assert sorted(map(tuple, out)) == [("x", "I0", 0.5, 2, 1), ("x", "I1", 0.5, 2, 2)]


@pytest.fixture
def turned(spark, sf, tmp_path):
    """The tables with line items in another order, and a supplier that is not listed."""
    for t in ("orders", "customer", "supplier"):
        os.symlink(f"{sf}/{t}.parquet", tmp_path / f"{t}.parquet")
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").withColumn("l_suppkey", F.when(F.col("l_suppkey") == 3, -1).otherwise(F.col("l_suppkey")))
    for name, order in (("lineitem", F.xxhash64("l_orderkey", "l_linenumber", "l_partkey")), ("again", -F.xxhash64("l_orderkey", "l_linenumber", "l_partkey"))):
        rows.coalesce(1).sortWithinPartitions(order).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_slot_numbers_do_not_depend_on_the_order_of_lines(spark, turned, monkeypatch):
    got = [facts.nested_works(spark, turned).select("id", "authorships").collect()]
    load = facts.load
    monkeypatch.setattr(facts, "load", lambda s, d, name: load(s, d, "again" if name == "lineitem" else name))
    got.append(facts.nested_works(spark, turned).select("id", "authorships").collect())
    assert sorted(got[0]) == sorted(got[1])


@pytest.mark.parametrize("name", ["bio_credit", "bio_summary", "credit_raw_fallback", "string_weights"])
def test_slots_of_unlisted_suppliers_count(spark, turned, name):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in ("orders", "customer", "supplier"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{turned}/{t}.parquet'")
    c.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{turned}/lineitem.parquet/*.parquet'")
    df = catalogue.QUERIES[name](spark, turned)
    assert sorted(map(tuple, df.collect())) == sorted(c.sql(f"SELECT {', '.join(df.columns)} FROM ({catalogue.SQL[name]})").fetchall())
