"""Reasons of lost credit, metadata precedence, evidence and merges of refreshed records."""

from pyspark.sql import functions as F

from bylinelake.functions import identity
from bylinelake.operators import credit, refresh


def test_company_and_country(spark):
    rows = [("Acme GmbH, Berlin", True), ("Robert Bosch Ltd.", True), ("Institute of Physics Co., Ltd.", False), ("Incense Lab", False), (None, False), ("", False)]
    df = spark.createDataFrame([(i, r, x) for i, (r, x) in enumerate(rows)], "i int, r string, x boolean")
    assert [r["i"] for r in df.select("i", "x", refresh.looks_like_company(F.col("r")).alias("y")).collect() if r["x"] != r["y"]] == []
    rows = [("CN", ["US"], True), ("CN", ["HK"], False), ("HK", ["CN"], False), ("IE", ["GB", "FR"], False), ("HK", ["TW"], True), ("US", [], False), ("", ["US"], False), (None, ["US"], False), ("US", ["DE", "US"], False)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, c string, n array<string>, x boolean")
    assert [r["i"] for r in df.select("i", "x", refresh.country_contradiction(F.col("c"), F.col("n")).alias("y")).collect() if r["x"] != r["y"]] == []


INST = "array<struct<id:string,type:string>>"
WORK = f"doi string, authorships array<struct<author_name:string,institutions:{INST},raw_affiliations:array<string>>>"


def test_carry_forward_needs_the_same_byline(spark):
    one = lambda name, inst=(), raw=(): (name, [(i, "education") for i in inst], list(raw))
    now = [("a", [one("Ann Lee"), one("Bo", raw=["own"])]), ("b", [one("X")]), ("c", [one("")]), (None, [one("Y")]), ("d", [])]
    old = [("a", [one("ANN  LEE", ["I1"], ["u"]), one("bo", ["I2"], ["v"])]), ("b", [one("Z", ["I3"])]), ("c", [one("", ["I4"])]), (None, [one("Y", ["I5"])]), ("d", [])]
    out = refresh.carry_forward(spark.createDataFrame(now, WORK), spark.createDataFrame(old, WORK), identity.words_key)
    got = {r["doi"]: [([i["id"] for i in a["institutions"]], a["raw_affiliations"]) for a in r["authorships"]] for r in out.collect()}
    assert got == {"a": [(["I1"], ["u"]), (["I2"], ["own"])], "b": [([], [])], "c": [([], [])], None: [([], [])], "d": []}


def test_discovery_counts_distinct_candidates(spark):
    kind = "id string, title string, names array<string>, year int"
    wanted = spark.createDataFrame([("w1", "t", ["a", "b"], 2020), ("w2", "t", ["b", "a"], 2020), ("w3", "u", ["a"], None), ("w4", "", ["a"], 2020), ("w5", "v", [""], 2020), ("w6", None, None, None)], kind)
    found = spark.createDataFrame([("c1", "t", ["a", "b"], 2021)] * 2 + [("c2", "t", ["a", "b"], 2022), ("c3", "u", ["a"], 1990), ("c4", "u", ["a"], None), ("c5", "", ["a"], 2020), ("c6", "v", [""], 2020)], kind)
    out = {r["id"]: (r["status"], r["n"], r["found"]) for r in refresh.discover(wanted, found).collect()}
    assert out == {"w1": ("matched", 1, "c1"), "w3": ("ambiguous", 2, None)} | {w: ("unresolved", 0, None) for w in ("w2", "w4", "w5", "w6")}


def test_editorial_candidates(spark):
    one = lambda kind: ("n", [("i", kind)], [])
    rows = [("a", "article", "Results", [one("education")] * 3), ("b", "article", "Results", [one("education")]), ("c", "Editorial", "x", [one("education")] * 3), ("d", None, "Guest editorial", [one("education")] * 3), ("e", "article", "x", [one("company")]), ("f", "article", None, [])]
    df = spark.createDataFrame(rows, "id string, type string, title string, " + WORK.split(", ", 1)[1])
    assert {r["id"] for r in refresh.editorial_candidates(df, "(?i)editorial", credit.NON_RESEARCH).collect()} == {"b", "c", "d"}


def test_empty_tables(spark):
    slots = spark.createDataFrame([], f"n_slots int, institutions {INST}, raw_affiliations array<string>")
    w = refresh.string_weights(slots)
    assert w.count() == 0 and refresh.map_coverage(w, spark.createDataFrame([], "raw_affiliation string, status string")).count() == 0
