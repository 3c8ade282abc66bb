"""Ranking fixtures: scores, tolerance ties, regions, history, search, state."""

import math

import pytest

from bylinelake.operators import ranking as rk

FACTS = [("x", "A", 2020, 4, 3.0), ("x", "A", 2026, 9, 99.0), ("x", "B", 2020, 2, 1.0), ("x", "C", 2020, 2, 1.0), ("x", "D", 2020, 1, 0.5), ("y", "B", 2021, 1, 3.0), ("y", "C", 2021, 1, 3.0)]
INST = [("A", "Alpha", "US", "NA", "education"), ("B", "Beta", "DE", "EU", ""), ("C", "Gamma", "US", "NA", "facility"), ("D", "Delta", "", "", "education")]


@pytest.fixture(scope="module")
def data(spark):
    f = spark.createDataFrame(FACTS, "area string, institution string, year int, pub_count int, adjusted_count double")
    i = spark.createDataFrame(INST, "institution string, name string, country string, continent string, type string")
    return f, i


def ranks(data, **kw):
    out = rk.rank(*data, rk.Selection(2016, 2025, ("x", "y"), **kw)).orderBy("rank", "institution").collect()
    return [(r["institution"], r["rank"], r["tied"], round(r["score"], 9)) for r in out]


def test_scores_and_ties(data):
    b = round(math.sqrt(8) - 1, 9)
    assert ranks(data) == [("B", 1, True, b), ("C", 1, True, b), ("A", 3, False, 1.0), ("D", 4, False, round(math.sqrt(1.5) - 1, 9))]


@pytest.mark.parametrize(("kw", "want"), [({"region": "US"}, ["C", "A"]), ({"region": "EU"}, ["B"]), ({"kind": "education"}, ["B", "A", "D"]), ({"kind": "research"}, ["C"]), ({"kind": "facility"}, ["C"])])
def test_predicates(data, kw, want):
    assert [r[0] for r in ranks(data, **kw)] == want


def test_chain_of_small_gaps_shares_a_rank(spark):
    rows = spark.createDataFrame([("a", 1.0), ("b", 1.0 - 8e-10), ("c", 1.0 - 16e-10), ("d", 0.5)], "i string, s double")
    got = {r["i"]: (r["rank"], r["tied"]) for r in rk.tolerant_rank(rows, "s", ["i"]).collect()}
    assert got == {"a": (1, True), "b": (1, True), "c": (1, True), "d": (4, False)}


def test_history_and_movement(spark):
    r = spark.createDataFrame([("a", 2018, 2), ("a", 2019, 1), ("a", 2021, 1)], "institution string, year int, rank int")
    h = rk.history(r, 2018, 2021)
    assert [x["rank"] for x in h.orderBy("year").collect()] == [2, 1, None, 1]
    assert rk.net_movement(h, 2021).first()["movement"] == 1
    assert rk.net_movement(h, 2020).first()["movement"] is None


def test_trend_sort(spark):
    rows = spark.createDataFrame([("a", 1, None), ("b", 2, 3), ("c", 3, -2), ("d", 4, 3)], "institution string, rank int, movement int")
    order = lambda mode: [r["institution"] for r in rk.trend_sort(rows, mode).orderBy("position").collect()]
    assert order("improved") == ["b", "d", "c", "a"]
    assert order("declined") == ["c", "b", "d", "a"]
    assert order("score") == ["a", "b", "c", "d"]


def test_disabled_venues_drop_empty_areas(spark):
    v = spark.createDataFrame([("a", "x", "v1", 2020, 1, 1.0), ("a", "y", "v2", 2020, 1, 2.0)], "institution string, area string, venue string, year int, pub_count int, adjusted_count double")
    out = rk.enabled_facts(v, v, rk.Selection(2020, 2020, ("x", "y"), disabled_venues=("v1",))).collect()
    assert [(r["area"], r["adjusted_count"]) for r in out] == [("y", 2.0)]


def test_search_tiers(spark):
    n = spark.createDataFrame([("Massachusetts Institute of Technology",), ("Mitre Corp",), ("Summit College",), ("Univ Committee",)], "name string")
    got = lambda q, **k: {r["name"]: r["tier"] for r in rk.search(n, q, **k).collect()}
    assert got("mit") == {"Massachusetts Institute of Technology": 1, "Mitre Corp": 2}
    assert got("mmit") == {"Summit College": 4, "Univ Committee": 4}
    assert got("tech giant", aliases={"tech giant": "Mitre Corp"}) == {"Mitre Corp": 0}


def test_state_round_trip():
    default = rk.Selection(2016, 2025, ("x", "y"))
    s = rk.Selection(2018, 2020, ("y",), "EU", "all", ("v1",))
    assert rk.decode_state(rk.encode_state(s, default), default, ("x", "y")) == s
    assert rk.encode_state(default, default) == ""
    assert rk.decode_state("from=2024&to=2019&areas=zz&x=1", default, ("x", "y")) == rk.Selection(2019, 2024, ("x", "y"))
    assert rk.decode_state("from=99", default, ("x",)).first == 2016


def test_compare_has_totals(spark, data):
    slots = spark.createDataFrame([("A", 1), ("B", 2)], "institution string, slot int")
    out = {(r["slot"], r["year"], r["area"]): r["adj"] for r in rk.compare(data[0], slots, 2016, 2025).collect()}
    assert out[2, None, None] == 4.0 and out[2, 2021, None] == 3.0 and out[1, 2020, "x"] == 3.0
