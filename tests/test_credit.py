"""Credit over nested works: duplicates, ownership, aliases, fallback, names."""

import pytest
from pyspark.sql import functions as F

from bylinelake.operators import credit


def inst(i, name="n", kind="education"):
    return {"id": i, "display_name": name, "country_code": "US", "type": kind, "lineage": []}


def slot(insts=(), raws=(), author="A1", name="Ann"):
    return {"author_id": author, "author_name": name, "institutions": list(insts), "raw_affiliations": list(raws), "affiliation_source": None}


def work(id_, venue, year, line, slots, doi=None, title="T", kind="article", pub=None):
    return {"id": id_, "doi": doi, "title": title, "publication_year": pub or year, "type": kind, "authorships": slots, "venue": venue, "year_dir": year, "line_no": line}


@pytest.fixture
def run(spark):
    def go(works, aliases=(), mapping=(), venues=(("v", "x"), ("w", "x")), venue_excluded=None, types=("education",)):
        w = spark.createDataFrame(works, credit.WORK_SCHEMA + ", venue string, year_dir int, line_no int")
        v = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(venues)], "venue string, area string, position int")
        m = spark.createDataFrame(list(mapping), "raw_affiliation string, status string, institution_id string, institution_name string, institution_type string")
        a = spark.createDataFrame(list(aliases), "duplicate_id string, canonical_id string, canonical_name string")
        e = spark.createDataFrame(venue_excluded, "venue string, record_key string") if venue_excluded else None
        return credit.aggregate_works(w, v, m, a, e, credit_types=types)

    return go


U = "https://openalex.org/"


def facts(out):
    return {r["institution_id"].replace(U, ""): (r["pub_count"], round(r["adjusted_count"], 9)) for r in out["institution_area_year"].collect()}


def test_replayed_work_counts_once(run):
    w = [work("W1", "v", 2020, i, [slot([inst("I1")])], doi="10.1/X") for i in (1, 2)]
    assert facts(run(w)) == {"I1": (1, 1.0)}


def test_venue_exclusion_leaves_the_other_owner(run):
    w = [work("W1", v, 2020, 1, [slot([inst("I1")])], doi="https://doi.org/10.1/x") for v in ("v", "w")]
    out = run(w, venue_excluded=[("v", "doi:10.1/x")])
    assert [r["venue"] for r in out["institution_venue_year"].collect()] == ["w"]


def test_same_title_without_doi_is_two_works(run):
    assert facts(run([work(f"W{i}", "v", 2020, i, [slot([inst("I1")])]) for i in (1, 2)])) == {"I1": (2, 2.0)}


def test_alias_collapse_and_forms(run):
    w = [work("W1", "v", 2020, 1, [slot([inst("I1"), inst(f"http://openalex.org/I2/"), inst("I3")])])]
    assert facts(run(w, [("I1", "I0", ""), (f"{U}I2", "I0", "Zero")])) == {"I0": (1, 0.5), "I3": (1, 0.5)}


def test_alias_chain_and_cycle(spark, run):
    c = credit.alias_closure(spark.createDataFrame([("a", "b", "B"), ("b", "c", ""), ("c", "d", "D"), ("d", "e", "")], "duplicate_id string, canonical_id string, canonical_name string"))
    assert {(r[0], r[1], r[2]) for r in c.collect()} == {("a", "e", "D"), ("b", "e", "D"), ("c", "e", "D"), ("d", "e", None)}
    with pytest.raises(ValueError, match="alias cycle"):
        run([work("W1", "v", 2020, 1, [slot([inst("I1")])])], [("I1", "I2", ""), ("I2", "I1", "")])


def test_earlier_edition_owns_and_record_year_counts(run):
    w = [work("W1", "v", y, 1, [slot([inst("I1")])], doi="10.1/x", pub=y + 1) for y in (2025, 2024)]
    assert [(r["year"], r["pub_count"]) for r in run(w)["institution_area_year"].collect()] == [(2025, 1)]


def test_editorial_owns_its_duplicate(run):
    w = [work("W1", "v", 2020, 1, [slot([inst("I1")])], doi="10.1/x", kind="Editorial"), work("W1", "v", 2020, 2, [slot([inst("I1")])], doi="10.1/x")]
    assert facts(run(w)) == {}


def test_null_author_and_null_type(run):
    w = [work("W1", "v", 2020, 1, [slot([inst("I1")], author=a) for a in (None, "null")], kind=None)]
    got = {r["author_id"]: r["adjusted_count"] for r in run(w)["author"].collect()}
    assert got == {None: 0.5, "null": 0.5}


def test_fallback_only_where_no_institution(run):
    maps = [("Raw A", "auto", "I5", "Five", "education"), ("Raw B", "review", "I6", "Six", "education"), ("Raw C", "manual", "I5", "Five", "company")]
    w = [work("W1", "v", 2020, 1, [slot(raws=["Raw A", "Raw C"]), slot([inst("I7", kind="company")], ["Raw A"]), slot(raws=["Raw B"]), slot()])]
    out = run(w, mapping=maps)
    assert facts(out) == {"I5": (1, 0.25)}
    assert out["audit"].first().asDict() == {"works": 1, "slots": 4, "dropped_slots": 2}


def test_last_name_wins(run):
    w = [work(f"W{i}", "v", 2020, i, [slot([inst("I1", n)])]) for i, n in ((3, "Last"), (1, "First"), (2, "Mid"))]
    assert run(w)["institution_names"].first()["institution_name"] == "Last"


def test_last_listed_area_and_unknown_venue(run):
    w = [work("W1", "v", 2020, 1, [slot([inst("I1")])]), work("W2", "zz", 2020, 1, [slot([inst("I1")])])]
    assert [(r["area"], r["pub_count"]) for r in run(w, venues=(("v", "x"), ("v", "y")))["institution_area_year"].collect()] == [("y", 1)]


def test_array_shares_match_shares(spark):
    rows = spark.createDataFrame([(1, 0, 2, ["a", "b", "a"]), (1, 1, 2, ["a"]), (2, 0, 1, [])], "w int, s int, n int, i array<string>")
    a = credit.array_shares(rows, "i", "n").groupBy("w", "institution").agg(F.sum("share")).collect()
    b = credit.shares(rows.select("w", "s", "n", F.explode("i").alias("institution")), ["w"], ["s"], "institution", "n").groupBy("w", "institution").agg(F.sum("share")).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) == [(1, "a", 0.75), (1, "b", 0.25)]
