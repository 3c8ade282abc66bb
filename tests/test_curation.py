"""Names, places, map checks and evidence, on cases that reach each branch; nulls and empty tables."""

import pytest
from pyspark.sql import functions as F

from bylinelake.functions import identity, names, places
from bylinelake.operators import curation, evidence, merge


def test_names_agree_as_a_column_and_as_a_matrix(spark):
    cases = [("Ann Lee", "A. Lee", True), ("Zhang Wei", "Wei Zhang", True), ("BinChen", "Bin Chen", True), ("ChenBin", "Bin Chen", True), ("Søren Łuk Jr.", "soren luk", True), ("Bo Li", "Xu Li", False), ("O'Neil P", "P ONeil", True), ("", "", False), (None, "A B", False), ("&eacute;mile Roux", "E Roux", True), ("A B C", "C B A", True)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, a string, b string, x boolean")
    got = df.select("i", "x", names.names_agree(names.name_tokens("a"), names.name_tokens("b")).alias("y")).collect()
    assert [r["i"] for r in got if r["x"] != r["y"]] == []
    m = names.agreement([c[0] for c in cases], [c[1] for c in cases])
    assert [bool(m[i, i]) for i in range(len(cases))] == [c[2] for c in cases]


def test_name_parts(spark):
    df = spark.createDataFrame([("Héctor J. Sussmann Jr.",), ("Wan–Sik Hwang",), (None,)], "n string")
    got = df.select(names.family_key("n"), names.sorted_tokens("n"), names.letter_tokens("n")).collect()
    assert [tuple(r) for r in got] == [("sussmann", ["hector", "j", "jr", "sussmann"], ["hector", "j", "sussmann", "jr"]), ("hwang", ["hwang", "sik", "wan"], ["wan", "sik", "hwang"]), ("", [], [])]


def lcs(a, b, same):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = max(t[i][j + 1], t[i + 1][j], t[i][j] + 1 if same[i][j] else 0)
    return t[-1][-1]


def test_alignment_is_longest(spark):
    import random

    rng = random.Random(5)
    people = ["Ann Lee", "A Lee", "Bo Xu", "Xu Bo", "C D", "Eve Moss", ""]
    rows = [(rng.choices(people, k=rng.randint(0, 9)), rng.choices(people, k=rng.randint(0, 9))) for _ in range(40)] + [(None, ["a"])]
    out = spark.createDataFrame(rows, "a array<string>, b array<string>").select("a", "b", merge.align("a", "b").alias("p")).collect()
    for r in out:
        a, b, pairs = r["a"] or [], r["b"] or [], [tuple(p) for p in r["p"]]
        same = names.agreement(a, b) if a and b else []
        assert len(pairs) == lcs(a, b, same) and all(same[i][j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))


def test_countries(spark):
    cases = [("MIT, USA", ["US"]), ("Univ. of New Mexico, U.S.A.", ["US"]), ("UNAM, Mexico", ["MX"]), ("New South Wales, Australia", ["AU"]), ("Cardiff, Wales", ["GB"]), ("Bilkent, Türkiye", ["TR"]), ("China " + "x" * 60, []), ("Indiana", []), ("", []), (None, [])]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, r string, x array<string>")
    assert [r["i"] for r in df.select("i", "x", places.countries_named(F.col("r")).alias("y")).collect() if r["x"] != r["y"]] == []
    df = spark.createDataFrame([("lab paris france and texas",), ("francevilla",), (None,)], "w string")
    got = [r[0] for r in df.select(places.countries_in_words(F.col("w"), {"france": "FR", "usa": "US"})).collect()]
    assert got == [["FR", "US"], [], []]


def test_venue_and_title_forms(spark):
    venues = {"Conference on Robots (ICRA)": "ICRA", "IEEE Transactions on Robotics": "IEEE Trans. Robotics", "IEEE Journal of Selected Topics in Signal Processing": "IEEE J. Sel. Topics Signal Processing", "IEEE Journal on Emerging and Selected Topics in Circuits": "IEEE J. Sel. Topics Circuits", "Symposium on VLSI / Circuits": "VLSI", "Transactions on Computer-Aided Design of Integrated Circuits and Systems": "Trans. Computer-Aided Design"}
    df = spark.createDataFrame(list(venues.items()), "v string, x string")
    got = {r["v"]: r["y"] for r in df.select("v", identity.short_venue(F.col("v")).alias("y")).collect()}
    assert got == venues
    df = spark.createDataFrame([("A &amp; B: “c_d”, é",), (None,)], "t string")
    assert [tuple(r) for r in df.select(identity.query_words(F.col("t")), identity.alnum_key(F.col("t"))).collect()] == [("A B c_d é", "aampbcde"), ("", "")]
    df = spark.createDataFrame([("Univ. de Gen&egrave;ve &amp; Lab",)], "n string")
    assert df.select(identity.institution_words(F.col("n"))).first()[0] == "university de geneve and laboratory"


INDEX = "id string, display_name string, country_code string, type string, lineage array<string>, alternatives array<string>, acronyms array<string>"
MAP = "raw_affiliation string, status string, institution_id string, institution_name string, institution_type string, country_code string, lineage string, matched_via string"


def test_map_checks_reach_every_kind(spark):
    index = spark.createDataFrame([("u", "Ucity Univ", "US", "education", None, None, ["UCU"]), ("c", "Firm", "US", "company", None, None, None)], INDEX)
    row = lambda raw, iid="u", status="auto", kind="education", via=None: (raw, status, iid, "x", kind, "US", "", via)
    m = spark.createDataFrame([row("A-B"), row("a b", "c", kind="company"), row("x", via="ucu"), row("y", via="zz"), row("Acme Ltd, Tokyo", via="Tokyo"), row("z, Japan"), row("w", kind="company"), row("v, Japan", status="review"), row("q", iid=None, via="zz"), row(None)], MAP)
    got = {tuple(r) for r in curation.map_checks(m, index).collect()}
    assert got == {("variant_split", "a b", 2), ("acronym", "y", 1), ("city_firm", "Acme Ltd, Tokyo", 1), ("acronym", "Acme Ltd, Tokyo", 1), ("abroad", "z, Japan", 1), ("type_differs", "w", 1)}


def test_enrich_and_empty_tables(spark):
    index = spark.createDataFrame([("u", "New", None, "education", ["u", "v"], None, None)], INDEX)
    m = spark.createDataFrame([("a", "auto", "u", "old", "company", "FR", "", ""), ("b", "auto", "none", "old", "company", "FR", "", ""), ("c", "auto", None, "old", None, None, "", "")], MAP)
    got = {r["raw_affiliation"]: (r["institution_name"], r["institution_type"], r["country_code"], r["lineage"]) for r in curation.enrich(m, index).collect()}
    assert got == {"a": ("New", "education", "", "u|v"), "b": ("old", "company", "FR", ""), "c": ("old", None, None, "")}
    none = spark.createDataFrame([], MAP)
    assert curation.map_checks(none, index).count() == 0 and curation.country_repairs(none, index).count() == 0
    decisions = spark.createDataFrame([], "raw_affiliation string, key string, decision string, institution_id string, evidence string, at int")
    done, rejected = curation.apply_decisions(m, decisions, index, "at")
    assert done.count() == 3 and rejected.count() == 0


SLOT = "array<struct<author_id:string,author_name:string,institutions:array<string>,raw_affiliations:array<string>>>"
WORK = f"doi string, title string, source string, backfilled_from string, authorships {SLOT}"


def compatible_names(a, b):
    if not a or not b or a == b:
        return bool(a) and a == b
    if min(len(a), len(b)) < 2 or a[-1] != b[-1]:
        return False
    if "".join(a[:-1]) == "".join(b[:-1]):
        return True
    return all(x == y or (len(x) == 1 and y.startswith(x)) or (len(y) == 1 and x.startswith(y)) for x, y in zip(a[:-1], b[:-1]))


def test_compatible_names(spark):
    pool = [[], ["lee"], ["a", "lee"], ["ann", "lee"], ["ann", "b", "lee"], ["anna", "lee"], ["wan", "sik", "hwang"], ["wansik", "hwang"], ["bo", "lee"], ["a", "c", "lee"]]
    df = spark.createDataFrame([(a, b) for a in pool for b in pool], "a array<string>, b array<string>")
    for r in df.select("a", "b", evidence.compatible(F.col("a"), F.col("b")).alias("x")).collect():
        assert r["x"] == compatible_names(r["a"], r["b"]), (r["a"], r["b"])


def test_preserve_keeps_what_is_certain(spark):
    one = lambda name, ident=None, inst=(), raw=(): (ident, name, list(inst), list(raw))
    url = "https://openalex.org/A1"
    now = [("10.1/a", "The <i>Title</i>", None, None, [one("A. Lee"), one("New Name", url), one("B Ray", raw=["own"]), one("C Fox", inst=["I9"]), one("Bo Li"), one("B Li")]),
           ("10.1/b", "Something else", None, None, [one("A Lee")]), ("10.1/c", "T", "semanticscholar", None, [one("A Lee")]), ("10.1/d", "T", "semanticscholar", "openalex", [one("A Lee")]), (None, "T", None, None, [one("A Lee")]), ("10.1/e", "T", None, None, None)]
    old = [("https://doi.org/10.1/A", "the title", None, None, [one("Ann Lee", None, ["I1"], ["r1"]), one("Old Name", url, ["I2"]), one("B Ray", None, ["I3"], ["r3"]), one("C Fox", None, ["I4"], ["r4"]), one("Bob Li", None, ["I5"])])]
    old += [(f"10.1/{x}", "T", None, None, [one("A Lee", None, ["I7"])]) for x in "bcde"] + [(None, "T", None, None, [one("A Lee", None, ["I8"])])]
    out = evidence.preserve(spark.createDataFrame(now, WORK), spark.createDataFrame(old, WORK)).collect()
    got = {r["doi"]: ([(s["institutions"], s["raw_affiliations"]) for s in r["authorships"] or []], r["retained"]) for r in out}
    bare = ([([], [])], 0)
    assert got == {"10.1/a": ([(["I1"], ["r1"]), (["I2"], []), ([], ["own"]), (["I9"], ["r4"]), ([], []), (["I5"], [])], 4), "10.1/b": bare, "10.1/c": bare, "10.1/d": ([(["I7"], [])], 1), None: bare, "10.1/e": ([], 0)}


def test_canonical_and_metadata(spark):
    kind = "id string, doi string, title string, publication_year int, type string, extra int, authorships array<struct<author:struct<id:string,display_name:string>,institutions:array<struct<id:string,display_name:string,country_code:string,type:string,lineage:array<string>,ror:string>>>>"
    rows = [("W1", "d", "t", 2020, "article", 1, [(("A1", "Ann"), [("I1", "U", "US", "education", ["I1"], "r"), None]), (None, None)]), ("W2", None, None, None, None, None, None)]
    out = evidence.canonical(spark.createDataFrame(rows, kind))
    assert [r["authorships"] for r in out.orderBy("id").collect()] == [[("A1", "Ann", [("I1", "U", "US", "education", ["I1"])]), (None, None, [])], None]
    assert "extra" not in out.columns
    found = spark.createDataFrame([("W1", 5)], "id string, refs int")
    got = {r["id"]: r["refs"] for r in evidence.with_metadata(out, found, {"refs": F.lit(None).cast("int")}).collect()}
    assert got == {"W1": 5, "W2": None}


@pytest.mark.parametrize("size, want", [(100, {"a": 50, "b": 1}), (1, {"a": 1, "b": 1})])
def test_quotas(size, want):
    assert curation.quotas(size, {"a": 0.5, "b": 0.001}) == want
