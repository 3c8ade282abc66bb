"""Identity functions, parsers, candidates, merges and checks on small inputs."""

import json

import pytest
from pyspark.sql import functions as F

from bylinelake.functions import identity as idn
from bylinelake.operators import merge, quality, resolve
from bylinelake.sources import files, html, text
from bylinelake.streaming import ingest


def one(spark, col, **values):
    schema = ", ".join(f"{k} {v[1]}" for k, v in values.items())
    return spark.createDataFrame([tuple(v[0] for v in values.values())], schema).select(col.alias("x")).first()["x"]


@pytest.mark.parametrize(("raw", "want"), [(" HTTPS://dx.doi.org/10.1/AB ", "10.1/ab"), ("10.1/x", "10.1/x"), ("", None), (None, None)])
def test_norm_doi(spark, raw, want):
    assert one(spark, idn.norm_doi(F.col("d")), d=(raw, "string")) == want


@pytest.mark.parametrize(("raw", "want"), [("I12", "https://openalex.org/I12"), ("http://openalex.org/I1//", "https://openalex.org/I1"), (None, None)])
def test_institution_id(spark, raw, want):
    assert one(spark, idn.institution_id(F.col("d")), d=(raw, "string")) == want


def test_fold_and_words(spark):
    assert one(spark, idn.fold(F.col("d")), d=("École  d’Été ﬁn", "string")) == "ecole d ete fin"
    assert one(spark, idn.unescape(F.col("d")), d=("a &amp;amp; b", "string")) == "a & b"
    assert one(spark, idn.institution_words(F.col("d")), d=("The Univ. of A & B Labs", "string")) == "university of a and b laboratories"
    assert one(spark, idn.title_key(F.col("d")), d=("On <i>X</i>: a Test!", "string")) == "on-x-a-test"
    assert one(spark, idn.family_in_name(F.col("d"), F.lit("Jan van der Berg")), d=("van der", "string")) is True


def test_program_authors_and_years(spark):
    got = one(spark, idn.parse_program_authors(F.col("d")), d=("Ann Lee, MIT; and CSAIL; Bo Xu, ETH", "string"))
    assert [(r["name"], r["affiliation"]) for r in got] == [("Ann Lee", "MIT; and CSAIL"), ("Bo Xu", "ETH")]
    assert one(spark, idn.year_runs(F.col("d")), d=([2020, 2016, 2017, 2018, 2017], "array<int>")) == "2016–2018, 2020"
    assert one(spark, idn.is_biennial(F.col("d")), d=([2016, 2018, 2020], "array<int>")) is True
    assert one(spark, idn.is_biennial(F.col("d")), d=([2016, 2018], "array<int>")) is False
    assert one(spark, idn.nice_ceiling(F.col("d")), d=(33.0, "double")) == 50.0
    assert one(spark, idn.csv_field(F.col("d")), d=('a "b", c', "string")) == '"a ""b"", c"'


def test_bibtex_and_latex():
    entries = text.parse_bibtex('@comment{x} @inproceedings{k1, title = {A {Nested {T}itle}}, author = "Doe, Jane and {The A and B Group} and M{\\"u}ller, Jr, Kai", year = 2024}')
    assert entries[0]["key"] == "k1" and text.latex_to_text(entries[0]["title"]) == "A Nested Title" and entries[0]["year"] == "2024"
    assert text.bib_authors(entries[0]["author"]) == ["Jane Doe", "The A and B Group", "Kai Müller Jr"]
    assert text.latex_to_text(r"Stra\ss e \'{e} \v{c} \o{} \& {X}") == "Straße é č ø & X"


def test_listing(spark):
    page = '<ul><li><p class="title">A &amp; B</p><span class="authors">X Y, Z</span><a href="/1">pdf</a></li><li>none</li></ul>'
    got = html.listing(spark.createDataFrame([("v", page), ("w", None)], "venue string, html string"), "html", ["venue"]).collect()
    assert [(r["venue"], r["position"], r["title"], r["authors"], r["link"]) for r in got] == [("v", 0, "A & B", ["X Y", "Z"], "/1")]


def test_candidates_put_departments_last(spark):
    got = one(spark, resolve.candidates(F.col("d"), 4), d=("Dept. of Physics, Univ Alpha (UA), Berlin", "string"))
    assert "Univ Alpha" in " ".join(got) and got[-1] != "Dept. of Physics" or "Dept" in got[-1]
    assert not got[0].startswith("Dept")


def test_candidates_clean_up(spark):
    got = one(spark, resolve.candidates(F.col("d"), ignored=("italy",)), d=("Dept. of X, Acme Labs Inc., 00100, Italy (AL)", "string"))
    assert got == ["AL", "Dept. of X, Acme Labs", "Acme Labs", "Dept. of X"]
    assert one(spark, resolve.candidates(F.col("d")), d=("", "string")) == []
    assert one(spark, resolve.candidates(F.col("d")), d=(None, "string")) is None


def test_resolve_tiers(spark):
    texts = ["Stanford", "Tianjin", "Lab Y (KTH)", "KTH", "Royal Institute of Technology", "University of California", "Oslo", "Dept. of X, Oslo University", None, ""]
    raws = spark.createDataFrame([(t,) for t in [*texts, "Oslo"]], "raw string")
    names = [(1, "Stanford University", ["SU"]), (2, "KTH Royal Institute of Technology", ["KTH"]), (3, None, None), (4, "Tinbergen Institute", ["TI"]), (5, "Southern California University of Health Sciences", None), (6, "University Oslo", None), (7, "Oslo", None), (8, "Oslo", None)]
    names = spark.createDataFrame(names, "id int, name string, acronyms array<string>")
    got = {r["raw"]: (r["id"], round(r["score"], 4), r["matched_via"]) for r in resolve.resolve_tiers(raws, names, "raw").collect()}
    assert got == {
        "Stanford": (1, round(0.72 + 0.25 * 8 / 19, 4), "prefix"),
        "Lab Y (KTH)": (2, 1.0, "acronym"),
        "KTH": (2, 1.0, "acronym"),
        "Royal Institute of Technology": (2, round(0.72 + 0.25 * 3 / 4, 4), "tokens"),
        "Oslo": (7, 1.0, "exact"),
        "Dept. of X, Oslo University": (6, 0.97, "tokens"),
    }
    assert not resolve.resolve_tiers(raws.limit(0), names, "raw").count() and not resolve.resolve_tiers(raws, names.limit(0).drop("acronyms"), "raw").count()


def test_guard_and_replay(spark):
    rows = spark.createDataFrame([("a", "auto", 1), ("b", "auto", 2), ("c", "review", 3)], "raw string, status string, institution_id int")
    out = {r["raw"]: (r["status"], r["institution_id"], r["guard"]) for r in resolve.guard(rows, F.col("raw") == "b", F.lit(True), F.col("raw") == "a", F.when(F.col("raw") == "a", 9)).collect()}
    assert out == {"a": ("auto", 9, "namesake"), "b": ("review", 2, "company"), "c": ("review", 3, None)}
    ledger = spark.createDataFrame([("a", 1, 7), ("a", 2, 8), ("d", 1, 5)], "raw string, at int, institution_id int")
    new = {r["raw"]: (r["status"], r["institution_id"]) for r in resolve.replay(rows, ledger, "raw", "at").collect()}
    assert new == {"a": ("manual", 8), "b": ("auto", 2), "c": ("review", 3), "d": ("manual", 5)}


def test_bylines(spark):
    arr = "array<string>"
    outcome = lambda a, b: one(spark, merge.byline_outcome(F.col("a"), F.col("b")), a=(a, arr), b=(b, arr))
    assert [outcome(["x", "y"], b) for b in (["x", "y"], ["x", "y", "z"], ["x"], ["y", "x"], ["p", "q"])] == ["exact", "short", "long", "reordered", "different"]
    assert outcome(["a", "b", "c"], ["a", "b", "z"]) == "names_differ"
    assert one(spark, merge.multiset_overlap(F.col("a"), F.col("b")), a=(["x", "x", "y"], arr), b=(["x", "y", "y"], arr)) == 2
    assert [tuple(r) for r in one(spark, merge.align(F.col("a"), F.col("b")), a=(["a", "b", "c"], arr), b=(["b", "c", "d"], arr))] == [(1, 0), (2, 1)]
    fill = merge.positional_fill(F.col("a"), F.col("b"), lambda x, y: (x == "") | (x == y), lambda x: x == "")
    assert one(spark, fill, a=(["p", ""], arr), b=(["p", "q"], arr)) == ["p", "q"]
    assert one(spark, fill, a=(["p", ""], arr), b=(["z", "q"], arr)) == ["p", ""]


def test_unique_matches_and_cascade(spark):
    left = spark.createDataFrame([(1, 1, "i1", "n"), (1, 2, None, "n"), (1, 3, None, "m")], "p int, l int, i string, n string")
    right = spark.createDataFrame([(1, 1, "i1", "q"), (1, 2, None, "n"), (1, 3, None, "k")], "p int, r int, i string, n string")
    got = {(r["l"], r["r"], r["stage"]) for r in merge.unique_matches(left, right, "l", "r", [["i"], ["n"]], ["p"]).collect()}
    assert got == {(1, 1, 0), (2, 2, 1)}


def test_checks(spark):
    rows = spark.createDataFrame([("v", y, n) for y, n in ((2016, 100), (2017, 100), (2018, 100), (2019, 300), (2020, 100), (2021, 40))], "k string, year int, n int")
    assert {(r["year"], r["kind"]) for r in quality.local_outliers(rows, "k", "year", "n").collect()} == {(2019, "spike"), (2021, "dip")}
    gaps = spark.createDataFrame([("v", 2016), ("v", 2018)], "k string, y int")
    assert [r["y"] for r in quality.missing_years(gaps, "k", "y").collect()] == [2017]
    low, high = quality.wilson(F.lit(5), F.lit(10))
    assert [round(x, 3) for x in spark.range(1).select(low, high).first()] == [0.237, 0.763]
    with pytest.raises(Exception, match="no rows wanted"):
        quality.require(rows, F.col("n") > 50, "no rows wanted").collect()
    drops = spark.createDataFrame([("v", 2016, 5.0), ("v", 2017, 6.0), ("v", 2018, 0.5), ("v", 2019, 3.0)], "k string, y int, n double")
    assert [r["y"] for r in quality.cliffs(drops, "k", "y", "n").collect()] == [2018]


def test_weighted_sample_follows_weights(spark):
    rows = spark.createDataFrame([(1, 1.0), (2, 9.0), (3, 0.0)], "k long, w double")
    got = {r["k"]: r["count"] for r in merge.weighted_sample(rows, "k", "w", 2000, 1).groupBy("k").count().collect()}
    assert sum(got.values()) == 2000 and 3 not in got and 1650 < got[2] < 1950


def test_works_tree_and_ingest(spark, tmp_path):
    for venue, year, ids in (("v", "2020", ("W1", "W1", "W2")), ("w", "2021", ("W3",)), ("w", "notes", ("W4",))):
        p = tmp_path / "cache" / venue / year
        p.mkdir(parents=True)
        p.joinpath("works.jsonl").write_text("".join(json.dumps({"id": i, "title": "a b", "publication_year": 2020, "authorships": []}, ensure_ascii=False) + "\n" for i in ids))
    got = files.read_works(spark, f"{tmp_path}/cache").collect()
    assert sorted((r["venue"], r["year_dir"], r["id"]) for r in got) == [("v", 2020, "W1"), ("v", 2020, "W1"), ("v", 2020, "W2"), ("w", 2021, "W3")]
    stream = tmp_path / "in" / "venue=v" / "year_dir=2020"
    stream.mkdir(parents=True)
    for name, ids in (("a", ("W1", "W1", "W2")), ("b", ("W2", "W3"))):
        stream.joinpath(f"{name}.jsonl").write_text("".join(json.dumps({"id": i}) + "\n" for i in ids))
        ingest.ingest_works(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/cp")
    assert sorted(r["id"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["W1", "W2", "W3"]
    (tmp_path / "cache" / "v" / "2020" / "works.jsonl").write_text("version https://git-lfs.github.com/spec/v1\n")
    with pytest.raises(ValueError, match="pointer"):
        files.read_works(spark, f"{tmp_path}/cache")


def test_replace_and_inventory(spark, tmp_path):
    path = f"{tmp_path}/t"
    stamp = files.replace_path(spark, spark.range(3), path)
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(RuntimeError, match="another writer"):
        files.replace_path(spark, spark.range(1), path, stamp - 1)
    now = files.inventory(spark, f"{path}/*.parquet")
    assert files.changed_files(now, now).count() == 0
    f = now.withColumn("venue", F.lit("v"))
    assert ingest.stale_partitions(ingest.fingerprints(f, "venue", "a"), ingest.fingerprints(f, "venue", "b"), "venue").count() == 1


def test_biology_dialect(spark):
    from bylinelake.operators import biology

    rows = [("article", "10.1/x", "science", 0, "1", "5"), ("article", "10.1/x", "science", 5, "e12", "e12"), ("article", "10.1/x", "science", 5, "3", "4"), ("note", "d", "x", 9, "1", "9"), ("Note", "d", "x", 9, "1", "9"), ("article", "10.1038/d41586", "nature", 50, "1", "9"), ("article", "d", "cell", 3, "7", "7"), ("article", "d", "cell", 3, "7", "7.e1"), (None, None, "y", None, None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, k string, d string, v string, r int, a string, b string")
    got = df.select("i", biology.research_article(*(F.col(c) for c in "kdvrab")).alias("x")).orderBy("i").collect()
    assert [r["x"] for r in got] == [False, True, False, False, True, False, False, True, True]
    inst = "institutions array<struct<id:string,name:string,type:string,country:string>>"
    slots = spark.createDataFrame([(1, "v", 2020, 2, 0, [("H", "Hosp", "healthcare", "US"), ("C", "Co", "company", "US")]), (1, "v", 2020, 2, 1, [("U", "Uni", "education", "US")]), (2, "z", 2020, 1, 0, [("U", "Uni", "education", "US")])], f"work int, venue string, year int, n_slots int, slot int, {inst}")
    areas = spark.createDataFrame([("v", "x", 0), ("v", "y", 1)], "venue string, area string, position int")
    rollup = spark.createDataFrame([("H", "U", "Uni")], "child string, parent string, parent_name string")
    out = biology.credit(slots, areas, rollup)
    assert sorted(map(tuple, out["area"].collect())) == [("U", "elite_bio", 2020, 1, 1.0), ("U", "x", 2020, 2, 1.0), ("U", "y", 2020, 2, 1.0)]
    assert sorted(map(tuple, out["venue"].collect())) == [("U", "elite_bio", "z", 2020, 1, 1.0), ("U", "x", "v", 2020, 2, 1.0)]
    assert {r["id"] for r in biology.credit(slots, areas, rollup, edu_only=False)["area"].collect()} == {"U", "C"}


def test_title_prefixes_and_enrichment(spark):
    a = spark.createDataFrame([(1, "A very long title about circuits and systems for people"), (2, "Short")], "l int, title string")
    b = spark.createDataFrame([(7, "Session 3: A very long title about circuits and systems of others"), (8, "short"), (9, "Shorter")], "r int, title string")
    assert sorted((x["l"], x["r"]) for x in merge.title_prefix_matches(a, b, "l", "r", "title").collect()) == [(1, 7), (2, 8)]
    t = "k int, byline array<struct<name:string,aff:string>>, coverage double"
    base = spark.createDataFrame([(1, [("Ann", None)], 0.0), (2, [("Bo", "x")], 1.0)], t)
    fresh = spark.createDataFrame([(1, [("ANN", "MIT")], 1.0), (1, [("Zed", "q")], 1.0), (2, [("Bo", None)], 0.0)], t)
    assert {r["k"]: r["byline"][0]["aff"] for r in merge.aligned_enrichment(base, fresh, "k", "byline", "coverage").collect()} == {1: "MIT", 2: "x"}
    assert one(spark, merge.container_matches(F.col("a"), F.lit("Proc. of X")), a=("Proc of X, Volume 3", "string")) is True
    assert one(spark, merge.strings_agree(F.col("a"), F.lit("University of Leeds, UK")), a=("Leeds Univ", "string")) is True


def test_article_rule_branches(spark):
    from bylinelake.operators import biology

    rows = [  # kind, doi, venue, references, first, last, article
        ("article", "d", "science", None, "10", "12", False), ("article", "d", "science", None, "10", "13", True), ("article", "d", "science", 10, "10", "11", True),
        ("article", "10.1126/science.x", "y", 0, None, None, False), ("article", "d", "science", 5, "9", "e9", True), ("article", "d", "science", None, None, None, True),
        ("article", "10.1016/J.CELL.x", "y", 4, "7", "7", False), ("article", "d", "cell", None, "7", "7", False), ("article", "d", "cell", 3, None, None, True),
        ("article", "d", "cell", 3, "7.e1", "7.e1", True), ("peer-review", "d", "y", None, None, None, True), ("other", "d", "y", None, None, None, True), (None, "https://doi.org/10.1038/d1", "y", 9, "1", "9", False),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, k string, d string, v string, r int, a string, b string, x boolean")
    got = df.select("i", "x", biology.research_article(*(F.col(c) for c in "kdvrab")).alias("y")).collect()
    assert [r["i"] for r in got if r["x"] != r["y"]] == []


def test_alias_cycles_of_any_length(spark):
    from bylinelake.operators import credit

    make = lambda pairs: spark.createDataFrame([(a, b, "") for a, b in pairs], "duplicate_id string, canonical_id string, canonical_name string")
    for n in (1, 2, 3, 5):
        with pytest.raises(ValueError, match="alias cycle"):
            credit.alias_closure(make([(f"c{i}", f"c{(i + 1) % n}") for i in range(n)] + [("x", "y")]))
    long = credit.alias_closure(make([(f"a{i}", f"a{i + 1}") for i in range(37)])).collect()
    assert {r["canonical_id"] for r in long} == {"a37"} and len(long) == 37
    assert credit.alias_closure(make([("x", "y")]).limit(0)).count() == 0


def test_group_and_garbled_names(spark):
    from bylinelake.functions import identity

    names = ["The ATLAS Collaboration", "the big sky survey", "Project Manhattan", "A Study Group", "(anonymous)", "Steam Engine", "Ann Lee", "", None, "Ã¼ber", "caf&eacute;", "12 34", "Ω Ω", "x\x01y"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string").select("i", identity.is_group_name(F.col("n")).alias("g"), identity.is_garbled(F.col("n")).alias("b")).orderBy("i").collect()
    assert [r["i"] for r in df if r["g"]] == [0, 1, 3, 4]
    assert [r["i"] for r in df if r["b"]] == [9, 10, 11, 13]


def test_local_outliers_need_neighbours_and_size(spark):
    of = lambda pairs, **k: {(r["year"], r["kind"]) for r in quality.local_outliers(spark.createDataFrame([("v", y, n) for y, n in pairs], "k string, year int, n int"), "k", "year", "n", **k).collect()}
    assert of([(2016, 100), (2017, 100), (2018, 900)]) == set()  # two neighbours only
    assert of([(y, 4) for y in range(2010, 2016)] + [(2016, 90)]) == set()  # a median under 20
    assert of([(2010, 100), (2011, 100), (2012, 100), (2015, 400), (2019, 100)]) == {(2015, "spike")}  # beside is the next present year
    done = [(y, 100) for y in range(2015, 2021)]
    assert of([*done, (2021, 30)], last=2020) == set() and of([*done, (2021, 400)], last=2020) == {(2021, "spike")}


def test_search_rules(spark):
    from bylinelake.operators import ranking as rk

    n = spark.createDataFrame([("Texas A&M University",), ("University of Washington",), ("Uwajima University",), ("Seattle Pacific",)], "name string")
    got = lambda q: {r["name"]: r["tier"] for r in rk.search(n, q, aliases=rk.ABBREVIATIONS).collect()}
    assert got("a&m") == {"Texas A&M University": 2}
    assert got("uw") == {"University of Washington": 0}
    assert got("  ") == {r["name"]: 0 for r in n.collect()}
    assert got("tam") == {"Texas A&M University": 3} and got("jima") == {"Uwajima University": 4}


def test_lines_and_replacement(spark, tmp_path):
    lines = spark.createDataFrame([(2, "b,2"), (1, "a,1")], "rank int, line string")
    files.write_lines(lines, "line", f"{tmp_path}/out", "name,n", ["rank"])
    assert b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*"))) == b"name,n\r\na,1\r\nb,2\r\n"
    path = f"{tmp_path}/t"
    files.replace_path(spark, spark.range(3), path)
    files.replace_path(spark, spark.range(5), path)
    assert spark.read.parquet(path).count() == 5 and [p.name for p in tmp_path.iterdir() if p.name.startswith("t-")] == []
