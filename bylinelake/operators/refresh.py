"""Weights and coverage of raw affiliations, reasons of lost credit, metadata precedence, and merges of refreshed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Company forms, and pairs of country codes that do not contradict each other. Fixed values.
COMPANY = r"\b(?:Ltd\.?|Limited|Inc\.?|GmbH|Corp\.?|Corporation|Co\.,?|LLC|S\.A\.|AG|B\.V\.|Pte)(?=[\s,.;)]|$)"
ACADEMIC = r"(?i)univ|college|institut|school|academy|polytech|politec|faculty|facult|department|dept|laborator|hochschule"
SAME_COUNTRY = (("CN", "HK"), ("CN", "TW"), ("CN", "MO"), ("GB", "IE"))


def looks_like_company(raw: Column) -> Column:
    """A company form without an academic word."""
    return F.coalesce(raw.rlike(COMPANY) & ~raw.rlike(ACADEMIC), F.lit(False))


def country_contradiction(country: Column, named: Column) -> Column:
    """The string names countries (array of codes), but neither the institution's own nor one taken for the same."""
    pairs = F.array(*(F.lit(f"{x}{y}") for a, b in SAME_COUNTRY for x, y in ((a, b), (b, a))))
    same = F.exists(named, lambda n: (n == country) | F.array_contains(pairs, F.concat(n, country)))
    return F.coalesce((F.size(named) > 0) & (country != "") & ~same, F.lit(False))


def string_weights(slots: DataFrame) -> DataFrame:
    """(raw, occurrences, share) of raw strings in slots without institutions; a slot's part of its work is dealt evenly
    over its strings. slots: n_slots, institutions, raw_affiliations."""
    bare = slots.filter(F.size(F.coalesce("institutions", F.array())) <= 0)
    rows = bare.select((F.lit(1.0) / F.col("n_slots") / F.size("raw_affiliations")).alias("part"), F.explode("raw_affiliations").alias("raw"))
    return rows.groupBy("raw").agg(F.count("*").alias("occurrences"), F.sum("part").alias("share"))


def map_coverage(weights: DataFrame, mapping: DataFrame) -> DataFrame:
    """(status, strings, occurrences, share of occurrences in percent) by map status, `unmapped` for strings without a row.
    mapping: raw_affiliation (unique), status."""
    j = weights.join(mapping.select(F.col("raw_affiliation").alias("raw"), "status"), "raw", "left")
    g = j.groupBy(F.coalesce("status", F.lit("unmapped")).alias("status")).agg(F.count("*").alias("strings"), F.sum("occurrences").alias("occurrences"))
    total = g.agg(F.sum("occurrences").alias("__total"))  # one row
    return g.crossJoin(F.broadcast(total)).select("status", "strings", "occurrences", F.try_divide(100.0 * F.col("occurrences"), F.col("__total")).alias("percent"))


def drop_reason(institutions: Column, mapped: Column, raws: Column, has_doi: Column, tried: Column, native: Column, credit_types: tuple[str, ...] = ("education",)) -> Column:
    """Why a slot earns nothing, null if it earns: the first of nine reasons that holds.

    institutions and mapped: arrays of structs with type (as recorded) and index_type (that the index has now); mapped is
    what the raw strings resolve to, and counts only where institutions are missing.
    """
    empty = lambda a: F.size(F.coalesce(a, F.array())) <= 0
    pays = lambda a: F.coalesce(F.exists(a, lambda i: F.coalesce(i["type"].isin(*credit_types), F.lit(False))), F.lit(False))
    would = lambda i: F.coalesce(i["index_type"].isin(*credit_types), F.lit(False))
    untyped = F.exists(institutions, lambda i: (F.coalesce(i["type"], F.lit("")) == "") & would(i))
    none = F.when(~has_doi, "no_doi").when(tried, "backfill_tried").when(native, "never_backfilled").otherwise("other")
    return (
        F.when(pays(institutions), None)
        .when(~empty(institutions) & untyped, "untyped_institution")
        .when(~empty(institutions), "openalex_noncredit")
        .when(pays(mapped), None)
        .when(~empty(mapped) & F.exists(mapped, would), "retyped_row")
        .when(~empty(mapped), "raw_noncredit")
        .when(~empty(raws), "raw_unmapped")
        .otherwise(F.concat(F.lit("no_affiliation:"), none))
    )


def metadata(rows: DataFrame, overrides: DataFrame, live: DataFrame, snapshot: DataFrame) -> DataFrame:
    """(id, name, country): an override, else the live record, else the snapshot, else the row's own name.

    All have id, name, country, each id once; a live record hides the snapshot's as a whole, overrides go by field.
    """
    part = lambda df, tag: df.select("id", F.struct("name", "country").alias(tag))
    j = rows.select("id", F.col("name").alias("__own")).join(part(overrides, "o"), "id", "left").join(part(live, "l"), "id", "left").join(part(snapshot, "s"), "id", "left")
    source = F.coalesce("l", "s")
    set_ = lambda c: F.nullif(c, F.lit(""))
    return j.select("id", F.coalesce(set_(F.col("o.name")), set_(source["name"]), "__own").alias("name"), F.coalesce(set_(F.col("o.country")), set_(source["country"]), F.lit("")).alias("country"))


def carry_forward(works: DataFrame, baseline: DataFrame, same_name) -> DataFrame:
    """works with institutions and raw strings of the baseline's slots where their own are empty, for works with the same
    DOI whose names agree in number and order (same_name normalises one); no name may be empty. Both have doi (each once)
    and authorships array<struct<author_name, institutions, raw_affiliations>>."""
    old = baseline.select(F.col("doi").alias("__doi"), F.col("authorships").alias("__old")).filter("__doi IS NOT NULL")
    j = works.join(old, F.col("doi") == F.col("__doi"), "left")
    names = lambda c: F.transform(c, lambda a: F.coalesce(same_name(a["author_name"]), F.lit("")))
    aligned = F.coalesce((names(F.col("authorships")) == names(F.col("__old"))) & ~F.array_contains(names(F.col("authorships")), "") & (F.size("authorships") > 0), F.lit(False))
    full = lambda mine, theirs: F.when(F.size(F.coalesce(mine, F.array())) <= 0, theirs).otherwise(mine)
    filled = F.zip_with("authorships", "__old", lambda a, b: a.withField("institutions", full(a["institutions"], b["institutions"])).withField("raw_affiliations", full(a["raw_affiliations"], b["raw_affiliations"])))
    return j.withColumn("authorships", F.when(aligned, filled).otherwise(F.col("authorships"))).drop("__doi", "__old")


def discover(wanted: DataFrame, candidates: DataFrame) -> DataFrame:
    """(id, status, n, found): exact normalised title and byline, years at most one apart (an unknown year agrees): none is
    unresolved, one matched, more ambiguous. Both have title, names array<string>, year, normalised; found is the one id."""
    c = candidates.select("id", "title", "names", F.col("year").alias("__year")).distinct()
    c = c.groupBy("title", "names", "__year").agg(F.count("*").alias("__n"), F.min("id").alias("__found"))  # copies never meet in pairs
    usable = F.coalesce((F.col("title") != "") & (F.size("names") > 0) & ~F.array_contains("names", ""), F.lit(False))
    near = F.col("year").isNull() | F.col("__year").isNull() | (F.abs(F.col("year") - F.col("__year")) <= 1)
    hits = wanted.filter(usable).join(c, ["title", "names"]).filter(near).groupBy("id").agg(F.sum("__n").alias("n"), F.min("__found").alias("found"))
    j = wanted.select("id").join(hits, "id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    status = F.when(F.col("n") == 0, "unresolved").when(F.col("n") == 1, "matched").otherwise("ambiguous")
    return j.select("id", status.alias("status"), "n", F.when(F.col("n") == 1, F.col("found")).alias("found"))


def conflict_flags(rows: DataFrame, key: str, title: str, names: str, year: str) -> DataFrame:
    """(key, flags): of keys with two rows or more, which of title, byline and known year they disagree in."""
    g = rows.groupBy(key).agg(F.count("*").alias("n"), *(F.count_distinct(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(t) for c, t in ((title, "t"), (names, "b"))), F.count_distinct(year).alias("y"))
    flag = lambda c, name: F.when(F.col(c) > 1, name)
    return g.filter("n > 1").select(key, F.array_compact(F.array(flag("t", "title_conflict"), flag("b", "byline_conflict"), flag("y", "year_conflict"))).alias("flags"))


def editorial_candidates(works: DataFrame, hints: str, non_research: tuple[str, ...]) -> DataFrame:
    """Works that may be front matter and earn credit: two authors at most, such a type, or a title hint."""
    odd = (F.size("authorships") <= 2) | F.coalesce(F.lower("type"), F.lit("")).isin(*non_research) | F.coalesce(F.col("title").rlike(hints), F.lit(False))
    pays = F.exists("authorships", lambda a: F.coalesce(F.exists(a["institutions"], lambda i: F.coalesce(i["type"] == "education", F.lit(False))), F.lit(False)))
    return works.filter(odd & F.coalesce(pays, F.lit(False)))


def audit_outcome(credited: Column, current: Column, decision: Column, judged: Column) -> Column:
    """correct, wrong_institution, wrong_credited, missed_credit or undecidable; ids already follow aliases."""
    kind = F.lower(F.coalesce(decision, F.lit("")))
    education, other = kind.isin("education", "supported", "corrected"), kind == "noneducation"
    return (
        F.when(~education & ~other, F.when(credited, "undecidable").otherwise("correct"))
        .when(credited & other, "wrong_credited")
        .when(credited, F.when(current.eqNullSafe(judged), "correct").otherwise("wrong_institution"))
        .otherwise(F.when(education, "missed_credit").otherwise("correct"))
    )
