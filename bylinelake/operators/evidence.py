"""Evidence about works from several harvests: canonical records, authors of two versions, what may be kept, what is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import fold, norm_doi, short_id, unescape
from ..functions.names import letter_tokens
from .merge import ratio

#: Catalogue ids of authors. Fixed value.
AUTHOR_ID = r"^https?://openalex\.org/A\d+$"


def canonical(works: DataFrame) -> DataFrame:
    """Provider records (id, doi, title, publication_year, type, authorships of author{id, display_name}, institutions{id,
    display_name, country_code, type, lineage}) as works of the engine; null lists of institutions become empty ones."""
    fields = ("id", "display_name", "country_code", "type", "lineage")
    inst = lambda i: F.struct(*(i[f].alias(f) for f in fields))
    known = lambda a: F.transform(F.filter(a["institutions"], lambda i: i.isNotNull()), inst)
    bare = lambda a: F.filter(F.transform(F.array(a), lambda x: inst(F.get(x["institutions"], F.lit(0)))), lambda i: F.lit(False))
    slots = F.transform("authorships", lambda a: F.struct(a["author"]["id"].alias("author_id"), a["author"]["display_name"].alias("author_name"), F.coalesce(known(a), bare(a)).alias("institutions")))
    return works.select("id", "doi", "title", "publication_year", "type", slots.alias("authorships"))


def compatible(a: Column, b: Column) -> Column:
    """Arrays of name tokens that may name one person: the same; or the same last token and given names that agree in turn,
    where an initial stands for a name, one may omit middle names, and hyphens may divide a given name."""
    given = lambda t: F.slice(t, F.lit(1), F.greatest(F.size(t) - 1, F.lit(0)))
    n = F.least(F.size(a), F.size(b)) - 1
    pairs = F.arrays_zip(F.slice(a, F.lit(1), F.greatest(n, F.lit(0))).alias("x"), F.slice(b, F.lit(1), F.greatest(n, F.lit(0))).alias("y"))
    short = lambda p, x, y: (F.length(p[x]) == 1) & F.startswith(p[y], p[x])
    agree = F.forall(pairs, lambda p: (p["x"] == p["y"]) | short(p, "x", "y") | short(p, "y", "x"))
    longer = (n >= 1) & (F.try_element_at(a, F.lit(-1)) == F.try_element_at(b, F.lit(-1))) & ((F.array_join(given(a), "") == F.array_join(given(b), "")) | agree)
    return F.coalesce((F.size(a) > 0) & (F.size(b) > 0) & ((a == b) | longer), F.lit(False))


def author_matches(before: DataFrame, after: DataFrame) -> DataFrame:
    """(work, old, new) places of the same author in two versions of a work, where that is unique within the work: by
    catalogue id, then by equal names, then by compatible names (the only candidate on both sides).

    Both have work, at, author_id and tokens (array). Authors meet within their work and family name only.
    """
    def alone(rows: DataFrame, key: Column, place: str) -> DataFrame:
        return rows.select("work", key.alias("key"), "at").filter("key IS NOT NULL").groupBy("work", "key").agg(F.min("at").alias(place), F.count("*").alias("n")).filter("n = 1").drop("n")

    ident = F.when(F.col("author_id").rlike(AUTHOR_ID), F.col("author_id"))
    name = F.nullif(F.array_join("tokens", " "), F.lit(""))
    by = lambda key: alone(before, key, "old").join(alone(after, key, "new"), ["work", "key"]).drop("key")

    family = lambda rows, place, tokens: rows.select("work", F.try_element_at("tokens", F.lit(-1)).alias("family"), F.col("at").alias(place), F.col("tokens").alias(tokens)).filter("family IS NOT NULL")
    options = family(before, "old", "a").join(family(after, "new", "b"), ["work", "family"]).filter(compatible(F.col("a"), F.col("b"))).select("work", "old", "new")
    one = lambda place, other: options.groupBy("work", place).agg(F.min(other).alias(other), F.count("*").alias("n")).filter("n = 1").select("work", "old", "new")
    loose = one("old", "new").join(one("new", "old"), ["work", "old", "new"])

    found = by(ident)
    for more in (by(name), loose):
        rest = more.join(found.select("work", "old"), ["work", "old"], "left_anti").join(found.select("work", "new"), ["work", "new"], "left_anti")
        found = found.unionByName(rest.select(*found.columns))
    return found


def preserve(fresh: DataFrame, baseline: DataFrame, least_title: float = 0.97) -> DataFrame:
    """fresh with institutions and raw strings of the baseline where a matched author's own are empty, and `retained`, the
    number of authors that got some. An author with raw strings but no institutions keeps to that.

    Both have doi (each once), title, source, backfilled_from and authorships array<struct<author_id, author_name,
    institutions, raw_affiliations>>. Titles must agree to least_title; versions from author profiles (source
    semanticscholar, not backfilled) give and take nothing. Works without a DOI stay as they are.
    """
    def part(df: DataFrame, tag: str) -> DataFrame:
        bare = F.replace(fold(F.regexp_replace(unescape(F.coalesce("title", F.lit(""))), "<[a-zA-Z/][^>]*>", "")), F.lit(" "), F.lit(""))
        profile = F.coalesce((F.col("source") == "semanticscholar") & ~F.coalesce(F.col("backfilled_from") == "openalex", F.lit(False)), F.lit(False))
        return df.filter(~profile & norm_doi(F.col("doi")).isNotNull()).select(norm_doi(F.col("doi")).alias("work"), bare.alias(f"t_{tag}"), F.col("authorships").alias(tag))

    same = part(fresh, "now").join(part(baseline, "was"), "work").filter("t_now <> '' AND t_was <> ''")
    same = same.filter((F.col("t_now") == F.col("t_was")) | (ratio(F.col("t_now"), F.col("t_was")) >= least_title))

    def slots(tag: str) -> DataFrame:
        rows = same.select("work", F.posexplode(tag).alias("at", "s"))
        return rows.select("work", "at", F.col("s.author_id").alias("author_id"), letter_tokens(F.col("s.author_name")).alias("tokens"))

    pairs = author_matches(slots("was"), slots("now")).groupBy("work").agg(F.map_from_entries(F.collect_list(F.struct("new", "old"))).alias("__pairs"))
    given = same.join(pairs, "work").select(F.col("work").alias("__work"), F.col("was").alias("__was"), "__pairs")
    empty = lambda c: F.size(F.coalesce(c, F.array())) <= 0
    old = lambda i: F.get(F.col("__was"), F.try_element_at(F.col("__pairs"), i))
    takes = lambda a, i, f: empty(a[f]) & ~empty(old(i)[f]) & ~(empty(a["institutions"]) & ~empty(a["raw_affiliations"]))

    def merged(a: Column, i: Column) -> Column:
        out = a
        for f in ("institutions", "raw_affiliations"):
            out = out.withField(f, F.when(F.coalesce(takes(a, i, f), F.lit(False)), old(i)[f]).otherwise(a[f]))
        return out

    changed = lambda a, i: F.coalesce(takes(a, i, "institutions"), F.lit(False)) | F.coalesce(takes(a, i, "raw_affiliations"), F.lit(False))
    j = fresh.join(given, norm_doi(fresh["doi"]) == F.col("__work"), "left")
    has = F.col("__work").isNotNull()
    marks = F.transform("authorships", lambda a, i: changed(a, i).cast("int"))
    return j.withColumn("retained", F.when(has, F.aggregate(marks, F.lit(0), lambda s, x: s + x)).otherwise(0)).withColumn("authorships", F.when(has, F.transform("authorships", merged)).otherwise(F.col("authorships"))).drop("__work", "__was", "__pairs")


def hydrated(works: DataFrame, full: DataFrame, most: int = 100) -> DataFrame:
    """(id, outcome): complete (nothing to fetch), absent, id or doi differs, truncated, shorter, or hydrated. A byline is to be
    fetched if it is marked as truncated, shorter than its count, or has `most` names. Both have id, asked for as such, doi,
    authors, authors_count and truncated; full has `found`, the id that came back."""
    needs = F.coalesce(F.col("truncated"), F.lit(False)) | F.coalesce(F.col("authors") < F.col("authors_count"), F.lit(False)) | (F.col("authors") >= most)
    f = full.select("id", F.struct("found", "doi", "authors", "authors_count", "truncated").alias("__f"))
    r = F.col("__f")
    cut = F.coalesce(r["truncated"], F.lit(False)) | F.coalesce(r["authors"] < r["authors_count"], F.lit(False))
    why = (
        F.when(~needs, "complete")
        .when(r.isNull(), "absent")
        .when(~short_id(r["found"]).eqNullSafe(short_id(F.col("id"))), "id_differs")
        .when(~norm_doi(r["doi"]).eqNullSafe(norm_doi(F.col("doi"))), "doi_differs")
        .when(cut, "truncated")
        .when(r["authors"] < F.col("authors"), "shorter")
        .otherwise("hydrated")
    )
    return works.join(f, "id", "left").select("id", why.alias("outcome"))


def open_scopes(results: DataFrame, errors: DataFrame, unresolved: DataFrame) -> DataFrame:
    """(venue, year, status, reason) of scopes that a collection has not completed. Errors block and unresolved scopes replace
    what is there, unless it is complete. All have venue, year (together unique), reason; results and unresolved have status."""
    part = lambda df, tag, status: df.select("venue", "year", F.struct(status.alias("status"), F.col("reason").alias("reason")).alias(tag))
    j = part(results, "r", F.col("status")).join(part(errors, "e", F.lit("blocked")), ["venue", "year"], "full_outer")
    j = j.join(part(unresolved, "u", F.coalesce("status", F.lit("blocked"))), ["venue", "year"], "full_outer")
    done = F.coalesce(F.col("r.status") == "complete", F.lit(False))
    last = F.when(done, F.col("r")).otherwise(F.coalesce("u", "e", "r"))
    out = j.select("venue", "year", F.coalesce(last["status"], F.lit("unknown")).alias("status"), last["reason"].alias("reason")).filter("status <> 'complete'")
    return out.withColumn("reason", F.coalesce(F.nullif("reason", F.lit("")), "status"))


def pending_ids(wanted: DataFrame, asked: DataFrame, key: str) -> DataFrame:
    """Distinct non-null keys that are wanted and were not asked for."""
    return wanted.select(key).dropna().distinct().join(asked.select(key), key, "left_anti")


def missing_scopes(venues: DataFrame, cached: DataFrame, first: int, last: int) -> DataFrame:
    """(venue, year) to collect: years from the later of `first` and the venue's source_first_year up to `last`, less what is
    cached."""
    begin = F.greatest(F.lit(first), F.coalesce("source_first_year", F.lit(first)))
    years = F.when(begin <= last, F.sequence(begin, F.lit(last)))
    return venues.select("venue", F.explode(years).alias("year")).join(cached.select("venue", "year").distinct(), ["venue", "year"], "left_anti")


def with_metadata(works: DataFrame, found: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """works with the columns of `defaults` from found (id unique); unmatched works keep their own value, else the default."""
    j = works.join(found.select("id", *(F.col(c).alias(f"__{c}") for c in defaults)), "id", "left")
    own = lambda c: [F.col(c)] if c in works.columns else []
    rest = [c for c in works.columns if c not in defaults]
    return j.select(*rest, *(F.coalesce(F.col(f"__{c}"), *own(c), d).alias(c) for c, d in defaults.items()))


def facets(works: DataFrame, columns: list[str]) -> DataFrame:
    """(facet, value, n): how many works have each value of each column, in one pass (grouping sets); null is '(none)'."""
    as_text = works.select(*(F.coalesce(F.col(c).cast("string"), F.lit("(none)")).alias(c) for c in columns))
    g = as_text.groupingSets([(F.col(c),) for c in columns], *columns).agg(F.count("*").alias("n"))
    named = F.coalesce(*(F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("facet"), F.col(c).alias("value"))) for c in columns))
    return g.select(named.alias("__f"), "n").select("__f.*", "n")


def digests_differ(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """(path, problem): missing or changed files of a release, and unlisted ones. manifest: path, sha256; files: path,
    content."""
    now = files.select("path", F.sha2("content", 256).alias("__now"))
    j = manifest.select("path", F.lower("sha256").alias("__was"), F.lit(True).alias("__listed")).join(now, "path", "full_outer")
    why = F.when(F.col("__listed").isNull(), "unlisted").when(F.col("__now").isNull(), "missing").when(~F.col("__was").eqNullSafe(F.col("__now")), "changed")
    return j.select("path", why.alias("problem")).filter("problem IS NOT NULL")


def first_known(base: DataFrame, observed: DataFrame, fields: list[str], at: str) -> DataFrame:
    """(id, fields): each field from base, where it is set there, else the first set value observed, by `at`."""
    set_ = lambda c: F.nullif(F.col(c), F.lit(""))
    seen = observed.groupBy("id").agg(*(F.min_by(set_(f), F.when(set_(f).isNotNull(), F.col(at))).alias(f"__{f}") for f in fields))
    j = base.select("id", *fields).join(seen, "id", "full_outer")
    return j.select("id", *(F.coalesce(set_(f), F.col(f"__{f}")).alias(f) for f in fields))
