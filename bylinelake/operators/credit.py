"""Fractional credit: ownership of duplicate works, bylines, affiliation fallback, aliases, shares and fact tables.

A work's unit of credit is split evenly over all byline slots, and a slot's part evenly over its distinct canonical
institutions that earn credit. Parts of slots without one are lost, not handed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Work types that earn no credit. Fixed values.
NON_RESEARCH = ("editorial", "erratum", "letter", "book-review", "peer-review", "retraction", "other")

WORK_SCHEMA = (
    "id string, openalex_id string, s2_corpusid string, doi string, title string, publication_year int, type string, source string, "
    "crossref_issued_year int, referenced_works_count int, biblio struct<first_page:string,last_page:string>, "
    "authorships array<struct<author_id:string,author_name:string,institutions:array<struct<id:string,display_name:string,country_code:string,type:string,lineage:array<string>>>,raw_affiliations:array<string>,affiliation_source:string>>"
)


def first_owner(rows: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key in the given order; the others are replays. Partial minima, so a hot key is no hot task."""
    sorts = F.struct(*(c if isinstance(c, Column) else F.col(c) for c in order))
    by = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    first = rows.groupBy(*by).agg(F.min_by(F.struct(*(F.col(c) for c in rows.columns)), sorts).alias("__row"))
    return first.select("__row.*")


def is_research(kind: Column, non_research: tuple[str, ...] = NON_RESEARCH) -> Column:
    """Works of unknown type count as research."""
    return ~F.coalesce(F.lower(kind), F.lit("")).isin(*non_research)


def owned_research(works: DataFrame, keys: list[str], order: list, type_col: str, venue_excluded: DataFrame | None = None, excluded: DataFrame | None = None, on: list[str] | None = None, non_research: tuple[str, ...] = NON_RESEARCH) -> DataFrame:
    """Venue exclusions, then ownership, then type, then global exclusions: in this order, so that an editorial that comes
    first keeps a later copy from earning credit."""
    rows = works.join(venue_excluded, on or keys, "left_anti") if venue_excluded is not None else works
    rows = first_owner(rows, keys, order).filter(is_research(F.col(type_col), non_research))
    return rows.join(excluded, keys[-1], "left_anti") if excluded is not None else rows


def bylines(works: DataFrame) -> DataFrame:
    """One row a byline slot of nested works: all work columns, slot, n_slots and the author's fields."""
    rest = [c for c in works.columns if c != "authorships"]
    return works.withColumn("n_slots", F.size("authorships")).select(*rest, "n_slots", F.posexplode("authorships").alias("slot", "a")).select(*rest, "n_slots", "slot", "a.*")


def with_fallback(slots: DataFrame, mapping: DataFrame) -> DataFrame:
    """Institutions of each slot; only where there are none, those its raw strings map to (status auto or manual), each
    once in order of first appearance. mapping: raw_affiliation, status, institution_id, institution_name, institution_type.
    Slots are told apart by (work_uid, slot)."""
    usable = mapping.filter(F.col("status").isin("auto", "manual") & (F.coalesce("institution_id", F.lit("")) != ""))
    usable = usable.select(F.col("raw_affiliation").alias("raw"), F.struct(F.col("institution_id").alias("id"), F.col("institution_name").alias("display_name"), F.col("institution_type").alias("type")).alias("hit"))
    bare = F.size(F.coalesce("institutions", F.array())) == 0
    raws = slots.filter(bare).select("work_uid", "slot", F.posexplode("raw_affiliations").alias("pos", "raw"))
    hits = first_owner(raws.join(usable, "raw").select("work_uid", "slot", "pos", "hit"), ["work_uid", "slot", "hit.id"], ["pos"])
    lists = hits.groupBy("work_uid", "slot").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "hit"))), lambda x: x["hit"]).alias("mapped"))
    own = F.transform("institutions", lambda x: F.struct(x["id"].alias("id"), x["display_name"].alias("display_name"), x["type"].alias("type")))
    return slots.join(lists, ["work_uid", "slot"], "left").withColumn("credited", F.when(bare, F.col("mapped")).otherwise(own)).drop("mapped")


def alias_closure(aliases: DataFrame) -> DataFrame:
    """(duplicate_id, canonical_id, canonical_name): chains followed to their end, with the last label on the way.

    Each round doubles the length of the chains followed, so n aliases take log2(n) rounds; what is open after them goes in
    a circle, which is an error. A round is kept in memory and on disk, so that plans do not grow with the rounds.
    """
    now = aliases.select("duplicate_id", "canonical_id", F.nullif(F.col("canonical_name"), F.lit("")).alias("canonical_name")).persist()
    for _ in range(now.count().bit_length() + 1):
        nxt = now.select(F.col("duplicate_id").alias("canonical_id"), F.col("canonical_id").alias("__to"), F.col("canonical_name").alias("__name"))
        both = now.join(nxt, "canonical_id", "left")
        then = both.select("duplicate_id", F.coalesce("__to", "canonical_id").alias("canonical_id"), F.coalesce("__name", "canonical_name").alias("canonical_name"), F.col("__to").isNotNull().alias("__open")).persist()
        ends = not then.filter("__open").limit(1).count()
        now.unpersist()
        now = then.drop("__open")
        if ends:
            return now
    raise ValueError("alias cycle")


def canonical(rows: DataFrame, closure: DataFrame, col: str) -> DataFrame:
    """rows with col replaced by its canonical id where it has one."""
    c = closure.select(F.col("duplicate_id").alias(col), F.col("canonical_id").alias("__canonical"))
    return rows.join(c, col, "left").withColumn(col, F.coalesce("__canonical", col)).drop("__canonical")


def shares(slots: DataFrame, work: list[str], slot: list[str], institution: str, n_slots: str = "n_slots") -> DataFrame:
    """Rows (slot, institution), each once, with its share of the work; rows without an institution go."""
    rows = slots.filter(F.col(institution).isNotNull()).dropDuplicates([*work, *slot, institution])
    per_slot = F.count("*").over(Window.partitionBy(*work, *slot))
    return rows.withColumn("share", F.lit(1.0) / F.col(n_slots) / per_slot)


def institution_facts(credit: DataFrame, by: list[str], work: list[str]) -> DataFrame:
    """pub_count (distinct works) and adjusted_count (credit) by the given columns."""
    once = credit.groupBy(*by, *work).agg(F.sum("share").alias("share"))  # no shuffle where rows are partitioned by work
    return once.groupBy(*by).agg(F.count("*").alias("pub_count"), F.sum("share").alias("adjusted_count"))


def author_facts(credit: DataFrame, by: list[str]) -> DataFrame:
    return credit.groupBy(*by).agg(F.sum("share").alias("adjusted_count"))


def last_name(rows: DataFrame, key: str, name: str, order: list[str]) -> DataFrame:
    """The name seen last for each key, by a total order."""
    return rows.groupBy(key).agg(F.max_by(name, F.struct(*order)).alias(name))


def quarantine(works: DataFrame, rules: list[tuple[Column, str]]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with the reason of the first rule that holds)."""
    reason = F.lit(None).cast("string")
    for holds, why in reversed(rules):
        reason = F.when(holds, why).otherwise(reason)
    marked = works.withColumn("reason", reason)
    return marked.filter("reason IS NULL").drop("reason"), marked.filter("reason IS NOT NULL")


def aggregate_works(works: DataFrame, venue_area: DataFrame, mapping: DataFrame, aliases: DataFrame, venue_excluded: DataFrame | None = None, excluded: DataFrame | None = None, credit_types: tuple[str, ...] = ("education",)) -> dict[str, DataFrame]:
    """Nested works (WORK_SCHEMA with venue, year_dir, line_no) to the three fact tables and the audit counts.

    Unknown venues are left out; a venue under two areas belongs to the last one listed (venue_area: venue, area, position).
    """
    from ..functions.identity import institution_id, record_key

    area = venue_area.groupBy("venue").agg(F.max_by("area", "position").alias("area"))
    keyed = works.join(area, "venue").withColumn("record_key", record_key(F.col("doi"), F.col("id"), F.col("openalex_id"), F.col("s2_corpusid"), F.col("title"), F.col("venue"), F.col("year_dir")))
    kept = owned_research(keyed, ["venue", "record_key"], ["year_dir", "line_no"], "type", venue_excluded, excluded, ["venue", "record_key"])
    kept = kept.withColumn("work_uid", F.concat_ws("|", "venue", "record_key"))
    slots = with_fallback(bylines(kept), mapping)
    one = F.explode_outer(F.filter("credited", lambda x: x["type"].isin(*credit_types)))
    flat = slots.select("work_uid", "venue", "area", F.col("publication_year").alias("year"), "year_dir", "line_no", "n_slots", "slot", "author_id", "author_name", one.alias("i"))
    flat = flat.withColumn("institution_id", institution_id(F.col("i.id"))).withColumn("institution_name", F.col("i.display_name")).drop("i")
    closure = alias_closure(aliases)
    closure = closure.select(institution_id(F.col("duplicate_id")).alias("duplicate_id"), institution_id(F.col("canonical_id")).alias("canonical_id"), "canonical_name")
    credit = shares(canonical(flat, closure, "institution_id"), ["work_uid"], ["slot"], "institution_id")
    return {
        "institution_area_year": institution_facts(credit, ["institution_id", "area", "year"], ["work_uid"]),
        "institution_venue_year": institution_facts(credit, ["institution_id", "area", "venue", "year"], ["work_uid"]),
        "author": author_facts(credit, ["author_id", "institution_id", "area", "year"]),
        "institution_names": last_name(flat.filter("institution_id IS NOT NULL"), "institution_id", "institution_name", ["venue", "year_dir", "line_no", "slot"]),
        "audit": slots.agg(F.count_distinct("work_uid").alias("works"), F.count("*").alias("slots"), F.count_if(F.size(F.coalesce("credited", F.array())) == 0).alias("dropped_slots")),
    }


def array_shares(slots: DataFrame, institutions: str, n_slots: str, name: str = "institution") -> DataFrame:
    """Like shares(), where each slot is a row that holds its institutions as an array: no shuffle is needed."""
    rows = slots.withColumn("__all", F.array_distinct(F.filter(F.coalesce(institutions, F.array()), lambda x: x.isNotNull()))).drop(institutions)
    return rows.withColumn("share", F.lit(1.0) / F.col(n_slots) / F.size("__all")).withColumn(name, F.explode("__all")).drop("__all")
