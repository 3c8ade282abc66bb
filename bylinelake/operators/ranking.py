"""Rankings over fact tables: geometric-mean scores, ranks with tolerance, history, movement, comparison, search."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from urllib.parse import parse_qs, urlencode

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tolerant_rank(rows: DataFrame, score: str, ties: list[Column | str], by: list[str] | None = None, relative: float | None = 1e-9, absolute: float | None = None, prefix: str = "") -> DataFrame:
    """Competition rank by score, highest first; a row ties with the row above if their scores differ by no more than the
    tolerance, so that chains of small gaps share a rank. Adds rank and tied."""
    by = by or []
    order = [F.desc(score), *ties]
    w = Window.partitionBy(*by).orderBy(*order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s, above, below = F.col(score), F.lag(score).over(w), F.lead(score).over(w)

    def same(a: Column, b: Column) -> Column:
        limit = F.lit(absolute) if absolute is not None else relative * F.greatest(F.lit(1.0), F.abs(b))
        return F.coalesce(F.abs(a - b) <= limit, F.lit(False))

    out = rows.withColumn("__pos", F.row_number().over(w)).withColumn("__up", same(above, s)).withColumn("__down", same(s, below))
    out = out.withColumn(f"{prefix}rank", F.max(F.when(~F.col("__up"), F.col("__pos"))).over(run)).withColumn(f"{prefix}tied", F.col("__up") | F.col("__down"))
    return out.drop("__pos", "__up", "__down")


def in_region(country: Column, continent: Column, region: str) -> Column:
    """world, a continent, or a country; a blank country is in the world only."""
    if region == "world":
        return F.lit(True)
    return (F.coalesce(country, F.lit("")) != "") & ((F.upper(continent) == region.upper()) | (F.upper(country) == region.upper()))


def of_type(kind: Column, wanted: str) -> Column:
    """all, education (blank counts), research (any other that is not blank), or one type."""
    k = F.coalesce(kind, F.lit(""))
    if wanted == "all":
        return F.lit(True)
    if wanted == "education":
        return k.isin("", "education")
    return ~k.isin("", "education") if wanted == "research" else k == wanted


@dataclass(frozen=True)
class Selection:
    first: int
    last: int
    areas: tuple[str, ...]
    region: str = "world"
    kind: str = "all"
    disabled_venues: tuple[str, ...] = ()
    extra: dict = field(default_factory=dict)


def area_scores(facts: DataFrame, selection: Selection, by: list[str] | None = None) -> DataFrame:
    """Credit and papers by institution and area within the years; facts: institution, area, year, pub_count, adjusted_count."""
    rows = facts.filter(F.col("year").between(selection.first, selection.last) & F.col("area").isin(*selection.areas))
    return rows.groupBy("institution", "area", *(by or [])).agg(F.sum("adjusted_count").alias("adj"), F.sum("pub_count").alias("pubs"))


def geometric_scores(per_area: DataFrame, k: int, by: list[str] | None = None) -> DataFrame:
    """expm1 of the mean log1p credit over k selected areas, those without credit included; nothing for no credit at all."""
    out = per_area.groupBy("institution", *(by or [])).agg((F.expm1(F.sum(F.log1p("adj")) / k)).alias("score"), F.sum("adj").alias("adj_total"), F.sum("pubs").alias("pub_total"), F.count_if(F.col("adj") > 0).alias("active"))
    return out.filter("adj_total > 0")


def rank(facts: DataFrame, institutions: DataFrame, selection: Selection, digits: int | None = None, relative: float = 1e-9) -> DataFrame:
    """institutions: institution, name, country, continent, type. Region and type hold for whole institutions, so they are
    applied before the facts are summed."""
    kept = institutions.filter(in_region(F.col("country"), F.col("continent"), selection.region) & of_type(F.col("type"), selection.kind))
    scored = geometric_scores(area_scores(facts.join(kept.select("institution"), "institution", "left_semi"), selection), len(selection.areas))
    if digits is not None:
        scored = scored.withColumn("score", F.round("score", digits))
    return tolerant_rank(scored.join(kept, "institution"), "score", ["name", "institution"], relative=relative)


def enabled_facts(area_facts: DataFrame, venue_facts: DataFrame, selection: Selection) -> DataFrame:
    """Area facts, or with disabled venues the sums of the enabled ones; areas left without a venue drop out."""
    if not selection.disabled_venues:
        return area_facts
    rows = venue_facts.filter(~F.col("venue").isin(*selection.disabled_venues))
    return rows.groupBy("institution", "area", "year").agg(F.sum("pub_count").alias("pub_count"), F.sum("adjusted_count").alias("adjusted_count"))


def area_ranks(per_area: DataFrame, ranked: DataFrame) -> DataFrame:
    """Ranks by area among ranked institutions with credit there; absolute tolerance."""
    rows = per_area.join(ranked.select("institution"), "institution", "left_semi").filter("adj > 0")
    return tolerant_rank(rows, "adj", ["institution"], ["area"], absolute=1e-9)


def annual_ranks(facts: DataFrame, selection: Selection, digits: int | None = None) -> DataFrame:
    """Each year ranked for itself, with the same number of areas: one job, partitioned by year."""
    scored = geometric_scores(area_scores(facts, selection, ["year"]), len(selection.areas), ["year"])
    if digits is not None:
        scored = scored.withColumn("score", F.round("score", digits))
    return tolerant_rank(scored, "score", ["institution"], ["year"])


def history(ranks: DataFrame, first: int, last: int) -> DataFrame:
    """(institution, year, rank) for each year; null where it was not ranked."""
    grid = ranks.select("institution").distinct().select("institution", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("year"))
    return grid.join(ranks.select("institution", "year", "rank"), ["institution", "year"], "left")


def net_movement(hist: DataFrame, last_complete: int) -> DataFrame:
    """Rank of the first year less that of the last complete one; null if either is missing."""
    rows = hist.filter(F.col("year") <= last_complete)
    return rows.groupBy("institution").agg((F.min_by("rank", "year") - F.max_by("rank", "year")).alias("movement"))


def trend_sort(rows: DataFrame, mode: str) -> DataFrame:
    """Position by improvement or decline (unknown last), rank deciding ties; or by rank."""
    first = {"improved": [F.desc_nulls_last("movement")], "declined": [F.asc_nulls_last("movement")]}.get(mode, [])
    return rows.withColumn("position", F.row_number().over(Window.orderBy(*first, "rank", "institution")))


def compare(facts: DataFrame, slots: DataFrame, first: int, last: int) -> DataFrame:
    """Credit by area, year and slot (slots: institution, slot), with sums over areas (area null) and over all (both null)."""
    rows = facts.filter(F.col("year").between(first, last)).join(F.broadcast(slots), "institution")
    return rows.rollup("slot", "year", "area").agg(F.sum("adjusted_count").alias("adj"), F.sum("pub_count").alias("pubs")).filter("slot IS NOT NULL")


def year_totals(facts: DataFrame) -> DataFrame:
    return facts.groupBy("year").agg(F.sum("adjusted_count").alias("total"))


def dense_start(totals: DataFrame, keep: int, floor: float = 0.05) -> DataFrame:
    """The first year with at least `floor` of the peak, but no later than `keep`."""
    dense = totals.crossJoin(F.broadcast(totals.agg(F.max("total").alias("peak")))).filter(F.col("total") >= floor * F.col("peak"))
    return dense.agg(F.least(F.min("year"), F.lit(keep)).alias("dense_start"))


#: Abbreviations that people type, and what the name then contains. Fixed values.
ABBREVIATIONS = {
    "mit": "massachusetts institute of technology",
    "cmu": "carnegie mellon university",
    "uiuc": "university of illinois urbana-champaign",
    "ucb": "university of california, berkeley",
    "berkeley": "university of california, berkeley",
    "ucla": "university of california, los angeles",
    "ucsd": "university of california san diego",
    "ucsb": "university of california, santa barbara",
    "uci": "university of california, irvine",
    "ucd": "university of california, davis",
    "ucsc": "university of california, santa cruz",
    "ucr": "university of california, riverside",
    "usc": "university of southern california",
    "nyu": "new york university",
    "gatech": "georgia institute of technology",
    "gt": "georgia institute of technology",
    "vt": "virginia tech",
    "tamu": "texas a&m university",
    "utaustin": "university of texas at austin",
    "ut": "university of texas at austin",
    "umd": "university of maryland, college park",
    "umich": "university of michigan",
    "uw": "university of washington",
    "unc": "university of north carolina at chapel hill",
    "upenn": "university of pennsylvania",
    "penn": "university of pennsylvania",
    "psu": "pennsylvania state university",
    "asu": "arizona state university",
    "osu": "ohio state university",
    "caltech": "california institute of technology",
    "eth": "eth zurich",
    "epfl": "école polytechnique fédérale de lausanne",
    "nus": "national university of singapore",
    "ntu": "nanyang technological university",
    "pku": "peking university",
    "zju": "zhejiang university",
    "sjtu": "shanghai jiao tong university",
    "ustc": "university of science and technology of china",
    "hku": "university of hong kong",
    "cuhk": "chinese university of hong kong",
    "hkust": "hong kong university of science and technology",
    "ucl": "university college london",
    "tum": "technical university of munich",
    "snu": "seoul national university",
    "kaist": "korea advanced institute of science and technology",
}


def match_tier(name: Column, query: str, aliases: dict[str, str] | None = None) -> Column:
    """0 the name contains what the query abbreviates, 1 the query is its capitals' initials, 2 a word begins with it, 3 the
    initials begin with it, 4 anywhere; null for no match. An empty query matches everything at 0."""
    q = query.strip().lower()
    if not q:
        return F.lit(0)
    n = F.lower(name)
    initials = F.lower(F.array_join(F.regexp_extract_all(name, F.lit(r"\b[A-Z]"), F.lit(0)), ""))
    alias = (aliases or {}).get(q)
    tier = F.when(n.contains(alias.lower()), 0) if alias else F.when(F.lit(False), 0)
    tier = tier.when(initials == q, 1).when(n.startswith(q) | n.contains(" " + q), 2)
    return (tier.when(initials.startswith(q), 3) if len(q) > 1 else tier).when(n.contains(q), 4)


def search(rows: DataFrame, query: str, name: str = "name", aliases: dict[str, str] | None = None) -> DataFrame:
    """rows by match_tier(), with the tiers that the best one leaves: alias hits alone, else tiers up to 3, else 4."""
    found = rows.withColumn("tier", match_tier(F.col(name), query, aliases)).filter("tier IS NOT NULL")
    best = found.agg(F.min("tier").alias("__best"))
    limit = F.when(F.col("__best") == 0, 0).when(F.col("__best") <= 3, 3).otherwise(4)
    return found.crossJoin(F.broadcast(best)).filter(F.col("tier") <= limit).drop("__best")


def encode_state(s: Selection, default: Selection) -> str:
    """The selection as a query string; what equals the default is left out."""
    out = {"from": (s.first, default.first), "to": (s.last, default.last), "region": (s.region, default.region), "type": (s.kind, default.kind), "areas": (",".join(s.areas), ",".join(default.areas)), "off": (",".join(s.disabled_venues), ",".join(default.disabled_venues))}
    return urlencode({k: a for k, (a, b) in out.items() if a != b})


def decode_state(text: str, default: Selection, known_areas: tuple[str, ...]) -> Selection:
    """Years from 1600 to 2200, swapped if reversed; unknown areas and bad values are ignored."""
    got = {k: v[-1] for k, v in parse_qs(text.lstrip("#?")).items()}

    def year(name: str, other: int) -> int:
        v = got.get(name, "")
        return int(v) if v.isdigit() and 1600 <= int(v) <= 2200 else other

    a, b = sorted((year("from", default.first), year("to", default.last)))
    areas = tuple(x for x in got.get("areas", "").split(",") if x in known_areas) or default.areas
    off = tuple(x for x in got.get("off", "").split(",") if x) or default.disabled_venues
    return replace(default, first=a, last=b, areas=areas, region=got.get("region", default.region), kind=got.get("type", default.kind), disabled_venues=off)
