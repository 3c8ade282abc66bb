"""Curating the affiliation map: decisions and their queue, map checks, country repairs, samples.

The map has raw_affiliation (unique), status, institution_id, institution_name, institution_type, country_code, lineage and
matched_via; the index has id (unique), display_name, country_code, type, lineage, alternatives and acronyms (arrays).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identity import institution_id, row_key, short_id, words_key
from ..functions.places import countries_named
from .refresh import country_contradiction, looks_like_company

#: Kinds of decisions and the status that each gives a map row (none: the row stays as it is). Fixed values.
STATUS_FOR = {"supported": "manual", "corrected": "manual", "noneducation": "manual", "unresolved": "unmatched", "needs-policy": None}

#: Words of academic units in folded strings; firms; cities that firms are matched by. Fixed values.
STRONG_ACADEMIC = r"univ|college|polytech|politec|hochschule|\becole\b|escuela|scuola|daigaku|hogeschool|academ|akadem|institute of tech|institut[eo]? (?:of|de|for|di) |institut(?:o)? tecn|school of|faculty|facult|departement|dipartimento|departamento|\bcnrs\b|\binria\b"
FIRM = r"(?i)\b(inc|ltd|gmbh|corp|corporation|llc|limited|company|co\.|research lab(?:oratories|oratory)?|ai research)\b"
CITIES = (
    "tokyo", "beijing", "shanghai", "seoul", "london", "paris", "berlin", "munich", "boston", "san diego", "san jose",
    "santa clara", "dallas", "austin", "seattle", "palo alto", "mountain view", "sunnyvale", "cambridge", "oxford", "zurich",
    "geneva", "hong kong", "singapore", "shenzhen", "guangzhou", "nanjing", "hangzhou", "chengdu", "wuhan", "xian", "tianjin",
    "suzhou", "dresden", "stuttgart", "hamburg", "frankfurt", "aachen", "eindhoven", "delft", "helsinki", "stockholm",
    "copenhagen", "oslo", "melbourne", "sydney", "toronto", "vancouver", "montreal", "taipei", "hsinchu", "kyoto", "osaka",
    "yokohama", "nagoya", "bengaluru", "hyderabad", "mumbai", "delhi", "pune",
)


def _blank(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))) == ""


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _array(c: str) -> Column:
    return F.coalesce(F.col(c), F.array().cast("array<string>"))


def enrich(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Name, type, country and lineage of each map row from the index; what the index lacks stays as recorded. Nulls there
    become empty strings."""
    i = index.select(F.col("id").alias("institution_id"), F.struct(F.col("display_name").alias("n"), F.col("type").alias("t"), F.col("country_code").alias("c"), F.array_join("lineage", "|").alias("l")).alias("__i"))
    j = rows.join(i, "institution_id", "left")
    new = {"institution_name": "n", "institution_type": "t", "country_code": "c", "lineage": "l"}
    return j.select(*(F.when(F.col("__i").isNotNull(), _text(F.col(f"__i.{new[c]}"))).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in rows.columns))


def judged(decisions: DataFrame, index: DataFrame) -> DataFrame:
    """decisions (raw_affiliation, key, decision, institution_id, evidence) with `error` (null: valid) and the fields that a
    valid one gives: found_id, found_name, found_type, found_country, found_lineage. The first rule broken is the error."""
    i = index.select(F.col("id").alias("__id"), F.struct("display_name", "type", "country_code", "lineage").alias("__i"))
    j = decisions.withColumn("__id", F.nullif(institution_id(F.col("institution_id")), F.lit(""))).join(i, "__id", "left")
    d, inst, has = F.col("decision"), F.col("__i"), F.col("__id").isNotNull()
    credits, kind = F.coalesce(d.isin("supported", "corrected"), F.lit(False)), _text(inst["type"])
    error = (
        F.when(~F.coalesce(d.isin(*STATUS_FOR), F.lit(False)), "unknown decision")
        .when(_blank(F.col("evidence")), "evidence is required")
        .when(_text(F.col("raw_affiliation")) == "", "raw_affiliation is required")
        .when((_text(F.col("key")) != "") & (F.col("key") != row_key(F.col("raw_affiliation"))), "key does not match")
        .when(credits & ~has, "institution is required")
        .when(has & inst.isNull(), "unknown institution")
        .when(credits & (kind != "education"), "not education")
        .when(has & (d == "noneducation") & (kind == "education"), "is education")
    )
    field = lambda c: F.when(has, _text(c)).otherwise(F.lit(""))
    lineage = F.when(has, F.coalesce(F.nullif(F.array_join(inst["lineage"], "|"), F.lit("")), F.col("__id"))).otherwise("")
    return j.select(*decisions.columns, error.alias("error"), F.coalesce("__id", F.lit("")).alias("found_id"), field(inst["display_name"]).alias("found_name"), F.when(~has & (d == "noneducation"), "company").otherwise(field(inst["type"])).alias("found_type"), field(inst["country_code"]).alias("found_country"), lineage.alias("found_lineage"))


def apply_decisions(mapping: DataFrame, decisions: DataFrame, index: DataFrame, at: str, override: bool = False) -> tuple[DataFrame, DataFrame]:
    """(map, rejected): the latest valid decision of each string (by column `at`) takes effect; new strings become rows.

    A manual row keeps its institution unless override: only a decision that confirms it is accepted there. rejected has
    raw_affiliation and error.
    """
    d = judged(decisions, index)
    fields = ["decision", "found_id", "found_name", "found_type", "found_country", "found_lineage"]
    j = d.join(mapping.select("raw_affiliation", F.struct("status", "institution_id").alias("__now")), "raw_affiliation", "left")
    becomes = F.create_map(*(F.lit(x) for k, v in STATUS_FOR.items() if v for x in (k, v)))
    settled = (F.col("__now.status") == "manual") & ~((short_id(_text(F.col("__now.institution_id"))) == short_id(F.col("found_id"))) & F.coalesce(F.try_element_at(becomes, F.col("decision")) == "manual", F.lit(False)))
    j = j.withColumn("error", F.coalesce("error", F.when(F.coalesce(settled, F.lit(False)) & ~F.lit(override), "already manual")))
    latest = j.filter("error IS NULL").groupBy("raw_affiliation").agg(F.max_by(F.struct(*fields), at).alias("__d"))
    latest = latest.withColumn("__status", F.try_element_at(becomes, F.col("__d.decision"))).filter("__status IS NOT NULL")
    out = mapping.join(latest, "raw_affiliation", "full_outer")
    taken = F.col("__d").isNotNull()
    new = {"status": F.col("__status"), "institution_id": F.col("__d.found_id"), "institution_name": F.col("__d.found_name"), "institution_type": F.col("__d.found_type"), "country_code": F.col("__d.found_country"), "lineage": F.col("__d.found_lineage"), "matched_via": F.concat(F.lit("adjudicated:"), F.col("__d.decision"))}
    done = out.select(*(F.when(taken, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in mapping.columns))
    return done, j.filter("error IS NOT NULL").select("raw_affiliation", "error")


def queue(mapping: DataFrame, weights: DataFrame, most: int, batch: int = 50, pending: tuple[str, ...] = ("review", "unmapped")) -> DataFrame:
    """(batch, raw_affiliation, status, share, occurrences, variants): the `most` pending strings of largest share, then
    occurrences, then text. Strings of `weights` (raw, occurrences, share) without a map row are unmapped and pending.
    variants: other strings of the map that are the same when folded."""
    w = weights.select(F.col("raw").alias("raw_affiliation"), "occurrences", "share")
    folded = mapping.groupBy(words_key(F.col("raw_affiliation")).alias("__key")).agg(F.count("*").alias("__n"))
    seen = mapping.select("raw_affiliation", "status", F.lit(1).alias("__own"))
    j = seen.join(w, "raw_affiliation", "full_outer").withColumn("status", F.coalesce("status", F.lit("unmapped")))
    j = j.filter((F.col("__own").isNull()) | F.col("status").isin(*pending))
    order = [F.desc("share"), F.desc("occurrences"), F.col("raw_affiliation")]
    top = j.withColumn("share", F.coalesce("share", F.lit(0.0))).withColumn("occurrences", F.coalesce("occurrences", F.lit(0))).orderBy(*order).limit(most)
    top = top.withColumn("batch", (F.floor((F.row_number().over(Window.orderBy(*order)) - 1) / batch) + 1).cast("int"))  # `most` rows only
    top = top.withColumn("__key", words_key(F.col("raw_affiliation"))).join(folded, "__key", "left")
    return top.select("batch", "raw_affiliation", "status", "share", "occurrences", (F.coalesce("__n", F.lit(0)) - F.coalesce("__own", F.lit(0))).alias("variants"))


def academic_evidence(raw: Column, names: Column) -> Column:
    """An academic word in the folded string, or one of the names (three letters or more) as whole words."""
    padded = F.concat(F.lit(" "), words_key(raw), F.lit(" "))
    own = F.exists(names, lambda n: (F.length(words_key(n)) >= 3) & F.contains(padded, F.concat(F.lit(" "), words_key(n), F.lit(" "))))
    return F.coalesce(words_key(raw).rlike(STRONG_ACADEMIC), F.lit(False)) | F.coalesce(own, F.lit(False))


def _credited(mapping: DataFrame) -> DataFrame:
    return mapping.filter(F.col("status").isin("auto", "manual") & (F.col("institution_type") == "education") & (_text(F.col("institution_id")) != ""))


def country_repairs(mapping: DataFrame, index: DataFrame, least: int = 5, ratio: int = 3) -> DataFrame:
    """(raw_affiliation, action, reason, other): what is to be done about credited rows whose string speaks against them.

    corrected: the string names other countries, and one education institution there has the same name (`other`); manual
    rows are only unresolved. noneducation: automatic rows of firms. unresolved: country (no such namesake), evidence (no
    academic word, nor the institution's name), namesake (the string names no country, but `least` strings and `ratio` times
    as many as agree point to one namesake abroad).
    """
    i = index.select(F.col("id").alias("institution_id"), F.struct(_text(F.col("country_code")).alias("country"), F.array_compact(F.concat(F.array("display_name"), _array("alternatives"), _array("acronyms"))).alias("names")).alias("__i"))
    rows = _credited(mapping).join(i, "institution_id", "left").withColumn("named", countries_named(F.col("raw_affiliation")))
    rows = rows.withColumn("country", F.coalesce("__i.country", "country_code", F.lit("")))
    rows = rows.withColumn("against", country_contradiction(F.col("country"), F.col("named")))

    key = lambda c: F.lower(F.trim(c))
    known = index.filter("type = 'education'").select(F.col("id").alias("other"), "country_code", F.explode(F.array_distinct(F.transform(F.array_compact(F.concat(F.array("display_name"), _array("alternatives"))), key))).alias("name")).filter("name <> ''")
    asked = rows.filter("against").select("raw_affiliation", "named", F.explode(F.array_distinct(F.array(key(_text(F.col("matched_via"))), key(_text(F.col("institution_name")))))).alias("name"))
    twins = asked.join(known, "name").filter(F.array_contains("named", F.col("country_code"))).groupBy("raw_affiliation").agg(F.min("other").alias("other"), F.max("other").alias("__last")).filter("other = __last").drop("__last")
    rows = rows.join(twins, "raw_affiliation", "left")

    clash = rows.filter("other IS NOT NULL").groupBy("institution_id", F.col("other").alias("twin")).agg(F.count("*").alias("n")).groupBy("institution_id").agg(F.max_by(F.struct("n", "twin"), F.struct("n", "twin")).alias("__t"))
    agree = rows.filter((F.size("named") > 0) & ~F.col("against")).groupBy("institution_id").agg(F.count("*").alias("__agree"))
    suspect = clash.join(agree, "institution_id", "left").filter((F.col("__t.n") >= least) & (F.col("__t.n") >= ratio * F.coalesce("__agree", F.lit(0)))).select("institution_id", F.col("__t.twin").alias("__twin"))
    rows = rows.join(suspect, "institution_id", "left")

    auto, firm = F.col("status") == "auto", looks_like_company(F.col("raw_affiliation"))
    lacks = auto & F.col("__i").isNotNull() & ~academic_evidence(F.col("raw_affiliation"), F.col("__i.names"))
    found = lambda action, reason, other: F.struct(F.lit(action).alias("action"), F.lit(reason).alias("reason"), other.cast("string").alias("other"))
    none = F.lit(None)
    first = (
        F.when(F.col("against") & F.col("other").isNotNull() & auto, found("corrected", "country", F.col("other")))
        .when(F.col("against"), found("unresolved", "country", F.col("other")))
        .when(firm & auto, found("noneducation", "company", none))
        .when(~firm & lacks, found("unresolved", "evidence", none))
    )
    second = F.when(auto & (F.size("named") == 0) & F.col("__twin").isNotNull(), found("unresolved", "namesake", F.col("__twin")))
    return rows.select("raw_affiliation", F.explode(F.array_compact(F.array(first, second))).alias("__f")).select("raw_affiliation", "__f.*")


def map_checks(mapping: DataFrame, index: DataFrame) -> DataFrame:
    """(check, key, n): variant_split (folded strings with several institutions, one of them credited as education),
    type_differs (the index has another type), acronym (a short match that is no official one), city_firm (a firm credited
    by a city) and abroad (other countries named), each by string but the first, which is by folded string."""
    used = mapping.filter(F.col("status").isin("auto", "manual") & (_text(F.col("institution_id")) != ""))
    split = used.groupBy(words_key(F.col("raw_affiliation")).alias("key")).agg(F.count_distinct(short_id(F.col("institution_id"))).alias("n"), F.max(_text(F.col("institution_type")) == "education").alias("__e")).filter("n > 1 AND __e").select(F.lit("variant_split").alias("check"), "key", "n")
    i = index.select(F.col("id").alias("institution_id"), F.struct(_text(F.col("type")).alias("type"), F.transform(F.concat(_array("acronyms"), _array("alternatives")), F.lower).alias("short")).alias("__i"))
    j = used.join(i, "institution_id", "left")
    via, credit, raw = _text(F.col("matched_via")), F.col("institution_type") == "education", F.col("raw_affiliation")
    name = lambda holds, label: F.when(F.coalesce(holds, F.lit(False)), label)
    checks = F.array_compact(F.array(
        name(F.col("__i").isNotNull() & (F.col("__i.type") != _text(F.col("institution_type"))), "type_differs"),
        name(credit & via.rlike(r"^\p{L}{1,5}$") & ~F.coalesce(F.array_contains("__i.short", F.lower(via)), F.lit(False)), "acronym"),
        name(credit & F.lower(via).isin(*CITIES) & raw.rlike(FIRM), "city_firm"),
        name(credit & country_contradiction(F.col("country_code"), countries_named(raw)), "abroad"),
    ))
    return split.unionByName(j.select(F.explode(checks).alias("check"), raw.alias("key"), F.lit(1).cast("long").alias("n")))


def accuracy(slots: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts of correct and wrong (or missing) verdicts of readable sample slots, and the share of correct ones; null where
    there are none. slots: kind, image_ok, verdict."""
    of = lambda *v: F.count_if(F.col("verdict").isin(*v))
    g = slots.filter((F.col("kind") == "sample") & F.col("image_ok")).groupBy(*(by or [])).agg(of("correct").alias("correct"), of("wrong", "missing").alias("wrong"))
    return g.withColumn("accuracy", F.try_divide("correct", F.col("correct") + F.col("wrong")))


def quotas(size: int, strata: dict[str, float]) -> dict[str, int]:
    """How many to draw of each stratum: its share of the size, one at least."""
    return {name: max(1, round(size * share)) for name, share in strata.items()}


def stratified(rows: DataFrame, key: str, stratum: str, size: int, strata: dict[str, float], seed: int) -> DataFrame:
    """A simple random sample by quota of each stratum, with `place`, a shuffled order that tells nothing of the strata. The
    draw follows the SHA-256 of seed and key, so it is the same everywhere; rows of strata without a quota are left out."""
    h = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"), 256)
    want = F.create_map(*(F.lit(x) for pair in quotas(size, strata).items() for x in pair))
    w = Window.partitionBy(stratum).orderBy("__h", key)
    drawn = rows.filter(F.col(stratum).isin(*strata)).withColumn("__h", h).withColumn("__i", F.row_number().over(w)).filter(F.col("__i") <= F.try_element_at(want, F.col(stratum)))
    shuffled = F.sha2(F.concat(F.col("__h"), F.lit("place")).cast("binary"), 256)
    return drawn.withColumn("place", F.row_number().over(Window.orderBy(shuffled, key))).drop("__h", "__i")  # the quotas bound it


def once(rows: DataFrame, key: str, at: str, identity: list[str]) -> DataFrame:
    """The first row (by `at`) of each key, with duplicate_suspect: another row, dropped ones included, has the same
    identity. Nulls in the identity are equal to each other; rows without a key count as one key."""
    rest = [c for c in rows.columns if c != key]
    first = rows.groupBy(key).agg(F.min_by(F.struct(*rest), at).alias("__r")).select(key, "__r.*")
    h = F.xxhash64(*identity)
    n = rows.groupBy(h.alias("__h"), *(F.col(c).alias(f"__{c}") for c in identity)).agg(F.count("*").alias("__n"))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in identity]
    j = first.withColumn("__own", h).join(n.filter("__n > 1"), [F.col("__own") == F.col("__h"), *same], "left")
    return j.select(*rows.columns, F.col("__n").isNotNull().alias("duplicate_suspect"))


#: Severities, most severe first.
SEVERITIES = ("critical", "high", "medium", "low")


def verification(flags: dict[str, DataFrame], active: Column) -> DataFrame:
    """One table (phase, severity, scope, message) of all phases' flags; what is not `active` (a condition on scope) is at most
    medium: known gaps of what users don't see."""
    every = None
    for phase, df in flags.items():
        part = df.select(F.lit(phase).alias("phase"), "severity", "scope", "message")
        every = part if every is None else every.unionByName(part)
    lowered = F.when(~F.coalesce(active, F.lit(False)) & F.col("severity").isin("critical", "high"), "medium").otherwise(F.col("severity"))
    return every.withColumn("severity", lowered)


def outcome(flags: DataFrame) -> DataFrame:
    """One row: counts by severity, exit status (2 if anything is critical or high) and whether the snapshot may advance."""
    g = flags.agg(*(F.count_if(F.col("severity") == s).alias(s) for s in SEVERITIES))
    bad = F.col("critical") + F.col("high") > 0
    return g.withColumn("status", F.when(bad, 2).otherwise(0)).withColumn("advance", ~bad)


def coverage_collapse(rows: DataFrame, key: str, year: str, papers: str, credit: str, last: int, least_papers: int = 30, least_norm: float = 20, critical: float = 0.4, high: float = 0.7) -> DataFrame:
    """(key, year, share, norm, severity): years up to `last` whose credit a paper, in percent, is far under the key's own median
    over its years of `least_papers` or more, of which there must be three; medians under least_norm are not judged."""
    big = rows.filter(F.col(papers) >= least_papers).withColumn("share", 100.0 * F.col(credit) / F.col(papers))
    own = Window.partitionBy(key)
    j = big.withColumn("norm", F.median("share").over(own)).withColumn("__n", F.count("*").over(own)).filter((F.col("__n") >= 3) & (F.col("norm") >= least_norm) & (F.col(year) <= last))
    r = F.col("share") / F.col("norm")
    return j.withColumn("severity", F.when(r < critical, "critical").when(r < high, "high")).filter("severity IS NOT NULL").select(key, year, "share", "norm", "severity")
