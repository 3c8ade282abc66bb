"""Resolving free-text affiliations to institutions: candidates, tiers, token indexes, guards, decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identity import words_key

#: Departments rank last among candidate segments. Fixed values.
DEPARTMENT = r"(?i)\b(dept|department|school|faculty|division|section|college of)\b"
POSTAL = r"^[\d][\d\s\-]*$|^[A-Z]{1,2}\d{1,2}[A-Z]?\s*\d?[A-Z]{0,2}$"
COMPANY = r"(?i)[\s,]+\b(inc|ltd|co|corp|corporation|llc|gmbh|plc|pvt|pte|s\.?a|n\.?v|b\.?v|ag|k\.?k|s\.?r\.?l|s\.?p\.?a|limited)\b\.?,?\s*$"
FUNCTION_WORDS = ("of", "the", "and", "for", "de", "da", "du", "la", "le", "der", "van", "von")
STOP_WORDS = ("of", "the", "and", "for", "at", "in", "de", "la", "university", "institute")


def candidates(raw: Column, most: int = 5, ignored: tuple[str, ...] = ()) -> Column:
    """Names that may stand in an affiliation string: bracketed parts, then runs of two and three neighbouring comma segments,
    the segments, and parts around `and`/`&`; in each of these kinds departments last and longer ones first; at most `most`.

    Postal codes and what `ignored` lists in lower case (countries, say) are no names; company suffixes are cut off. A null
    string gives null.
    """
    text = F.regexp_replace(raw, r"\([^)]*\)", " ")
    tidy = lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, r"\s+", " "), COMPANY, ""))
    named = lambda parts, least: F.filter(F.transform(parts, tidy), lambda x: (F.length(x) >= least) & ~x.rlike(POSTAL) & ~F.lower(x).isin(*ignored, ""))
    none = F.array().cast("array<string>")
    inside = named(F.regexp_extract_all(raw, F.lit(r"\(([^)]*)\)"), F.lit(1)), 2)
    segs = named(F.split(text, "[,;]"), 3)
    halves = named(F.flatten(F.transform(segs, lambda x: F.when(x.rlike(r"(?i)\s(and|&)\s"), F.split(x, r"(?i)\s(?:and|&)\s")).otherwise(none))), 3)
    run = lambda n: F.transform(F.when(F.size(segs) >= n, F.sequence(F.lit(1), F.size(segs) - n + 1)).otherwise(F.array().cast("array<int>")), lambda i: F.array_join(F.slice(segs, i, F.lit(n)), ", "))
    ranked = lambda parts: F.transform(F.array_sort(F.transform(parts, lambda x: F.struct(x.rlike(DEPARTMENT).alias("late"), (-F.length(x)).alias("size"), x.alias("name")))), lambda x: x["name"])
    return F.slice(F.array_distinct(F.concat(inside, ranked(F.concat(run(2), run(3))), ranked(segs), ranked(halves))), 1, most)


def acronym_like(name: Column) -> Column:
    """One word of up to 12 characters with two letters or more, of which 60 % or more are capitals."""
    letters, capitals = (F.length(F.regexp_replace(name, f"[^{kind}]", "")) for kind in (r"\p{L}", r"\p{Lu}"))
    return ~name.contains(" ") & (F.length(name) <= 12) & (letters >= 2) & (capitals >= 0.6 * letters)


def content_tokens(name: Column, stop: tuple[str, ...] = STOP_WORDS) -> Column:
    return F.array_except(F.split(words_key(name), " "), F.array(*(F.lit(w) for w in (*stop, ""))))


def resolve_tiers(raws: DataFrame, names: DataFrame, raw: str, least_ratio: float = 0.55) -> DataFrame:
    """(raw, id, score, matched_via, candidate) a string that matches: the best of four tiers over its candidates.

    names: id, name and, if there, acronyms (array). The tiers are the exact name (score 1), an acronym (1), a short candidate
    that starts a name or the other way round, and a candidate of several words whose content words are all in the name and
    least_ratio of those there; the latter two score 0.72 and 0.25 times the share covered. From 0.97 on the earliest
    candidate wins, else the best score; then the earlier candidate, the tier in this order, and the smaller id.

    Each tier is a join by equality with one row a key: of the names that start alike the shortest is the best one, and a
    candidate is looked up by its rarest word only. Null strings and names match nothing.
    """
    options = raws.select(raw).distinct().select(raw, F.posexplode(candidates(F.col(raw))).alias("at", "candidate"))
    options = options.withColumn("key", words_key(F.col("candidate"))).filter("key <> ''")
    index = names.select("id", words_key(F.col("name")).alias("key"), F.array_distinct(content_tokens(F.col("name"), FUNCTION_WORDS)).alias("words")).filter("key <> ''")
    of = lambda rows, via, score: rows.select(raw, "at", "candidate", "id", score.alias("score"), F.lit(via).alias("matched_via"))
    covered = lambda part, whole: 0.72 + 0.25 * part / whole

    by_name = index.groupBy("key").agg(F.min("id").alias("id"))
    found = [of(options.join(by_name, "key"), "1 exact", F.lit(1.0))]
    if "acronyms" in names.columns:
        short = names.select("id", F.explode("acronyms").alias("a")).groupBy(F.upper("a").alias("short")).agg(F.min("id").alias("id"))
        found.append(of(options.filter(acronym_like(F.col("candidate"))).withColumn("short", F.upper("candidate")).join(short, "short"), "2 acronym", F.lit(1.0)))

    size = F.length("key")
    brief = options.filter(size.between(3, 8))
    starts = lambda least: F.explode(F.transform(F.sequence(F.lit(least), F.least(size, F.lit(8))), lambda n: F.substring("key", F.lit(1), n)))
    begun = index.filter(size >= 5).select("id", size.alias("size"), starts(3).alias("key")).groupBy("key").agg(F.min_by(F.struct("id", "size"), F.struct("size", "id")).alias("n"))
    found.append(of(brief.join(begun, "key").select("*", "n.id"), "3 prefix", covered(size, F.col("n.size"))))
    longer = brief.filter(size >= 5).select(raw, "at", "candidate", size.alias("size"), starts(5).alias("key"))
    found.append(of(longer.join(by_name, "key"), "3 prefix", covered(size, F.col("size"))))

    several = options.filter(F.col("key").contains(" ")).withColumn("mine", F.array_distinct(content_tokens(F.col("candidate"), FUNCTION_WORDS))).filter(F.size("mine") > 0)
    postings = index.select("id", "words", F.explode("words").alias("word"))
    spread = postings.groupBy("word").agg(F.count("*").alias("n"))
    rarest = several.select(raw, "at", "candidate", "mine", F.explode("mine").alias("word")).join(spread, "word", "left")
    rarest = rarest.groupBy(raw, "at", "candidate").agg(F.any_value("mine").alias("mine"), F.min_by("word", F.struct(F.coalesce("n", F.lit(0)), "word")).alias("word"))
    within = rarest.join(postings, "word").filter((F.size("mine") >= least_ratio * F.size("words")) & (F.size(F.array_except("mine", "words")) == 0))
    found.append(of(within, "4 tokens", covered(F.size("mine"), F.size("words"))))

    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    order = F.struct(-F.least("score", F.lit(0.97)), "at", "matched_via", -F.col("score"), "id")
    best = every.groupBy(raw).agg(F.min_by(F.struct("id", "score", F.substring("matched_via", 3, 9).alias("matched_via"), "candidate"), order).alias("m"))
    return best.select(raw, "m.*")


def status_of(score: Column, auto: float = 0.9, review: float = 0.72) -> Column:
    return F.when(score >= auto, "auto").when(score >= review, "review").otherwise("unmatched")


def token_candidates(raws: DataFrame, key: str, raw: str, names: DataFrame, top: int = 5, posting_limit: int | None = None) -> DataFrame:
    """(key, id, coverage, tokens, rank): share of a name's content tokens that stand in the string; best `top`, by
    coverage, tokens and id. Tokens with more than posting_limit names can be left out of the index if a limit is given."""
    postings = names.select("id", F.size(F.array_distinct(content_tokens(F.col("name")))).alias("all"), F.explode(F.array_distinct(content_tokens(F.col("name")))).alias("token"))
    if posting_limit:
        rare = postings.groupBy("token").count().filter(F.col("count") <= posting_limit).select("token")
        postings = postings.join(rare, "token", "left_semi")
    words = raws.select(key, F.explode(F.array_distinct(content_tokens(F.col(raw)))).alias("token"))
    hits = words.join(postings, "token").groupBy(key, "id").agg((F.count("*") / F.max("all")).alias("coverage"), F.count("*").alias("tokens"))
    w = Window.partitionBy(key).orderBy(F.desc("coverage"), F.desc("tokens"), "id")
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)


def jaccard(a: Column, b: Column) -> Column:
    return F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b)))


def acronym(name: Column) -> Column:
    words = F.filter(F.split(words_key(name), " "), lambda w: (w != "") & ~w.isin("of", "the", "and", "for"))
    return F.upper(F.array_join(F.transform(words, lambda w: F.substring(w, F.lit(1), F.lit(1))), ""))


def collisions(names: DataFrame, key: Column) -> DataFrame:
    """Keys (such as acronyms) that several ids share: (key, n, ids in order)."""
    return names.groupBy(key.alias("key")).agg(F.count_distinct("id").alias("n"), F.array_sort(F.collect_set("id")).alias("ids")).filter("n > 1")


def whole_segment(raws: DataFrame, raw: str, names: DataFrame) -> DataFrame:
    """(raw, id): a comma segment of the string is exactly a name."""
    segs = raws.select(raw, F.explode(F.array_distinct(F.transform(F.split(raw, ","), words_key))).alias("key"))
    return segs.join(names.select("id", words_key(F.col("name")).alias("key")), "key").select(raw, "id").distinct()


def guard(rows: DataFrame, company: Column, evidence: Column, contradiction: Column, namesake: Column) -> DataFrame:
    """Status and id of matched rows after the guards: a contradiction of countries moves to the only namesake in the named
    country or to review; companies and rows without academic evidence go to review. Only `auto` rows are judged."""
    auto = F.col("status") == "auto"
    moved = auto & contradiction & namesake.isNotNull()
    why = F.when(~auto, None).when(moved, "namesake").when(contradiction, "country").when(company, "company").when(~evidence, "no_evidence")
    return rows.withColumn("guard", why).withColumn("institution_id", F.when(moved, namesake).otherwise(F.col("institution_id"))).withColumn("status", F.when(auto & why.isNotNull() & (why != "namesake"), "review").otherwise(F.col("status")))


def unique_namesake(names: DataFrame) -> DataFrame:
    """(key, country, namesake): the id of names that one institution only has in a country."""
    return names.groupBy(words_key(F.col("name")).alias("key"), "country").agg(F.min("id").alias("namesake"), F.count_distinct("id").alias("n")).filter("n = 1").drop("n")


def first_rule(rows: DataFrame, text: str, rules: list[tuple[str, str]]) -> DataFrame:
    """rows with `cluster`: the value of the first (pattern, value) that holds."""
    from ..functions.identity import guess_by_rules

    return rows.withColumn("cluster", guess_by_rules(F.col(text), rules))


def latest_decisions(ledger: DataFrame, key: str, at: str) -> DataFrame:
    """The last entry of each key of an append-only ledger."""
    rest = [c for c in ledger.columns if c != key]
    return ledger.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(at)).alias("d")).select(key, "d.*")


def replay(mapping: DataFrame, ledger: DataFrame, key: str, at: str, override: bool = False) -> DataFrame:
    """The map with the latest decisions applied; manual rows stay unless override; new keys are added."""
    d = latest_decisions(ledger, key, at).select(key, F.col("institution_id").alias("__id"), F.lit(True).alias("__has"))
    j = mapping.join(d, key, "full_outer")
    apply = F.col("__has").isNotNull() & ((F.coalesce("status", F.lit("")) != "manual") | F.lit(override))
    return j.select(key, F.when(apply, "manual").otherwise(F.col("status")).alias("status"), F.when(apply, F.col("__id")).otherwise(F.col("institution_id")).alias("institution_id"))


def nearest_centroid(vectors: DataFrame, centroids: DataFrame, id_col: str, vec: str, auto: float = 0.85, review: float = 0.7) -> DataFrame:
    """(id, label, score, status): the centroid of largest cosine; centroids (label, c array<double>) are few by contract."""
    rows = [(r["label"], [float(x) for x in r["c"]]) for r in centroids.orderBy("label").limit(100_001).collect()]
    if len(rows) > 100_000:
        raise ValueError("too many centroids to broadcast")
    shared = vectors.sparkSession.sparkContext.broadcast(rows)

    def run(parts):
        import numpy as np
        import pyarrow as pa

        m = np.array([c for _, c in shared.value])
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        labels = np.array([x for x, _ in shared.value])
        for b in parts:
            v = np.asarray(b.column("v").flatten(), float).reshape(len(b), -1)
            s = v @ m.T / np.linalg.norm(v, axis=1, keepdims=True)
            best = s.argmax(axis=1)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(labels[best], pa.int64()), pa.array(s[np.arange(len(v)), best])], names=["id", "label", "score"])

    out = vectors.select(F.col(id_col).alias("id"), F.col(vec).alias("v")).mapInArrow(run, "id long, label long, score double")
    return out.withColumn("status", status_of(F.col("score"), auto, review)).withColumnRenamed("id", id_col)


def trap_outcome(clause: Column, got: Column, kind: Column) -> Column:
    """Whether a clause holds: id:X, not:X or noneducation."""
    value = F.regexp_replace(clause, "^[a-z]+:", "")
    return F.when(clause.startswith("id:"), got == value).when(clause.startswith("not:"), ~got.eqNullSafe(value)).when(clause == "noneducation", F.coalesce(kind, F.lit("")) != "education")
