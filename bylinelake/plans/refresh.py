"""Queries over weights, coverage, reasons of lost credit and merges, on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import credit, refresh
from .facts import RAW, nested_works, raw_mapping
from .registry import load, query


def _slots(spark, d):
    return credit.bylines(nested_works(spark, d))


@query(f"WITH {RAW} SELECT s_name AS raw, count(*) AS occurrences, round(sum(share), 6) AS share FROM b WHERE own IS NULL GROUP BY s_name")
def string_weights(spark, d):
    return refresh.string_weights(_slots(spark, d)).withColumn("share", F.round("share", 6))


@query(f"WITH {RAW}, w AS (SELECT s_name, count(*) AS n, CASE WHEN any_value(inst) IS NULL THEN 'unmapped' ELSE 'auto' END AS status FROM b WHERE own IS NULL GROUP BY s_name) SELECT status, count(*) AS strings, CAST(sum(n) AS BIGINT) AS occurrences, round(100.0 * sum(n) / (SELECT sum(n) FROM w), 6) AS percent FROM w GROUP BY status")
def map_coverage(spark, d):
    return refresh.map_coverage(refresh.string_weights(_slots(spark, d)), raw_mapping(spark, d).filter("status = 'auto'")).withColumn("percent", F.round("percent", 6))


@query("""SELECT event_id, CASE WHEN a = 1 THEN NULL WHEN a = 2 THEN 'untyped_institution' WHEN a = 3 THEN 'openalex_noncredit' WHEN b = 1 THEN NULL WHEN b = 2 THEN 'retyped_row' WHEN b = 3 THEN 'raw_noncredit' WHEN event_id % 3 = 0 THEN 'raw_unmapped'
 WHEN event_id % 2 = 0 THEN 'no_affiliation:no_doi' WHEN event_type = 'click' THEN 'no_affiliation:backfill_tried' WHEN event_id % 7 > 3 THEN 'no_affiliation:never_backfilled' ELSE 'no_affiliation:other' END AS reason
 FROM (SELECT event_id, event_type, event_id % 5 AS a, event_id % 11 AS b FROM events)""")
def drop_reasons(spark, d):
    """Made-up slots that reach each of the nine reasons."""
    kinds = {1: ("education", None), 2: ("", "education"), 3: ("company", "company")}
    e, i = load(spark, d, "events"), F.col("event_id")
    none = F.array().cast("array<struct<type:string,index_type:string>>")

    def of(n):
        out = F.when(F.lit(False), none)
        for k, (a, b) in kinds.items():
            given = ("company", "education") if k == 2 and n == 11 else (a, b)
            out = out.when(i % n == k, F.array(F.struct(F.lit(given[0]).alias("type"), F.lit(given[1]).cast("string").alias("index_type"))))
        return out.otherwise(none)

    raws = F.when(i % 3 == 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    return e.select(i, refresh.drop_reason(of(5), of(11), raws, i % 2 != 0, F.col("event_type") == "click", i % 7 > 3).alias("reason"))


@query("""SELECT s_suppkey AS id, CASE WHEN s_suppkey % 5 = 0 THEN 'over' WHEN s_suppkey % 3 = 0 THEN 'live' WHEN s_suppkey % 2 = 0 AND s_suppkey % 7 <> 0 THEN 'snap' ELSE s_name END AS name,
 CASE WHEN s_suppkey % 5 = 0 AND s_suppkey % 10 = 0 THEN 'OV' WHEN s_suppkey % 3 = 0 THEN '' WHEN s_suppkey % 2 = 0 THEN 'SN' ELSE '' END AS country FROM supplier""")
def release_metadata(spark, d):
    s = load(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    lit = lambda c, n, k: s.filter(c).select("id", n.alias("name"), k.alias("country"))
    over = lit("id % 5 = 0", F.lit("over"), F.when(F.col("id") % 10 == 0, "OV"))
    snap = lit("id % 2 = 0", F.when(F.col("id") % 7 == 0, "").otherwise("snap"), F.lit("SN"))
    return refresh.metadata(s, over, lit("id % 3 = 0", F.lit("live"), F.lit("")), snap)


@query("""WITH w AS (SELECT doc_id AS id, text, source, n_chars % 3 + 2000 AS year FROM documents), c AS (SELECT DISTINCT doc_id AS f, text, source, CASE WHEN lang = 'de' THEN NULL ELSE n_chars % 7 + 2000 END AS y FROM documents),
h AS (SELECT id, count(*) AS n, min(f) AS f FROM w JOIN c USING (text, source) WHERE text <> '' AND (y IS NULL OR abs(year - y) <= 1) GROUP BY id)
SELECT id, CASE WHEN n IS NULL THEN 'unresolved' WHEN n = 1 THEN 'matched' ELSE 'ambiguous' END AS status, coalesce(n, 0) AS n, CASE WHEN n = 1 THEN f END AS found FROM w LEFT JOIN h USING (id)""")
def discover_status(spark, d):
    """Text and source stand for title and byline; all documents look for all documents."""
    docs = load(spark, d, "documents").withColumn("names", F.array("source")).withColumn("title", F.col("text"))
    w = docs.select(F.col("doc_id").alias("id"), "title", "names", (F.col("n_chars") % 3 + 2000).alias("year"))
    c = docs.select(F.col("doc_id").alias("id"), "title", "names", F.when(F.col("lang") == "de", None).otherwise(F.col("n_chars") % 7 + 2000).alias("year"))
    return refresh.discover(w, c).withColumn("n", F.col("n").cast("long"))


@query("""SELECT conv_id, concat_ws(',', CASE WHEN count(DISTINCT coalesce(role, '')) > 1 THEN 'title_conflict' END, CASE WHEN count(DISTINCT coalesce(text, '')) > 1 THEN 'byline_conflict' END, CASE WHEN count(DISTINCT turn) > 1 THEN 'year_conflict' END) AS flags FROM conversations GROUP BY conv_id HAVING count(*) > 1""")
def conflicts(spark, d):
    out = refresh.conflict_flags(load(spark, d, "conversations"), "conv_id", "role", "text", "turn")
    return out.withColumn("flags", F.array_join("flags", ","))


@query("""SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN event_type NOT IN ('click', 'view', 'purchase') THEN CASE WHEN c THEN 'undecidable' ELSE 'correct' END WHEN event_type = 'view' THEN CASE WHEN c THEN 'wrong_credited' ELSE 'correct' END
 WHEN c THEN CASE WHEN user_id % 3 = event_id % 3 THEN 'correct' ELSE 'wrong_institution' END ELSE 'missed_credit' END AS outcome FROM (SELECT *, event_id % 2 = 0 AS c FROM events)) GROUP BY outcome""")
def audit_outcomes(spark, d):
    e = load(spark, d, "events")
    kind = F.when(F.col("event_type") == "click", "Education").when(F.col("event_type") == "purchase", "corrected").when(F.col("event_type") == "view", "noneducation").otherwise(F.col("event_type"))
    return e.groupBy(refresh.audit_outcome(F.col("event_id") % 2 == 0, F.col("user_id") % 3, kind, F.col("event_id") % 3).alias("outcome")).agg(F.count("*").alias("n"))
