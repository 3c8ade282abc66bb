"""Queries over decisions, map checks, samples, evidence and verification, on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.names import name_tokens, names_agree
from ..operators import curation, evidence
from .registry import load, query

URL = "https://openalex.org/I"


def institutions(spark, d):
    """Suppliers as institutions; every third is a company."""
    s = load(spark, d, "supplier")
    return s.select(F.concat(F.lit(URL), "s_suppkey").alias("id"), F.col("s_name").alias("display_name"), F.when(F.col("s_suppkey") % 3 == 0, "company").otherwise("education").alias("type"), F.concat(F.lit("C"), "s_nationkey").alias("country_code"), F.array(F.concat(F.lit(URL), "s_suppkey")).alias("lineage"), F.array().cast("array<string>").alias("alternatives"), F.array().cast("array<string>").alias("acronyms"))


def decisions(spark, d):
    """Events as decisions on strings s0 to s49; kinds by event type, some without evidence, key or institution."""
    e = load(spark, d, "events")
    kinds = F.create_map(*(F.lit(x) for p in (("click", "supported"), ("view", "corrected"), ("purchase", "noneducation"), ("signup", "unresolved")) for x in p))
    return e.select("event_id", F.concat(F.lit("s"), F.col("event_id") % 50).alias("raw_affiliation"), F.when(F.col("event_id") % 5 == 0, "bad").otherwise("").alias("key"), F.coalesce(F.try_element_at(kinds, "event_type"), F.lit("other")).alias("decision"), F.when(F.col("user_id") % 4 != 0, F.concat(F.lit("I"), F.col("user_id") % 12)).alias("institution_id"), F.when(F.col("event_id") % 7 == 0, " ").otherwise("x").alias("evidence"))


DECISIONS = f"""i AS (SELECT '{URL}' || s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN 'company' ELSE 'education' END AS type, s_name FROM supplier),
e AS (SELECT event_id, 's' || (event_id % 50) AS raw, CASE event_type WHEN 'click' THEN 'supported' WHEN 'view' THEN 'corrected' WHEN 'purchase' THEN 'noneducation' WHEN 'signup' THEN 'unresolved' ELSE 'other' END AS kind,
 CASE WHEN user_id % 4 <> 0 THEN '{URL}' || (user_id % 12) END AS iid FROM events),
j AS (SELECT e.*, i.type, i.s_name, CASE WHEN kind = 'other' THEN 'unknown decision' WHEN event_id % 7 = 0 THEN 'evidence is required' WHEN event_id % 5 = 0 THEN 'key does not match'
 WHEN kind IN ('supported', 'corrected') AND iid IS NULL THEN 'institution is required' WHEN iid IS NOT NULL AND i.id IS NULL THEN 'unknown institution' WHEN kind IN ('supported', 'corrected') AND i.type <> 'education' THEN 'not education'
 WHEN iid IS NOT NULL AND kind = 'noneducation' AND i.type = 'education' THEN 'is education' END AS error FROM e LEFT JOIN i ON i.id = e.iid)"""


@query(f"WITH {DECISIONS} SELECT event_id, error FROM j")
def decision_errors(spark, d):
    return curation.judged(decisions(spark, d), institutions(spark, d)).select("event_id", "error")


@query(f"""WITH {DECISIONS}, m AS (SELECT 's' || s_suppkey AS raw, CASE WHEN s_suppkey % 4 = 0 THEN 'manual' ELSE 'auto' END AS status, '{URL}' || (s_suppkey % 12) AS iid FROM supplier),
k AS (SELECT j.* FROM j LEFT JOIN m ON m.raw = j.raw WHERE error IS NULL AND (m.status IS NULL OR m.status <> 'manual' OR (m.iid = j.iid AND kind <> 'unresolved'))),
l AS (SELECT raw, arg_max(kind, event_id) AS kind, arg_max(coalesce(iid, ''), event_id) AS iid FROM k GROUP BY raw)
SELECT coalesce(m.raw, l.raw) AS raw_affiliation, CASE WHEN l.raw IS NULL THEN m.status WHEN kind = 'unresolved' THEN 'unmatched' ELSE 'manual' END AS status, CASE WHEN l.raw IS NULL THEN m.iid ELSE l.iid END AS institution_id FROM m FULL JOIN l ON m.raw = l.raw""")
def map_after_decisions(spark, d):
    s = load(spark, d, "supplier")
    m = s.select(F.concat(F.lit("s"), "s_suppkey").alias("raw_affiliation"), F.when(F.col("s_suppkey") % 4 == 0, "manual").otherwise("auto").alias("status"), F.concat(F.lit(URL), F.col("s_suppkey") % 12).alias("institution_id"))
    return curation.apply_decisions(m, decisions(spark, d), institutions(spark, d), "event_id")[0]


@query("""WITH p AS (SELECT p_partkey AS id, p_name AS raw, p_size, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS i FROM part), u AS (SELECT * FROM p WHERE i = 1),
m AS (SELECT raw FROM u WHERE id % 2 = 0), r AS (SELECT raw, CASE WHEN id % 2 = 1 THEN 'unmapped' ELSE 'review' END AS status, CASE WHEN id % 3 = 0 THEN 0.0 ELSE p_size / 64.0 END AS share, CAST(CASE WHEN id % 3 = 0 THEN 0 ELSE p_size END AS BIGINT) AS occurrences, id FROM u WHERE (id % 2 = 1 AND id % 3 <> 0) OR (id % 2 = 0 AND id % 4 = 0)),
t AS (SELECT *, row_number() OVER (ORDER BY share DESC, occurrences DESC, raw) AS n FROM r)
SELECT CAST(floor((n - 1) / 20) + 1 AS INT) AS batch, raw AS raw_affiliation, status, CAST(share AS DOUBLE) AS share, occurrences, CAST(0 AS BIGINT) AS variants FROM t WHERE n <= 200""")
def review_queue(spark, d):
    u = load(spark, d, "part").groupBy(F.col("p_name").alias("raw")).agg(F.min_by(F.struct("p_partkey", "p_size"), "p_partkey").alias("p")).select("raw", F.col("p.p_partkey").alias("id"), F.col("p.p_size").alias("p_size"))
    m = u.filter("id % 2 = 0").select(F.col("raw").alias("raw_affiliation"), F.when(F.col("id") % 4 == 0, "review").otherwise("auto").alias("status"))
    w = u.filter("id % 3 <> 0").select("raw", F.col("p_size").cast("long").alias("occurrences"), (F.col("p_size") / 64.0).cast("double").alias("share"))
    return curation.queue(m, w, most=200, batch=20).withColumn("variants", F.col("variants").cast("long"))


#: (string, status, institution, matched by) of made-up map rows, one for each outcome of the repairs.
CASES = [
    ("Southeast University, Nanjing, China", "auto", "B", "southeast university"),
    ("Southeast University, Wuxi, China", "manual", "B", "southeast university"),
    ("Acme GmbH, Linz, Austria", "auto", "A", "linz"),
    ("Akita Software, Palo Alto, CA", "auto", "S", "palo alto"),
    ("School of Automation, Southeast University", "auto", "B", "southeast university"),
    ("Physics, University of Test, France", "auto", "D", "ut"),
    ("University of Oz, Australia", "auto", "O", "university of oz"),
    ("Acme Corp., Paris, China", "review", "A", "paris"),
]
INDEX = [("A", "Linz College", "AT", "education"), ("B", "Southeast University", "BD", "education"), ("C", "Southeast University", "CN", "education"), ("D", "University of Test", "DE", "education"), ("O", "University of Oz", "AU", "education"), ("S", "Stanford University", "US", "company")]


def _cases(spark, d):
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(CASES)], "case int, text string, status string, institution_id string, matched_via string")
    index = spark.createDataFrame(INDEX, "id string, display_name string, country_code string, type string").withColumns({"alternatives": F.array().cast("array<string>"), "acronyms": F.array().cast("array<string>")})
    keys = load(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % len(CASES)).cast("int").alias("case"))
    m = keys.join(F.broadcast(rows), "case")  # eight rows
    own = index.select(F.col("id").alias("institution_id"), F.col("display_name").alias("institution_name"), "country_code")
    m = m.join(F.broadcast(own), "institution_id").select(F.concat_ws(" ", F.lit("Unit"), "c_custkey", "text").alias("raw_affiliation"), "c_custkey", "status", "institution_id", "institution_name", F.lit("education").alias("institution_type"), "country_code", "matched_via")
    return m, index


@query("""WITH k AS (SELECT c_custkey, c_custkey % 8 AS k, sum(CASE WHEN c_custkey % 8 < 2 THEN 1 ELSE 0 END) OVER () AS n FROM customer)
SELECT c_custkey, CASE k WHEN 0 THEN 'corrected' WHEN 2 THEN 'noneducation' ELSE 'unresolved' END AS action, CASE k WHEN 2 THEN 'company' WHEN 3 THEN 'evidence' WHEN 4 THEN 'namesake' ELSE 'country' END AS reason, CASE WHEN k IN (0, 1, 4) THEN 'C' END AS other
FROM k WHERE k < 4 OR k = 5 OR (k = 4 AND n >= 5)""")
def country_repair_actions(spark, d):
    m, index = _cases(spark, d)
    return curation.country_repairs(m, index).join(m.select("raw_affiliation", "c_custkey"), "raw_affiliation").drop("raw_affiliation")


@query("""SELECT "check", count(*) AS n FROM (SELECT unnest(CASE c_custkey % 8 WHEN 0 THEN ['abroad'] WHEN 1 THEN ['abroad'] WHEN 2 THEN ['acronym'] WHEN 3 THEN ['type_differs'] WHEN 5 THEN ['acronym', 'abroad'] ELSE [] END) AS "check" FROM customer) GROUP BY "check" """)
def map_check_counts(spark, d):
    m, index = _cases(spark, d)
    return curation.map_checks(m, index).groupBy("check").agg(F.count("*").alias("n"))


@query("""SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS correct, count(*) FILTER (WHERE event_type IN ('view', 'error')) AS wrong, CASE WHEN count(*) FILTER (WHERE event_type IN ('click', 'view', 'error')) > 0 THEN round(count(*) FILTER (WHERE event_type = 'click') / count(*) FILTER (WHERE event_type IN ('click', 'view', 'error')), 6) END AS accuracy
FROM events WHERE event_id % 3 <> 0 AND value > 20 GROUP BY user_id""")
def extractor_accuracy(spark, d):
    e = load(spark, d, "events")
    v = F.when(F.col("event_type") == "click", "correct").when(F.col("event_type") == "view", "wrong").when(F.col("event_type") == "error", "missing").otherwise("unclear")
    slots = e.select("user_id", F.when(F.col("event_id") % 3 != 0, "sample").otherwise("task").alias("kind"), (F.col("value") > 20).alias("image_ok"), v.alias("verdict"))
    return curation.accuracy(slots, ["user_id"]).withColumn("accuracy", F.round("accuracy", 6))


@query("""WITH s AS (SELECT o_orderkey, o_orderpriority, sha256('7:' || o_orderkey) AS h FROM orders), n AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY h, o_orderkey) AS i FROM s)
SELECT o_orderkey, o_orderpriority, CAST(row_number() OVER (ORDER BY sha256(h || 'place'), o_orderkey) AS INT) AS place FROM n WHERE i <= CASE o_orderpriority WHEN '1-URGENT' THEN 50 WHEN '2-HIGH' THEN 30 WHEN '5-LOW' THEN 1 ELSE 0 END""")
def strata_sample(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return curation.stratified(o, "o_orderkey", "o_orderpriority", 100, {"1-URGENT": 0.5, "2-HIGH": 0.3, "5-LOW": 0.001}, seed=7)


@query("""WITH e AS (SELECT event_id % 400 AS member, event_id, user_id, event_type, count(*) OVER (PARTITION BY user_id, event_type) AS n FROM events), f AS (SELECT *, row_number() OVER (PARTITION BY member ORDER BY event_id) AS i FROM e)
SELECT member, event_id, user_id, event_type, n > 1 AS duplicate_suspect FROM f WHERE i = 1""")
def membership_once(spark, d):
    e = load(spark, d, "events").select((F.col("event_id") % 400).alias("member"), "event_id", "user_id", "event_type")
    return curation.once(e, "member", "event_id", ["user_id", "event_type"])


COLLAPSE = """v AS (SELECT l_suppkey % 40 AS venue, CAST(year(l_shipdate) AS INT) AS year, count(*) AS papers, sum(CASE WHEN l_returnflag = 'A' AND (l_suppkey % 40 + year(l_shipdate)) % 3 <> 0 THEN 1.0 ELSE 0.0 END) AS credit FROM lineitem GROUP BY 1, 2),
s AS (SELECT *, 100.0 * credit / papers AS share FROM v WHERE papers >= 20), m AS (SELECT *, median(share) OVER (PARTITION BY venue) AS norm, count(*) OVER (PARTITION BY venue) AS n FROM s),
c AS (SELECT venue, year, round(share, 4) AS share, round(norm, 4) AS norm, CASE WHEN share / norm < 0.4 THEN 'critical' WHEN share / norm < 0.7 THEN 'high' END AS severity FROM m WHERE n >= 3 AND norm >= 10 AND year <= 1997)"""


def _collapse(spark, d):
    li = load(spark, d, "lineitem")
    y, v = F.year("l_shipdate"), F.col("l_suppkey") % 40
    rows = li.groupBy(v.alias("venue"), y.alias("year")).agg(F.count("*").alias("papers"), F.sum(F.when((F.col("l_returnflag") == "A") & ((v + y) % 3 != 0), 1.0).otherwise(0.0)).alias("credit"))
    out = curation.coverage_collapse(rows, "venue", "year", "papers", "credit", last=1997, least_papers=20, least_norm=10)
    return out.withColumns({"share": F.round("share", 4), "norm": F.round("norm", 4)})


@query(f"WITH {COLLAPSE} SELECT * FROM c WHERE severity IS NOT NULL")
def coverage_severity(spark, d):
    return _collapse(spark, d)


@query(f"""WITH {COLLAPSE}, f AS (SELECT CASE WHEN venue < 20 THEN severity ELSE 'medium' END AS severity FROM c WHERE severity IS NOT NULL UNION ALL SELECT 'low' FROM supplier WHERE s_acctbal < 0)
SELECT *, CASE WHEN critical + high > 0 THEN 2 ELSE 0 END AS status, critical + high = 0 AS advance FROM (SELECT count(*) FILTER (WHERE severity = 'critical') AS critical, count(*) FILTER (WHERE severity = 'high') AS high, count(*) FILTER (WHERE severity = 'medium') AS medium, count(*) FILTER (WHERE severity = 'low') AS low FROM f)""")
def verification_outcome(spark, d):
    cover = _collapse(spark, d).select("severity", F.col("venue").cast("string").alias("scope"), F.format_string("%d: %.1f%%", "year", "share").alias("message"))
    poor = load(spark, d, "supplier").filter("s_acctbal < 0").select(F.lit("low").alias("severity"), F.lit("other").alias("scope"), F.col("s_name").alias("message"))
    return curation.outcome(curation.verification({"coverage": cover, "balance": poor}, F.expr("try_cast(scope AS INT) < 20")))


@query("""WITH c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN CASE c_custkey % 3 WHEN 0 THEN 'complete' WHEN 1 THEN 'partial' ELSE 'empty' END END AS r, c_custkey % 5 = 0 AS e, c_custkey % 7 = 0 AS u FROM customer)
SELECT k AS venue, 2020 AS year, CASE WHEN u THEN 'missing' WHEN e THEN 'blocked' ELSE r END AS status, CASE WHEN u THEN 'missing' WHEN e THEN 'timeout' ELSE r END AS reason FROM c WHERE (r IS NOT NULL OR e OR u) AND coalesce(r, '') <> 'complete'""")
def open_scopes(spark, d):
    k = load(spark, d, "customer").select(F.col("c_custkey").alias("venue"), F.lit(2020).alias("year"))
    status = F.when(F.col("venue") % 3 == 0, "complete").when(F.col("venue") % 3 == 1, "partial").otherwise("empty")
    return evidence.open_scopes(k.filter("venue % 2 = 0").select("*", status.alias("status"), F.lit(None).cast("string").alias("reason")), k.filter("venue % 5 = 0").withColumn("reason", F.lit("timeout")), k.filter("venue % 7 = 0").select("*", F.lit("missing").alias("status"), F.lit("").alias("reason")))


@query("""WITH w AS (SELECT o_orderkey AS id, o_custkey % 120 AS a, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey % 120 + 1 END AS n FROM orders)
SELECT id, CASE WHEN a < 100 AND n IS NULL AND id % 11 <> 0 THEN 'complete' WHEN id % 3 = 0 THEN 'absent' WHEN id % 13 = 0 THEN 'id_differs' WHEN id % 7 = 0 THEN 'doi_differs' WHEN id % 17 = 0 THEN 'truncated' WHEN id % 5 = 0 AND a > 0 THEN 'shorter' ELSE 'hydrated' END AS outcome FROM w""")
def hydration_outcomes(spark, d):
    o, i = load(spark, d, "orders"), F.col("o_orderkey")
    a, doi = F.col("o_custkey") % 120, F.concat(F.lit("10.1/"), i)
    works = o.select(i.alias("id"), doi.alias("doi"), a.alias("authors"), F.when(i % 2 == 0, a + 1).alias("authors_count"), (i % 11 == 0).alias("truncated"))
    got = o.filter("o_orderkey % 3 <> 0").select(i.alias("id"), F.when(i % 13 == 0, "x").otherwise(i.cast("string")).alias("found"), F.when(i % 7 == 0, "10.2/x").otherwise(F.concat(F.lit("https://doi.org/"), doi)).alias("doi"), F.when(i % 5 == 0, F.greatest(a - 1, F.lit(0))).otherwise(a + 2).alias("authors"), F.lit(None).cast("long").alias("authors_count"), (i % 17 == 0).alias("truncated"))
    works = works.withColumn("id", F.col("id").cast("string"))
    out = evidence.hydrated(works, got.withColumn("id", F.col("id").cast("string")))
    return out.withColumn("id", F.col("id").cast("long"))


@query("SELECT doc_id FROM documents WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL) GROUP BY doc_id")
def pending_ids(spark, d):
    return evidence.pending_ids(load(spark, d, "documents"), load(spark, d, "labels"), "doc_id")


@query("""SELECT s_suppkey AS venue, CAST(y AS INT) AS year FROM supplier, range(1990, 2000) t(y) WHERE y >= greatest(1990, CASE WHEN s_suppkey % 2 = 0 THEN 1988 + s_suppkey % 14 ELSE 1990 END)
AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND year(l_shipdate) = y AND l_linenumber = 1 AND l_quantity > 45)""")
def missing_scopes(spark, d):
    v = load(spark, d, "supplier").select(F.col("s_suppkey").alias("venue"), F.when(F.col("s_suppkey") % 2 == 0, (1988 + F.col("s_suppkey") % 14).cast("int")).alias("source_first_year"))
    c = load(spark, d, "lineitem").filter("l_linenumber = 1 AND l_quantity > 45").select(F.col("l_suppkey").alias("venue"), F.year("l_shipdate").alias("year"))
    return evidence.missing_scopes(v, c, 1990, 1999)


@query("""SELECT 'o_orderstatus' AS facet, coalesce(o_orderstatus, '(none)') AS value, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'o_orderpriority', coalesce(o_orderpriority, '(none)'), count(*) FROM orders GROUP BY 2
UNION ALL SELECT 'o_year', CAST(year(o_orderdate) AS VARCHAR), count(*) FROM orders GROUP BY 2""")
def facet_counts(spark, d):
    return evidence.facets(load(spark, d, "orders").withColumn("o_year", F.year("o_orderdate")), ["o_orderstatus", "o_orderpriority", "o_year"])


@query("SELECT 'd' || doc_id AS path, CASE WHEN doc_id % 3 = 0 THEN 'unlisted' WHEN doc_id % 5 = 0 THEN 'missing' ELSE 'changed' END AS problem FROM documents WHERE text IS NOT NULL AND (doc_id % 3 = 0 AND doc_id % 5 <> 0 OR doc_id % 3 <> 0 AND (doc_id % 5 = 0 OR doc_id % 7 = 0))")
def release_digests(spark, d):
    docs = load(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", F.concat(F.lit("d"), "doc_id").alias("path"), F.col("text").cast("binary").alias("content"))
    text = F.when(F.col("doc_id") % 7 == 0, F.lit("other").cast("binary")).otherwise(F.col("content"))
    return evidence.digests_differ(docs.filter("doc_id % 3 <> 0").select("path", F.upper(F.sha2(text, 256)).alias("sha256")), docs.filter("doc_id % 5 <> 0").select("path", "content"))


@query("""WITH o AS (SELECT o_custkey AS id, arg_min(o_orderpriority, o_orderkey) FILTER (WHERE o_orderpriority <> '5-LOW') AS country, arg_min(o_orderstatus, o_orderkey) AS type FROM orders GROUP BY 1)
SELECT coalesce(c_custkey, id) AS id, coalesce(CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment END, country) AS country, coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_name END, type) AS type FROM (SELECT * FROM customer WHERE c_custkey % 2 = 0) FULL JOIN o ON id = c_custkey""")
def first_known_metadata(spark, d):
    base = load(spark, d, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 4 == 0, F.col("c_mktsegment")).otherwise("").alias("country"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).alias("type"))
    seen = load(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("country"), F.col("o_orderstatus").alias("type"), "o_orderkey")
    return evidence.first_known(base, seen, ["country", "type"], "o_orderkey")


@query("""WITH t AS (SELECT p_partkey AS id, string_split(p_name, ' ') AS a FROM part WHERE p_name NOT LIKE '%-%'), j AS (SELECT x.id, x.a, y.a AS b FROM t x JOIN t y ON y.id = x.id + 1)
SELECT id, (a[-1] = b[-1] AND a[1][1] = b[1][1]) OR (a[-1] = b[1] AND a[1][1] = b[-1][1]) OR list_sort(list_distinct(a)) = list_sort(list_distinct(b)) OR array_to_string(a, '') IN (array_to_string(b, ''), array_to_string(list_reverse(b), '')) AS agree FROM j""")
def name_agreement(spark, d):
    p = load(spark, d, "part").filter("p_name NOT LIKE '%-%'")
    a = p.select(F.col("p_partkey").alias("id"), name_tokens("p_name").alias("a"))
    b = p.select((F.col("p_partkey") - 1).alias("id"), name_tokens("p_name").alias("b"))
    return a.join(b, "id").select("id", names_agree(F.col("a"), F.col("b")).alias("agree"))
