"""Quality, merge and sampling queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import identity
from ..operators import credit, merge, quality
from .facts import FACTS, S, area_facts, credited, slots
from .registry import load, query

VY = "vy AS (SELECT o_orderpriority AS venue, year(o_orderdate) AS year, count(*) AS papers, sum(o_totalprice) AS price FROM orders GROUP BY ALL)"


def venue_years(spark, d):
    y = F.year("o_orderdate").cast("long").alias("year")
    return load(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("venue"), y).agg(F.count("*").alias("papers"), F.sum("o_totalprice").alias("price"))


LINES = "n AS (SELECT l_orderkey, count(*) AS size FROM lineitem GROUP BY 1), o AS (SELECT orders.*, year(o_orderdate) AS year, o_orderpriority AS venue, coalesce(size, 0) AS size FROM orders LEFT JOIN n ON l_orderkey = o_orderkey)"


def works(spark, d):
    n = load(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("size"))
    o = load(spark, d, "orders")
    return o.join(n, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", F.col("o_orderpriority").alias("venue"), F.year("o_orderdate").cast("long").alias("year"), "o_orderstatus", "o_totalprice", F.coalesce("size", F.lit(0)).cast("long").alias("size"))


CLASSES = ("credited", "resolved", "unresolved", "foreign", "empty")


def _slot_class():
    return F.when(F.col("l_returnflag") == "A", "credited").when(F.col("l_returnflag") == "R", F.when(F.col("l_linestatus") == "F", "resolved").otherwise("unresolved")).when(F.col("l_linestatus") == "O", "foreign").otherwise("empty")


SC = """c AS (SELECT o_orderpriority AS venue, year(o_orderdate) AS year, CASE WHEN l_returnflag = 'A' THEN 'credited' WHEN l_returnflag = 'R' THEN CASE WHEN l_linestatus = 'F' THEN 'resolved' ELSE 'unresolved' END WHEN l_linestatus = 'O' THEN 'foreign' ELSE 'empty' END AS cls
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
q AS (SELECT venue, year, count(*) AS slots, """ + ", ".join(f"count(CASE WHEN cls = '{x}' THEN 1 END) AS {x}" for x in CLASSES) + " FROM c GROUP BY ROLLUP (venue, year))"


def quality_counts(spark, d):
    rows = load(spark, d, "lineitem").join(load(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_orderpriority").alias("venue"), F.year("o_orderdate").cast("long").alias("year"), "l_returnflag", "l_linestatus")
    return quality.slot_classes(rows, _slot_class(), ["venue", "year"], CLASSES)


@query(f"WITH {SC} SELECT * FROM q")
def quality_scan(spark, d):
    return quality_counts(spark, d)


@query(f"""WITH {SC} SELECT venue, year, round(100.0 * (credited + resolved) / slots, 6) AS coverage, round(CASE WHEN credited + resolved > 0 THEN 100.0 * credited / (credited + resolved) END, 6) AS purity,
round(CASE WHEN resolved + unresolved > 0 THEN 100.0 * resolved / (resolved + unresolved) END, 6) AS resolution FROM q""")
def coverage_scorecard(spark, d):
    q = quality_counts(spark, d).withColumn("raw", F.col("resolved") + F.col("unresolved"))
    s = quality.scorecard(q, "credited", "resolved", "raw", "slots")
    return s.select("venue", "year", *(F.round(c, 6).alias(c) for c in ("coverage", "purity", "resolution")))


@query("""SELECT source, count(*) AS docs, count(toxic) AS labelled, round(100.0 * (1 - count(toxic) / count(*)), 6) AS gap, CASE WHEN 1 - count(toxic) / count(*) > 0.65 THEN 'critical' WHEN 1 - count(toxic) / count(*) > 0.6 THEN 'high' WHEN 1 - count(toxic) / count(*) > 0.5 THEN 'medium' END AS severity
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source""")
def area_gap(spark, d):
    j = load(spark, d, "documents").select("doc_id", "source").join(load(spark, d, "labels").select("doc_id", "toxic"), "doc_id", "left")
    g = j.groupBy("source").agg(F.count("*").alias("docs"), F.count("toxic").alias("labelled")).withColumn("part", 1 - F.col("labelled") / F.col("docs"))
    return g.select("source", "docs", "labelled", F.round(100.0 * F.col("part"), 6).alias("gap"), quality.graded(F.col("part"), [(0.65, "critical"), (0.6, "high"), (0.5, "medium")], below=False).alias("severity"))


@query("SELECT n_regionkey AS parent, count(DISTINCT n_nationkey) AS children, count(DISTINCT s_suppkey) AS institutions FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1")
def nested_lineage(spark, d):
    return load(spark, d, "nation").join(load(spark, d, "supplier"), F.col("s_nationkey") == F.col("n_nationkey"), "left").groupBy(F.col("n_regionkey").alias("parent")).agg(F.count_distinct("n_nationkey").alias("children"), F.count_distinct("s_suppkey").alias("institutions"))


@query(f"WITH {LINES} SELECT venue, year, count(*) AS papers, count(CASE WHEN size = 1 THEN 1 END) AS solo, count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS front_matter, CAST(sum(size) AS BIGINT) AS credit, CAST(sum(CASE WHEN size = 1 THEN size ELSE 0 END) AS BIGINT) AS solo_credit, count(CASE WHEN size = 0 THEN 1 END) AS no_authors FROM o GROUP BY ALL")
def venue_stats(spark, d):
    return works(spark, d).groupBy("venue", "year").agg(F.count("*").alias("papers"), F.count_if(F.col("size") == 1).alias("solo"), F.count_if(F.col("o_orderstatus") == "P").alias("front_matter"), F.sum("size").alias("credit"), F.sum(F.when(F.col("size") == 1, F.col("size")).otherwise(0)).alias("solo_credit"), F.count_if(F.col("size") == 0).alias("no_authors"))


@query(f"WITH {LINES}, s AS (SELECT venue, count(*) AS papers, count(CASE WHEN size = 1 THEN 1 END) AS solo FROM o GROUP BY 1) SELECT 'solo' AS \"check\", CASE WHEN 100.0 * solo / papers > 15 THEN 'high' ELSE 'medium' END AS severity, venue AS entity, round(100.0 * solo / papers, 6) AS metric, 'single-author share' AS message FROM s WHERE papers >= 200 AND 100.0 * solo / papers > 8")
def solo_share(spark, d):
    s = works(spark, d).groupBy("venue").agg(F.count("*").alias("papers"), F.count_if(F.col("size") == 1).alias("solo")).filter("papers >= 200").withColumn("p", identity.percent(F.col("solo"), F.col("papers")))
    return quality.flags(s, "solo", quality.graded(F.col("p"), [(15, "high"), (8, "medium")], below=False), "venue", F.round("p", 6), "single-author share")


@query(f"WITH {VY}, g AS (SELECT venue, list(year ORDER BY year) AS ys FROM vy GROUP BY venue) SELECT venue, len(ys) >= 3 AND len(list_filter(range(1, len(ys)), lambda i: ys[i + 1] - ys[i] <> 2)) = 0 AS biennial, len(odd) >= 3 AND len(list_filter(range(1, len(odd)), lambda i: odd[i + 1] - odd[i] <> 2)) = 0 AS odd_years FROM (SELECT *, list_filter(ys, lambda y: y % 2 = 1 AND y < 2000) AS odd FROM g)")
def biennial(spark, d):
    g = venue_years(spark, d).groupBy("venue").agg(F.collect_set("year").alias("ys"))
    return g.select("venue", identity.is_biennial(F.col("ys")).alias("biennial"), identity.is_biennial(F.filter("ys", lambda y: (y % 2 == 1) & (y < 2000))).alias("odd_years"))


@query(f"WITH {VY} SELECT year, count(DISTINCT venue) AS venues FROM vy WHERE papers >= 10 GROUP BY year HAVING count(DISTINCT venue) < 6")
def sparse_years(spark, d):
    return venue_years(spark, d).filter("papers >= 10").groupBy("year").agg(F.count_distinct("venue").alias("venues")).filter("venues < 6")


DAYS = "e AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, sum(value) AS v FROM events GROUP BY ALL)"


def daily(spark, d):
    return load(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.sum("value").alias("v"))


@query(f"WITH {DAYS}, w AS (SELECT event_type, CAST(day AS VARCHAR) AS day, n, median(n) OVER (PARTITION BY event_type) AS norm, count(*) OVER (PARTITION BY event_type) AS c FROM e) SELECT event_type, day, n, norm, round(n / norm, 6) AS ratio, CASE WHEN n / norm < 0.4 THEN 'critical' WHEN n / norm < 0.7 THEN 'high' END AS severity FROM w WHERE c >= 3")
def coverage_collapse(spark, d):
    rows = quality.against_own_median(daily(spark, d), "event_type", "n")
    return rows.select("event_type", F.col("day").cast("string").alias("day"), "n", F.col("norm").cast("double").alias("norm"), F.round("ratio", 6).alias("ratio"), quality.graded(F.col("ratio"), [(0.4, "critical"), (0.7, "high")]).alias("severity"))


YEARLY = "t AS (SELECT l_suppkey AS k, year(l_shipdate) AS year, CAST(count(*) AS DOUBLE) AS n FROM lineitem GROUP BY ALL)"


def yearly(spark, d):
    return load(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("k"), F.year("l_shipdate").cast("long").alias("year")).agg(F.count("*").cast("double").alias("n"))


@query(f"""WITH {YEARLY}, p AS (SELECT a.k, a.year, b.n AS n2, abs(a.year - b.year) AS gap, row_number() OVER (PARTITION BY a.k, a.year ORDER BY abs(a.year - b.year), b.year) AS i FROM t a JOIN t b ON a.k = b.k AND a.year <> b.year AND b.year <= 2000 WHERE a.year <= 2000),
m AS (SELECT k, year, median(n2) AS norm FROM p WHERE i <= 6 AND gap <= 6 GROUP BY k, year HAVING count(*) >= 3),
o AS (SELECT k, year, n, row_number() OVER w AS i, coalesce(lead(n) OVER w, lag(n) OVER w) AS beside FROM t WHERE year <= 2000 WINDOW w AS (PARTITION BY k ORDER BY year)),
z AS (SELECT k, median(n) AS norm, max_by(n, year) AS beside FROM t WHERE year > 1994 AND year <= 2000 GROUP BY k HAVING count(*) >= 3),
u AS (SELECT k, year, n, norm, CASE WHEN n >= 1.2 * norm AND (beside IS NULL OR n >= 1.1 * beside) THEN 'spike' WHEN n <= 0.9 * norm AND i > 2 THEN 'dip' END AS kind FROM m JOIN o USING (k, year)
 UNION ALL SELECT t.k, year, n, norm, CASE WHEN n >= 1.2 * norm AND n >= 1.1 * beside THEN 'spike' END FROM t JOIN z USING (k) WHERE year > 2000)
SELECT * FROM u WHERE kind IS NOT NULL AND norm >= 20""")
def count_spike(spark, d):
    return quality.local_outliers(yearly(spark, d), "k", "year", "n", spike=1.2, beside=1.1, dip=0.9, last=2000)


@query(f"WITH {YEARLY}, w AS (SELECT *, lag(n) OVER (PARTITION BY k ORDER BY year) AS previous, sum(n) OVER (PARTITION BY k) AS total, count(*) OVER (PARTITION BY k) AS c FROM t) SELECT k, year, previous, n FROM w WHERE previous >= 3 AND n < 0.75 * previous AND n < 100000 AND total >= 10 AND c >= 3 AND year < (SELECT max(year) FROM t)")
def cliff_drop(spark, d):
    return quality.cliffs(yearly(spark, d), "k", "year", "n", drop=0.25, most_after=100000)


@query(f"WITH {YEARLY}, w AS (SELECT *, avg(n) OVER (PARTITION BY k) AS mean, stddev_pop(n) OVER (PARTITION BY k) AS sd, count(*) OVER (PARTITION BY k) AS c FROM t) SELECT k, year, n, round(mean, 6) AS mean, round(sd, 6) AS sd FROM w WHERE c >= 3 AND abs(n - mean) > 1.9 * sd")
def sigma_outlier(spark, d):
    return quality.sigma_outliers(yearly(spark, d), "k", "n", 1.9).select("k", "year", "n", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"))


@query(f"WITH {YEARLY}, l AS (SELECT k, list(n ORDER BY n) AS ns FROM t GROUP BY k) SELECT k, ns[len(ns) // 2 + 1] AS upper_median, list_aggregate(ns, 'median') AS median FROM l")
def upper_median(spark, d):
    return yearly(spark, d).groupBy("k").agg(quality.upper_median(F.collect_list("n")).alias("upper_median"), F.median("n").alias("median"))


@query(f"WITH {LINES}, g AS (SELECT venue, year, count(CASE WHEN size = 4 THEN 1 END) AS at_0, count(CASE WHEN size = 3 THEN 1 END) AS at_1, count(CASE WHEN size = 2 THEN 1 END) AS at_2 FROM o GROUP BY ALL) SELECT * FROM g WHERE at_0 >= 5 AND at_0 >= 1 * greatest(at_1, at_2, 1)")
def truncation_spike(spark, d):
    return quality.truncation_spike(works(spark, d), ["venue", "year"], "size", 4, 5, 1)


@query(f"WITH {LINES}, z AS (SELECT venue, year, count(*) AS works, count(CASE WHEN size = 0 THEN 1 END) AS zero FROM o GROUP BY ALL HAVING count(*) >= 10), w AS (SELECT *, median(zero / works) OVER (PARTITION BY venue) AS norm FROM z) SELECT venue, year, works, zero, round(norm, 6) AS norm FROM w WHERE zero / works > 1.2 * norm")
def zero_author_spike(spark, d):
    z = works(spark, d).groupBy("venue", "year").agg(F.count("*").alias("works"), F.count_if(F.col("size") == 0).alias("zero")).filter("works >= 10").withColumn("rate", F.col("zero") / F.col("works"))
    w = z.withColumn("norm", F.median("rate").over(Window.partitionBy("venue")))
    return w.filter(F.col("rate") > 1.2 * F.col("norm")).select("venue", "year", "works", "zero", F.round("norm", 6).alias("norm"))


@query("SELECT l_orderkey AS work, l_suppkey AS author, count(*) - 1 AS extra FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_authors(spark, d):
    return load(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("work"), F.col("l_suppkey").alias("author")).agg((F.count("*") - 1).alias("extra")).filter("extra > 0")


@query("""SELECT turn, count(*) AS n, count(CASE WHEN regexp_matches(text, 'collaboration|consortium|\\bteam\\b|working group|study group|\\bcommittee\\b|\\bthe\\b.+\\b(?:project|survey|experiment|mission)\\b|^\\(.*\\)$', 'i') THEN 1 END) AS groups FROM conversations GROUP BY turn""")
def group_names(spark, d):
    return load(spark, d, "conversations").groupBy("turn").agg(F.count("*").alias("n"), F.count_if(identity.is_group_name(F.col("text"))).alias("groups"))


@query(f"""WITH {S}, r AS (SELECT *, CASE WHEN status = 'P' THEN 'non_research' WHEN venue = '5-LOW' THEN 'low_venue' WHEN share = 1 THEN 'single_author' END AS reason FROM s)
SELECT reason, venue, institution, count(*) AS slots, round(sum(share), 4) AS credit FROM r WHERE reason IS NOT NULL GROUP BY GROUPING SETS ((reason), (venue, reason), (reason, institution))""")
def dropped_reason_sets(spark, d):
    reasons = [(F.col("status") == "P", "non_research"), (F.col("venue") == "5-LOW", "low_venue"), (F.col("share") == 1, "single_author")]
    return quality.dropped_by_reason(credited(spark, d), reasons, "share", "venue", "institution").withColumn("credit", F.round("credit", 4)).select("reason", "venue", "institution", "slots", "credit")


@query("""WITH g AS (SELECT l_suppkey AS k, sum(l_quantity) AS q, count(*) AS n, max_by(l_partkey, (l_quantity, l_partkey)) AS example FROM lineitem GROUP BY 1)
SELECT CASE WHEN q < 15500 THEN '(other)' ELSE CAST(k AS VARCHAR) END AS k, round(sum(q), 4) AS l_quantity, CAST(sum(n) AS BIGINT) AS n, max(CASE WHEN q >= 15500 THEN example END) AS example FROM g GROUP BY 1""")
def mismap_example(spark, d):
    rows = load(spark, d, "lineitem").select(F.col("l_suppkey").alias("k"), "l_quantity", "l_partkey")
    return quality.small_tail(rows, "k", "l_quantity", "l_partkey", 15500).withColumn("l_quantity", F.round("l_quantity", 4))


@query("""WITH p AS (SELECT s_suppkey AS supp, b AS brand FROM (SELECT s_suppkey FROM supplier) CROSS JOIN (SELECT DISTINCT p_brand AS b FROM part))
SELECT supp, brand FROM p WHERE NOT EXISTS (SELECT 1 FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_suppkey = supp AND p_brand = brand AND l_quantity >= 45)""")
def tripwire(spark, d):
    known = load(spark, d, "supplier").select(F.col("s_suppkey").alias("supp")).crossJoin(F.broadcast(load(spark, d, "part").select(F.col("p_brand").alias("brand")).distinct()))
    scored = load(spark, d, "lineitem").filter("l_quantity >= 45").join(load(spark, d, "part"), F.col("p_partkey") == F.col("l_partkey")).select(F.col("l_suppkey").alias("supp"), F.col("p_brand").alias("brand"))
    return quality.tripwire(known, scored, ["supp", "brand"])


@query("WITH b AS (SELECT DISTINCT o_custkey AS k, year(o_orderdate) AS year FROM orders), s AS (SELECT k, min(year) AS a, max(year) AS z FROM b GROUP BY k) SELECT k, y AS year FROM (SELECT k, unnest(range(a, z + 1)) AS y FROM s) x WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.k = x.k AND b.year = x.y)")
def missing_years(spark, d):
    rows = load(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.year("o_orderdate").cast("long").alias("year"))
    return quality.missing_years(rows, "k", "year")


@query("""WITH b AS (SELECT DISTINCT o_custkey AS k, year(o_orderdate) AS y FROM orders), r AS (SELECT k, y, y - row_number() OVER (PARTITION BY k ORDER BY y) AS g FROM b),
i AS (SELECT k, min(y) AS a, max(y) AS z FROM r GROUP BY k, g) SELECT k, string_agg(CASE WHEN a = z THEN CAST(a AS VARCHAR) ELSE a || '–' || z END, ', ' ORDER BY a) AS years FROM i GROUP BY k""")
def year_ranges(spark, d):
    return load(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(identity.year_runs(F.collect_set(F.year("o_orderdate"))).alias("years"))


@query("""WITH a AS (SELECT source, avg(CASE WHEN toxic = 0 THEN 100.0 ELSE 0 END) AS v FROM documents JOIN labels USING (doc_id) GROUP BY 1), b AS (SELECT source, avg(CASE WHEN quality = 1 THEN 100.0 ELSE 0 END) AS v FROM documents JOIN labels USING (doc_id) GROUP BY 1)
SELECT source, round(b.v, 6) AS before, round(a.v, 6) AS v, CASE WHEN b.v - a.v > 50 THEN 'critical' WHEN b.v - a.v > 10 THEN 'high' ELSE 'medium' END AS severity FROM a JOIN b USING (source) WHERE b.v - a.v > 0.5""")
def snapshot_regression(spark, d):
    j = load(spark, d, "documents").join(load(spark, d, "labels"), "doc_id")
    share = lambda c: j.groupBy("source").agg(F.avg(F.when(c, 100.0).otherwise(0.0)).alias("v"))
    out = quality.snapshot_regression(share(F.col("toxic") == 0), share(F.col("quality") == 1), ["source"], "v", [(50, "critical"), (10, "high"), (0.5, "medium")])
    return out.select("source", F.round("before", 6).alias("before"), F.round("v", 6).alias("v"), "severity")


RK = "rk AS (SELECT institution, year, row_number() OVER (PARTITION BY year ORDER BY round(sum(adjusted_count), 6) DESC, institution) AS rank FROM f GROUP BY institution, year)"


@query(f"""WITH {S}, {FACTS}, {RK}, a AS (SELECT institution, rank AS now FROM rk WHERE year = 2000 AND rank <= 50), b AS (SELECT institution, rank AS before FROM rk WHERE year = 1999 AND rank <= 50)
SELECT * FROM (SELECT institution, now, before, CASE WHEN before IS NULL THEN 'new' WHEN now IS NULL THEN 'gone' WHEN abs(now - before) >= 10 THEN 'moved' END AS kind FROM a FULL JOIN b USING (institution)) WHERE kind IS NOT NULL""")
def top50_movers(spark, d):
    t = area_facts(spark, d).groupBy("institution", "year").agg(F.round(F.sum("adjusted_count"), 6).alias("s"))
    t = t.withColumn("rank", F.row_number().over(Window.partitionBy("year").orderBy(F.desc("s"), "institution")).cast("long"))
    return quality.top_movers(t.filter("year = 2000"), t.filter("year = 1999"), "institution", "rank")


@query(f"""WITH {S}, {FACTS}, r AS (SELECT institution, area, year, adjusted_count AS a FROM f), c AS (SELECT institution, area, year, sum(share) AS a FROM s WHERE status = 'F' GROUP BY ALL)
SELECT count(CASE WHEN c.institution IS NULL THEN 1 END) AS missing, count(CASE WHEN r.institution IS NULL THEN 1 END) AS extra, (SELECT count(*) FROM (SELECT 1 FROM f GROUP BY institution, area, year HAVING count(*) > 1)) AS duplicates, count(CASE WHEN abs(r.a - c.a) > 1e-4 THEN 1 END) AS adjusted_count_mismatches, round(max(abs(r.a - c.a)), 6) AS adjusted_count_largest
FROM r FULL JOIN c ON r.institution = c.institution AND r.area = c.area AND r.year = c.year""")
def compare_tables(spark, d):
    changed = credit.institution_facts(credited(spark, d).filter("status = 'F'"), ["institution", "area", "year"], ["work"])
    out = quality.compare_tables(area_facts(spark, d), changed, ["institution", "area", "year"], ["adjusted_count"])
    return out.withColumn("adjusted_count_largest", F.round("adjusted_count_largest", 6))


@query(f"""WITH {S}, {FACTS}, a AS (SELECT area, year, sum(adjusted_count) AS l FROM f GROUP BY ALL), b AS (SELECT area, year, sum(share) AS r FROM s WHERE NOT (venue = '5-LOW' AND year = 1997) AND area <> 'BUILDING' GROUP BY ALL)
SELECT area, year, round(l, 4) AS left_sum, round(r, 4) AS right_sum FROM a FULL JOIN b USING (area, year) WHERE l IS NULL OR r IS NULL OR abs(l - r) > 1e-4""")
def reconcile_area_venue(spark, d):
    """Area sums against venue sums that lack one venue's year and one area: those rows and no others."""
    c = credited(spark, d)
    kept = c.filter("NOT (venue = '5-LOW' AND year = 1997) AND area <> 'BUILDING'")
    venue = credit.institution_facts(kept, ["institution", "area", "venue", "year"], ["work"])
    out = quality.reconcile(credit.institution_facts(c, ["institution", "area", "year"], ["work"]), venue, ["area", "year"], "adjusted_count", 1e-4)
    return out.select("area", "year", F.round("left_sum", 4).alias("left_sum"), F.round("right_sum", 4).alias("right_sum"))


@query(f"""WITH {S}, {FACTS}, t AS (SELECT institution, area, year, round(sum(share), 5) AS v FROM s WHERE author % 50 <> 0 GROUP BY author, institution, area, year), b AS (SELECT institution, area, year, sum(v) AS r, count(*) AS n FROM t GROUP BY ALL)
SELECT institution, area, year, round(adjusted_count, 5) AS left_sum, round(r, 5) AS right_sum FROM f FULL JOIN b USING (institution, area, year) WHERE adjusted_count IS NULL OR r IS NULL OR abs(adjusted_count - r) > 0.000005 * (n + 1) + 1e-8""")
def reconcile_author(spark, d):
    """Author sums of five-place rows against institution sums, within the rounding of that many rows; some authors lack."""
    author = credit.author_facts(credited(spark, d).filter("author % 50 <> 0"), ["author", "institution", "area", "year"]).withColumn("adjusted_count", F.round("adjusted_count", 5))
    limit = 0.000005 * (F.col("right_n") + 1) + 1e-8
    out = quality.reconcile(area_facts(spark, d), author, ["institution", "area", "year"], "adjusted_count", limit)
    return out.select("institution", "area", "year", F.round("left_sum", 5).alias("left_sum"), F.round("right_sum", 5).alias("right_sum"))


@query("""WITH s AS (SELECT lang, count(*) AS n, count(CASE WHEN quality = 1 THEN 1 END) AS k FROM documents JOIN labels USING (doc_id) GROUP BY lang), p AS (SELECT *, k / n AS p FROM s)
SELECT lang, n, k, round(greatest(0.0, (p + 1.96 * 1.96 / (2 * n) - 1.96 * sqrt(p * (1 - p) / n + 1.96 * 1.96 / (4 * n * n))) / (1 + 1.96 * 1.96 / n)), 6) AS low, round(least(1.0, (p + 1.96 * 1.96 / (2 * n) + 1.96 * sqrt(p * (1 - p) / n + 1.96 * 1.96 / (4 * n * n))) / (1 + 1.96 * 1.96 / n)), 6) AS high FROM p""")
def wilson(spark, d):
    s = load(spark, d, "documents").join(load(spark, d, "labels"), "doc_id").groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.col("quality") == 1).alias("k"))
    low, high = quality.wilson(F.col("k"), F.col("n"))
    return s.select("lang", "n", "k", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


@query("""SELECT unnest(['quality', 'clean', 'long']) AS gate, unnest([round(avg(CASE WHEN quality = 1 THEN 1.0 ELSE 0 END), 6), round(avg(CASE WHEN toxic = 0 THEN 1.0 ELSE 0 END), 6), round(avg(CASE WHEN n_chars > 500 THEN 1.0 ELSE 0 END), 6)]) AS rate, unnest([0.9, 0.8, 0.5])::DOUBLE AS least,
unnest([avg(CASE WHEN quality = 1 THEN 1.0 ELSE 0 END) >= 0.9, avg(CASE WHEN toxic = 0 THEN 1.0 ELSE 0 END) >= 0.8, avg(CASE WHEN n_chars > 500 THEN 1.0 ELSE 0 END) >= 0.5]) AS passed FROM documents JOIN labels USING (doc_id)""")
def gates(spark, d):
    j = load(spark, d, "documents").join(load(spark, d, "labels"), "doc_id")
    out = quality.gates(j, {"quality": (F.col("quality") == 1, 0.9), "clean": (F.col("toxic") == 0, 0.8), "long": (F.col("n_chars") > 500, 0.5)})
    return out.withColumn("rate", F.round("rate", 6))


@query("WITH g AS (SELECT lang, coalesce(quality, -1) AS outcome, count(*) AS draws FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1, 2) SELECT *, round(100.0 * draws / sum(draws) OVER (PARTITION BY lang), 6) AS share FROM g")
def strata_outcomes(spark, d):
    g = load(spark, d, "documents").join(load(spark, d, "labels"), "doc_id", "left").groupBy("lang", F.coalesce("quality", F.lit(-1)).alias("outcome")).agg(F.count("*").alias("draws"))
    return g.withColumn("share", F.round(100.0 * F.col("draws") / F.sum("draws").over(Window.partitionBy("lang")), 6))


@query("WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY sha256(CAST(doc_id AS VARCHAR)), doc_id) AS i FROM documents) SELECT doc_id, source FROM r WHERE i <= 5")
def hash_sample(spark, d):
    return merge.hash_sample(load(spark, d, "documents").select("doc_id", "source"), "doc_id", 5, ["source"])


@query()
def pps_sample(spark, d):
    """Two hundred draws in proportion to price; its points come from a hash that DuckDB does not have."""
    return merge.weighted_sample(load(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", "o_totalprice", 200, 7)


CONV = "c AS (SELECT conv_id, list(role ORDER BY turn, role, text) AS roles, list(role ORDER BY turn DESC, role, text) AS back FROM conversations GROUP BY conv_id)"


def conversations(spark, d):
    c = load(spark, d, "conversations")
    up = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda x: x["role"])
    down = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("turn")).alias("turn"), "role", "text"))), lambda x: x["role"])
    return c.groupBy("conv_id").agg(up.alias("roles"), down.alias("back"))


@query(f"""WITH {CONV} SELECT conv_id, CASE WHEN roles = back THEN 'exact' WHEN list_sort(roles) = list_sort(back) THEN 'reordered' ELSE 'other' END AS outcome, len(roles) AS n FROM c""")
def byline_compare(spark, d):
    c = conversations(spark, d)
    out = merge.byline_outcome(F.col("roles"), F.col("back"))
    return c.select("conv_id", out.alias("outcome"), F.size("roles").cast("long").alias("n"))


@query()
def byline_lcs(spark, d):
    """Longest common subsequence; not expressible in SQL."""
    return conversations(spark, d).select("conv_id", F.size(merge.align("roles", "back")).alias("common"))


@query(f"WITH {CONV} SELECT conv_id, list_filter(roles, lambda r: r = 'user') AS users, len(roles) AS overlap FROM c")
def multiset_overlap(spark, d):
    return conversations(spark, d).select("conv_id", F.filter("roles", lambda r: r == "user").alias("users"), merge.multiset_overlap(F.col("roles"), F.col("back")).cast("long").alias("overlap"))


@query(f"WITH {CONV} SELECT conv_id, array_to_string(CASE WHEN len(list_filter(range(1, len(roles) + 1), lambda i: roles[i] <> back[i] AND roles[i] <> 'user')) = 0 THEN list_transform(range(1, len(roles) + 1), lambda i: CASE WHEN roles[i] = 'user' THEN back[i] ELSE roles[i] END) ELSE roles END, ',') AS filled FROM c")
def positional_fill(spark, d):
    fill = merge.positional_fill(F.col("roles"), F.col("back"), lambda a, b: (a == b) | (a == "user"), lambda a: a == "user")
    return conversations(spark, d).select("conv_id", F.array_join(fill, ",").alias("filled"))


@query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY n_chars DESC, doc_id DESC) AS i FROM documents) SELECT source, lang, doc_id, n_chars FROM r WHERE i = 1")
def richest_duplicate(spark, d):
    return merge.best_of(load(spark, d, "documents").select("source", "lang", "doc_id", "n_chars"), ["source", "lang"], [F.col("n_chars"), F.col("doc_id")])


@query("SELECT doc_id, CASE WHEN lang IN ('en', 'fr') THEN 'fresh' ELSE 'base' END AS origin, CASE WHEN lang IN ('en', 'fr') THEN n_chars + 1 ELSE n_chars END AS n_chars FROM documents WHERE lang IN ('en', 'fr', 'de')")
def overlay_merge(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "n_chars", "lang")
    base = docs.filter("lang IN ('en', 'de')").withColumn("origin", F.lit("base"))
    fresh = docs.filter("lang IN ('en', 'fr')").withColumn("n_chars", F.col("n_chars") + 1).withColumn("origin", F.lit("fresh"))
    return merge.overlay(base, fresh, ["doc_id"]).drop("lang")


@query("SELECT doc_id, quality FROM labels UNION ALL SELECT doc_id, NULL FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def membership_preserve(spark, d):
    docs = load(spark, d, "documents").select("doc_id", F.lit(None).cast("int").alias("quality"))
    return merge.overlay(docs, load(spark, d, "labels").select("doc_id", "quality"), ["doc_id"])


@query("SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'O' THEN o_custkey WHEN o_orderpriority = '1-URGENT' THEN -o_custkey END AS v, CASE WHEN o_orderstatus = 'O' THEN 'cheap' WHEN o_orderpriority = '1-URGENT' THEN 'dear' END AS source FROM orders")
def discovery_cascade(spark, d):
    o = load(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("v"), "o_orderstatus", "o_orderpriority")
    return merge.cascade(o, [("cheap", o.filter("o_orderstatus = 'O'")), ("dear", o.filter("o_orderpriority = '1-URGENT'").withColumn("v", -F.col("v")))], "k", "v")


@query("""WITH a AS (SELECT doc_id, lang, n_chars FROM documents WHERE source <> 'src1'), b AS (SELECT doc_id, CASE WHEN source = 'src3' THEN 'xx' ELSE lang END AS lang, n_chars + CASE WHEN lang = 'fr' THEN 1 ELSE 0 END AS n_chars FROM documents WHERE source <> 'src2'),
j AS (SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, a.doc_id AS x, b.doc_id AS y, a.lang AS l1, b.lang AS l2, a.n_chars AS n1, b.n_chars AS n2 FROM a FULL JOIN b ON a.doc_id = b.doc_id)
SELECT * FROM (SELECT doc_id, CASE WHEN y IS NULL THEN 'a_only' WHEN x IS NULL THEN 'b_only' ELSE concat_ws(',', CASE WHEN l1 <> l2 THEN 'lang' END, CASE WHEN n1 <> n2 THEN 'n_chars' END) END AS issues FROM j) WHERE issues <> ''""")
def full_outer_reconcile(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "lang", "n_chars", "source")
    other = docs.filter("source <> 'src2'").withColumn("n_chars", F.col("n_chars") + F.when(F.col("lang") == "fr", 1).otherwise(0)).withColumn("lang", F.when(F.col("source") == "src3", "xx").otherwise(F.col("lang")))
    return merge.reconcile_sources(docs.filter("source <> 'src1'"), other, "doc_id", ["lang", "n_chars"], ("a", "b"))


@query("""WITH a AS (SELECT s_nationkey AS w, s_suppkey AS l, s_name AS n, substr(s_name, 10, 8) AS t FROM supplier), b AS (SELECT s_nationkey AS w, s_suppkey + 1000 AS r, CASE WHEN s_acctbal < 2000 THEN NULL ELSE s_name END AS n, substr(s_name, 10, 8) AS t FROM supplier),
x AS (SELECT w, l, r, 0 AS stage FROM a JOIN b USING (w, n)), y AS (SELECT a.w, l, r, 1 AS stage FROM a JOIN b USING (w, t) WHERE l NOT IN (SELECT l FROM x) AND r NOT IN (SELECT r FROM x))
SELECT w, l, r, stage FROM (SELECT *, count(*) OVER (PARTITION BY w, l) AS c1, count(*) OVER (PARTITION BY w, r) AS c2 FROM (SELECT * FROM x UNION ALL SELECT * FROM y)) WHERE c1 = 1 AND c2 = 1""")
def staged_match(spark, d):
    s = load(spark, d, "supplier")
    tail = F.substring("s_name", 10, 8).alias("t")
    a = s.select(F.col("s_nationkey").alias("w"), F.col("s_suppkey").alias("l"), F.col("s_name").alias("n"), tail)
    b = s.select(F.col("s_nationkey").alias("w"), (F.col("s_suppkey") + 1000).alias("r"), F.when(F.col("s_acctbal") >= 2000, F.col("s_name")).alias("n"), tail)
    return merge.unique_matches(a, b, "l", "r", [["n"], ["t"]], ["w"])


@query("""WITH k AS (SELECT doc_id, source, lang, text, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS i FROM documents) SELECT doc_id, source, lang FROM k WHERE i = 1""")
def dedup_first_wins(spark, d):
    return credit.first_owner(load(spark, d, "documents").select("doc_id", "source", "lang", "text"), ["text"], ["doc_id"]).drop("text")


@query("""WITH k AS (SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS i FROM events) SELECT event_id, user_id, event_type FROM k WHERE i = 1 AND event_type <> 'click'""")
def dedup_type_owner(spark, d):
    """The first event of a user and day owns it, also if its type earns nothing."""
    e = load(spark, d, "events").withColumn("day", F.to_date("ts"))
    return credit.owned_research(e, ["user_id", "day"], ["ts", "event_id"], "event_type", non_research=("click",)).select("event_id", "user_id", "event_type")


@query("""WITH x AS (SELECT * FROM documents WHERE NOT (source = 'src1' AND lang = 'fr')), k AS (SELECT *, row_number() OVER (PARTITION BY source, text ORDER BY doc_id) AS i FROM x) SELECT doc_id, source FROM k WHERE i = 1 AND NOT EXISTS (SELECT 1 FROM benchmark b WHERE b.text = k.text)""")
def exclude_venue_keys(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "source", "text", "lang")
    out = docs.filter("source = 'src1' AND lang = 'fr'").select("source", "doc_id")
    return credit.owned_research(docs.withColumn("type", F.lit("article")), ["source", "text"], ["doc_id"], "type", out, load(spark, d, "benchmark").select("text"), ["source", "doc_id"]).select("doc_id", "source")
