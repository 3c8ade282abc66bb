"""Identity and resolution queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import identity
from ..operators import resolve
from .registry import load, query

WORDS = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'))"


@query(r"""SELECT page_id, regexp_replace(regexp_replace(lower(trim(url)), '^https?://', ''), '[?#].*$', '') AS address, nullif(regexp_replace(lower(trim(url)), '^https?://(dx\.)?doi\.org/', ''), '') AS doi FROM pages""")
def url_norm(spark, d):
    u = F.lower(F.trim("url"))
    return load(spark, d, "pages").select("page_id", F.regexp_replace(F.regexp_replace(u, "^https?://", ""), "[?#].*$", "").alias("address"), identity.norm_doi(F.col("url")).alias("doi"))


TITLE = "text"


@query(f"SELECT doc_id, regexp_replace(regexp_replace(lower({TITLE}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS hyphens, {WORDS.format(TITLE)} AS blanks FROM documents")
def title_norm(spark, d):
    t = F.col("text")
    return load(spark, d, "documents").select("doc_id", identity.title_key(t).alias("hyphens"), identity.words_key(t).alias("blanks"))


@query(f"""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'doi:10.1000/' || doc_id ELSE 'vt:' || source || '|' || 2000 || '|' || regexp_replace(regexp_replace(lower({TITLE}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') END AS work_key FROM documents""")
def work_key(spark, d):
    doi = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(" https://doi.org/10.1000/"), F.col("doc_id").cast("string")))
    return load(spark, d, "documents").select("doc_id", identity.work_key(doi, F.col("text"), F.col("source"), F.lit(2000)).alias("work_key"))


@query(f"""SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'doi:10.1000/' || doc_id WHEN doc_id % 4 = 1 THEN 'openalex:W' || doc_id WHEN doc_id % 4 = 2 THEN 's2:' || doc_id ELSE 'vt:' || source || '|' || 2000 || '|' || regexp_replace(regexp_replace(lower({TITLE}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') END AS record_key FROM documents""")
def record_key(spark, d):
    i, n = F.col("doc_id").cast("string"), F.col("doc_id") % 4
    return load(spark, d, "documents").select("doc_id", identity.record_key(F.when(n == 0, F.concat(F.lit("http://dx.doi.org/10.1000/"), i)), F.lit("x"), F.when(n == 1, F.concat(F.lit("https://openalex.org/W"), i)), F.when(n == 2, F.col("doc_id")), F.col("text"), F.col("source"), F.lit(2000)).alias("record_key"))


@query("SELECT s_suppkey, 'https://openalex.org/I' || s_suppkey AS full_id, 'I' || s_suppkey AS short_id, substr(sha1(s_name), 1, 16) AS row_key FROM supplier")
def inst_id(spark, d):
    raw = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("I"), F.col("s_suppkey").cast("string"))).otherwise(F.concat(F.lit("http://openalex.org/I"), F.col("s_suppkey").cast("string"), F.lit("/")))
    full = identity.institution_id(raw)
    return load(spark, d, "supplier").select("s_suppkey", full.alias("full_id"), identity.short_id(full).alias("short_id"), identity.row_key(F.col("s_name")).alias("row_key"))


@query("SELECT doc_id, doc_id % 10 IN (1, 7) AS matched FROM documents")
def doi_prefix(spark, d):
    doi = F.concat(F.lit("10.10"), (F.col("doc_id") % 10).cast("string"), F.lit("/x"))
    return load(spark, d, "documents").select("doc_id", identity.matches_prefix(doi, F.lit("10.101/, 10.107/")).alias("matched"))


@query("SELECT doc_id, year, (CASE WHEN doc_id % 2 = 0 THEN year BETWEEN 2018 AND 2021 ELSE year BETWEEN 2019 AND 2021 END) AS plausible FROM (SELECT doc_id, 2015 + doc_id % 10 AS year FROM documents)")
def year_window(spark, d):
    doi = F.when(F.col("doc_id") % 2 == 0, "10.48550/arxiv.1v2").otherwise("10.1/x")
    return load(spark, d, "documents").select("doc_id", (2015 + F.col("doc_id") % 10).alias("year")).withColumn("plausible", identity.year_plausible(doi, F.col("year"), F.lit(2020)))


RULES = [("^the ", "article"), ("heit|keit", "german"), ("eaux|ment", "french"), ("ing|tion", "english")]


@query(f"SELECT doc_id, CASE WHEN regexp_matches(lower({TITLE}), '^the ') THEN 'article' WHEN regexp_matches(lower({TITLE}), 'heit|keit') THEN 'german' WHEN regexp_matches(lower({TITLE}), 'eaux|ment') THEN 'french' WHEN regexp_matches(lower({TITLE}), 'ing|tion') THEN 'english' END AS cluster FROM documents")
def ordered_rules(spark, d):
    return resolve.first_rule(load(spark, d, "documents").select("doc_id", F.col("text").alias("t")), "t", RULES).select("doc_id", "cluster")


@query(r"SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, len(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) AS links, regexp_extract(html, '<html lang=\"([a-z]+)\"', 1) AS lang FROM pages")
def html_titles(spark, d):
    from ..sources import html

    return load(spark, d, "pages").select("page_id", html.title(F.col("html")).alias("title"), F.size(html.links(F.col("html"))).cast("long").alias("links"), html.language(F.col("html")).alias("lang"))


@query(r"SELECT page_id, link, i FROM (SELECT page_id, unnest(l) AS link, generate_subscripts(l, 1) - 1 AS i FROM (SELECT page_id, regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1) AS l FROM pages))")
def html_links(spark, d):
    from ..sources import html

    return load(spark, d, "pages").select("page_id", F.posexplode(html.links(F.col("html"))).alias("i", "link")).withColumn("i", F.col("i").cast("long"))


@query()
def html_unescape(spark, d):
    """Entities of page titles to a fixed point; SQL has no entity table."""
    from ..sources import html

    return load(spark, d, "pages").select("page_id", identity.unescape(html.title(F.col("html"))).alias("title"))


@query()
def folded_titles(spark, d):
    """Unicode decomposition; DuckDB's has another order of marks."""
    return load(spark, d, "documents").select("doc_id", identity.fold(F.col("text")).alias("folded"))


TOK = f"list_distinct(list_filter(string_split({WORDS.format('{0}')}, ' '), lambda w: w NOT IN ('of','the','and','for','at','in','de','la','university','institute','')))"
BENCH = f"""b AS (SELECT item_id AS id, {TOK.format("text")} AS toks FROM benchmark), bt AS (SELECT id, len(toks) AS allt, unnest(toks) AS token FROM b),
r AS (SELECT doc_id, unnest({TOK.format("text")}) AS token FROM documents), h AS (SELECT doc_id, id, count(*) / max(allt) AS coverage, count(*) AS tokens FROM r JOIN bt USING (token) GROUP BY ALL)"""


@query(f"WITH {BENCH}, k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY coverage DESC, tokens DESC, id) AS rank FROM h) SELECT doc_id, id, round(coverage, 6) AS coverage, tokens, rank FROM k WHERE rank <= 5")
def candidates_token(spark, d):
    names = load(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("name"))
    out = resolve.token_candidates(load(spark, d, "documents"), "doc_id", "text", names)
    return out.withColumn("coverage", F.round("coverage", 6)).withColumn("rank", F.col("rank").cast("long"))


@query(f"WITH x AS (SELECT item_id, {TOK.format('text')} AS t FROM benchmark) SELECT a.item_id AS a, b.item_id AS b, round(len(list_intersect(a.t, b.t)) / len(list_distinct(list_concat(a.t, b.t))), 6) AS score FROM x a JOIN x b ON a.item_id < b.item_id WHERE len(list_intersect(a.t, b.t)) > 0")
def jaccard_search(spark, d):
    t = load(spark, d, "benchmark").select("item_id", F.array_distinct(resolve.content_tokens(F.col("text"))).alias("t"))
    words = t.select("item_id", F.size("t").alias("n"), F.explode("t").alias("w"))
    a, b = words.select(F.col("item_id").alias("a"), F.col("n").alias("na"), "w"), words.select(F.col("item_id").alias("b"), F.col("n").alias("nb"), "w")
    both = a.join(b, "w").filter("a < b").groupBy("a", "b").agg(F.count("*").alias("c"), F.max("na").alias("na"), F.max("nb").alias("nb"))
    return both.select("a", "b", F.round(F.col("c") / (F.col("na") + F.col("nb") - F.col("c")), 6).alias("score"))


SPLIT = f"list_distinct(list_filter(string_split({WORDS.format('{0}')}, ' '), lambda w: w NOT IN ('of','the','and','for','de','da','du','la','le','der','van','von','')))"


@query(f"""WITH n AS (SELECT n_nationkey AS id, 'zq' || chr(97 + n_nationkey) AS short, {WORDS.format("n_name || ' University of Marine Science'")} AS key, {SPLIT.format("n_name || ' University of Marine Science'")} AS words FROM nation),
r AS (SELECT s_suppkey AS raw_id, s_suppkey % 4 AS kind, CASE s_suppkey % 4 WHEN 0 THEN n_name || ' University of Marine Science' WHEN 1 THEN 'ZQ' || chr(65 + n_nationkey) WHEN 2 THEN n_name ELSE 'Marine Science of ' || n_name END AS option FROM supplier JOIN nation ON s_nationkey = n_nationkey),
c AS (SELECT raw_id, kind, option, {WORDS.format('option')} AS key, {SPLIT.format('option')} AS words FROM r),
m AS (SELECT raw_id, id, 1.0::DOUBLE AS score, 1 AS tier FROM c JOIN n USING (key) UNION ALL SELECT raw_id, id, 1.0, 2 FROM c JOIN n ON lower(option) = short
UNION ALL SELECT raw_id, id, 0.72 + 0.25 * length(c.key) / length(n.key), 3 FROM c JOIN n ON starts_with(n.key, c.key) WHERE length(c.key) BETWEEN 3 AND 8
UNION ALL SELECT raw_id, id, 0.72 + 0.25 * len(c.words) / len(n.words), 4 FROM c JOIN n ON len(list_intersect(c.words, n.words)) = len(c.words) AND len(c.words) >= 0.55 * len(n.words) WHERE contains(c.key, ' ')),
b AS (SELECT *, row_number() OVER (PARTITION BY raw_id ORDER BY least(score, 0.97) DESC, tier, score DESC, id) AS i FROM m)
SELECT raw_id, id, round(score, 6) AS score, CASE tier WHEN 1 THEN 'exact' WHEN 2 THEN 'acronym' WHEN 3 THEN 'prefix' ELSE 'tokens' END AS matched_via, CASE WHEN score >= 0.9 THEN 'auto' ELSE 'review' END AS status FROM b WHERE i = 1""")
def exact_match_tiers(spark, d):
    """Strings about a name, its acronym, its start and its words, with a department and a postal code around them."""
    n = load(spark, d, "nation")
    full, short = F.concat("n_name", F.lit(" University of Marine Science")), F.concat(F.lit("ZQ"), F.char(65 + F.col("n_nationkey")))
    names = n.select(F.col("n_nationkey").alias("id"), full.alias("name"), F.array(short).alias("acronyms"))
    kind = F.col("s_suppkey") % 4
    text = F.when(kind == 0, F.concat(F.lit("Dept. X, "), full, F.lit(", 12345"))).when(kind == 1, F.concat(F.lit("Dept. X ("), short, F.lit(")"))).when(kind == 2, F.concat("n_name", F.lit(", 12345"))).otherwise(F.concat(F.lit("Marine Science of "), "n_name"))
    raws = load(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("raw_id"), text.alias("raw"))
    found = resolve.resolve_tiers(raws, names, "raw")
    return raws.join(found, "raw").select("raw_id", "id", F.round("score", 6).alias("score"), "matched_via", resolve.status_of(F.col("score")).alias("status"))


@query(f"""WITH n AS (SELECT p_partkey AS id, upper(array_to_string(list_transform(list_filter(string_split({WORDS.format('p_type')}, ' '), lambda w: w NOT IN ('', 'of', 'the', 'and', 'for')), lambda w: w[1]), '')) AS key FROM part)
SELECT key, count(DISTINCT id) AS n, min(id) AS first_id FROM n GROUP BY key HAVING count(DISTINCT id) > 1""")
def acronym_collision(spark, d):
    names = load(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_type")
    return resolve.collisions(names, resolve.acronym(F.col("p_type"))).select("key", "n", F.get("ids", F.lit(0)).alias("first_id"))


@query(f"""WITH seg AS (SELECT DISTINCT doc_id, {WORDS.format('x')} AS key FROM (SELECT doc_id, unnest(string_split(text, ',')) AS x FROM documents)),
nm AS (SELECT DISTINCT {WORDS.format('x')} AS key FROM (SELECT unnest(string_split(text, ',')) AS x FROM benchmark)) SELECT doc_id, count(*) AS hits FROM seg JOIN nm USING (key) WHERE key <> '' GROUP BY doc_id""")
def whole_segment(spark, d):
    docs = load(spark, d, "documents").select("doc_id", F.col("text").alias("raw"))
    keys = load(spark, d, "benchmark").select(F.explode(F.split("text", ",")).alias("name")).select(identity.words_key(F.col("name")).alias("name")).filter("name <> ''").distinct()
    names = keys.select(F.col("name").alias("id"), "name")
    hits = docs.select("doc_id", F.explode(F.array_distinct(F.transform(F.split("raw", ","), identity.words_key))).alias("name"))
    return hits.join(names, "name").groupBy("doc_id").agg(F.count("*").alias("hits"))


CENT = "e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), c AS (SELECT label AS cl, i, avg(x) AS x FROM e GROUP BY ALL), cn AS (SELECT cl, sqrt(sum(x * x)) AS n FROM c GROUP BY cl), s AS (SELECT vec_id, cl, sum(e.x * c.x) AS dot, sqrt(sum(e.x * e.x)) AS vn FROM e JOIN c USING (i) GROUP BY ALL), r AS (SELECT vec_id, cl AS label, dot / (vn * n) AS score FROM s JOIN cn USING (cl)), b AS (SELECT vec_id, max_by(label, score) AS label, max(score) AS score FROM r GROUP BY vec_id)"


def _nearest(spark, d):
    e = load(spark, d, "embeddings")
    c = e.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x")).groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("c"))
    return resolve.nearest_centroid(e, c, "vec_id", "embedding", auto=0.3, review=0.2)


@query(f"WITH {CENT} SELECT vec_id, CAST(label AS BIGINT) AS label, round(score, 6) AS score FROM b")
def cosine_argmax(spark, d):
    return _nearest(spark, d).select("vec_id", "label", F.round("score", 6).alias("score"))


@query(f"WITH {CENT} SELECT vec_id, CASE WHEN score >= 0.3 THEN CASE WHEN label = 3 THEN 'review' ELSE 'auto' END WHEN score >= 0.2 THEN 'review' ELSE 'unmatched' END AS status, CASE WHEN score >= 0.3 AND label = 3 THEN 'company' END AS guard FROM b")
def cosine_guarded(spark, d):
    rows = _nearest(spark, d).withColumn("institution_id", F.col("label"))
    out = resolve.guard(rows, F.col("label") == 3, F.lit(True), F.lit(False), F.lit(None).cast("long"))
    return out.select("vec_id", "status", "guard")


@query(f"WITH {CENT}, k AS (SELECT vec_id, score, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC) AS i FROM r) SELECT a.vec_id, round(a.score - b.score, 6) AS margin FROM k a JOIN k b ON a.vec_id = b.vec_id AND a.i = 1 AND b.i = 2")
def exemplar_margin(spark, d):
    e = load(spark, d, "embeddings")
    x = e.select("vec_id", F.posexplode("embedding").alias("i", "x")).withColumn("x", F.col("x").cast("double"))
    c = e.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("c"))
    c = c.withColumn("n", F.sqrt(F.sum(F.col("c") * F.col("c")).over(Window.partitionBy("label"))))
    s = x.join(F.broadcast(c), "i").groupBy("vec_id", "label").agg((F.sum(F.col("x") * F.col("c")) / F.max("n") / F.sqrt(F.sum(F.col("x") * F.col("x")))).alias("score"))
    top = s.groupBy("vec_id").agg(F.slice(F.sort_array(F.collect_list("score"), False), 1, 2).alias("s"))
    return top.select("vec_id", F.round(F.get("s", F.lit(0)) - F.get("s", F.lit(1)), 6).alias("margin"))


@query("SELECT user_id, max_by(event_type, (ts, event_id)) AS decision, count(*) AS entries FROM events GROUP BY user_id")
def decision_replay(spark, d):
    e = load(spark, d, "events").select("user_id", F.struct("ts", "event_id").alias("at"), "event_type")
    last = resolve.latest_decisions(e, "user_id", "at").select("user_id", F.col("event_type").alias("decision"))
    return last.join(e.groupBy("user_id").agg(F.count("*").alias("entries")), "user_id")


@query("SELECT event_id, json_extract_string(props, '$.' || (json_keys(props))[1]) AS first_value, len(json_keys(props)) AS keys FROM events")
def json_props(spark, d):
    keys = F.json_object_keys("props")
    props = F.from_json("props", "map<string,string>")
    return load(spark, d, "events").select("event_id", F.try_element_at(props, F.get(keys, F.lit(0))).alias("first_value"), F.size(keys).cast("long").alias("keys"))
