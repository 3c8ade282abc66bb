"""The queries of this package, their SQL, and the parameters they run with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import avi, bpe, langid, licenses, packing, pii, simhash, toxicity, vptree, warc
from .common import crc_bucket, table


#: Stands for a secret that a deployment would pass in.
PII_KEY = "example pseudonym key"


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_bundles(table(spark, sf_dir, "pages"), min_bytes=0)
    return warc.read_bundles(spark.read.schema(warc.BUNDLE_SCHEMA).parquet(path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_file(), outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_bucket("doc_id", 4) == 2, F.lit(False))
    model = langid.fit(docs, ~held_out)
    return langid.predict(docs, model).withColumn("held_out", held_out).select("doc_id", "held_out", "lang_pred", "score")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file(), window=2048, end_id=1)


def op5_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op6_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20, factor=1.0)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, max_bits=3)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_bucket("doc_id", 3) == 1, F.lit(False))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"), PII_KEY, "text", "n_pseudonyms").select("doc_id", "n_pseudonyms", "text")


def op10_avi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return avi.text_media(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_warc": op1_warc, "op2_bpe": op2_bpe, "op3_langid": op3_langid, "op4_packing": op4_packing, "op5_license": op5_license, "op6_vptree": op6_vptree, "op7_simhash": op7_simhash, "op8_toxicity": op8_toxicity, "op9_pii": op9_pii, "op10_avi": op10_avi}


#: DuckDB has SHA-1 as hex digits; every five bits of it are one base-32 digit.
OP1_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY hex, payload_bytes) AS target, count(*) OVER (PARTITION BY hex, payload_bytes) AS n FROM p)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(CAST(substr(bits, CAST(i * 5 + 1 AS INT), 1) AS INT) * 16 + CAST(substr(bits, CAST(i * 5 + 2 AS INT), 1) AS INT) * 8
      + CAST(substr(bits, CAST(i * 5 + 3 AS INT), 1) AS INT) * 4 + CAST(substr(bits, CAST(i * 5 + 4 AS INT), 1) AS INT) * 2
      + CAST(substr(bits, CAST(i * 5 + 5 AS INT), 1) AS INT) + 1 AS INT), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN n > 1 AND page_id <> target THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n > 1 AND page_id <> target THEN target END AS refers_to
FROM (SELECT *, CAST(unhex(hex) AS BIT)::VARCHAR AS bits FROM g)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": OP1_SQL, "op5_license": licenses.scan_sql()}
