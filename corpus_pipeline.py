"""Corpus cleaning: language ID, toxicity, near-duplicates, personal values, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of documents. Stages are
written as Parquet and read again by the next one. Further columns are carried along; an empty table gives empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bylinelake.llm import langid, packing, pii, simhash, toxicity
from bylinelake.llm.common import crc_bucket, table, written
from bylinelake.llm.queries import PII_KEY, tokenizer_file


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a determinable language (no text or no letter)."""
    return langid.keep_identified(docs, langid.fit(docs, F.lit(True)))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score 0.7 or more; learns from the labels that op8_toxicity learns from. A null
    text scores like an empty one; if labels of both classes are not there, every score is 0.5 and all documents stay."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~F.coalesce(crc_bucket("doc_id", 3) == 1, F.lit(False)))
    return toxicity.drop_toxic(docs, model, threshold=0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each class of texts with a similarity of 0.8 or more on five-word shingles."""
    return simhash.drop_near_duplicates(docs, size=5, similarity=0.8)


def personal_values(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal values by pseudonyms and sets n_chars anew; a null text stays null, with null n_chars."""
    return pii.pseudonymise(docs, PII_KEY).withColumn("n_chars", F.length("text").cast("long"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all that is left into sequences of 2048 tokens; one row a piece. A null or empty text is its end token alone."""
    return packing.pack(docs, tokenizer_file(), window=2048, end_id=1)


STAGES = [("language_id", language), ("toxicity", toxic), ("simhash_near_dedup", near_duplicates), ("pii_pseudonyms", personal_values), ("packing", sequences)]

#: Language models, fingerprints and tokenizers have no SQL form; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
