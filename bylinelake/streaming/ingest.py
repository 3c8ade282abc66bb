"""Incremental ingest: new files of works through Structured Streaming, and partitions rewritten by fingerprint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import record_key
from ..operators.credit import WORK_SCHEMA


def ingest_works(spark: SparkSession, source: str, target: str, checkpoint: str) -> None:
    """Read what is new under source (venue=<v>/year_dir=<y>/*.jsonl), keep the first record of each key, append to target.

    Runs until all present files are read and stops; the checkpoint folder holds what was read and the keys seen.
    """
    rows = spark.readStream.schema(WORK_SCHEMA + ", venue string, year_dir int").option("lineSep", "\n").json(source)
    keyed = rows.withColumn("record_key", record_key(F.col("doi"), F.col("id"), F.col("openalex_id"), F.col("s2_corpusid"), F.col("title"), F.col("venue"), F.col("year_dir")))
    query = keyed.dropDuplicates(["venue", "record_key"]).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def fingerprints(files: DataFrame, by: str, config: str) -> DataFrame:
    """(by, fingerprint) of an inventory (path, sha256) under a configuration: what a partition's results depend on."""
    each = F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "path", "sha256"))), "\n")
    return files.groupBy(by).agg(F.sha2(F.concat(F.lit(config + "\n"), each).cast("binary"), 256).alias("fingerprint"))


def stale_partitions(now: DataFrame, before: DataFrame, by: str) -> DataFrame:
    """Partitions to compute again: new ones and those with another fingerprint."""
    return now.join(before, [by, "fingerprint"], "left_anti").select(by)


def rewrite_partitions(df: DataFrame, by: str, path: str) -> None:
    """Replace only the partitions that df has."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
