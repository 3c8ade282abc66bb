"""Helpers that the corpus operators share."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a folder of our own in local mode
    (tests); on a cluster that is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.conf.get("spark.master", "local").split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = f"file://{tempfile.gettempdir()}/bylinelake-shared"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: lineage ends, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_bucket(id_col: str, mod: int) -> Column:
    """crc32 of an id written as text, modulo mod; null ids give null."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % mod


def batches(column, most: int = 1 << 19):
    """Slices (start, stop) of an Arrow string column with at most `most` bytes of text each, one row at least."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start, base = 0, 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(sizes, base + most, "right")))
        yield start, stop
        start, base = stop, int(sizes[stop - 1])


def lean(run):
    """`run` for mapInArrow; when a task's part is done, its worker, which Spark keeps for later tasks, gives freed memory back."""

    @functools.wraps(run)
    def tidy(parts):
        try:
            yield from run(parts)
        finally:
            give_back()

    return tidy


def give_back() -> None:
    """Hand memory that Arrow and the C library hold but don't use back to the system (the latter where glibc is there)."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, most: int):
    """Smaller Arrow batches for jobs that run inside; the session's own setting comes back afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(most, int(before) if int(before) > 0 else most)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def salted_lookup(left: DataFrame, right: DataFrame, key: str, spread: str, salts: int = 64) -> DataFrame:
    """Left join of `left` with `right` (one row a key) that spreads a hot key of `left` over `salts` tasks.

    Only (key, salt) pairs that occur on the left are made on the right, so it never grows past the left.
    """
    s = f"__salt_{key}"
    salted = left.withColumn(s, F.pmod(F.xxhash64(F.col(spread)), F.lit(salts)).cast("int"))
    present = salted.select(key, s).distinct()
    return salted.join(present.join(right, key), [key, s], "left").drop(s)
