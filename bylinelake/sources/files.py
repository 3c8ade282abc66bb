"""File sources and sinks: work trees, registries, shards, fact exports, inventories."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import csv_field
from ..operators.credit import WORK_SCHEMA

#: How a large-file pointer begins. Fixed value.
POINTER = "version https://git-lfs"


def refuse_pointers(spark: SparkSession, glob: str) -> None:
    """Fail before anything is written if a file is a large-file pointer instead of data."""
    lines = spark.read.option("lineSep", "\n").text(glob).filter(F.col("value").startswith(POINTER)).select(F.input_file_name().alias("f"))
    bad = [r["f"] for r in lines.distinct().limit(5).collect()]
    if bad:
        raise ValueError(f"pointer files instead of data: {', '.join(bad)}")


def read_works(spark: SparkSession, root: str, venues: list[str] | None = None, years: list[int] | None = None) -> DataFrame:
    """Nested works of root/<venue>/<year>/works.jsonl: WORK_SCHEMA, venue, year_dir, line_no and _corrupt_record.

    Only directories whose year is digits count. Venue and year narrow the paths that are opened. Records end at \\n only.
    line_no orders the records of a file.
    """
    picked = [f"{root}/{v}/{y}/works.jsonl" for v in (venues or ["*"]) for y in (years or ["[0-9]*"])]
    refuse_pointers(spark, picked[0] if len(picked) == 1 else picked)
    raw = spark.read.schema(WORK_SCHEMA + ", _corrupt_record string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").option("lineSep", "\n").json(picked)
    path = F.split(F.col("_metadata.file_path"), "/")
    at = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    rows = raw.select("*", F.element_at(path, -3).alias("venue"), F.element_at(path, -2).alias("year_text"), at.alias("line_no"))
    return rows.filter(F.col("year_text").rlike(r"^\d+$")).withColumn("year_dir", F.col("year_text").cast("int")).drop("year_text")


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with header, quoted line breaks and doubled quotes."""
    return spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', schema=schema, enforceSchema=False)


def read_registry(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """area, venue and venue_year tables of a JSON registry of areas with venues with years."""
    venue = "struct<key:string,display:string,kind:string,years:map<string,string>,openalex_ids:array<string>,exclude_dois:array<string>,expected_per_year:int>"
    doc = spark.read.text(path, wholetext=True).select(F.from_json("value", f"areas map<string,struct<name:string,cluster:string,default_on:boolean,venues:array<{venue}>>>").alias("d"))
    areas = doc.select(F.explode(F.map_entries("d.areas")).alias("e")).select(F.col("e.key").alias("area"), "e.value.*")
    venues = areas.select("area", F.posexplode("venues").alias("position", "v")).select("area", "position", F.col("v.key").alias("venue"), "v.display", "v.kind", "v.years", "v.exclude_dois", "v.expected_per_year")
    years = venues.select("venue", F.explode("years").alias("year", "target"))
    return {"area": areas.drop("venues"), "venue": venues, "venue_year": years.withColumn("year", F.col("year").cast("int"))}


def read_shards(spark: SparkSession, glob: str, schema: str, venue: str, exact: list[str], parts: list[str]) -> DataFrame:
    """Records of gzipped JSON-lines shards whose venue equals one of `exact` or contains one of `parts`."""
    v = F.lower(F.col(venue))
    keep = v.isin(*[x.lower() for x in exact])
    for p in parts:
        keep = keep | v.contains(p.lower())
    return spark.read.schema(schema).json(glob).filter(keep)


def affiliations_of(authors: DataFrame, papers: DataFrame, author: str, byline: str) -> DataFrame:
    """Author records that some paper's byline has: the second pass over the shards, as a semi-join."""
    wanted = papers.select(F.explode(byline).alias(author)).distinct()
    return authors.join(wanted, author, "left_semi")


def route_sources(sources: DataFrame) -> DataFrame:
    """How to harvest each (venue, year, source_id): a source of several years or of a journal needs a year filter; without
    a source the works come from the DOI registry."""
    from pyspark.sql import Window

    n = F.count("*").over(Window.partitionBy("venue", "source_id"))
    mode = F.when(F.coalesce("source_id", F.lit("")) == "", "crossref").when((F.col("kind") == "journal") | (n > 1), "filtered").otherwise("precise")
    return sources.withColumn("mode", mode)


def harvested_tail(rows: DataFrame, doi: str, prefixes: str | None, order: list[str]) -> DataFrame:
    """What follows a paged harvest: DOI prefix filter and first row a DOI."""
    from ..functions.identity import matches_prefix, norm_doi
    from ..operators.credit import first_owner

    kept = rows.filter(matches_prefix(F.col(doi), F.lit(prefixes))) if prefixes else rows
    return first_owner(kept.withColumn("__doi", norm_doi(F.col(doi))).filter("__doi IS NOT NULL"), ["__doi"], order).drop("__doi")


def check_counts(expected: DataFrame, rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, expected, found) where a harvest returned another number of rows than announced."""
    found = rows.groupBy(*keys).agg(F.count("*").alias("found"))
    return expected.select(*keys, F.col(value).alias("expected")).join(found, keys, "full_outer").filter(~F.coalesce("expected", F.lit(0)).eqNullSafe(F.coalesce("found", F.lit(0))))


def longer_bylines(works: DataFrame, refetched: DataFrame, key: str, cap: int = 100) -> DataFrame:
    """Works with exactly `cap` authors take a refetched byline if it is longer."""
    new = refetched.select(key, F.col("authorships").alias("__new"))
    better = (F.size("authorships") == cap) & (F.size("__new") > cap)
    return works.join(new, key, "left").withColumn("authorships", F.when(F.coalesce(better, F.lit(False)), F.col("__new")).otherwise(F.col("authorships"))).drop("__new")


def stale_affiliations(works: DataFrame, non_research: tuple[str, ...]) -> DataFrame:
    """Research works with a native id whose every slot has neither institution nor raw string."""
    empty = F.forall("authorships", lambda a: (F.size(F.coalesce(a["institutions"], F.array())) == 0) & (F.size(F.coalesce(a["raw_affiliations"], F.array())) == 0))
    return works.filter(F.col("id").rlike(r"(^|/)W\d+$") & (F.size("authorships") > 0) & empty & ~F.coalesce(F.lower("type"), F.lit("")).isin(*non_research))


def serving_rows(facts: DataFrame, digits: int = 5, keep: tuple[str, ...] = ()) -> DataFrame:
    """area (and the columns of keep) and the short JSON row {i, n, y, p, a} of each fact."""
    return facts.select("area", *keep, F.to_json(F.struct(F.col("institution").alias("i"), F.col("name").alias("n"), F.col("year").alias("y"), F.col("pub_count").alias("p"), F.round("adjusted_count", digits).alias("a"))).alias("row"))


def write_serving(facts: DataFrame, path: str, areas: DataFrame) -> None:
    """JSON by area; areas without rows get a directory with an empty file through a marker row."""
    rows = areas.select("area").join(serving_rows(facts), "area", "left").withColumn("row", F.coalesce("row", F.lit("")))
    rows.repartition("area").sortWithinPartitions("area", "row").write.mode("overwrite").partitionBy("area").text(path)


def write_facts(df: DataFrame, path: str, order: list, digits: int = 5, credit: str = "adjusted_count") -> None:
    """CSV in a fixed order: by the unrounded credit and the key, then rounded for the file."""
    df.orderBy(*order).withColumn(credit, F.round(credit, digits)).write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def ranking_lines(ranked: DataFrame, areas: list[str]) -> Column:
    """One RFC 4180 line of a ranking export, four places a number."""
    num = lambda c: F.format_string("%.4f", F.coalesce(c, F.lit(0.0)))
    return F.concat_ws(",", F.col("rank").cast("string"), csv_field(F.col("name")), csv_field(F.coalesce("country", F.lit(""))), num(F.col("score")), *(num(F.col(a)) for a in areas))


def write_lines(lines: DataFrame, column: str, path: str, header: str, order: list | None = None) -> None:
    """Text with CRLF line ends in the given order; the parts in name order are one file, which the header leads."""
    by = [c if isinstance(c, Column) else F.col(c) for c in order or []]
    body = lines.select(F.lit(1).alias("__part"), F.struct(*by, F.col(column)).alias("__by"), F.col(column).alias("value"))
    top = lines.sparkSession.range(1).select(F.lit(0).alias("__part"), F.lit(None).alias("__by"), F.lit(header).alias("value"))
    body.unionByName(top).orderBy("__part", "__by").select("value").write.mode("overwrite").option("lineSep", "\r\n").text(path)


def replace_path(spark: SparkSession, df: DataFrame, path: str, stamp: int | None = None) -> int:
    """Write beside path, move the old aside and the new into place, then delete the old: no moment is without a whole copy.
    If a stamp (of an earlier call) is given, the path must not have changed.

    Returns the new stamp.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(conf)
    if stamp is not None and (not fs.exists(target) or fs.getFileStatus(target).getModificationTime() != stamp):
        raise RuntimeError(f"{path} was changed by another writer")
    beside = f"{path}-{uuid.uuid4().hex}"
    df.write.parquet(beside)
    old = jvm.org.apache.hadoop.fs.Path(f"{path}-old-{uuid.uuid4().hex}")
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise RuntimeError(f"{path} could not be moved aside")
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(beside), target):
        if had:
            fs.rename(old, target)
        raise RuntimeError(f"{path} could not be replaced")
    if had:
        fs.delete(old, True)
    return fs.getFileStatus(target).getModificationTime()


def inventory(spark: SparkSession, glob: str) -> DataFrame:
    """path, bytes and sha256 of each file."""
    return spark.read.format("binaryFile").load(glob).select("path", F.length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def changed_files(manifest: DataFrame, now: DataFrame) -> DataFrame:
    """Files that are missing, new or have another hash than the manifest."""
    a, b = manifest.select("path", F.col("sha256").alias("was")), now.select("path", F.col("sha256").alias("now"))
    return a.join(b, "path", "full_outer").filter(~F.col("was").eqNullSafe(F.col("now")))
