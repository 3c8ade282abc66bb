"""The second credit dialect: several areas a venue, hospitals rolled up, papers counted once a credited slot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Types left out here, compared as they are written. Fixed values.
BIOLOGY_NON_RESEARCH = ("editorial", "erratum", "letter", "book-review", "note")


def research_article(kind: Column, doi: Column, venue: Column, references: Column, first_page: Column, last_page: Column) -> Column:
    """Whether a work is a research article; two journals with much front matter are judged by references and pages.

    They are known by venue key or DOI. With references counted as none it is front matter. Science: a first or last page
    with e makes an article, else at most two pages on with under ten references (or an unknown number) is front matter.
    Cell: one page that is not .e1 with under five (or an unknown number) is front matter.
    """
    text = lambda c: F.trim(F.coalesce(c, F.lit("")))
    d, v, a, b = F.lower(text(doi)), F.coalesce(venue, F.lit("")), text(first_page), text(last_page)
    none, few = F.coalesce(references == 0, F.lit(False)), lambda n: references.isNull() | (references < n)
    short = a.rlike("^[0-9]+$") & b.rlike("^[0-9]+$") & F.coalesce(b.try_cast("decimal(38,0)") - a.try_cast("decimal(38,0)") <= 2, F.lit(False))
    in_science, in_cell = (v == "science") | d.contains("10.1126/science"), (v == "cell") | d.contains("10.1016/j.cell")
    electronic = a.startswith("e") | b.startswith("e")
    one_page = (a != "") & (a == b) & ~a.endswith(".e1")
    cell_front = in_cell & (none | (one_page & few(5)))
    verdict = F.when(F.coalesce(kind, F.lit("")).isin(*BIOLOGY_NON_RESEARCH) | d.rlike(r"10\.1038/d[0-9]+"), False)
    return verdict.when(in_science & none, False).when(in_science & electronic, True).when(in_science & short & few(10), False).otherwise(~cell_front)


def credit(slots: DataFrame, venue_areas: DataFrame, rollup: DataFrame, allowed: DataFrame | None = None, default_area: str = "elite_bio", edu_only: bool = True) -> dict[str, DataFrame]:
    """Facts of this dialect from slots (work, venue, year, n_slots, institutions array<struct<id,name,type,country>>).

    A venue counts in all its areas (venue_areas: venue, area, position), unknown ones in the default area. rollup: child,
    parent, parent_name. Kept institutions are education, allowed ones and roll-up targets, or all unless edu_only. The
    venue table has the first area of a venue only.
    """
    one = slots.withColumn("i", F.explode("institutions")).select("work", "venue", "year", "n_slots", "slot", "i.*")
    up = one.join(rollup, one["id"] == rollup["child"], "left")
    up = up.withColumn("rolled", F.col("parent").isNotNull()).withColumn("id", F.coalesce("parent", "id")).drop("child", "parent", "parent_name")
    if edu_only:
        listed = F.lit(False)
        if allowed is not None:
            up = up.join(allowed.select(F.col("id"), F.lit(True).alias("__ok")), "id", "left")
            listed = F.col("__ok").isNotNull()
        up = up.filter((F.col("type") == "education") | listed | F.col("rolled"))
    kept = up.select("work", "venue", "year", "n_slots", "slot", "id").distinct()
    k = F.count("*").over(Window.partitionBy("work", "slot"))  # no join with a second run of the slots, which may number them anew
    shares = kept.withColumn("share", F.lit(1.0) / F.col("n_slots") / k)
    areas = venue_areas.groupBy("venue").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "area"))), lambda x: x["area"]).alias("areas"))
    placed = shares.join(areas, "venue", "left").withColumn("areas", F.coalesce("areas", F.array(F.lit(default_area))))
    sums = lambda df, *by: df.groupBy(*by).agg(F.count("*").alias("pub_count"), F.round(F.sum("share"), 4).alias("adjusted_count"))
    return {"area": sums(placed.withColumn("area", F.explode("areas")), "id", "area", "year"), "venue": sums(placed.withColumn("area", F.get("areas", F.lit(0))), "id", "area", "venue", "year")}


def summary(area: DataFrame) -> DataFrame:
    """All years of the area facts together, and the ordinal rank by area: credit descending, then id."""
    total = area.groupBy("area", "id").agg(F.round(F.sum("adjusted_count"), 4).alias("adjusted_count"), F.sum("pub_count").alias("pub_count"))
    return total.withColumn("rank", F.row_number().over(Window.partitionBy("area").orderBy(F.desc("adjusted_count"), "id")))


def package(edu: DataFrame, everyone: DataFrame) -> DataFrame:
    """Institutions of both modes, the education row first where both have one."""
    both = edu.withColumn("__m", F.lit(0)).unionByName(everyone.withColumn("__m", F.lit(1)))
    rest = [c for c in both.columns if c != "id"]
    return both.groupBy("id").agg(F.min_by(F.struct(*rest), "__m").alias("r")).select("id", "r.*").drop("__m")
