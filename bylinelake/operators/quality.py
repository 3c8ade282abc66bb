"""Data-quality checks: each gives rows, or flags (check, severity, entity, metric, message)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def flags(rows: DataFrame, check: str, severity: Column | str, entity: Column | str, metric: Column | str, message: Column | str) -> DataFrame:
    level = F.lit(severity) if isinstance(severity, str) else severity
    return rows.select(F.lit(check).alias("check"), level.alias("severity"), F.col(entity).cast("string").alias("entity") if isinstance(entity, str) else entity.cast("string").alias("entity"), (F.col(metric) if isinstance(metric, str) else metric).cast("double").alias("metric"), (F.lit(message) if isinstance(message, str) else message).alias("message")).filter("severity IS NOT NULL")


def lowered(severity: Column, default_on: Column) -> Column:
    """One level less for areas that are off by default."""
    return F.when(default_on, severity).when(severity == "critical", "high").when(severity == "high", "medium").when(severity == "medium", "low").otherwise(severity)


def graded(value: Column, steps: Sequence[tuple[float, str]], below: bool = True) -> Column:
    """The severity of the first step that the value is below (or above); null if none."""
    out = F.lit(None).cast("string")
    for limit, level in reversed(steps):
        out = F.when(value < limit if below else value > limit, level).otherwise(out)
    return out


def slot_classes(slots: DataFrame, cls: Column, by: list[str], names: Sequence[str]) -> DataFrame:
    """Counts of each class by `by` and in total (by columns null), as one column a class."""
    rows = slots.withColumn("__class", cls)
    counts = [F.count_if(F.col("__class") == n).alias(n) for n in names]
    return rows.rollup(*by).agg(F.count("*").alias("slots"), *counts)


def scorecard(counts: DataFrame, credited: str, resolved: str, raw: str, total: str) -> DataFrame:
    """coverage, purity and resolution in percent; resolution is null where there is nothing raw."""
    from ..functions.identity import percent

    return counts.withColumns({"coverage": percent(F.col(credited) + F.col(resolved), F.col(total)), "purity": percent(F.col(credited), F.col(credited) + F.col(resolved)), "resolution": percent(F.col(resolved), F.col(raw))})


def missing_years(rows: DataFrame, key: str, year: str, last: int | None = None) -> DataFrame:
    """(key, year) between a key's first and last year that it has no row for."""
    span = rows.groupBy(key).agg(F.min(year).alias("a"), (F.max(year) if last is None else F.lit(last)).alias("b"))
    grid = span.select(key, F.explode(F.sequence("a", "b")).alias(year))
    return grid.join(rows.select(key, year).distinct(), [key, year], "left_anti")


def against_own_median(rows: DataFrame, key: str, value: str, least_n: int = 3) -> DataFrame:
    """Each row's value against the median of its key, for keys with enough rows."""
    w = Window.partitionBy(key)
    out = rows.withColumn("norm", F.median(value).over(w)).withColumn("__count", F.count("*").over(w)).filter(F.col("__count") >= least_n)
    return out.drop("__count").withColumn("ratio", F.try_divide(F.col(value), F.col("norm")))


def upper_median(values: Column) -> Column:
    """The middle of the sorted values, the upper one of two."""
    s = F.array_sort(values)
    return F.get(s, F.floor(F.size(s) / 2).cast("int"))


def local_outliers(rows: DataFrame, key: str, year: str, value: str, reach: int = 6, most: int = 6, spike: float = 2.0, beside: float = 1.5, dip: float = 0.5, ramp: int = 2, least_years: int = 3, least_norm: float = 20, last: int | None = None) -> DataFrame:
    """Spikes and dips against the median of the nearest other years: at most `most`, the earlier of two as near first, of
    which those within `reach` count, and `least_years` there must be; medians under `least_norm` are not judged.

    A spike is also `beside` times the next year that is present, else the previous one. A dip is not looked for in the
    first `ramp` years. Years after `last` are unfinished: they are no neighbours, have no dips, and are held against the
    `reach` years up to `last` and its latest year. One shuffle; a key has as many rows as years.
    """
    ends = F.lit(last) if last is not None else F.lit(9999)
    g = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(year).alias("y"), F.col(value).cast("double").alias("v")))).alias("__ys"))
    done = F.filter("__ys", lambda o: o["y"] <= ends)
    one = g.withColumn("__done", done).select(key, "__done", F.explode("__ys").alias("__x"))
    x = F.col("__x")
    others = F.array_sort(F.transform(F.filter("__done", lambda o: o["y"] != x["y"]), lambda o: F.struct(F.abs(o["y"] - x["y"]).alias("d"), o["y"].alias("y"), o["v"].alias("v"))))
    finished = F.filter(F.slice(others, 1, most), lambda o: o["d"] <= reach)
    recent = F.filter("__done", lambda o: o["y"] > ends - reach)
    late = x["y"] > ends
    sorts = lambda a: F.array_sort(F.transform(a, lambda o: o["v"]))
    near = one.withColumn("__near", F.when(late, sorts(recent)).otherwise(sorts(finished)))
    at = lambda i: F.get("__near", F.floor(i).cast("int"))
    near = near.filter(F.size("__near") >= least_years).withColumn("norm", (at((F.size("__near") - 1) / 2) + at(F.size("__near") / 2)) / 2)
    later, earlier = F.filter("__done", lambda o: o["y"] > x["y"]), F.filter("__done", lambda o: o["y"] < x["y"])
    near = near.withColumn("__beside", F.coalesce(F.get(later, F.lit(0))["v"], F.get(F.reverse(earlier), F.lit(0))["v"])).withColumn("__before", F.size(earlier))
    high = (x["v"] >= spike * F.col("norm")) & (F.col("__beside").isNull() | (x["v"] >= beside * F.col("__beside")))
    low = ~late & (x["v"] <= dip * F.col("norm")) & (F.col("__before") >= ramp)
    out = near.filter(F.col("norm") >= least_norm).withColumn("kind", F.when(high, "spike").when(low, "dip")).filter("kind IS NOT NULL")
    return out.select(key, x["y"].alias(year), x["v"].alias(value), "norm", "kind")


def cliffs(rows: DataFrame, key: str, year: str, value: str, least_before: float = 3, drop: float = 0.8, most_after: float = 1, least_total: float = 10, least_years: int = 3) -> DataFrame:
    """Year-over-year falls between present years; the latest year of all is not judged."""
    w = Window.partitionBy(key).orderBy(year)
    whole = Window.partitionBy(key)
    latest = rows.agg(F.max(year).alias("__latest"))
    out = rows.withColumn("previous", F.lag(value).over(w)).withColumn("total", F.sum(value).over(whole)).withColumn("years", F.count("*").over(whole)).crossJoin(F.broadcast(latest))
    return out.filter((F.col("previous") >= least_before) & (F.col(value) < (1 - drop) * F.col("previous")) & (F.col(value) < most_after) & (F.col("total") >= least_total) & (F.col("years") >= least_years) & (F.col(year) < F.col("__latest"))).select(key, year, "previous", value)


def sigma_outliers(rows: DataFrame, key: str, value: str, sigmas: float = 3.0, least_n: int = 3) -> DataFrame:
    w = Window.partitionBy(key)
    out = rows.withColumn("mean", F.avg(value).over(w)).withColumn("sd", F.stddev_pop(value).over(w)).withColumn("__count", F.count("*").over(w))
    return out.filter((F.col("__count") >= least_n) & (F.abs(F.col(value) - F.col("mean")) > sigmas * F.col("sd"))).drop("__count")


def truncation_spike(sizes: DataFrame, by: list[str], size: str, limit: int, least: int = 5, factor: int = 3) -> DataFrame:
    """Groups with many works of exactly `limit` authors compared with limit - 1 and limit - 2."""
    n = sizes.groupBy(*by).agg(*(F.count_if(F.col(size) == limit - i).alias(f"at_{i}") for i in range(3)))
    return n.filter((F.col("at_0") >= least) & (F.col("at_0") >= factor * F.greatest("at_1", "at_2", F.lit(1))))


def dropped_by_reason(slots: DataFrame, reasons: list[tuple[Column, str]], share: str, venue: str, institution: str) -> DataFrame:
    """Lost credit by reason; by venue and reason; by reason and institution (grouping sets). The first reason counts."""
    reason = F.lit(None).cast("string")
    for holds, name in reversed(reasons):
        reason = F.when(holds, name).otherwise(reason)
    rows = slots.withColumn("reason", reason).filter("reason IS NOT NULL")
    r, v, i = F.col("reason"), F.col(venue), F.col(institution)
    return rows.groupingSets([(r,), (v, r), (r, i)], r, v, i).agg(F.count("*").alias("slots"), F.sum(share).alias("credit"))


def small_tail(rows: DataFrame, key: str, value: str, example: str, least: float) -> DataFrame:
    """Sums by key with the example of most value; keys under `least` are one row, `(other)`."""
    sums = rows.groupBy(key).agg(F.sum(value).alias(value), F.count("*").alias("n"), F.max_by(example, F.struct(value, example)).alias("example"))
    small = F.col(value) < least
    named = sums.withColumn(key, F.when(small, F.lit("(other)")).otherwise(F.col(key).cast("string"))).withColumn("example", F.when(small, F.lit(None)).otherwise(F.col("example")))
    return named.groupBy(key).agg(F.sum(value).alias(value), F.sum("n").alias("n"), F.max("example").alias("example"))


def wilson(hits: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """The 95 % interval of a share; 0 to 1 for no draws."""
    p = hits / n
    mid, half, den = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)), 1 + z * z / n
    return F.when(n > 0, F.greatest(F.lit(0.0), (mid - half) / den)).otherwise(0.0), F.when(n > 0, F.least(F.lit(1.0), (mid + half) / den)).otherwise(1.0)


def snapshot_regression(now: DataFrame, before: DataFrame, keys: list[str], value: str, steps: Sequence[tuple[float, str]]) -> DataFrame:
    """Falls of a percentage since a snapshot, graded by their size in points; keys that are new or gone are no falls."""
    b = before.select(*keys, F.col(value).alias("before"))
    out = now.join(b, keys).withColumn("fall", F.col("before") - F.col(value))
    return out.withColumn("severity", graded(F.col("fall"), steps, below=False)).filter("severity IS NOT NULL").select(*keys, "before", value, "fall", "severity")


def top_movers(now: DataFrame, before: DataFrame, key: str, rank: str, top: int = 50, least: int = 10) -> DataFrame:
    """Places among the top that moved far, are new or are gone."""
    a, b = now.filter(F.col(rank) <= top).select(key, F.col(rank).alias("now")), before.filter(F.col(rank) <= top).select(key, F.col(rank).alias("before"))
    kind = F.when(F.col("before").isNull(), "new").when(F.col("now").isNull(), "gone").when(F.abs(F.col("now") - F.col("before")) >= least, "moved")
    return a.join(b, key, "full_outer").withColumn("kind", kind).filter("kind IS NOT NULL")


def compare_tables(reference: DataFrame, candidate: DataFrame, keys: list[str], values: list[str], tolerance: float = 1e-4) -> DataFrame:
    """One row: missing, extra and duplicate keys, and mismatches and the largest difference of each value."""
    def one(df: DataFrame, tag: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.count("*").alias(f"{tag}_n"), *(F.max(v).alias(f"{tag}_{v}") for v in values))

    j = one(reference, "r").join(one(candidate, "c"), keys, "full_outer")
    both = F.col("r_n").isNotNull() & F.col("c_n").isNotNull()
    gap = {v: F.abs(F.col(f"r_{v}") - F.col(f"c_{v}")) for v in values}
    return j.agg(F.count_if(F.col("c_n").isNull()).alias("missing"), F.count_if(F.col("r_n").isNull()).alias("extra"), F.count_if((F.coalesce("r_n", F.lit(1)) > 1) | (F.coalesce("c_n", F.lit(1)) > 1)).alias("duplicates"), *(F.count_if(both & (gap[v] > tolerance)).alias(f"{v}_mismatches") for v in values), *(F.max(gap[v]).alias(f"{v}_largest") for v in values))


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], value: str, tolerance: Column | float) -> DataFrame:
    """Keys whose sums on both sides differ by more than the tolerance, or that one side lacks. tolerance may use right_n."""
    a = left.groupBy(*keys).agg(F.sum(value).alias("left_sum"))
    b = right.groupBy(*keys).agg(F.sum(value).alias("right_sum"), F.count("*").alias("right_n"))
    limit = F.lit(tolerance) if isinstance(tolerance, float) else tolerance
    out = a.join(b, keys, "full_outer")
    return out.filter(F.col("left_sum").isNull() | F.col("right_sum").isNull() | (F.abs(F.col("left_sum") - F.col("right_sum")) > limit))


def tripwire(known: DataFrame, scores: DataFrame, keys: list[str]) -> DataFrame:
    """Known strong pairs without a score."""
    return known.join(scores, keys, "left_anti")


def require(df: DataFrame, holds: Column, message: str) -> DataFrame:
    """df, failing the job on the first row that breaks the condition."""
    return df.filter(F.when(F.coalesce(holds, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def gates(df: DataFrame, checks: dict[str, tuple[Column, float]]) -> DataFrame:
    """(gate, rate, least, passed) of named rates of rows."""
    one = df.agg(*(F.avg(c.cast("double")).alias(n) for n, (c, _) in checks.items()))
    rows = F.array(*(F.struct(F.lit(n).alias("gate"), F.col(n).alias("rate"), F.lit(float(least)).alias("least"), F.coalesce(F.col(n) >= least, F.lit(False)).alias("passed")) for n, (_, least) in checks.items()))
    return one.select(F.explode(rows).alias("g")).select("g.*")
