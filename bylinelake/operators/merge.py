"""Joins that merge sources: staged matching, overlays, cascades, positional fills, reconciliation, sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unique_matches(left: DataFrame, right: DataFrame, left_id: str, right_id: str, stages: list[list[str]], within: list[str]) -> DataFrame:
    """One-to-one pairs (within..., left_id, right_id, stage): each stage matches on its columns what earlier ones left over,
    and only where the key is unique on both sides."""
    pairs, a, b = None, left, right
    for number, cols in enumerate(stages):
        keys = [*within, *cols]
        complete = lambda df: df.dropna(subset=cols)  # noqa: E731, B023
        alone = lambda df, i: complete(df).groupBy(*keys).agg(F.min(i).alias(i), F.count("*").alias("__n")).filter("__n = 1").drop("__n")  # noqa: E731, B023
        hit = alone(a, left_id).join(alone(b, right_id), keys).select(*within, left_id, right_id, F.lit(number).alias("stage"))
        pairs = hit if pairs is None else pairs.unionByName(hit)
        a, b = a.join(hit, [*within, left_id], "left_anti"), b.join(hit, [*within, right_id], "left_anti")
    return pairs


def overlay(base: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """Fresh rows, and base rows whose key fresh does not have."""
    return fresh.unionByName(base.join(fresh.select(*keys), keys, "left_anti"))


def best_of(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row of each key that is greatest by the order, kept whole (no window over a hot key: one maximum)."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order)))).alias("__r")).select(*keys, "__r.*")


def cascade(wanted: DataFrame, sources: list[tuple[str, DataFrame]], key: str, value: str) -> DataFrame:
    """(key, value, source) of the first source that has the key; keys that none has are left as null."""
    out, left = None, wanted.select(key).distinct()
    for name, source in sources:
        hit = left.join(source.select(key, value), key).select(key, value, F.lit(name).alias("source"))
        out = hit if out is None else out.unionByName(hit)
        left = left.join(hit.select(key), key, "left_anti")
    return out.unionByName(left.select(key, F.lit(None).cast(dict(out.dtypes)[value]).alias(value), F.lit(None).cast("string").alias("source")))


def reconcile_sources(a: DataFrame, b: DataFrame, key: str, fields: list[str], names: tuple[str, str]) -> DataFrame:
    """Full outer comparison: (key, issues), issues sorted: <name>_only, or the fields that differ; keys without any go."""
    left = a.select(key, *(F.col(f).alias(f"a_{f}") for f in fields), F.lit(True).alias("__a"))
    right = b.select(key, *(F.col(f).alias(f"b_{f}") for f in fields), F.lit(True).alias("__b"))
    j = left.join(right, key, "full_outer")
    both = F.col("__a").isNotNull() & F.col("__b").isNotNull()
    issues = F.array_compact(F.array(F.when(F.col("__b").isNull(), f"{names[0]}_only"), F.when(F.col("__a").isNull(), f"{names[1]}_only"), *(F.when(both & ~F.col(f"a_{f}").eqNullSafe(F.col(f"b_{f}")), f) for f in fields)))
    return j.select(key, F.array_join(F.array_sort(issues), ",").alias("issues")).filter("issues <> ''")


def byline_outcome(ours: Column, theirs: Column) -> Column:
    """exact, short or long (one begins the other), reordered, different (under 0.6 in common), else names_differ."""
    shared = _multiset_overlap(ours, theirs)
    rate = shared / F.greatest(F.size(ours), F.size(theirs))
    return (
        F.when(ours == theirs, "exact")
        .when((F.size(ours) < F.size(theirs)) & (F.slice(theirs, F.lit(1), F.size(ours)) == ours), "short")
        .when((F.size(ours) > F.size(theirs)) & (F.slice(ours, F.lit(1), F.size(theirs)) == theirs), "long")
        .when(F.array_sort(ours) == F.array_sort(theirs), "reordered")
        .when(rate < 0.6, "different")
        .otherwise("names_differ")
    )


def _multiset_overlap(a: Column, b: Column) -> Column:
    count = lambda xs, x: F.size(F.filter(xs, lambda y: y == x))
    return F.aggregate(F.array_distinct(a), F.lit(0), lambda acc, x: acc + F.least(count(a, x), count(b, x)))


def multiset_overlap(a: Column, b: Column) -> Column:
    """Common elements, counted as often as both have them."""
    return _multiset_overlap(a, b)


def positional_fill(ours: Column, theirs: Column, agree, empty) -> Column:
    """Slots of ours that are empty filled from theirs; all or nothing: equal lengths and agreement in each place, else ours."""
    fits = (F.size(ours) == F.size(theirs)) & F.forall(F.zip_with(ours, theirs, agree), lambda x: x)
    return F.when(F.coalesce(fits, F.lit(False)), F.zip_with(ours, theirs, lambda a, b: F.when(empty(a), b).otherwise(a))).otherwise(ours)


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])))
def align(left, right):
    """Longest common subsequence of two bylines under `names.agreement`: matched places, at most 250,000 cells (else none).
    Null bylines match nothing."""
    import numpy as np
    import pandas as pd

    from ..functions.names import agreement

    def one(x, y):
        x, y = list(x if x is not None else []), list(y if y is not None else [])
        if not x or not y or len(x) * len(y) > 250_000:
            return []
        fits = agreement(x, y)
        left_over = np.zeros((len(x) + 1, len(y) + 1), np.int32)  # length of the best alignment of what follows
        for i in range(len(x) - 1, -1, -1):
            best = np.maximum(left_over[i + 1, :-1], np.where(fits[i], left_over[i + 1, 1:] + 1, 0))
            left_over[i, :-1] = np.maximum.accumulate(best[::-1])[::-1]
        out, i, j = [], 0, 0
        while left_over[i, j]:
            if fits[i, j] and left_over[i, j] == left_over[i + 1, j + 1] + 1:
                out.append({"a": i, "b": j})
                i, j = i + 1, j + 1
            elif left_over[i + 1, j] == left_over[i, j]:
                i += 1
            else:
                j += 1
        return out

    return pd.Series([one(x, y) for x, y in zip(left, right)])


@F.pandas_udf(T.DoubleType())
def ratio(left, right):
    """Similarity of two strings as twice the matched characters over all; 0 if one is null."""
    import pandas as pd
    from difflib import SequenceMatcher

    return pd.Series([SequenceMatcher(None, a, b, autojunk=False).ratio() if a is not None and b is not None else 0.0 for a, b in zip(left, right)])


def evidence_reasons(title: Column, year_ok: Column, aligned: Column, doi_ok: Column, least_title: float = 0.88, least_aligned: float = 0.9) -> Column:
    """Why a candidate is refused; an empty array accepts it."""
    return F.array_compact(F.array(F.when(~doi_ok, "doi"), F.when(title < least_title, "title"), F.when(~year_ok, "year"), F.when(aligned < least_aligned, "byline")))


def hash_sample(rows: DataFrame, key: str, n: int, by: list[str] | None = None) -> DataFrame:
    """The n rows (of each group) of least SHA-256 of the key: the same rows whenever and wherever it runs."""
    h = F.sha2(F.col(key).cast("string").cast("binary"), 256)
    if not by:
        return rows.withColumn("__h", h).orderBy("__h", key).limit(n).drop("__h")
    w = Window.partitionBy(*by).orderBy(h, key)
    return rows.withColumn("__i", F.row_number().over(w)).filter(F.col("__i") <= n).drop("__i")


def weighted_sample(rows: DataFrame, key: str, weight: str, draws: int, seed: int) -> DataFrame:
    """Draws with replacement in proportion to the weight: seeded points on the line of cumulative weights, by range join.

    Cumulative weights are summed by partition first, so no window spans all rows.
    """
    chunks = 256
    part = rows.filter(F.col(weight) > 0).withColumn("__p", F.pmod(F.xxhash64(key), F.lit(chunks)))
    sums = part.groupBy("__p").agg(F.sum(weight).alias("__s")).withColumn("__base", F.coalesce(F.sum("__s").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    total = sums.agg(F.sum("__s").alias("__total"))
    at = F.sum(weight).over(Window.partitionBy("__p").orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    line = part.withColumn("__in", at).join(F.broadcast(sums.select("__p", "__base")), "__p").withColumn("__hi", F.col("__base") + F.col("__in")).withColumn("__lo", F.col("__hi") - F.col(weight))
    points = rows.sparkSession.range(draws).crossJoin(F.broadcast(total)).select(F.col("id").alias("draw"), (F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53)) * F.col("__total")).alias("__x"))
    chunk = F.broadcast(sums.select("__p", F.col("__base").alias("__b"), F.col("__s").alias("__w")))
    placed = points.join(chunk, (F.col("__x") >= F.col("__b")) & (F.col("__x") < F.col("__b") + F.col("__w")))
    return placed.join(line, ["__p"]).filter((F.col("__x") >= F.col("__lo")) & (F.col("__x") < F.col("__hi"))).select("draw", key, weight)


def container_matches(found: Column, scope: Column) -> Column:
    """Container titles are the same, or of one family with a volume number."""
    from ..functions.identity import words_key

    family = lambda c: F.trim(F.regexp_replace(words_key(c), r"\bvolume \w+\b", " "))
    return (words_key(found) == words_key(scope)) | (words_key(found).rlike(r"\bvolume \w+") & (F.regexp_replace(family(found), r"\s+", " ") == F.regexp_replace(family(scope), r"\s+", " ")))


def strings_agree(a: Column, b: Column) -> Column:
    """Two affiliation strings share a distinctive word."""
    from .resolve import content_tokens

    return F.arrays_overlap(content_tokens(a), content_tokens(b))


def title_prefix_matches(left: DataFrame, right: DataFrame, left_id: str, right_id: str, title: str, size: int = 35, least: int = 20) -> DataFrame:
    """Pairs whose normalised titles are equal or where one holds the other's first `size` characters (at least `least`
    long). Blocked on each word of a title's prefix, so it is an equi-join and no nested loop."""
    from ..functions.identity import words_key

    def parts(df: DataFrame, i: str, tag: str) -> DataFrame:
        t = df.select(F.col(i).alias(f"{tag}_id"), words_key(F.col(title)).alias(f"{tag}_t"))
        return t.withColumn(f"{tag}_p", F.substring(f"{tag}_t", 1, size)).filter(F.length(f"{tag}_t") > 0)

    a, b = parts(left, left_id, "a"), parts(right, right_id, "b")
    words = lambda c: F.explode(F.array_distinct(F.split(c, " ")))

    def holds(outer: DataFrame, inner: DataFrame, o: str, i: str) -> DataFrame:
        # the first word of the prefix must stand in the other title as the end of a word at least; whole words block it
        x = outer.withColumn("w", words(F.col(f"{o}_t")))
        y = inner.withColumn("w", F.get(F.split(f"{i}_p", " "), F.lit(0))).filter(F.length(f"{i}_p") >= least)
        return x.join(y, "w").filter(F.contains(F.col(f"{o}_t"), F.col(f"{i}_p"))).select("a_id", "b_id")

    equal = a.join(b, a["a_t"] == b["b_t"]).select("a_id", "b_id")
    out = equal.unionByName(holds(a, b, "a", "b")).unionByName(holds(b, a, "b", "a")).distinct()
    return out.withColumnsRenamed({"a_id": left_id, "b_id": right_id})


def aligned_enrichment(base: DataFrame, fresh: DataFrame, key: str, byline: str, coverage: str) -> DataFrame:
    """Base rows take the byline of a fresh row with the same names in the same order, if that does not lower coverage; of
    several, the one of most coverage. byline: array<struct<name,...>>; coverage: a column of both."""
    names = lambda c: F.transform(c, lambda x: F.lower(x["name"]))
    best = best_of(fresh.select(key, F.col(byline).alias("__b"), F.col(coverage).alias("__c")).withColumn("__n", F.array_join(names(F.col("__b")), "|")), [key, "__n"], [F.col("__c")])
    own = base.withColumn("__n", F.array_join(names(F.col(byline)), "|"))
    j = own.join(best, [key, "__n"], "left")
    better = F.col("__c").isNotNull() & (F.col("__c") >= F.col(coverage))
    return j.withColumn(byline, F.when(better, F.col("__b")).otherwise(F.col(byline))).withColumn(coverage, F.when(better, F.col("__c")).otherwise(F.col(coverage))).drop("__b", "__c", "__n")


def date_window(kind: Column, year: Column, grace_months: int = 3) -> Column:
    """First and last day to look for an edition: its year; for proceedings from the year before, and with some grace after."""
    first = F.when(kind == "journal", F.make_date(year, F.lit(1), F.lit(1))).otherwise(F.make_date(year - 1, F.lit(10), F.lit(1)))
    last = F.when(kind == "journal", F.make_date(year, F.lit(12), F.lit(31))).otherwise(F.add_months(F.make_date(year, F.lit(12), F.lit(31)), grace_months))
    return F.struct(first.alias("first"), last.alias("last"))
