"""Aggregations: each one pass, with partial sums before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import col
from plumbline.operators.order import running_total


def mode_smallest(df: DataFrame, group: Sequence[str], value: str, out: str) -> DataFrame:
    """AGG-06: the most frequent value of each group, the smallest of equals. Two aggregates, no window."""
    keys = [col(g) for g in group]
    counts = df.where(col(value).isNotNull()).groupBy(*keys, col(value).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*keys).agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias(out))


def top_k_sum(df: DataFrame, group: Sequence[str], value: str, k: int, out: str) -> DataFrame:
    """AGG-07: the sum of the k greatest values of each group."""
    w = Window.partitionBy(*[col(g) for g in group]).orderBy(col(value).desc_nulls_last())
    return df.where(col(value).isNotNull()).withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).groupBy(*[col(g) for g in group]).agg(F.sum(col(value)).alias(out))


def quantiles(df: DataFrame, group: Sequence[str], value: str, at: Sequence[float], out: Sequence[str]) -> DataFrame:
    """AGG-08, WIN-14: exact quantiles by linear interpolation: one row a group (one in all without ``group``).

    Counts of each group's distinct values are put in one global order by range partitions; a running total tells where
    each quantile lies, so the values of a group never come together, whatever its size. NULL values don't count; a NULL
    group is a group.
    """
    keys = [f"k{i}" for i in range(len(group))]
    counts = df.where(col(value).isNotNull()).groupBy(*[col(g).alias(k) for g, k in zip(group, keys)], col(value).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    upto = running_total(counts, [*keys, "v"], "n", "upto")
    ends = upto.groupBy(*[F.col(k).alias(f"{k}_") for k in keys]).agg(F.max("upto").alias("last"), F.sum("n").alias("total"))
    same = [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys]
    placed = upto.join(ends, same) if same else upto.crossJoin(F.broadcast(ends))
    place = F.col("upto") - (F.col("last") - F.col("total"))
    h = lambda q: (F.col("total") - 1) * F.lit(q)
    sides = [F.min(F.when(place > side(h(q)), F.col("v"))).alias(f"{name}{i}") for i, q in enumerate(at) for name, side in (("lo", F.floor), ("hi", F.ceil))]
    found = placed.groupBy(*keys).agg(F.first("total").alias("total"), *sides)
    between = lambda i, q: F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * (h(q) - F.floor(h(q)))
    return found.select(*[F.col(k).alias(g) for g, k in zip(group, keys)], *[between(i, q).alias(o) for i, (q, o) in enumerate(zip(at, out))])


def value_counts(df: DataFrame, value: Column, name: str) -> DataFrame:
    """AGG-09, AGG-10: counts of each value and their share."""
    counts = df.groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


def entropy(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """AGG-13: Shannon entropy of the values in each group, and over its greatest possible (0 for a single value)."""
    keys = [col(g) for g in group]
    counts = df.where(col(value).isNotNull()).groupBy(*keys, col(value).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    # -sum(p ln p) = ln N - sum(n ln n) / N: no share has to be joined back
    sums = counts.groupBy(*keys).agg(F.sum("n").alias("total"), F.sum(F.col("n") * F.log(F.col("n").cast("double"))).alias("nln"), F.count(F.lit(1)).alias("kinds"))
    h = F.log(F.col("total").cast("double")) - F.col("nln") / F.col("total")
    return sums.select(*group, "kinds", F.round(h, 6).alias("entropy"), F.round(F.when(F.col("kinds") > 1, h / F.log(F.col("kinds").cast("double"))).otherwise(0.0), 6).alias("evenness"))


def first_present(value: Column, order: Column) -> Column:
    """AGG-21: the first value in order that is not NULL."""
    return F.min_by(value, F.when(value.isNotNull(), order))


def longest(value: Column, order: Column) -> Column:
    """AGG-22: the longest text, the first of equals."""
    return F.max_by(value, F.struct(F.length(value), -order))


def joined_set(value: Column, mark: str = ";") -> Column:
    """AGG-23: distinct values in order, as one text."""
    return F.array_join(F.array_sort(F.collect_set(value)), mark)


def binned(df: DataFrame, key: Column, bins: dict[str, tuple[str, ...]], default: str) -> DataFrame:
    """AGG-14: rows by bin; a key may fall into several bins, and bins without rows count 0."""
    spark = df.sparkSession
    rows = [(k, b) for b, ks in bins.items() for k in ks]
    lookup = spark.createDataFrame(rows, "k string, bin string")
    hits = df.select(key.alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    found = hits.join(F.broadcast(lookup), "k", "left").groupBy(F.coalesce("bin", F.lit(default)).alias("bin")).agg(F.sum("n").alias("n"))
    names = spark.createDataFrame([(b,) for b in [*bins, default]], "bin string")
    return names.join(found, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))
