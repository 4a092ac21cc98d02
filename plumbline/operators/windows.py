"""Ranks and normalisations, as column expressions and over running totals of a global order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import col, fresh
from plumbline.operators.order import running_total


def percentile_rank(value: Column, group: Sequence[Column]) -> Column:
    """WIN-02: rank within the group over its size; equal values share the mean of their ranks. NULL has none."""
    order = Window.partitionBy(*group).orderBy(value.asc_nulls_last())
    same = Window.partitionBy(*group, value)
    whole = Window.partitionBy(*group)
    return F.when(value.isNotNull(), (F.rank().over(order) + (F.count(value).over(same) - 1) / 2) / F.count(value).over(whole))


def percentile_ranks(df: DataFrame, value: str, out: str) -> DataFrame:
    """WIN-01: the same over all rows; 0 for all if no value is above 0.

    Counts of distinct values are aggregated first (map-side); their running totals over range partitions give the mean
    rank of every value, and one join brings it back. Rows are never sorted in one place.
    """
    v, n, upto, total, top = fresh(df, "v", "n", "upto", "total", "top")
    counts = df.where(col(value).isNotNull()).groupBy(col(value).alias(v)).agg(F.count(F.lit(1)).alias(n))
    running = running_total(counts, [v], n, upto)
    whole = running.agg(F.sum(n).alias(total), F.max(v).alias(top))
    rank = F.when(F.col(top) <= 0, F.lit(0.0)).otherwise((F.col(upto) - (F.col(n) - 1) / 2) / F.col(total))
    ranks = running.crossJoin(F.broadcast(whole)).select(v, rank.alias(out))
    return df.join(ranks, col(value) == F.col(v), "left").drop(v)


def log_max(df: DataFrame, value: str, out: str) -> DataFrame:
    """WIN-03: ln(1 + x) over its greatest, 0 where that is 0. One aggregate row is joined; no sort."""
    (top,) = fresh(df, "top")
    x = F.log1p(F.greatest(F.coalesce(col(value).cast("double"), F.lit(0.0)), F.lit(0.0)))
    most = df.agg(F.max(x).alias(top))
    return df.crossJoin(F.broadcast(most)).withColumn(out, F.when(F.col(top) > 0, x / F.col(top)).otherwise(F.lit(0.0))).drop(top)


def ranked_head(df: DataFrame, group: Sequence[str], order: Sequence[Column], limit: Column | int, rank: str) -> DataFrame:
    """WIN-05, WIN-07, WIN-08: the first rows of each group; ``limit`` may differ from group to group."""
    w = Window.partitionBy(*[col(g) for g in group]).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= limit)


def capped_top(df: DataFrame, group: str, order: Sequence[Column], cap: int, limit: int) -> DataFrame:
    """WIN-10: the best ``limit`` rows with at most ``cap`` of each group; rows without a group aren't capped."""
    (r,) = fresh(df, "r")
    w = Window.partitionBy(col(group)).orderBy(*order)
    kept = df.where(col(group).isNotNull()).withColumn(r, F.row_number().over(w)).where(F.col(r) <= cap).drop(r)
    return kept.unionByName(df.where(col(group).isNull())).orderBy(*order).limit(limit)
