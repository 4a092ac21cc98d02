"""Balanced selections: the loops run over counts of groups, which are few; the rows are ranked once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import fresh
from plumbline.operators.learning import head_per_group
from plumbline.operators.order import global_position
from plumbline.session import cut


def share_cap_removals(counts: dict[str, int], removable: dict[str, int], share: float) -> dict[str, int]:
    """SEL-06: how many rows each group loses when, one at a time, the most over-represented group that still has
    removable rows gives one up until no such group is above ``share`` of what remains; of equals the first by name.

    Steps that are alike are taken at once: the largest groups, if equal in turn, go down together as far as they stay
    the largest and above the share. So the work grows with the number of groups, not with that of rows.
    """
    counts, left, out = dict(counts), dict(removable), {g: 0 for g in counts}
    limit = lambda total: max(1, int(total * share))
    while True:
        total = sum(counts.values())
        over = [g for g, n in counts.items() if n > limit(total) and left.get(g, 0) > 0]
        if not over:
            return out
        top = max(counts[g] for g in over)
        first = sorted(g for g in over if counts[g] == top)
        below = max((counts[g] for g in over if counts[g] < top), default=0)
        lo, hi = 0, min([top - below, *(left[g] for g in first)])
        while lo < hi:  # whole rounds over the largest that leave them above the share
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if top - mid > limit(total - mid * len(first)) else (lo, mid - 1)
        for g, k in [(g, lo) for g in first] if lo else [(first[0], 1)]:
            counts[g] -= k
            left[g] -= k
            out[g] += k


def cap_shares(df: DataFrame, group: str, keep: Column, worst_first: Sequence[Column], share: float) -> DataFrame:
    """SEL-06: drop the worst removable rows of over-represented groups. ``keep`` rows are never dropped.

    The counts of groups (a small table) decide on the driver how many rows go. Removable rows are put in one global
    order by range partitions, so a group of any size is ranked by many tasks. ``worst_first`` should end with an
    identifier.
    """
    spark = df.sparkSession
    kept, at, gone, start = fresh(df, "kept", "at", "gone", "start")
    marked = df.withColumn(kept, F.coalesce(keep, F.lit(False)))
    rows = marked.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col(kept)).alias("m")).collect()
    plan = share_cap_removals({r[0]: r["n"] for r in rows}, {r[0]: r["m"] for r in rows}, share)
    few = spark.createDataFrame([(g, n) for g, n in plan.items()], f"`{group}` string, {gone} bigint")
    placed = global_position(marked.where(~F.col(kept)), [F.col(group), *worst_first], at)
    begins = placed.groupBy(group).agg(F.min(at).alias(start)).join(few, group)
    lost = F.col(at) - F.coalesce(start, F.lit(0)) < F.coalesce(gone, F.lit(0))
    rest = placed.join(begins, group, "left").where(~lost)
    return marked.where(kept).select(*df.columns).unionByName(rest.select(*df.columns))


def diverse_cap(df: DataFrame, group: str, cluster: str, best_first: Sequence[Column], cap: int, diverse: float) -> DataFrame:
    """SEL-04: at most ``cap`` rows a group: the best ones first, the rest from the clusters least represented so far.

    All rankings are in two stages, and the second choice looks at the best rows of each cluster only. ``best_first``
    should end with an identifier; equal rows count once.
    """
    used, rank = fresh(df, "used", "rank_no")
    first = round((1 - diverse) * cap)
    one = cut(head_per_group(df, [group], best_first, first, rank).drop(rank))
    counts = one.groupBy(group, cluster).agg(F.count(F.lit(1)).alias(used))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in df.columns]
    rest = df.alias("a").join(one.alias("b"), same, "left_anti")
    best = head_per_group(rest, [group, cluster], best_first, cap - first, rank).drop(rank)
    fill = best.join(counts, [group, cluster], "left").withColumn(used, F.coalesce(used, F.lit(0)))
    two = head_per_group(fill, [group], [F.asc(used), *best_first], cap - first, rank)
    return one.unionByName(two.select(*one.columns))


def tiered(df: DataFrame, ident: str, tiers: Sequence[tuple[str, Column, Sequence[Column], int]]) -> DataFrame:
    """SEL-08: tiers in order, each with its own filter, order and cap; a row belongs to the first tier that takes it,
    and caps count only rows not taken before."""
    taken = None
    rest = df
    for name, which, order, cap in tiers:
        pick = rest.where(which).orderBy(*order).limit(cap).withColumn("tier", F.lit(name))
        taken = pick if taken is None else taken.unionByName(pick)
        rest = rest.join(pick.select(ident), ident, "left_anti")
    return taken
