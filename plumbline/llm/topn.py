"""Top N items within every group, by two-stage salted ranking.

Each group is hashed into subgroups by the item's identifier; every subgroup keeps its own best N (Spark also trims
each map task to N rows before the shuffle, by its window group limit), and the survivors, at most N times the number
of subgroups per group, are ranked again. A group of any size is thus spread over ``salts`` tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import col, fresh


def latest_per_key(df: DataFrame, key: str, when: str, tie: str, keep: Sequence[str]) -> DataFrame:
    """One row per ``key``: that with the greatest ``when``, then the smallest ``tie``; columns ``key`` and ``keep``.

    An aggregate, so a key that fills a third of the rows is reduced in every map task before the shuffle. Rows with a
    NULL key form no group; a NULL ``when`` counts as oldest, a NULL ``tie`` as last; rows equal in both are decided by
    the kept values, so the result is repeatable.
    """
    newest = F.struct(col(when).alias("w"), (-col(tie)).alias("t"), F.struct(*[col(c) for c in keep]).alias("kept"))
    (slot,) = fresh([key, *keep], "newest")
    picked = df.where(col(key).isNotNull()).groupBy(col(key)).agg(F.max(newest).alias(slot))
    return picked.select(col(key), *[F.col(slot)["kept"][c].alias(c) for c in keep])


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, salt_by: Sequence[str], rank: str = "rank_no", salts: int = 32) -> DataFrame:
    """The first ``n`` rows of every group under ``order``, with their rank from 1 in the column ``rank``.

    ``order`` should end with an identifier so that it is total; then the result is repeatable. ``salt_by`` names
    columns that spread a group's rows, usually that identifier. NULL group values form a group of their own. Fewer
    than ``n`` rows: all come out. An empty table gives an empty result. If the frame already has a column named as
    ``rank``, it is replaced in the result.
    """
    salt, first, final = fresh(df, "salt", "subrank", "final_rank")
    groups = [col(g) for g in group]
    salted = df.withColumn(salt, F.pmod(F.xxhash64(*[col(c) for c in salt_by]), F.lit(salts)))
    within = Window.partitionBy(*groups, F.col(salt)).orderBy(*order)
    survivors = salted.withColumn(first, F.row_number().over(within)).where(F.col(first) <= n).drop(first, salt)
    across = Window.partitionBy(*groups).orderBy(*order)
    return survivors.withColumn(final, F.row_number().over(across)).where(F.col(final) <= n).withColumn(rank, F.col(final)).drop(final)
