"""Places and running totals in a global order without sorting everything in one task: range partitions, each run through
on its own, and the totals of the partitions before as offsets."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import col, fresh
from plumbline.session import cut


def running_total(df: DataFrame, order: Sequence[str | Column], value: str, out: str, partitions: int | None = None) -> DataFrame:
    """``df`` with ``out``: the sum of the whole numbers ``value`` up to and with each row, in ``order``, which should
    end with an identifier (or hold every row's value once). NULL counts as 0.

    A key that fills a third of the rows is spread by what follows it in the order. One small row a partition is
    collected.
    """
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part, within, step = fresh(df, "part", "within", "step")
    stepped = cut(df.withColumn(step, F.coalesce(col(value), F.lit(0)).cast("bigint")))  # ranges are found by a pass of their own
    names = [*stepped.columns, within]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for b in batches:
            sums = np.cumsum(b.column(b.num_columns - 1).to_numpy(zero_copy_only=False)) + total
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sums, pa.int64())], names)
            total = int(sums[-1]) if len(sums) else total

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stepped.schema.fields) + f", {within} bigint"
    ordered = cut(stepped.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(run, schema).withColumn(part, F.spark_partition_id()))
    tops = {r[0]: r[1] for r in ordered.groupBy(part).agg(F.sum(step)).collect()}
    offsets = [0]
    for k in range(max(tops, default=0)):
        offsets.append(offsets[-1] + tops.get(k, 0))
    offset = F.get(F.array(*[F.lit(o).cast("bigint") for o in offsets]), F.col(part))
    return ordered.withColumn(out, F.col(within) + offset).drop(part, within, step)


def position_in_group(df: DataFrame, group: str, order: Sequence[str | Column], out: str) -> DataFrame:
    """``df`` with ``out``, every row's place (from 0) within its group in ``order``, which should end with an identifier.

    Places in the global order of groups, less those of the groups before, so a group of any size is the work of many
    tasks. Rows without a group are one group.
    """
    g, start = fresh(df, "g", "start")
    placed = global_position(df, [col(group), *order], out)
    begins = placed.groupBy(col(group).alias(g)).agg(F.min(out).alias(start))
    return placed.join(begins, col(group).eqNullSafe(F.col(g))).withColumn(out, F.col(out) - F.col(start)).drop(g, start)


def global_position(df: DataFrame, order: Sequence[str | Column], out: str, partitions: int | None = None) -> DataFrame:
    """``df`` with ``out``, every row's place (from 0) in ``order``."""
    (one,) = fresh(df, "one")
    return running_total(df.withColumn(one, F.lit(1)), order, one, out, partitions).withColumn(out, F.col(out) - 1).drop(one)
