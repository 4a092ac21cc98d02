"""Duplicates hidden by formatting: external sort of canonical records, then a scan of adjacent runs.

Canonical records are range-partitioned by (key, identifier) and sorted within partitions, so that equal keys are
neighbours and a key of any size is spread over as many partitions as its rows need. Every partition is scanned once;
runs of equal full keys get their first identifier. A run may go on from one partition to the next: only each
partition's first and last run can, and for these, two keys a partition at most, the smallest identifier is found over
all partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import col, is_missing
from plumbline.session import cut

#: A text that is a DOI as a whole, with what people put before and after it.
_DOI = r"(?is)^[^\p{L}\p{N}]*(?:doi[^\p{L}\p{N}]*|https?:\/\/\S*?)?10\.\d{4,9}\/\S+[^\p{L}\p{N}]*$"


def folded(text: Column) -> Column:
    """Letters and digits only, without regard to case."""
    return F.lower(F.upper(F.regexp_replace(text, r"[^\p{L}\p{N}]+", "")))


def looks_like_doi(text: Column) -> Column:
    return F.coalesce(text.rlike(_DOI), F.lit(False))


def canonical_key(title: Column, doi: Column) -> Column:
    """The key under which formatting copies agree; NULL for records without a title.

    A DOI counts from its ``10.`` on. The two values are put in a fixed order, so a record that has them in each
    other's column gets the same key. Missing values agree with each other.
    """

    def part(c: Column) -> Column:
        bare = F.regexp_replace(c, r"(?s)^.*?(?=10\.\d{4,9}\/)", "")
        return F.when(is_missing(c), F.lit("")).otherwise(folded(F.when(looks_like_doi(c), bare).otherwise(c)))

    titled = ~is_missing(title) | (~is_missing(doi) & ~looks_like_doi(doi))
    a, b = part(title), part(doi)
    return F.when(titled, F.concat_ws(" ", F.least(a, b), F.greatest(a, b)))


def sort_key(columns: Sequence[Column]) -> Column:
    """Canonical key over any columns whose order within the record does not matter either: folded, sorted, joined."""
    return F.array_join(F.array_sort(F.array(*[F.coalesce(folded(c), F.lit("")) for c in columns])), " ")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scans one sorted partition: every row's run head, and a digest of the key for rows whose run may go on outside.

    A run that reaches the end of a batch is held back until it is known whether it ends there, at most one batch of
    it; what a longer run already sent carries the digest.
    """
    key, head, first = None, None, True  # of the run that is open
    held: list[np.ndarray] = []

    def digest(k: str) -> str:
        return hashlib.sha256(k.encode()).hexdigest()

    for b in batches:
        n = b.num_rows
        if not n:
            continue
        keys, ids = b.column(0), b.column(1).to_numpy(zero_copy_only=False)
        changed = pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False) if n > 1 else np.zeros(0, bool)
        starts = np.concatenate([[0], np.flatnonzero(changed) + 1])
        goes_on = keys[0].as_py() == key
        heads = np.repeat(ids[starts], np.diff(np.append(starts, n)))
        tail = int(starts[-1])
        out_ids, out_heads, out_keys = [], [], []

        def send(i, h, k):
            out_ids.append(i)
            out_heads.append(h)
            out_keys.extend([k] * len(i))

        if goes_on:
            heads[: int(starts[1]) if len(starts) > 1 else n] = head
        if goes_on and len(starts) == 1:  # nothing but the open run: send what was held, hold this
            for h in held:
                send(h, np.full(len(h), head), digest(key))
            held = [ids]
        else:
            mark = digest(key) if key is not None and first else None
            for h in held:
                send(h, np.full(len(h), head), mark)
            at = 0
            if goes_on:
                at = int(starts[1])
                send(ids[:at], heads[:at], mark)
            if key is not None:
                first = False
            if at < tail:
                end = int(starts[1]) if at == 0 and first else at
                if end > at:  # the partition's first run ends within its first batch
                    send(ids[:end], heads[:end], digest(keys[0].as_py()))
                    first = False
                send(ids[end:tail], heads[end:tail], None)
            key, head, held = keys[tail].as_py(), heads[tail], [ids[tail:]]
        if out_ids:
            yield _batch(np.concatenate(out_ids), np.concatenate(out_heads), out_keys)
    if key is not None:
        for h in held:
            yield _batch(h, np.full(len(h), head), [digest(key)] * len(h))


def _batch(ids: np.ndarray, heads: np.ndarray, keys: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(heads, pa.int64()), pa.array(keys, pa.string())], ["id", "head", "outer"])


def copy_heads(df: DataFrame, key: Column, ident: str, partitions: int | None = None) -> DataFrame:
    """``id`` and ``head`` (the smallest identifier of its group of copies) for every record with a key.

    Records whose key is NULL, or that have no identifier, take no part. Keys are compared in full, whatever their
    length. Repeated rows are copies of themselves. Columns of the input other than those used are ignored.
    """
    spark = df.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # keys are worked out once: ranges are found by a pass of their own over what is written here
    keyed = cut(df.select(key.alias("key"), col(ident).cast("bigint").alias("id")).where("key is not null and id is not null"))
    runs = cut(keyed.repartitionByRange(partitions, "key", "id").sortWithinPartitions("key", "id").mapInArrow(_scan, "id bigint, head bigint, outer string"))
    whole = runs.where("outer is not null").groupBy("outer").agg(F.min("head").alias("first"))
    return runs.join(whole, "outer", "left").select("id", F.coalesce("first", "head").alias("head"))


def copies(df: DataFrame, key: Column, ident: str) -> DataFrame:
    """One row per canonical record: ``representative`` (its smallest identifier) and ``copies`` (exact count)."""
    return copy_heads(df, key, ident).groupBy(F.col("head").alias("representative")).agg(F.count(F.lit(1)).alias("copies"))


def copy_pairs(df: DataFrame, key: Column, ident: str) -> DataFrame:
    """``ord_a`` (representative) and ``ord_b`` for each other record of the group."""
    return copy_heads(df, key, ident).where(F.col("head") != F.col("id")).select(F.col("head").alias("ord_a"), F.col("id").alias("ord_b"))
