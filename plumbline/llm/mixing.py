"""Mixing sources to target weights: Pfair schedules of blocks, earliest deadline first.

Every source is a task whose weight w is its quota of tokens over all quotas, a ratio of whole numbers that is never
rounded. Its j-th block (from 0) is released at slot floor(j / w) and due by slot ceil((j + 1) / w); each slot takes, of
the blocks released, the one due first. The weights sum to 1, so every block is placed between release and deadline, and
at any point of the mix a source is less than one block away from its share.

The whole mix is scheduled, not a frame that repeats. A mix has at most ``max_slots`` slots, so blocks are larger in
larger mixes: the deviation stays below 1 / max_slots of the mix, and the plan has the same size for any data. Documents
look up the slot of their block in parallel. A document stands in the block in which it starts, so in tokens a source is
off by less than one block and its longest document. Positions within a source are running sums of sizes, worked out
bucket by bucket, so a source of any size is spread over many tasks.
"""

from __future__ import annotations

import base64
import heapq
import math
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from fractions import Fraction
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import col, present, trimmed
from plumbline.session import cut

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how byte-level BPE vocabularies of this kind cut text before merging.
PRE_TOKENS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


@lru_cache(maxsize=2)
def _encoding(vocabulary: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("own", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, ident: str, source: str, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """``id``, ``source`` (trimmed, lower case) and ``tokens`` of every document with a source and at least one token.

    The whole text counts. Rows with the same identifier are one document. NULL and empty texts have no tokens.
    ``tokenizer`` is a vocabulary file that the driver can read; it travels with the tasks, so executors need no copy.
    """
    with open(tokenizer, "rb") as f:
        vocabulary = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(vocabulary).encode_ordinary
        for b in batches:
            sizes = [len(encode(t)) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sizes, pa.int64())], ["id", "source", "tokens"])

    where = F.lower(trimmed(present(col(source))))
    rows = df.select(col(ident).cast("bigint").alias("id"), where.alias("source"), col(text).cast("string").alias("text"))
    counted = rows.where("id is not null and source is not null and text is not null").mapInArrow(run, "id bigint, source string, tokens bigint")
    return counted.where("tokens > 0").groupBy("id").agg(F.min("source").alias("source"), F.max("tokens").alias("tokens"))


def pfair_slots(quota: Mapping[str, int], block: int) -> dict[str, list[int]]:
    """The slot of each block of ``block`` tokens of every source; a source's last block may be shorter."""
    total = sum(quota.values())
    blocks = {s: -(-q // block) for s, q in quota.items() if q > 0}
    slots: dict[str, list[int]] = {s: [] for s in quota}
    waiting = [(0, s) for s in sorted(blocks)]  # by release
    ready: list[tuple[int, int, str]] = []  # by deadline, then the scarcer source
    t = 0
    while waiting or ready:
        if not ready:
            t = max(t, waiting[0][0])
        while waiting and waiting[0][0] <= t:
            _, s = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(len(slots[s]) + 1) * total // quota[s]), quota[s], s))
        _, _, s = heapq.heappop(ready)
        slots[s].append(t)
        t += 1
        if (j := len(slots[s])) < blocks[s]:
            heapq.heappush(waiting, (max(t, j * total // quota[s]), s))
    return slots


@dataclass(frozen=True)
class Quota:
    """What one source gives to one mix."""

    mix: str
    source: str
    share: float
    max_repeats: int
    available: int  # tokens of one pass
    tokens: int  # to be given


def quotas(targets: list[tuple[str, str, float, int]], available: Mapping[str, int]) -> list[Quota]:
    """Quotas in whole tokens: the largest totals at which no source with documents needs more than its repeats.

    A source without documents cannot give anything: its target is out of reach, the others keep their proportions.
    Shares are taken as the decimal numbers they are written as, so a quota is off by less than one token.
    """
    out = []
    for mix in sorted({t[0] for t in targets}):
        rows = [(s, share, reps) for m, s, share, reps in targets if m == mix]
        able = [(available.get(s, 0) * reps, Fraction(repr(share))) for s, share, reps in rows if share > 0 and available.get(s, 0) * reps > 0]
        total = min((most / share for most, share in able), default=Fraction(0))
        give = {s: math.floor(Fraction(repr(share)) * total) for s, share, reps in rows if share > 0 and available.get(s, 0) * reps > 0}
        out += [Quota(mix, s, share, reps, available.get(s, 0), give.get(s, 0)) for s, share, reps in rows]
    return out


def block_size(plan: list[Quota], mix: str, least: int, max_slots: int) -> int:
    return max(least, -(-sum(q.tokens for q in plan if q.mix == mix) // max_slots))


@dataclass(frozen=True)
class Mix:
    """``schedule``: mix_name, slot, start, source, doc_id, copy_no, tokens. ``shares``: one row a target.
    ``deviation``: how far, in tokens, each source is ahead of and behind its share at most, anywhere in the mix."""

    schedule: DataFrame
    shares: DataFrame
    deviation: DataFrame


def mix_sources(sizes: DataFrame, targets: DataFrame, block_tokens: int = 4096, bucket_rows: int = 50_000, seed: int = 7, max_slots: int = 200_000) -> Mix:
    """Mix documents to the target shares.

    Blocks have ``block_tokens`` tokens, or more where a mix would have more than ``max_slots`` of them.

    ``sizes``: id, source, tokens. ``targets``: mix_name, source, target_share, max_repeats, one row for each mix and
    source (a small table by nature: it reaches the driver). A source's documents come in a hashed order; when it is
    used up it starts again, up to max_repeats times. A copy is used if at least half of it lies within the quota, so a
    source is off by less than half a document. Targets with NULL names, shares or repeats are left out; sources
    without targets are not used; empty tables give an empty schedule and shares of 0.
    """
    spark = sizes.sparkSession
    wanted = [
        (r[0], r[1], float(r[2]), int(r[3]))
        for r in targets.select("mix_name", F.lower(trimmed(F.col("source"))), "target_share", "max_repeats").collect()
        if None not in tuple(r) and r[2] > 0 and r[3] > 0
    ]
    names = sorted({t[1] for t in wanted})
    used = cut(sizes.where(F.col("source").isin(names)))  # sized once, read by several steps
    totals = {r[0]: (r[1], r[2]) for r in used.groupBy("source").agg(F.sum("tokens"), F.count(F.lit(1))).collect()}
    plan = quotas(wanted, {s: t for s, (t, _) in totals.items()})

    buckets = max(1, math.ceil(max((n for _, n in totals.values()), default=0) / bucket_rows))
    order = F.xxhash64("id", F.lit(seed))
    spread = used.withColumn("h", order).withColumn("bucket", F.pmod(F.shiftright("h", 8), F.lit(buckets)))
    base = spread.groupBy("source", "bucket").agg(F.sum("tokens").alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # over buckets, not rows
    base = base.select("source", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "bucket").orderBy("h", "id").rowsBetween(Window.unboundedPreceding, -1)
    placed = spread.withColumn("inside", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(base, ["source", "bucket"])
    placed = placed.select("id", "source", "tokens", (F.col("base") + F.col("inside")).alias("at"))

    blocks = {m: block_size(plan, m, block_tokens, max_slots) for m in {q.mix for q in plan}}
    slots_of = {m: pfair_slots({q.source: q.tokens for q in plan if q.mix == m}, b) for m, b in blocks.items()}
    rows = [(q.mix, q.source, q.share, q.max_repeats, q.available, q.tokens, blocks[q.mix]) for q in plan]
    quota = spark.createDataFrame(rows, "mix_name string, source string, target_share double, max_repeats int, available bigint, quota bigint, block_tokens bigint")
    # at most max_slots numbers a mix
    slots = spark.createDataFrame([(q.mix, q.source, slots_of[q.mix][q.source]) for q in plan if q.tokens], "mix_name string, source string, slots array<int>")

    half = F.col("tokens") / 2.0
    fitting = F.floor((F.col("quota") - F.col("at") - half) / F.col("available")) + 1
    uses = placed.join(F.broadcast(quota), "source").withColumn("uses", F.least(fitting, F.col("max_repeats").cast("bigint"))).where("uses > 0")
    copies = uses.select("mix_name", "source", "id", "tokens", "at", "available", "block_tokens", F.explode(F.sequence(F.lit(1), F.col("uses").cast("int"))).alias("copy_no"))
    start = F.col("at") + (F.col("copy_no") - 1) * F.col("available")
    slot = F.get("slots", F.floor(start / F.col("block_tokens")).cast("int"))
    schedule = copies.join(F.broadcast(slots), ["mix_name", "source"]).select("mix_name", slot.cast("bigint").alias("slot"), start.cast("bigint").alias("start"), "source", F.col("id").alias("doc_id"), "copy_no", "tokens")

    given = uses.groupBy("mix_name", "source").agg(
        F.sum(F.col("tokens") * F.col("uses")).alias("tokens"), F.sum("uses").alias("copies"), F.count(F.lit(1)).alias("documents"), F.max("uses").alias("repeats_used")
    )
    whole = Window.partitionBy("mix_name")  # one row a target
    tokens = F.coalesce("tokens", F.lit(0))
    shares = quota.join(given, ["mix_name", "source"], "left").select(
        "mix_name", "source", "target_share", F.round(F.coalesce(tokens / F.nullif(F.sum(tokens).over(whole), F.lit(0)), F.lit(0.0)), 6).alias("actual_share"),
        tokens.alias("tokens"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("copies", F.lit(0)).alias("copies"),
        F.coalesce("repeats_used", F.lit(0)).cast("int").alias("repeats_used"), "max_repeats", (F.col("quota") > 0).alias("in_reach"),
    )
    return Mix(schedule, shares, _deviation(schedule, quota))


def _deviation(schedule: DataFrame, quota: DataFrame) -> DataFrame:
    """Sums of slots, at most max_slots a mix, run up in order: a source is furthest behind before one of its slots, and
    furthest ahead after it."""
    sums = schedule.groupBy("mix_name", "slot", "source").agg(F.sum("tokens").alias("n"))
    mix, own = Window.partitionBy("mix_name").orderBy("slot", "source"), Window.partitionBy("mix_name", "source").orderBy("slot")
    total = Window.partitionBy("mix_name")
    weighed = quota.select("mix_name", "source", "block_tokens", (F.col("quota") / F.sum("quota").over(total)).alias("w"))
    run = sums.withColumn("all", F.sum("n").over(mix)).withColumn("own", F.sum("n").over(own)).join(F.broadcast(weighed), ["mix_name", "source"])
    after, before = F.col("own") - F.col("w") * F.col("all"), F.col("w") * (F.col("all") - F.col("n")) - (F.col("own") - F.col("n"))
    out = run.groupBy("mix_name", "source").agg(F.max("block_tokens").alias("block_tokens"), F.round(F.max(after), 1).alias("most_ahead"), F.round(F.max(before), 1).alias("most_behind"))
    longest = schedule.groupBy("mix_name", "source").agg(F.max("tokens").alias("longest"))
    return out.join(longest, ["mix_name", "source"])
