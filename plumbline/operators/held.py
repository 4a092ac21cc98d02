"""Graphs whose vertices are numbers from 0, so that what is known of every vertex is an array.

Edges lie in blocks, all of a vertex's in one; a round is one narrow job over the blocks, with the arrays broadcast, and
brings back what has changed. The driver holds a few numbers a vertex, so a graph is worked on in this way up to a number
of vertices (``HELD_VERTICES``); larger ones are the work of joins, with the same results (operators/graph.py).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.order import global_position
from plumbline.session import cut

#: The most vertices of which the driver holds arrays, and the most edges that every task of betweenness holds.
HELD_VERTICES, HELD_EDGES = 10_000_000, 40_000_000
_BLOCK, _LEAST_BLOCK, _AT_ONCE = 1_000_000, 20_000, 2_000_000


def numbered(ids: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``ids`` (id, v) with their places in the order of id, and the edges with these numbers as ends."""
    ids = global_position(ids, ["id"], "v").select("id", F.col("v").cast("int").alias("v"))
    of = lambda end: ids.select(F.col("id").alias(end), F.col("v").alias(f"{end}_v"))
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    return ids, edges.join(of("src"), "src").join(of("dst"), "dst").select(F.col("src_v").alias("src"), F.col("dst_v").alias("dst"), *rest)


def blocks(edges: DataFrame, number: int, parts: int) -> DataFrame:
    """Of ``number`` edges (src, dst and, if there are weights, w) one row a partition: vertices, their numbers of edges,
    the other ends, and weights, laid end to end. Persisted."""
    weighted = "w" in edges.columns
    parts = max(min(parts, number // _LEAST_BLOCK), number // _BLOCK, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols: list[list[np.ndarray]] = [[], [], []]
        for b in batches:
            for c, x in zip(cols, b.columns):
                c.append(x.to_numpy(zero_copy_only=False))
        if not cols[0]:
            return
        src, dst = np.concatenate(cols[0]), np.concatenate(cols[1])
        order = np.lexsort((dst, src))
        ids, sizes = np.unique(src, return_counts=True)
        w = np.concatenate(cols[2])[order] if weighted else np.zeros(0)
        row = [ids.astype(np.int32), sizes.astype(np.int32), dst[order].astype(np.int32), w]
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in row], ["ids", "sizes", "dst", "w"])

    return edges.repartition(parts, "src").mapInArrow(run, "ids binary, sizes binary, dst binary, w binary").persist(StorageLevel.MEMORY_AND_DISK)


_KINDS = (np.int32, np.int32, np.int32, np.float64)


def _over(held: DataFrame, state: tuple, work: Callable, schema: str) -> pa.Table:
    """The columns that ``work(state, vertices, sizes, ends, weights)`` gives for each block, together on the driver."""
    shared = held.sparkSession.sparkContext.broadcast(state)
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                got = work(shared.value, *(np.frombuffer(c[k].as_py(), kind) for c, kind in zip(b.columns, _KINDS)))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in got], names)

    try:
        return held.mapInArrow(run, schema).toArrow()
    finally:
        shared.destroy()


def _column(t: pa.Table, k: int) -> np.ndarray:
    return t.column(k).to_numpy()


def _values(spark: SparkSession, **columns: np.ndarray) -> DataFrame:
    """A frame of arrays: ``v``, the vertices' numbers, and columns."""
    n = len(next(iter(columns.values())))
    return spark.createDataFrame(pa.table({"v": pa.array(np.arange(n, dtype=np.int32)), **{k: pa.array(x) for k, x in columns.items()}}))


# --- core numbers -----------------------------------------------------------------------------------------------


def _h_indices(state, ids, sizes, dst, _):
    """Vertices with a neighbour that has just fallen below them, if the h-index of the neighbours' numbers is below
    their own, too."""
    core, fell, first = state
    own = np.repeat(np.arange(len(ids)), sizes)
    mine, theirs = core[ids][own], core[dst]
    front = np.zeros(len(ids), bool)
    front[own[fell[dst] & ((theirs < mine) | first)]] = True
    take = front[own]
    own, x = own[take], np.minimum(mine[take], theirs[take])
    if not len(own):
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    key = np.sort((own.astype(np.int64) << 32) | (np.int64(2**32 - 1) - x))
    own, x = key >> 32, np.int64(2**32 - 1) - (key & np.int64(2**32 - 1))
    starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    rank = np.arange(len(own)) - np.repeat(starts, np.diff(np.append(starts, len(own)))) + 1
    new, v = np.maximum.reduceat(np.minimum(rank, x), starts), ids[own[starts]]
    less = new < core[v]
    return v[less].astype(np.int32), new[less].astype(np.int32)


def core_numbers(ids: DataFrame, near: DataFrame, parts: int) -> DataFrame:
    """``id, core`` of ``ids``; ``near`` holds every edge in both directions once."""
    ids, links = numbered(ids, near)
    spark, n = ids.sparkSession, ids.count()
    held = blocks(links, near.count(), parts)
    try:
        own = _over(held, (), lambda _, v, sizes, *rest: (v, sizes), "v int, core int")
        core = np.zeros(n, np.int32)
        core[_column(own, 0)] = _column(own, 1)
        fell = np.ones(n, bool)
        for step in count():
            got = _over(held, (core, fell, step == 0), _h_indices, "v int, core int")
            if not got.num_rows:
                break
            v = _column(got, 0)
            core[v] = _column(got, 1)
            fell = np.zeros(n, bool)
            fell[v] = True
    finally:
        held.unpersist()
    return ids.join(_values(spark, core=core.astype(np.int64)), "v").select("id", "core")


# --- communities ------------------------------------------------------------------------------------------------


def _moves(state, ids, sizes, dst, w):
    """The better communities of a half's vertices, and in the row of vertex -1 the weight within communities."""
    community, k, tot, turn, total, resolution = state
    own = np.repeat(np.arange(len(ids)), sizes)
    at, to = community[ids], community[dst]
    inside = w[at[own] == to].sum()
    take = turn[ids][own] & (ids[own] != dst)
    movers = np.flatnonzero(turn[ids])
    n = np.int64(len(community))
    key = np.concatenate([own[take] * n + to[take], movers * n + at[movers]])
    if not len(key):
        return np.array([-1], np.int32), np.zeros(1, np.int32), np.array([inside])
    weight = np.concatenate([w[take], np.zeros(len(movers))])
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    weight, v, c = np.add.reduceat(weight[order], starts), key[starts] // n, key[starts] % n
    moves = c != at[v]
    mine = k[ids][v]
    others = tot[c] - np.where(moves, 0.0, mine)
    gain = np.round(weight - resolution * mine * others / total, 9)
    order = np.lexsort((c, moves, -gain, v))
    v, c, moves = v[order], c[order], moves[order]
    best = np.concatenate([[True], v[1:] != v[:-1]]) & moves
    return np.append(ids[v[best]], -1).astype(np.int32), np.append(c[best], 0).astype(np.int32), np.append(np.zeros(best.sum()), inside)


def _between(held: DataFrame, place: np.ndarray) -> DataFrame:
    """The edges of the next level, between communities: added up within each block, then over all."""
    shared = held.sparkSession.sparkContext.broadcast(place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                ids, sizes, dst, w = (np.frombuffer(c[k].as_py(), kind) for c, kind in zip(b.columns, _KINDS))
                place = shared.value
                n = len(place)
                key = np.repeat(place[ids], sizes).astype(np.int64) * n + place[dst]
                order = np.argsort(key, kind="stable")
                key = key[order]
                starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                pair = key[starts]
                yield pa.RecordBatch.from_arrays([pa.array((pair // n).astype(np.int32)), pa.array((pair % n).astype(np.int32)), pa.array(np.add.reduceat(w[order], starts))], ["src", "dst", "w"])

    return cut(held.mapInArrow(run, "src int, dst int, w double").groupBy("src", "dst").agg(F.sum("w").alias("w")))


def communities(ids: DataFrame, near: DataFrame, parts: int, tol: float, resolution: float) -> DataFrame:
    """``id, community`` of ``ids``; ``near`` holds every edge in both directions once."""
    ids, links = numbered(ids, near)
    spark = ids.sparkSession
    halves = ids.select("v", F.pmod(F.xxhash64("id"), F.lit(2)).cast("int").alias("half")).toArrow()
    half = np.zeros(halves.num_rows, np.int8)
    half[_column(halves, 0)] = _column(halves, 1)
    whole = np.arange(len(half))  # of every vertex, the vertex of the level
    name = np.arange(len(half))  # of a level's vertex, the vertex that it is called by
    held = blocks(links.withColumn("w", F.lit(1.0)), near.count(), parts)
    best = None
    try:
        while True:
            n = len(name)
            sums = _over(held, (), lambda _, v, sizes, dst, w: (v, np.add.reduceat(w, np.cumsum(sizes) - sizes)), "v int, k double")
            if not sums.num_rows:
                break
            k = np.zeros(n)
            k[_column(sums, 0)] = _column(sums, 1)
            total, community = float(k.sum()), np.arange(n, dtype=np.int32)
            score = start = 0.0
            for step in count():
                tot = np.bincount(community, k, n)
                got = _over(held, (community, k, tot, half[name] == step % 2, total, resolution), _moves, "v int, community int, inside double")
                v, c, inside = (_column(got, i) for i in range(3))
                if step % 2 == 0:  # both halves have moved
                    now = float(inside.sum() / total - (tot * tot).sum() / (total * total))
                    if step and now - score < tol:
                        score = now
                        break
                    score = now
                    start = start if step else now
                community[v[v >= 0]] = c[v >= 0]
            if best is not None and score - start < tol:
                break
            best = score
            used, place = np.unique(community, return_inverse=True)
            whole, name = place[whole], name[used]
            level = _between(held, place.astype(np.int32))
            held.unpersist()
            held = blocks(level, level.count(), parts)
    finally:
        held.unpersist()
    first = np.full(len(name), len(half))
    np.minimum.at(first, whole, np.arange(len(whole)))
    named = ids.join(_values(spark, c=first[whole].astype(np.int32)), "v").select("id", "c")
    return named.join(ids.select(F.col("v").alias("c"), F.col("id").alias("community")), "c").select("id", "community")


# --- betweenness ------------------------------------------------------------------------------------------------


def _steps(graph: tuple, front: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The edges that leave ``front``, some at a time: from, to."""
    begin, sizes, dst = graph
    ends = np.cumsum(sizes[front], dtype=np.int64)
    at = 0
    while at < len(front):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _AT_ONCE, "right")))
        some = front[at:upto]
        k = sizes[some]
        total = int(k.sum())
        if total:
            edge = np.repeat(begin[some] - (np.cumsum(k) - k), k) + np.arange(total)
            yield np.repeat(some, k), dst[edge]
        at = upto


def _dependencies(graph: tuple, root: int, dist: np.ndarray, paths: np.ndarray, dep: np.ndarray, into: np.ndarray) -> None:
    """Adds to ``into`` how much each vertex is needed by the shortest paths from ``root``. The arrays come and go
    empty: ``dist`` -1, the others 0."""
    dist[root], paths[root] = 0, 1.0
    fronts = [np.array([root])]
    while len(front := fronts[-1]):
        depth, fresh = len(fronts), []
        for of, to in _steps(graph, front):
            new = to[dist[to] < 0]
            if len(new) * 8 < len(dist):
                new = np.unique(new)
                dist[new] = depth
            else:
                dist[new] = -2
                new = np.flatnonzero(dist == -2)
                dist[new] = depth
            fresh.append(new)
            tree = dist[to] == depth
            np.add.at(paths, to[tree], paths[of[tree]])
        fronts.append(np.concatenate(fresh) if fresh else front[:0])
    for depth in range(len(fronts) - 2, -1, -1):
        for of, to in _steps(graph, fronts[depth]):
            tree = dist[to] == depth + 1
            of, to = of[tree], to[tree]
            np.add.at(dep, of, paths[of] / paths[to] * (1 + dep[to]))
    for depth, front in enumerate(fronts):
        if depth:
            into[front] += dep[front]
    for front in fronts:
        dist[front], paths[front], dep[front] = -1, 0.0, 0.0


def betweenness(ids: DataFrame, edges: DataFrame, number: int, pivots: int, parts: int) -> DataFrame:
    """``id, v`` of ``ids`` and ``dep``, the sum over the pivots, who are chosen by hash. Every task holds the graph of
    ``number`` edges, four bytes an edge, and has some pivots of its own."""
    ids, links = numbered(ids, edges)
    spark, n = ids.sparkSession, ids.count()
    roots = _column(ids.orderBy(F.xxhash64("id"), "id").limit(pivots).select("v").toArrow(), 0)
    begin, sizes, dst, at = np.zeros(n, np.int64), np.zeros(n, np.int32), np.zeros(number, np.int32), 0
    held = blocks(links, number, parts)
    try:
        for row in held.toLocalIterator():
            v, k, ends = (np.frombuffer(x, np.int32) for x in row[:3])
            begin[v], sizes[v] = at + np.cumsum(k) - k, k
            dst[at : at + len(ends)] = ends
            at += len(ends)
    finally:
        held.unpersist()
    shared = spark.sparkContext.broadcast((begin, sizes, dst, roots))
    tasks = max(1, min(len(roots), max(parts, len(roots) // 100)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin, sizes, dst, roots = shared.value
        n = len(begin)
        dist, paths, dep, into = np.full(n, -1, np.int32), np.zeros(n), np.zeros(n), np.zeros(n)
        for b in batches:
            for k in b.column(0).to_pylist():
                for root in roots[k::tasks]:
                    _dependencies((begin, sizes, dst), int(root), dist, paths, dep, into)
        v = np.flatnonzero(into)
        yield pa.RecordBatch.from_arrays([pa.array(v.astype(np.int32)), pa.array(into[v])], ["v", "dep"])

    try:
        sums = cut(spark.range(0, tasks, 1, tasks).mapInArrow(run, "v int, dep double").groupBy("v").agg(F.sum("dep").alias("dep")))
    finally:
        shared.destroy()
    return ids.join(sums, "v", "left")
