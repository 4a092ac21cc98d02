"""Recommendations, reading lists and layouts over graphs and assignments (section 2.12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.graph import both_ways, induced


def head_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank_no", salts: int = 32) -> DataFrame:
    """The first ``n`` rows of every group in order, ranked from 1; ``order`` should end with an identifier.

    Two stages: rows are ranked within hashed parts of their group, whose survivors, ``n * salts`` a group at most, are
    ranked again, so a group with a third of all rows is the work of many tasks.
    """
    keys = [F.col(g) for g in group]
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns if dict(df.dtypes)[c] != "map"]), F.lit(salts))
    part = Window.partitionBy(*keys, "salt__").orderBy(*order)
    few = df.withColumn("salt__", salt).withColumn("r__", F.row_number().over(part)).where(F.col("r__") <= n).drop("r__", "salt__")
    return few.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= n)


def next_topics(edges: DataFrame, topic_of: DataFrame, priority: DataFrame, least: int = 2, most: int = 3) -> DataFrame:
    """SEL-18: topics that a topic leads to: ``topic, next_topic, links, rank_no``.

    Links across topics are counted; .7 of their number and .3 of the target's mean priority make the score.
    ``topic_of``: id, topic. ``priority``: id, priority.
    """
    a, b = topic_of.select(F.col("id").alias("src"), F.col("topic")), topic_of.select(F.col("id").alias("dst"), F.col("topic").alias("next_topic"))
    links = edges.join(a, "src").join(b, "dst").where("topic <> next_topic").groupBy("topic", "next_topic").agg(F.count(F.lit(1)).alias("links")).where(F.col("links") >= least)
    mean = topic_of.join(priority, "id").groupBy(F.col("topic").alias("next_topic")).agg(F.avg("priority").alias("p"))
    scored = links.join(mean, "next_topic", "left").withColumn("score", F.round(0.7 * F.col("links") + 0.3 * F.coalesce("p", F.lit(0.0)), 6))
    return head_per_group(scored.drop("p"), ["topic"], [F.desc("score"), F.asc("next_topic")], most)


def seed_lists(path: DataFrame, assigned: DataFrame, most: int = 14) -> DataFrame:
    """SEL-22: members of a topic's reading path first, then those assigned to it, each once: ``topic, id, rank_no``.

    ``path`` and ``assigned``: topic, id, place.
    """
    both = path.select("topic", "id", F.lit(0).alias("kind"), "place").unionByName(assigned.select("topic", "id", F.lit(1).alias("kind"), "place"))
    once = both.groupBy("topic", "id").agg(F.min(F.struct("kind", "place")).alias("o"))
    return head_per_group(once, ["topic"], [F.asc("o"), F.asc("id")], most).select("topic", "id", "rank_no")


def journey(scored: DataFrame, easy: int, bridges: int = 5, dives: int = 8) -> DataFrame:
    """SEL-23: foundations by difficulty, bridges by overlap with what is chosen, deep dives by a blend: ``stage, id, rank_no``.

    ``scored``: id, difficulty, relevance, overlap, core, cites.
    """
    blend = F.round(F.col("relevance") + 2 * F.col("overlap") + 1.4 * F.col("core") + 0.2 * F.log1p(F.col("cites").cast("double")), 6)
    stages = [
        ("foundation", scored.where(F.col("relevance") > 0), [F.asc("difficulty"), F.desc("relevance"), F.asc("id")], easy),
        ("bridge", scored.where(F.col("overlap") > 0), [F.desc("overlap"), F.asc("id")], bridges),
        ("deep", scored, [F.desc("blend"), F.asc("id")], dives),
    ]
    out = None
    for stage, rows, order, n in stages:
        top = rows.withColumn("blend", blend).orderBy(*order).limit(n).withColumn("rank_no", F.row_number().over(Window.partitionBy().orderBy(*order)))  # n rows
        part = top.select(F.lit(stage).alias("stage"), "id", "rank_no")
        out = part if out is None else out.unionByName(part)
    return out


def companions(edges: DataFrame, members: DataFrame, least: int = 2, most: int = 10) -> DataFrame:
    """SEL-24: vertices outside a group with ``least`` or more links into it: ``grp, id, links, rank_no``. ``members``: id, grp."""
    near = both_ways(edges)
    inside = near.join(members.select(F.col("id").alias("src"), "grp"), "src").groupBy("grp", F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("links")).where(F.col("links") >= least)
    outside = inside.join(members.select("id", "grp"), ["id", "grp"], "left_anti")
    return head_per_group(outside, ["grp"], [F.desc("links"), F.asc("id")], most)


def anchors(edges: DataFrame, members: DataFrame, most: int = 5) -> DataFrame:
    """SEL-24: the members of a group that its other members point to most: ``grp, id, cited, rank_no``."""
    m = members.select("id", "grp")
    inner = edges.join(m.select(F.col("id").alias("src"), F.col("grp").alias("a")), "src").join(m.select(F.col("id").alias("dst"), "grp"), "dst").where("a = grp")
    return head_per_group(inner.groupBy("grp", F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("cited")), ["grp"], [F.desc("cited"), F.asc("id")], most)


def visible(edges: DataFrame, hits: DataFrame) -> DataFrame:
    """FLT-15: what a search shows: the hits and their neighbours: ``id, hit``."""
    start = hits.select("id").distinct()
    near = both_ways(edges).join(start.withColumnRenamed("id", "src"), "src", "left_semi").select(F.col("dst").alias("id"))
    return start.withColumn("hit", F.lit(True)).unionByName(near.withColumn("hit", F.lit(False))).groupBy("id").agg(F.max("hit").alias("hit"))


def above_threshold(edges: DataFrame, score: DataFrame, least: float) -> DataFrame:
    """FLT-14: edges between vertices that reach a score. ``score``: id, score."""
    return induced(edges, score.where(F.col("score") >= least))


def kinship(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """GRA-18: parents (cited) and children (citing) of each vertex: ``id, other, kind``."""
    start = ids.select("id").distinct()
    up = start.join(edges, F.col("id") == F.col("src")).select("id", F.col("dst").alias("other"), F.lit("parent").alias("kind"))
    down = start.join(edges, F.col("id") == F.col("dst")).select("id", F.col("src").alias("other"), F.lit("child").alias("kind"))
    return up.unionByName(down).distinct()


def nearest_in_layer(nodes: DataFrame, layer: str, place: str) -> DataFrame:
    """GRA-27: the node of the next layer that lies nearest to each node (the smaller id of equals): ``id, nearest``.

    ``nodes``: id, the layer's number and a position. Only the next lower and higher position are compared, found by a
    running maximum and minimum over both layers, so no layer is paired with another. The window is over one layer pair.
    """
    own = nodes.select("id", F.col(layer).alias("l"), F.col(place).alias("y"), F.lit(0).alias("target"))
    nxt = nodes.select("id", (F.col(layer) - 1).alias("l"), F.col(place).alias("y"), F.lit(1).alias("target"))
    both = own.unionByName(nxt)
    mark = lambda order_id: F.when(F.col("target") == 1, F.struct(F.col("y").alias("y"), order_id.alias("o"), F.col("id").alias("id")))
    upto = Window.partitionBy("l").orderBy("y").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    on = Window.partitionBy("l").orderBy("y").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    low = F.max(mark(-F.col("id"))).over(upto)
    high = F.min(mark(F.col("id"))).over(on)
    found = both.withColumn("a", low).withColumn("b", high).where("target = 0")
    da, db = F.col("y") - F.col("a.y"), F.col("b.y") - F.col("y")
    pick = F.when(F.col("a").isNull(), F.col("b.id")).when(F.col("b").isNull(), F.col("a.id")).when(da < db, F.col("a.id")).when(db < da, F.col("b.id")).otherwise(F.least("a.id", "b.id"))
    return found.select("id", pick.alias("nearest")).where("nearest is not null")


def tree_layout(parents: DataFrame, rounds: int | None = None) -> DataFrame:
    """GRA-21: places in a forest: ``id, depth, x``: leaves one after another in the order of their paths, parents midway
    between their first and last leaf. ``parents``: id, parent (NULL for roots).

    Depths and paths grow level by level from the roots; the spans of leaves come from the paths, which are ordered once.
    Vertices on a cycle, which no root reaches, have no place.
    """
    from plumbline.operators.order import global_position
    from plumbline.session import cut

    front = cut(parents.where("parent is null").select("id", F.lit(0).alias("depth"), F.array(F.lpad(F.col("id").cast("string"), 20, "0")).alias("path")))
    placed, d = front, 0
    kids = parents.where("parent is not null")
    while rounds is None or d < rounds:
        d += 1
        front = cut(kids.join(front.select(F.col("id").alias("parent"), F.col("path").alias("above")), "parent").select("id", F.lit(d).alias("depth"), F.concat("above", F.array(F.lpad(F.col("id").cast("string"), 20, "0"))).alias("path")))
        if front.isEmpty():
            break
        placed = placed.unionByName(front)
    leaves = placed.join(kids.select(F.col("parent").alias("id")).distinct(), "id", "left_anti")
    at = global_position(leaves.withColumn("key", F.array_join("path", "/")), ["key"], "x")
    spans = at.select(F.explode("path").alias("v"), "x").groupBy("v").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    own = placed.withColumn("v", F.element_at("path", -1)).join(spans, "v")
    return own.select("id", "depth", ((F.col("lo") + F.col("hi")) / 2.0).alias("x"))


def barycentre_layout(nodes: DataFrame, edges: DataFrame, sweeps: int = 4) -> DataFrame:
    """GRA-23: places in layers: ``id, layer, y``. Every sweep orders a layer by the mean place of the neighbours in the
    layer before (then after, in turn); ties by id. Edges between adjacent layers only. ``nodes``: id, layer.

    A sweep is a join and one ranking a layer; layers of a drawing are small by nature.
    """
    from plumbline.session import cut

    by_layer = lambda *o: F.row_number().over(Window.partitionBy("layer").orderBy(*o)) - 1
    place = cut(nodes.select("id", "layer", by_layer("id").alias("y")))
    near = both_ways(edges)
    for k in range(sweeps):
        side = -1 if k % 2 == 0 else 1
        other = place.select(F.col("id").alias("dst"), F.col("layer").alias("ol"), F.col("y").alias("oy"))
        mean = place.join(near, F.col("id") == F.col("src")).join(other, "dst").where(F.col("ol") == F.col("layer") + side).groupBy("id").agg(F.avg("oy").alias("m"))
        moved = place.join(mean, "id", "left")
        place = cut(moved.select("id", "layer", by_layer(F.coalesce("m", F.col("y").cast("double")), "id").alias("y")))
    return place
