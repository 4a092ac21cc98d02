"""Graph operators over edge frames ``src, dst`` (and vertex frames ``id``).

Iterative operators keep their state as frames, cut the lineage in the checkpoint folder and stop on a counted condition;
nothing but single numbers reaches the driver. Core numbers, communities and betweenness of graphs of a bounded size are
worked out on arrays instead (operators/held.py), and by joins beyond it. Metrics take ``nodes`` (column id): vertices that may have no edge are then
part of the graph. Without it, the vertices are the ends of the edges.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import fresh
from plumbline.operators import held
from plumbline.operators.order import position_in_group
from plumbline.session import cut


def clean_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """GRA-01, GRA-15: distinct directed edges without NULL ends and self loops."""
    return edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).where("src is not null and dst is not null and src <> dst").distinct()


def both_ways(edges: DataFrame) -> DataFrame:
    """GRA-11: every edge in both directions, once each."""
    return edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).where("src <> dst").distinct()


def vertices(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """The ends of the edges and ``nodes``, once each."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    return (ends if nodes is None else ends.unionByName(nodes.select("id").where("id is not null"))).distinct()


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def induced(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """JON-10: edges with both ends among ``ids``."""
    some = ids.select("id").distinct()
    return edges.join(some.withColumnRenamed("id", "src"), "src", "left_semi").join(some.withColumnRenamed("id", "dst"), "dst", "left_semi").select("src", "dst")


def degrees(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """GRA-03: in, out and total degree of every vertex; one aggregate."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("src").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")), F.struct(F.col("dst").alias("id"), F.lit(0).alias("o"), F.lit(1).alias("i")))).alias("e")).select("e.id", "e.o", "e.i")
    if nodes is not None:
        ends = ends.unionByName(nodes.select("id", F.lit(0).alias("o"), F.lit(0).alias("i")).where("id is not null"))
    return ends.groupBy("id").agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"), F.sum(F.col("i") + F.col("o")).alias("degree"))


def pagerank(edges: DataFrame, alpha: float = 0.85, max_iter: int = 100, tol: float = 1e-6, nodes: DataFrame | None = None) -> DataFrame:
    """GRA-02: ``id, rank``. Uniform start, dangling mass spread evenly, until the summed change is below n * tol.

    The edges with their source's share are partitioned by source once and kept so; a round moves the ranks and partial
    sums of what flows to each vertex, so a vertex with a third of all edges sends partial sums, too. The change and the
    mass that dangles are observed while a round is written to the checkpoint folder: one job a round.
    """
    ids = cut(vertices(edges, nodes))
    n = ids.count()
    if n == 0:
        return ids.withColumn("rank", F.lit(0.0))
    out = edges.groupBy("src").agg(F.count(F.lit(1)).alias("out"))
    links = edges.join(out, "src").select("src", "dst", "out").repartition(_partitions(edges), "src").persist()
    start = ids.join(out.withColumnRenamed("src", "id"), "id", "left").select("id", F.col("out").isNull().alias("dangling"), F.lit(1.0 / n).alias("rank"))
    dangling = F.coalesce(F.sum(F.when(F.col("dangling"), F.col("rank"))), F.lit(0.0)).alias("lost")
    ranks, seen = _observed(start, dangling)
    try:
        for _ in range(max_iter):
            base = (1 - alpha) / n + alpha * seen["lost"] / n
            gained = links.join(ranks.select(F.col("id").alias("src"), "rank"), "src").groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("rank") / F.col("out")).alias("g"))
            new = ranks.join(gained, "id", "left").select("id", "dangling", (F.lit(base) + alpha * F.coalesce("g", F.lit(0.0))).alias("rank"), F.col("rank").alias("before"))
            ranks, seen = _observed(new, dangling, F.sum(F.abs(F.col("rank") - F.col("before"))).alias("change"))
            ranks = ranks.drop("before")
            if seen["change"] < n * tol:
                break
    finally:
        links.unpersist()
    return ranks.select("id", "rank")


def _observed(df: DataFrame, *metrics: Column) -> tuple[DataFrame, dict]:
    """The frame, written to the checkpoint folder, and aggregates over it that are taken along."""
    seen = Observation()
    out = cut(df.observe(seen, *metrics))
    return out, seen.get


def frontier(edges: DataFrame, seeds: DataFrame, max_depth: int | None, label: str = "label") -> DataFrame:
    """GRA-07, GRA-12, GRA-13: least distance from each label's seeds: ``label, id, dist`` up to ``max_depth`` (None: until empty).

    ``seeds``: label, id. All labels advance together. Each round joins only the last front and takes out what was
    reached before.
    """
    reached = cut(seeds.select(F.col(label).alias("label"), "id").where("label is not null and id is not null").distinct().withColumn("dist", F.lit(0)))
    front = reached
    for d in count(1) if max_depth is None else range(1, max_depth + 1):
        step = front.join(edges, F.col("id") == F.col("src")).select("label", F.col("dst").alias("id")).distinct()
        front = cut(step.join(reached, ["label", "id"], "left_anti").withColumn("dist", F.lit(d)))
        if front.isEmpty():
            break
        reached = reached.unionByName(front)
    return reached


def lineage(edges: DataFrame, seeds: DataFrame, max_depth: int = 4, decay: float = 0.7) -> DataFrame:
    """GRA-07: over reversed edges from every seed: least distance, number of seeds, and the sum of decay^distance."""
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    reach = frontier(back, seeds.select(F.col("id").alias("label"), "id"), max_depth)
    return reach.groupBy("id").agg(F.min("dist").alias("min_seed_distance"), F.count(F.lit(1)).alias("seeds_reached"), F.round(F.sum(F.pow(F.lit(decay), F.col("dist"))), 6).alias("lineage"))


def support(edges: DataFrame, topics: DataFrame, max_hops: int = 4, decay: float = 0.65) -> DataFrame:
    """GRA-12: for each vertex and topic the hops to the topic's seeds and decay^(hops - 1); seeds themselves excluded."""
    reach = frontier(both_ways(edges), topics, max_hops)
    return reach.where("dist > 0").select("id", "label", "dist", F.round(F.pow(F.lit(decay), F.col("dist") - 1), 6).alias("support"))


def generations(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """GRA-14: vertices that cite nothing are generation 0; others their least distance to one; 0 if there is none."""
    ids = cut(vertices(edges, nodes))
    roots = ids.join(edges.select(F.col("src").alias("id")).distinct(), "id", "left_anti")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    reach = frontier(back, roots.select(F.lit(0).alias("label"), "id"), None)
    return ids.join(reach.select("id", "dist"), "id", "left").select("id", F.coalesce("dist", F.lit(0)).alias("generation"))


def core_numbers(edges: DataFrame, nodes: DataFrame | None = None, most_vertices: int = held.HELD_VERTICES) -> DataFrame:
    """GRA-04: core numbers, as the fixed point of the h-index of the neighbours' numbers, from the degrees down.

    A round looks only at the front: vertices with a neighbour that has just fallen below them. The h-index of a vertex
    is taken from counts of its neighbours' numbers (capped at its own), so a vertex with many neighbours never has them
    all in one place: at most one row for each different number. Edges are partitioned by vertex once and kept so.
    Rounds go on until no number falls; vertices without edges have 0. Up to ``most_vertices`` the numbers are an array
    that is sent to blocks of edges; with more a round is joins, and its counts and numbers are frames.
    """
    near = cut(both_ways(edges))
    ids = cut(vertices(near) if nodes is None else vertices(edges, nodes))
    if ids.count() <= most_vertices:
        return held.core_numbers(ids, near, _partitions(edges))
    near = near.repartition(_partitions(edges), "src").persist()
    core = cut(near.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("core")).withColumn("was", F.lit(None).cast("bigint")))
    above = Window.partitionBy("src").orderBy(F.desc("c")).rowsBetween(Window.unboundedPreceding, 0)
    try:
        for step in count(1):
            own = core.select(F.col("id").alias("src"), "core")
            if step == 1:
                front = own
            else:
                fell = core.where("was > core").select(F.col("id").alias("src"), F.col("core").alias("now"))
                hit = near.join(fell, "src").groupBy(F.col("dst").alias("src")).agg(F.min("now").alias("now"))
                front = own.join(hit, "src").where("now < core").select("src", "core")
            around = near.join(front, "src").join(core.select(F.col("id").alias("dst"), F.col("core").alias("c")), "dst")
            counts = around.groupBy("src", F.least("c", "core").alias("c")).agg(F.count(F.lit(1)).alias("n"))
            h = counts.withColumn("m", F.sum("n").over(above)).groupBy(F.col("src").alias("id")).agg(F.max(F.least("c", "m")).alias("new"))
            new = core.join(h, "id", "left").select("id", F.least("core", F.coalesce("new", "core")).alias("core"), F.col("core").alias("was"))
            core, seen = _observed(new, F.count_if(F.col("was") > F.col("core")).alias("fallen"))
            if not seen["fallen"]:
                break
    finally:
        near.unpersist()
    out = core.select("id", "core")
    return out if nodes is None else ids.join(out, "id", "left").select("id", F.coalesce("core", F.lit(0)).alias("core"))


def components(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Connected components: ``id, component`` (its smallest id), by alternating large and small stars.

    Each round links vertices to the smallest neighbour known; edges stay at most as many as before, and the number of
    rounds grows with the logarithm of the longest path. Rounds go on until nothing changes.
    """
    ids = vertices(edges, nodes)
    e = cut(edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).where("u <> v").distinct())
    while True:
        two = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = two.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = two.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.u", "x.v").where("u <> v").distinct()
        new = cut(small)
        if new.count() == e.count() and new.join(e, ["u", "v"], "left_anti").isEmpty():
            e = new
            break
        e = new
    return ids.join(e.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("c")), "id", "left").select("id", F.coalesce("c", "id").alias("component"))


def modularity(links: DataFrame, parts: DataFrame) -> float:
    """Newman's modularity of ``parts`` (id, community) over ``links`` (src, dst, w), which hold both directions."""
    of = lambda c, x: parts.select(F.col("id").alias(c), F.col("community").alias(x))
    ends = links.join(of("src", "a"), "src").join(of("dst", "b"), "dst")
    sums = ends.groupBy("a").agg(F.sum("w").alias("k"), F.sum(F.when(F.col("a") == F.col("b"), F.col("w")).otherwise(0.0)).alias("inside"))
    k, k2, inside = sums.agg(F.sum("k"), F.sum(F.col("k") * F.col("k")), F.sum("inside")).first()
    return (inside / k - k2 / (k * k)) if k else 0.0


def communities(edges: DataFrame, nodes: DataFrame | None = None, tol: float = 1e-4, resolution: float = 1.0, most_vertices: int = held.HELD_VERTICES) -> DataFrame:
    """GRA-06: communities by greedy modularity (Louvain), deterministic: ``id, community`` (its smallest id).

    Vertices move to the neighbouring community with the greatest gain in modularity (the smallest of equals); in each
    round those of one of two hashed halves may move, so neighbours do not merely change places. When a sweep over both
    halves gains less than ``tol``, communities become vertices and the next level begins, until a level gains less.
    Up to ``most_vertices`` the communities are an array that is sent to blocks of edges. With more, the moves of a round
    are joins and partial sums; totals of communities are aggregates, so no community comes together.
    """
    parts = _partitions(edges)
    edges = cut(edges.select("src", "dst"))
    ids = cut(vertices(edges, nodes))
    level = both_ways(edges).withColumn("w", F.lit(1.0))
    if ids.count() <= most_vertices:
        return held.communities(ids, cut(level.select("src", "dst")), parts, tol, resolution)
    whole = ids.select("id", F.col("id").alias("community"))  # every vertex to its vertex of the current level
    best = None
    while True:
        links = cut(level).repartition(parts, "src").persist()
        total = links.agg(F.sum("w")).first()[0]
        if not total:
            links.unpersist()
            break
        k = links.groupBy(F.col("src").alias("id")).agg(F.sum("w").alias("k"))
        where = cut(k.select("id", "k", F.col("id").alias("community"))).repartition(parts, "id").persist()
        score = start = modularity(links, where)
        for step in count():
            tot = where.groupBy("community").agg(F.sum("k").alias("tot"))
            to = links.where("src <> dst").join(where.select(F.col("id").alias("dst"), "community"), "dst").groupBy(F.col("src").alias("id"), "community").agg(F.sum("w").alias("w"))
            stay = where.select("id", "community", F.lit(0.0).alias("w"))
            offers = to.unionByName(stay).groupBy("id", "community").agg(F.sum("w").alias("w")).join(tot, "community")
            offers = offers.join(where.select("id", "k", F.col("community").alias("own")), "id")
            others = F.col("tot") - F.when(F.col("community") == F.col("own"), F.col("k")).otherwise(0.0)
            gain = F.round(F.col("w") - resolution * F.col("k") * others / F.lit(total), 9)
            choice = offers.groupBy("id").agg(F.min(F.struct((-gain).alias("loss"), (F.col("community") != F.col("own")).alias("moves"), "community")).alias("b"))
            turn = F.pmod(F.xxhash64("id"), F.lit(2)) == step % 2
            new = where.join(choice, "id").select("id", "k", F.when(turn, F.col("b.community")).otherwise(F.col("community")).alias("community"))
            new = cut(new).repartition(parts, "id").persist()
            where.unpersist()
            where = new
            if step % 2:
                now = modularity(links, where)
                if now - score < tol:
                    break
                score = now
        score = modularity(links, where)
        if best is not None and score - start < tol:
            where.unpersist()
            links.unpersist()
            break
        best = score
        of = lambda c, x: where.select(F.col("id").alias(c), F.col("community").alias(x))
        whole = cut(whole.join(where.select(F.col("id").alias("community"), F.col("community").alias("next")), "community", "left").select("id", F.coalesce("next", "community").alias("community")))
        level = cut(links.join(of("src", "a"), "src").join(of("dst", "b"), "dst").groupBy(F.col("a").alias("src"), F.col("b").alias("dst")).agg(F.sum("w").alias("w")))
        where.unpersist()
        links.unpersist()
    first = whole.groupBy("community").agg(F.min("id").alias("first"))
    return whole.join(first, "community").select("id", F.col("first").alias("community"))


def shared_pairs(pairs: DataFrame, member: str, group: str, least: int = 1, block: int = 1000) -> DataFrame:
    """GRA-08, GRA-09, GRA-10: pairs of members by the number of groups they share: ``a < b, weight``.

    Co-citation: members are the cited, groups the citing. Coupling: the other way round. Co-authorship: authors by
    paper. No group is left out: n members give n (n - 1) / 2 pairs, as the result asks for. Members of groups above
    ``block`` are cut into blocks of about that size, and every two blocks meet in a task of their own, so a hot group is
    the work of many tasks; smaller groups are joined as they are. Sums are partial before they are moved.
    """
    p = pairs.select(F.col(member).alias("m"), F.col(group).alias("g")).where("m is not null and g is not null").distinct()
    lanes = p.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("lanes"))
    p = p.join(lanes, "g").withColumn("s", F.pmod(F.xxhash64("m"), F.col("lanes")).cast("int"))
    # block s meets every block t: rows go to the cells (s, t) and (t, s), those with s <= t
    low = p.select("g", "m", F.col("s").alias("u"), F.explode(F.sequence("s", F.col("lanes") - 1)).alias("v"))
    high = p.select("g", "m", F.explode(F.sequence(F.lit(0), F.col("s"))).alias("u"), F.col("s").alias("v"))
    same = (F.col("x.g") == F.col("y.g")) & (F.col("x.u") == F.col("y.u")) & (F.col("x.v") == F.col("y.v"))
    ordered = F.when(F.col("x.u") == F.col("x.v"), F.col("x.m") < F.col("y.m")).otherwise(True)
    both = low.alias("x").join(high.alias("y"), same & ordered)
    both = both.select(F.least("x.m", "y.m").alias("xm"), F.greatest("x.m", "y.m").alias("ym"))
    return both.groupBy(F.col("xm").alias("a"), F.col("ym").alias("b")).agg(F.count(F.lit(1)).alias("weight")).where(F.col("weight") >= least)


def best_parent(edges: DataFrame, score: DataFrame) -> DataFrame:
    """GRA-20: every vertex's most important cited vertex (ties: the smallest id). ``score``: id, score."""
    s = score.select(F.col("id").alias("dst"), "score")
    return edges.join(s, "dst").groupBy(F.col("src").alias("id")).agg(F.min_by("dst", F.struct(-F.col("score"), F.col("dst"))).alias("parent"))


def two_hops(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """GRA-18: vertices two steps from each of ``ids`` and not nearer, by the number of ways."""
    near = both_ways(edges)
    start = ids.select("id").distinct()
    one = start.join(near, F.col("id") == F.col("src")).select("id", F.col("dst").alias("mid"))
    two = one.join(near, F.col("mid") == F.col("src")).where("dst <> id").groupBy("id", "dst").agg(F.count(F.lit(1)).alias("ways"))
    return two.join(one.select("id", F.col("mid").alias("dst")), ["id", "dst"], "left_anti").select("id", F.col("dst").alias("related"), "ways")


def density(edges: DataFrame, members: DataFrame) -> DataFrame:
    """AGG-30: edges within each group over its possible ones. ``members``: id, grp."""
    m = members.select("id", "grp")
    inner = edges.join(m.select(F.col("id").alias("src"), F.col("grp").alias("a")), "src").join(m.select(F.col("id").alias("dst"), F.col("grp").alias("b")), "dst").where("a = b")
    n = m.groupBy("grp").agg(F.count(F.lit(1)).alias("members"))
    k = inner.groupBy(F.col("a").alias("grp")).agg(F.count(F.lit(1)).alias("links"))
    links = F.coalesce("links", F.lit(0))
    return n.join(k, "grp", "left").select("grp", "members", links.alias("links"), F.round(F.when(F.col("members") > 1, links / (F.col("members") * (F.col("members") - 1))).otherwise(0.0), 6).alias("density"))


def betweenness(edges: DataFrame, pivots: int | None = None, nodes: DataFrame | None = None, most_edges: int = held.HELD_EDGES) -> DataFrame:
    """GRA-05: betweenness from pivots chosen by hash, scaled to all vertices (exact if there are as many pivots).

    Without ``pivots``, all vertices are pivots in graphs of up to 5,000, and 500 in larger ones.

    Breadth-first from every pivot, with numbers of shortest paths, then dependencies back, level by level. Pivots are
    shared out among tasks that hold the graph; with more than ``most_edges`` edges all pivots advance at once, by joins.
    """
    edges = cut(edges.select("src", "dst"))
    ids = cut(vertices(edges, nodes))
    n, number = ids.count(), edges.count()
    pivots = (n if n <= 5000 else 500) if pivots is None else pivots
    if 0 < number <= most_edges and n <= held.HELD_VERTICES:
        scale = n / max(1, min(pivots, n)) / max(1, (n - 1) * (n - 2))
        return held.betweenness(ids, edges, number, pivots, _partitions(edges)).select("id", (F.coalesce("dep", F.lit(0.0)) * scale).alias("betweenness"))
    start = ids.orderBy(F.xxhash64("id"), "id").limit(pivots)
    used = min(pivots, n)
    levels = [cut(start.select(F.col("id").alias("root"), "id", F.lit(1.0).alias("paths")))]
    seen = levels[0].select("root", "id")
    while True:
        step = levels[-1].join(edges, F.col("id") == F.col("src")).groupBy("root", F.col("dst").alias("id")).agg(F.sum("paths").alias("paths"))
        nxt = cut(step.join(seen, ["root", "id"], "left_anti"))
        if nxt.isEmpty():
            break
        levels.append(nxt)
        seen = seen.unionByName(nxt.select("root", "id"))
    total = None
    below = levels[-1].withColumn("dep", F.lit(0.0))
    for level in reversed(levels[:-1]):
        part = below.select(F.col("root"), F.col("id").alias("dst"), ((1 + F.col("dep")) / F.col("paths")).alias("per"))
        up = level.join(edges, F.col("id") == F.col("src")).join(part, ["root", "dst"]).groupBy("root", "id").agg(F.sum(F.col("paths") * F.col("per")).alias("dep"))
        below = cut(level.join(up, ["root", "id"], "left").select("root", "id", "paths", F.coalesce("dep", F.lit(0.0)).alias("dep")))
        inner = below.where("root <> id").select("id", "dep")
        total = inner if total is None else total.unionByName(inner)
    scale = n / max(1, used) / max(1, (n - 1) * (n - 2))
    sums = total.groupBy("id").agg(F.sum("dep").alias("dep")) if total is not None else None
    if sums is None:
        return ids.withColumn("betweenness", F.lit(0.0))
    return ids.join(sums, "id", "left").select("id", (F.coalesce("dep", F.lit(0.0)) * scale).alias("betweenness"))


def golden_positions(df: DataFrame, group: str, order: Column) -> DataFrame:
    """GRA-22: a place on a golden-angle spiral for every row of a group."""
    (k,) = fresh(df, "k")
    angle = F.col(k) * F.lit(2.399963229728653)
    radius = F.sqrt(F.col(k).cast("double"))
    return position_in_group(df, group, [order], k).withColumn("x", radius * F.cos(angle)).withColumn("y", radius * F.sin(angle)).drop(k)
