import random
from collections import deque

import pytest

from plumbline.operators import graph as G


def _edges(spark, pairs):
    return spark.createDataFrame(pairs, "src long, dst long")


def _random(n, m, seed):
    rng = random.Random(seed)
    return sorted({(a, b) for a, b in ((rng.randrange(n), rng.randrange(n)) for _ in range(m)) if a != b})


def test_pagerank_fixture(spark):
    got = {r.id: r.rank for r in G.pagerank(spark.createDataFrame([("B", "A"), ("C", "B"), ("C", "A")], "src string, dst string")).collect()}
    assert got == pytest.approx({"A": 0.520869, "B": 0.281551, "C": 0.197580}, abs=1e-5)
    assert G.pagerank(_edges(spark, [(1, 2)]).limit(0)).count() == 0


def test_cores_by_peeling(spark):
    pairs = _random(30, 90, 1)
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want, k, left = {}, 0, {v: set(x) for v, x in near.items()}
    while left:
        v = min(left, key=lambda x: len(left[x]))
        k = max(k, len(left[v]))
        want[v] = k
        for u in left.pop(v):
            if u in left:
                left[u].discard(v)
    assert {r.id: r.core for r in G.core_numbers(_edges(spark, pairs)).collect()} == want


def test_components(spark):
    pairs = [(i, i + 1) for i in range(1, 20)] + [(30, 40), (41, 40), (50, 51), (7, 7)]
    got = {r.id: r.component for r in G.components(_edges(spark, pairs)).collect()}
    assert all(got[i] == 1 for i in range(1, 21)) and got[41] == got[40] == 30 and got[51] == 50


def test_generations_and_support(spark):
    gen = {r.id: r.generation for r in G.generations(spark.createDataFrame([("B", "A"), ("C", "B"), ("X", "Y"), ("Y", "X")], "src string, dst string")).collect()}
    assert gen == {"A": 0, "B": 1, "C": 2, "X": 0, "Y": 0}
    e = spark.createDataFrame([("A", "B"), ("B", "C")], "src string, dst string")
    topics = spark.createDataFrame([("T0", "A"), ("T1", "C")], "label string, id string")
    got = {(r.id, r.label): (r.dist, r.support) for r in G.support(e, topics, 4, 0.5).collect()}
    assert got == {("B", "T0"): (1, 1.0), ("C", "T0"): (2, 0.5), ("B", "T1"): (1, 1.0), ("A", "T1"): (2, 0.5)}
    lin = {r.id: (r.min_seed_distance, r.lineage) for r in G.lineage(spark.createDataFrame([("B", "A"), ("C", "B")], "src string, dst string"), spark.createDataFrame([("A",)], "id string")).collect()}
    assert lin == {"A": (0, 1.0), "B": (1, 0.7), "C": (2, 0.49)}


def test_pairs(spark):
    cites = spark.createDataFrame([("P", "X"), ("Q", "X"), ("P", "Y"), ("Q", "Y"), ("R", "Y")], "src string, dst string")
    coupling = {(r.a, r.b): r.weight for r in G.shared_pairs(cites, "src", "dst").collect()}
    assert coupling == {("P", "Q"): 2, ("P", "R"): 1, ("Q", "R"): 1}
    assert {(r.a, r.b): r.weight for r in G.shared_pairs(cites, "dst", "src").collect()} == {("X", "Y"): 2}
    assert {(r.a, r.b): r.weight for r in G.shared_pairs(cites, "src", "dst", block=1).collect()} == coupling
    crowd = spark.createDataFrame([(i, "g") for i in range(50)], "m long, g string")
    for block in (7, 1000):
        got = G.shared_pairs(crowd, "m", "g", block=block).collect()
        assert len({(r.a, r.b) for r in got}) == len(got) == 50 * 49 // 2 and all(r.weight == 1 and r.a < r.b for r in got)


def test_betweenness_is_exact_with_all_pivots(spark):
    pairs = _random(14, 40, 5)
    out = {}
    for a, b in pairs:
        out.setdefault(a, []).append(b)
    ids = sorted({x for p in pairs for x in p})
    want = dict.fromkeys(ids, 0.0)
    for s in ids:  # breadth first, then dependencies back
        dist, paths, order, queue = {s: 0}, {s: 1.0}, [], deque([s])
        while queue:
            v = queue.popleft()
            order.append(v)
            for u in out.get(v, []):
                if u not in dist:
                    dist[u], paths[u] = dist[v] + 1, 0.0
                    queue.append(u)
                if dist[u] == dist[v] + 1:
                    paths[u] += paths[v]
        dep = dict.fromkeys(order, 0.0)
        for v in reversed(order):
            for u in out.get(v, []):
                if dist.get(u) == dist[v] + 1:
                    dep[v] += paths[v] / paths[u] * (1 + dep[u])
            if v != s:
                want[v] += dep[v]
    n = len(ids)
    got = {r.id: r.betweenness * (n - 1) * (n - 2) for r in G.betweenness(_edges(spark, pairs), pivots=n).collect()}
    assert got == pytest.approx(want)


def test_betweenness_follows_long_paths(spark):
    n = 21
    got = {r.id: r.betweenness * (n - 1) * (n - 2) for r in G.betweenness(_edges(spark, [(i, i + 1) for i in range(n - 1)])).collect()}
    assert got == pytest.approx({i: float(i * (n - 1 - i)) for i in range(n)})


def test_queries_reach_four_steps(spark, tmp_path):
    from plumbline.plans import graphs

    spark.createDataFrame([(1, i, i) for i in range(1, 7)], "l_orderkey long, l_linenumber int, l_partkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(i, 1 if i == 6 else 5, "b") for i in range(1, 7)], "p_partkey long, p_size int, p_brand string").write.parquet(str(tmp_path / "part.parquet"))
    assert {r.id: r.min_seed_distance for r in graphs.gra_07_lineage(spark, str(tmp_path)).collect()} == {6: 0, 5: 1, 4: 2, 3: 3, 2: 4}
    assert {r.id: r.dist for r in graphs.gra_12_support(spark, str(tmp_path)).collect()} == {5: 1, 4: 2, 3: 3, 2: 4}


def test_communities(spark):
    ring = []
    for c in range(6):
        ring += [(10 * c + a, 10 * c + b) for a in range(5) for b in range(5) if a < b] + [(10 * c + 4, 10 * (c + 1) % 60)]
    e = _edges(spark, ring)
    got = {r.id: r.community for r in G.communities(e, spark.createDataFrame([(99,)], "id long")).collect()}
    assert got == {**{10 * c + a: 10 * c for c in range(6) for a in range(5)}, 99: 99}
    links = G.both_ways(e).withColumn("w", G.F.lit(1.0))
    parts = spark.createDataFrame([(i, c) for i, c in got.items()], "id long, community long")
    m = 6 * 10 + 6
    assert G.modularity(links, parts) == pytest.approx(6 * (10 / m - (22 / (2 * m)) ** 2))
    assert G.communities(e.limit(0)).count() == 0


def test_vertices_without_edges(spark):
    e = spark.createDataFrame([("B", "A"), ("C", "B"), ("C", "A")], "src string, dst string")
    nodes = spark.createDataFrame([("A",), ("Z",), ("Z",), (None,)], "id string")
    rank = {r.id: r.rank for r in G.pagerank(e, nodes=nodes, tol=1e-12).collect()}
    assert set(rank) == set("ABCZ") and sum(rank.values()) == pytest.approx(1) and rank["Z"] == pytest.approx(rank["C"])
    assert {r.id: r.degree for r in G.degrees(e, nodes).collect()} == {"A": 2, "B": 2, "C": 2, "Z": 0}
    assert {r.id: r.core for r in G.core_numbers(e, nodes).collect()} == {"A": 2, "B": 2, "C": 2, "Z": 0}
    assert {r.id: r.generation for r in G.generations(e, nodes).collect()} == {"A": 0, "B": 1, "C": 1, "Z": 0}
    assert {r.id: r.component for r in G.components(e, nodes).collect()} == {"A": "A", "B": "A", "C": "A", "Z": "Z"}
    assert {r.id: r.betweenness for r in G.betweenness(e, nodes=nodes).collect()}["Z"] == 0


def test_betweenness_held_and_by_joins(spark, monkeypatch):
    from plumbline.operators import held

    pairs = _random(60, 200, 7)
    of = lambda **k: {r.id: r.betweenness for r in G.betweenness(_edges(spark, pairs), pivots=25, **k).collect()}
    want = of(most_edges=0)
    assert of() == pytest.approx(want)
    begin, sizes, dst = G.held.np.array([0, 2, 3, 4]), G.held.np.array([2, 1, 1, 0]), G.held.np.array([1, 2, 3, 3])
    monkeypatch.setattr(held, "_AT_ONCE", 1)  # edges come in several pieces
    n = 4
    dist, paths, dep, into = G.held.np.full(n, -1), *(G.held.np.zeros(n) for _ in range(3))
    held._dependencies((begin, sizes, dst), 0, dist, paths, dep, into)
    assert into.tolist() == [0, 0.5, 0.5, 0] and (dist == -1).all() and not paths.any() and not dep.any()


def test_betweenness_of_a_graph_with_many_vertices_is_one_job_over_pivots(spark):
    n = 6000  # above 5,000, a path: a level for each vertex
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("path", "path")
    got = {r.id: r.betweenness for r in G.betweenness(_edges(spark, [(i, i + 1) for i in range(n - 1)]), pivots=3).collect()}
    ran = len(jobs.getJobIdsForGroup("path"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(got) == n and max(got.values()) > 0 and ran < 60


def test_cores_on_arrays_and_by_joins(spark):
    pairs = _random(20, 60, 3) + [(200, i) for i in range(20)] + [(300 + i, 301 + i) for i in range(4)]  # a hub and a path
    nodes = spark.createDataFrame([(999,), (5,), (None,)], "id long")
    of = lambda **k: {r.id: r.core for r in G.core_numbers(_edges(spark, pairs), nodes, **k).collect()}
    got = of()
    assert got == of(most_vertices=0) and got[999] == 0 and got[302] == 1
    assert G.core_numbers(_edges(spark, [(1, 2)]).limit(0)).count() == 0


def test_communities_on_arrays_and_by_joins(spark):
    pairs = [(1, 2), (2, 3), (1, 3), (3, 4), (4, 5), (5, 6), (4, 6)]
    nodes = spark.createDataFrame([(99,)], "id long")
    of = lambda **k: {r.id: r.community for r in G.communities(_edges(spark, pairs), nodes, **k).collect()}
    got = of()
    assert got == of(most_vertices=0) and got[99] == 99 and len(set(got.values())) < len(got)
