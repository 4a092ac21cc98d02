"""Section 2.12, graphs: the edges are parts that follow each other within an order, and parts with their suppliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import graph as G
from plumbline.sources.tables import table


def followers(spark, d):
    """Directed edges between parts: a line's part to the next line's part of the same order."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    nxt = li.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("l_partkey").alias("dst"))
    return G.clean_edges(li.join(nxt, ["l_orderkey", "l_linenumber"]).select(F.col("l_partkey").alias("src"), "dst"))


def _seeds(spark, d):
    return table(spark, d, "part").where("p_size = 1").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("label"))


def _everything(spark, d):
    """All parts, and suppliers under negative numbers: these stand in no edge."""
    return table(spark, d, "part").select(F.col("p_partkey").alias("id")).unionByName(table(spark, d, "supplier").select((-F.col("s_suppkey")).alias("id")))


def gra_01_edges(spark, d):
    """GRA-01, GRA-15: the distinct edges."""
    return followers(spark, d)


def gra_02_pagerank(spark, d):
    """GRA-02: PageRank, vertices without edges included, up to 100 rounds, until the summed change is below n * 1e-6."""
    return G.pagerank(followers(spark, d), nodes=_everything(spark, d)).select("id", F.round("rank", 9).alias("rank"))


def gra_03_degrees(spark, d):
    """GRA-03: degrees, vertices without edges included."""
    return G.degrees(followers(spark, d), _everything(spark, d))


def gra_04_cores(spark, d):
    """GRA-04: core numbers, vertices without edges included."""
    return G.core_numbers(followers(spark, d), _everything(spark, d))


def gra_05_betweenness(spark, d):
    """GRA-05: betweenness, exact up to 5,000 vertices, from 500 pivots above."""
    return G.betweenness(followers(spark, d)).select("id", F.round("betweenness", 9).alias("betweenness"))


def gra_06_communities(spark, d):
    """GRA-06: communities by modularity, vertices without edges included."""
    return G.communities(followers(spark, d), _everything(spark, d))


def gra_07_lineage(spark, d):
    """GRA-07, GRA-13: distances, reach and lineage up to four steps from the seeds, over reversed edges."""
    return G.lineage(followers(spark, d), _seeds(spark, d))


def gra_08_cocitation(spark, d):
    """GRA-08: suppliers met in the same orders."""
    li = table(spark, d, "lineitem")
    return G.shared_pairs(li, "l_suppkey", "l_orderkey", least=2)


def gra_09_coupling(spark, d):
    """GRA-09: orders that share two or more parts."""
    li = table(spark, d, "lineitem")
    return G.shared_pairs(li, "l_orderkey", "l_partkey", least=2)


def gra_10_coauthors(spark, d):
    """GRA-10: authors typed for the same work."""
    p = table(spark, d, "candidate_papers").where("openalex_id <> ''")
    return G.shared_pairs(p, "first_author", "openalex_id")


def gra_11_adjacency(spark, d):
    """GRA-11."""
    return G.both_ways(followers(spark, d))


def gra_12_support(spark, d):
    """GRA-12: support of brands up to four hops away."""
    return G.support(followers(spark, d), _seeds(spark, d))


def gra_14_generations(spark, d):
    """GRA-14: generations, vertices without edges included."""
    return G.generations(followers(spark, d), _everything(spark, d))


def gra_16_lineage_links(spark, d):
    """GRA-16: links with the in-degree of their target as strength."""
    e = followers(spark, d)
    n = e.groupBy("dst").agg(F.count(F.lit(1)).alias("strength"))
    return e.join(n, "dst").select("src", "dst", "strength")


def gra_17_shared_with_seeds(spark, d):
    """GRA-17, GRA-19: how many seeds share a neighbour with each vertex."""
    near = G.both_ways(followers(spark, d))
    seeds = _seeds(spark, d).select(F.col("id").alias("src"))
    around = near.join(seeds, "src").select(F.col("src").alias("seed"), "dst")
    return around.join(near.select(F.col("src").alias("id"), "dst"), "dst").where("id <> seed").groupBy("id").agg(F.count_distinct("seed").alias("seeds"))


def gra_18_related(spark, d):
    """GRA-18: parts two steps from the seeds, by the number of ways."""
    return G.two_hops(followers(spark, d), _seeds(spark, d)).where("ways >= 3")


def gra_20_parents(spark, d):
    """GRA-20: the most important vertex that each one points to."""
    e = followers(spark, d)
    score = G.degrees(e).select("id", F.col("in_degree").alias("score"))
    return G.best_parent(e, score)


def gra_22_positions(spark, d):
    """GRA-22: positions within groups."""
    return G.golden_positions(table(spark, d, "customer").select("c_custkey", "c_nationkey"), "c_nationkey", F.col("c_custkey")).select("c_custkey", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


def gra_26_property_graph(spark, d):
    """GRA-26: several kinds of nodes and edges in one frame."""
    n, s, c = table(spark, d, "nation"), table(spark, d, "supplier"), table(spark, d, "customer")
    edge = lambda df, a, b, kind: df.select(F.concat(F.lit(a[0] + ":"), F.col(a)).alias("src"), F.concat(F.lit(b[0] + ":"), F.col(b)).alias("dst"), F.lit(kind).alias("kind"))
    return edge(n, "n_nationkey", "n_regionkey", "IN_REGION").unionByName(edge(s, "s_suppkey", "s_nationkey", "FROM")).unionByName(edge(c, "c_custkey", "c_nationkey", "FROM")).distinct()


def gra_28_components(spark, d):
    """Connected components of works that share an identifier list."""
    s = table(spark, d, "scored_papers")
    from plumbline.functions.text import split_list

    ids = s.select("record_id", F.explode(F.transform(split_list(F.col("all_openalex_ids")), lambda x: F.element_at(F.split(x, "/"), -1))).alias("w")).where(F.col("w").rlike(r"^W[0-9]{11}\z"))
    first = ids.groupBy("w").agg(F.min("record_id").alias("dst"))
    return G.components(ids.join(first, "w").select(F.col("record_id").alias("src"), "dst"))


def agg_30_density(spark, d):
    """AGG-30: density of edges within brands."""
    return G.density(followers(spark, d), table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("grp")))


_E = "e AS MATERIALIZED (SELECT DISTINCT a.l_partkey AS src, b.l_partkey AS dst FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1 WHERE a.l_partkey <> b.l_partkey)"
_U = "u AS MATERIALIZED (SELECT src, dst FROM e UNION SELECT dst, src FROM e)"
_V = "v AS MATERIALIZED (SELECT src AS id FROM e UNION SELECT dst FROM e)"
_S = "s AS (SELECT p_partkey AS id, p_brand AS label FROM part WHERE p_size = 1)"


_ALL = "v AS MATERIALIZED (SELECT p_partkey AS id FROM part UNION SELECT -s_suppkey FROM supplier UNION SELECT src FROM e UNION SELECT dst FROM e)"


def _pagerank_sql(rounds: int) -> str:
    """Rounds up to the first whose summed change is below n * 1e-6."""
    parts = [_E, _ALL, "o AS MATERIALIZED (SELECT src, count(*) AS out FROM e GROUP BY src)", "n AS (SELECT count(*)::DOUBLE AS n FROM v)", "r0 AS MATERIALIZED (SELECT id, 1.0::DOUBLE / (SELECT n FROM n) AS rank FROM v)"]
    for i in range(rounds):
        parts.append(
            f"r{i + 1} AS MATERIALIZED (SELECT v.id, 0.15 / (SELECT n FROM n) + 0.85 * coalesce((SELECT sum(rank) FROM r{i} WHERE id NOT IN (SELECT src FROM o)), 0) / (SELECT n FROM n) + 0.85 * coalesce(g, 0) AS rank "
            f"FROM v LEFT JOIN (SELECT dst AS id, sum(rank / out) AS g FROM e JOIN r{i} ON r{i}.id = e.src JOIN o USING (src) GROUP BY dst) USING (id))"
        )
    changes = " UNION ALL ".join(f"SELECT {i + 1} AS k, sum(abs(a.rank - b.rank)) AS c FROM r{i + 1} a JOIN r{i} b USING (id)" for i in range(rounds))
    parts.append(f"pick AS (SELECT min(k) AS k FROM ({changes}) WHERE c < (SELECT n FROM n) * 1e-6)")
    return "WITH " + ", ".join(parts) + " " + " UNION ALL ".join(f"SELECT id, round(rank, 9) AS rank FROM r{i + 1} WHERE (SELECT k FROM pick) = {i + 1}" for i in range(rounds))


def _reach_sql(label: str, seeds: str, edges: str, depth: int = 4) -> str:
    """d0 to d4: what is met after so many steps; m: the least of them."""
    steps = [f"d0 AS MATERIALIZED (SELECT DISTINCT {seeds} AS {label}, id, 0 AS d FROM s)"]
    steps += [f"d{k} AS MATERIALIZED (SELECT DISTINCT {label}, y AS id, {k} AS d FROM d{k - 1} JOIN ({edges}) ON x = id)" for k in range(1, depth + 1)]
    return ", ".join(steps) + f", m AS (SELECT {label}, id, min(d) AS d FROM (" + " UNION ALL ".join(f"SELECT * FROM d{k}" for k in range(depth + 1)) + ") GROUP BY ALL)"


def _pairs_sql(m: str, g: str, least: int, t: str, where: str = "") -> str:
    return f"WITH p AS MATERIALIZED (SELECT DISTINCT {m} AS m, {g} AS g FROM {t} WHERE {m} IS NOT NULL AND {g} IS NOT NULL {where}) SELECT x.m AS a, y.m AS b, count(*) AS weight FROM p x JOIN p y ON x.g = y.g AND x.m < y.m GROUP BY ALL HAVING count(*) >= {least}"


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith(("gra_", "agg_30"))}
ORACLE = {
    "gra_04_cores": f"WITH RECURSIVE {_E}, {_U}, {_ALL}, r(id, core) USING KEY (id) AS (SELECT src AS id, count(*) AS core FROM u GROUP BY src UNION SELECT id, new FROM (SELECT x.src AS id, max(least(i, c)) AS new, any_value(own) AS own FROM (SELECT u.src, b.core AS c, a.core AS own, row_number() OVER (PARTITION BY u.src ORDER BY b.core DESC) AS i FROM u JOIN recurring.r a ON a.id = u.src JOIN recurring.r b ON b.id = u.dst WHERE EXISTS (SELECT 1 FROM r)) x GROUP BY x.src) WHERE new < own) SELECT v.id, coalesce(core, 0) AS core FROM v LEFT JOIN r USING (id)",
    "gra_28_components": f"WITH RECURSIVE ids AS (SELECT record_id, string_split(trim(unnest(string_split(coalesce(all_openalex_ids, ''), ';')), ' '), '/')[-1] AS w FROM scored_papers), k AS MATERIALIZED (SELECT DISTINCT record_id AS id, w FROM ids WHERE regexp_full_match(w, 'W[0-9]{{11}}')), l AS MATERIALIZED (SELECT DISTINCT a.id AS x, b.id AS y FROM k a JOIN k b USING (w)), r(id, c) USING KEY (id) AS (SELECT DISTINCT id, id AS c FROM k UNION SELECT y, min(n) FROM (SELECT l.y, r.c AS n, o.c AS own FROM r JOIN l ON l.x = r.id JOIN recurring.r o ON o.id = l.y) WHERE n < own GROUP BY y) SELECT id, c AS component FROM r",
    "gra_01_edges": f"WITH {_E} SELECT src, dst FROM e",
    "gra_02_pagerank": _pagerank_sql(40),
    "gra_03_degrees": f"WITH {_E}, {_ALL}, x AS (SELECT src AS id, 1 AS o, 0 AS i FROM e UNION ALL SELECT dst, 0, 1 FROM e UNION ALL SELECT id, 0, 0 FROM v) SELECT id, sum(i) AS in_degree, sum(o) AS out_degree, sum(i + o) AS degree FROM x GROUP BY id",
    "gra_07_lineage": f"WITH {_E}, {_S}, {_reach_sql('seed', 'id', 'SELECT dst AS x, src AS y FROM e')} SELECT id, min(d) AS min_seed_distance, count(*) AS seeds_reached, round(sum(pow(0.7, d)), 6) AS lineage FROM m GROUP BY id",
    "gra_08_cocitation": _pairs_sql("l_suppkey", "l_orderkey", 2, "lineitem"),
    "gra_09_coupling": _pairs_sql("l_orderkey", "l_partkey", 2, "lineitem"),
    "gra_10_coauthors": _pairs_sql("first_author", "openalex_id", 1, "candidate_papers", "AND openalex_id <> ''"),
    "gra_11_adjacency": f"WITH {_E}, {_U} SELECT src, dst FROM u",
    "gra_12_support": f"WITH {_E}, {_U}, {_S}, {_reach_sql('label', 'label', 'SELECT src AS x, dst AS y FROM u')} SELECT id, label, d AS dist, round(pow(0.65, d - 1), 6) AS support FROM m WHERE d > 0",
    "gra_14_generations": f"WITH RECURSIVE {_E}, {_ALL}, r(id, d) USING KEY (id) AS (SELECT id, 0 AS d FROM v WHERE id NOT IN (SELECT src FROM e) UNION SELECT e.src, min(r.d) + 1 FROM r JOIN e ON e.dst = r.id WHERE e.src NOT IN (SELECT id FROM recurring.r) GROUP BY e.src) SELECT v.id, coalesce(d, 0) AS generation FROM v LEFT JOIN r USING (id)",
    "gra_16_lineage_links": f"WITH {_E} SELECT src, dst, count(*) OVER (PARTITION BY dst) AS strength FROM e",
    "gra_17_shared_with_seeds": f"WITH {_E}, {_U}, {_S}, a AS (SELECT s.id AS seed, dst FROM u JOIN s ON src = s.id) SELECT u.src AS id, count(DISTINCT seed) AS seeds FROM a JOIN u USING (dst) WHERE u.src <> seed GROUP BY 1",
    "gra_18_related": f"WITH {_E}, {_U}, {_S}, o AS (SELECT s.id, dst AS mid FROM u JOIN s ON src = s.id) SELECT o.id, u.dst AS related, count(*) AS ways FROM o JOIN u ON u.src = mid WHERE u.dst <> o.id AND (o.id, u.dst) NOT IN (SELECT id, mid FROM o) GROUP BY ALL HAVING count(*) >= 3",
    "gra_20_parents": f"WITH {_E}, i AS (SELECT dst, count(*) AS n FROM e GROUP BY dst) SELECT src AS id, dst AS parent FROM e JOIN i USING (dst) QUALIFY row_number() OVER (PARTITION BY src ORDER BY n DESC, dst) = 1",
    "gra_22_positions": "WITH k AS (SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS k FROM customer) SELECT c_custkey, round(sqrt(k) * cos(k * 2.399963229728653::DOUBLE), 4) AS x, round(sqrt(k) * sin(k * 2.399963229728653::DOUBLE), 4) AS y FROM k",
    "gra_26_property_graph": "SELECT 'n:' || n_nationkey AS src, 'n:' || n_regionkey AS dst, 'IN_REGION' AS kind FROM nation UNION SELECT 's:' || s_suppkey, 's:' || s_nationkey, 'FROM' FROM supplier UNION SELECT 'c:' || c_custkey, 'c:' || c_nationkey, 'FROM' FROM customer",
    "agg_30_density": f"WITH {_E}, m AS (SELECT p_brand AS grp, count(*) AS members FROM part GROUP BY 1), k AS (SELECT a.p_brand AS grp, count(*) AS links FROM e JOIN part a ON src = a.p_partkey JOIN part b ON dst = b.p_partkey WHERE a.p_brand = b.p_brand GROUP BY 1) SELECT grp, members, coalesce(links, 0) AS links, round(CASE WHEN members > 1 THEN coalesce(links, 0) / (members * (members - 1)) ELSE 0 END, 6) AS density FROM m LEFT JOIN k USING (grp)",
}
