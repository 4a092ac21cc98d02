"""Section 2.12: recommendations, reading lists, topic labels and layouts. Topics are brands of parts, links their orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import text as T
from plumbline.functions.columns import is_missing
from plumbline.operators import graph as G
from plumbline.operators import learning as L
from plumbline.operators import retrieval as R
from plumbline.operators.windows import percentile_ranks
from plumbline.plans.graphs import _seeds, followers
from plumbline.sources.tables import table

JARGON = ("lesion", "relapse", "cohort", "placebo", "hazard", "baseline", "plasma", "median", "trial", "cortical", "synaptic", "complement")
ANCHORS = {"biology": ("cell", "plasma", "synaptic", "complement", "expression"), "care": ("clinic", "rehab", "physio", "nurse"), "imaging": ("imaging", "lesion", "tomography")}


def _topics(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("topic"))


def _priority(spark, d):
    """SEL-16: .45 of the rank of price, .35 of that of size, .2 of that of the in-degree."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_retailprice").cast("double").alias("price"), F.col("p_size").alias("size"))
    p = p.join(G.degrees(followers(spark, d)).select("id", "in_degree"), "id", "left").fillna(0, ["in_degree"])
    for c in ("price", "size", "in_degree"):
        p = percentile_ranks(p, c, f"{c}_rank")
    return p.select("id", F.round(0.45 * F.col("price_rank") + 0.35 * F.col("size_rank") + 0.2 * F.col("in_degree_rank"), 8).alias("priority"))


def sel_16_priority(spark, d):
    """SEL-16: a blend of three ranks."""
    return _priority(spark, d)


def sel_18_next_topics(spark, d):
    """SEL-18: topics that a topic leads to."""
    prices = table(spark, d, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") / 50.0).alias("priority"))
    return L.next_topics(followers(spark, d), _topics(spark, d), prices).select("topic", "next_topic", "links", "rank_no")


def sel_19_starters(spark, d):
    """SEL-19: the three members of each topic with the greatest priority."""
    return L.head_per_group(_topics(spark, d).join(_priority(spark, d), "id"), ["topic"], [F.desc("priority"), F.asc("id")], 3).select("topic", "id", "rank_no")


def sel_22_seed_lists(spark, d):
    """SEL-22: at most fourteen members of each topic, its seeds first."""
    p = table(spark, d, "part").select(F.col("p_brand").alias("topic"), F.col("p_partkey").alias("id"), F.col("p_size").alias("place"))
    return L.seed_lists(p.where("place = 1"), p, 14)


def sel_23_journey(spark, d):
    """SEL-23: foundations, bridges and deep dives."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.floor(F.col("p_size") / 10).alias("difficulty"), F.round(F.col("p_retailprice").cast("double") / 1000, 6).alias("relevance"))
    near = G.both_ways(followers(spark, d))
    overlap = near.join(_seeds(spark, d).select(F.col("id").alias("dst")), "dst", "left_semi").groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("overlap"))
    deg = G.degrees(followers(spark, d)).select("id", F.col("in_degree").alias("cites"))
    scored = p.join(overlap, "id", "left").join(deg, "id", "left").fillna(0, ["overlap", "cites"]).withColumn("core", (F.col("cites") >= 10).cast("int"))
    return L.journey(scored, 6)


def sel_24_companions(spark, d):
    """SEL-24: what stands around a topic."""
    m = _topics(spark, d).withColumnRenamed("topic", "grp")
    return L.companions(followers(spark, d), m)


def sel_24_anchors(spark, d):
    """SEL-24: what a topic points to most within itself."""
    m = _topics(spark, d).withColumnRenamed("topic", "grp")
    return L.anchors(followers(spark, d), m)


def sel_12_labels(spark, d):
    """SEL-12: clusters of five or more papers, labelled by their three most frequent concepts."""
    p = table(spark, d, "candidate_papers").where(~is_missing(F.col("venue"))).select(F.col("venue").alias("cluster"), "_ord", F.col("concepts"))
    big = p.groupBy("cluster").agg(F.count(F.lit(1)).alias("papers")).where("papers >= 5")
    words = p.select("cluster", F.explode(T.split_list(F.col("concepts"))).alias("c")).groupBy("cluster", "c").agg(F.count(F.lit(1)).alias("n"))
    top = L.head_per_group(words, ["cluster"], [F.desc("n"), F.asc("c")], 3).groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("rank_no", "c"))).alias("t"))
    return big.join(top, "cluster", "left").select("cluster", "papers", F.coalesce(F.array_join(F.transform("t", lambda x: x["c"]), " / "), F.lit("")).alias("label"))


def _spectrum(spark, d):
    """SEL-13: for each source and kind the share of the kind's words met in its texts; shares of a source sum to 1."""
    docs = table(spark, d, "documents").select(F.lower(F.trim("source")).alias("source"), F.lower("text").alias("text")).where("source is not null")
    met = docs.groupBy("source").agg(*[F.bool_or(F.coalesce(F.col("text").contains(w), F.lit(False))).cast("int").alias(f"{k}_{w}") for k, ws in ANCHORS.items() for w in ws])
    share = {k: sum((F.col(f"{k}_{w}") for w in ws), F.lit(0)) / len(ws) for k, ws in ANCHORS.items()}
    total = F.nullif(sum(share.values(), F.lit(0.0)), F.lit(0.0))
    return met.select("source", *[F.coalesce(s / total, F.lit(0.0)).alias(k) for k, s in share.items()])


def sel_13_spectrum(spark, d):
    """SEL-13: which kinds of words a source has, as shares."""
    s = _spectrum(spark, d)
    return s.select("source", *[F.round(k, 6).alias(k) for k in ANCHORS])


def sel_14_dominant(spark, d):
    """SEL-14: the kind in which a source is most above the mean of all sources; the first of equals."""
    s = _spectrum(spark, d)
    mean = s.agg(*[F.avg(k).alias(f"mean_{k}") for k in ANCHORS])
    over = {k: F.round(F.col(k) - F.col(f"mean_{k}"), 9) for k in ANCHORS}
    most = F.greatest(*over.values())
    pick = F.coalesce(*[F.when(o == most, F.lit(k)) for k, o in over.items()])
    return s.crossJoin(F.broadcast(mean)).select("source", pick.alias("dominant"), F.round(most, 6).alias("above"))


def sel_15_difficulty(spark, d):
    """SEL-15: a level from the number of different technical words."""
    n = T.term_hits(F.col("text"), JARGON)
    level = F.when(n >= 10, 5).when(n >= 7, 4).when(n >= 4, 3).when(n >= 2, 2).otherwise(1)
    return table(spark, d, "documents").select("doc_id", n.alias("words"), level.alias("difficulty"))


def sel_20_categories(spark, d):
    """SEL-20: the category of each topic by votes of its papers, weighted; of equals the first; a fallback without votes."""
    t = table(spark, d, "core_corpus_tracked").select("canonical_paper_id", F.upper(F.trim("primary_topic_code")).alias("topic"), "evidence_strength").where("topic is not null and topic not in ('', 'NAN', 'UNMAPPED')")
    s = table(spark, d, "scored_papers").where(~is_missing(F.col("evidence_type"))).groupBy("canonical_paper_id").agg(F.min(F.lower("evidence_type")).alias("category"))
    votes = t.join(s, "canonical_paper_id").groupBy("topic", "category").agg(F.sum(F.coalesce("evidence_strength", F.lit(0)) + 1).alias("votes"))
    best = votes.groupBy("topic").agg(F.min(F.struct((-F.col("votes")).alias("n"), "category")).alias("b")).select("topic", "b.category")
    return t.select("topic").distinct().join(best, "topic", "left").select("topic", F.coalesce("category", F.lit("general")).alias("category"))


def ir_03_selection(spark, d):
    """IR-03: for each topic eight foundational members, and eight advanced ones that are not among these."""
    p = table(spark, d, "part").select(F.col("p_brand").alias("topic"), F.col("p_partkey").alias("id"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"))
    base = L.head_per_group(p, ["topic"], [F.desc("size"), F.asc("price"), F.asc("id")], 8)
    rest = p.join(base.select("id"), "id", "left_anti")
    more = L.head_per_group(rest, ["topic"], [F.desc("price"), F.asc("id")], 8)
    return base.select("topic", "id", F.lit("foundational").alias("kind"), "rank_no").unionByName(more.select("topic", "id", F.lit("advanced").alias("kind"), "rank_no"))


QUERY_WORDS, PHRASE = ("fatigu", "lesion", "rehabilit", "cortical"), "cortical lesion"


def _idea_scores(spark, d):
    """IR-04: BM25 over two fields, with bonuses for the phrase and for a well cited work."""
    p = table(spark, d, "candidate_papers").select("_ord", "title", "abstract", "cited_by_count")
    fields = p.select(F.col("_ord").alias("doc"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), T.stemmed_tokens(F.col(f)).alias("tokens")) for f in ("title", "abstract")])).alias("f")).select("doc", "f.field", "f.tokens")
    scores = R.bm25_scores(fields, list(QUERY_WORDS), {"title": 3.4, "abstract": 2.2})
    cites = F.greatest(F.coalesce("cited_by_count", F.lit(0)), F.lit(0))
    bonus = R.phrase_bonus(F.coalesce("title", F.lit("")), F.coalesce("abstract", F.lit("")), PHRASE) + 0.18 * F.log1p(cites.cast("double"))
    return scores.join(p.withColumnRenamed("_ord", "doc"), "doc").select("doc", F.round(F.col("score") + bonus, 6).alias("score"), "abstract", cites.alias("cites"))


def ir_04_priors(spark, d):
    """IR-04: ranked search with phrase and citation bonuses."""
    return _idea_scores(spark, d).select("doc", "score")


def ir_06_idea_match(spark, d):
    """IR-06: the best matches among works with an abstract and some citations, cut at a share of the best."""
    pool = _idea_scores(spark, d).where(~is_missing(F.col("abstract")) & (F.col("cites") >= 5)).select("doc", "score")
    return R.relative_cut(pool, 0.5, 0.4, 30, [F.desc("score"), F.asc("doc")])


def flt_13_lineage_filters(spark, d):
    """FLT-13: edges between parts of some sizes, brands and generations."""
    e = followers(spark, d)
    p = table(spark, d, "part").where("p_size between 5 and 30").where(~F.col("p_brand").isin("Brand#11", "Brand#12")).select(F.col("p_partkey").alias("id"))
    young = G.generations(e).where("generation <= 3").select("id")
    return G.induced(e, p.join(young, "id", "left_semi"))


def flt_14_importance(spark, d):
    """FLT-14: edges between parts with many ends."""
    e = followers(spark, d)
    return L.above_threshold(e, G.degrees(e).select("id", F.col("degree").alias("score")), 36)


def flt_15_visible(spark, d):
    """FLT-15: parts whose name holds a word, and their neighbours."""
    hits = table(spark, d, "part").where(F.lower("p_name").contains("a")).where("p_size = 7").select(F.col("p_partkey").alias("id"))
    return L.visible(followers(spark, d), hits)


def gra_18_kin(spark, d):
    """GRA-18: parents and children of the seeds."""
    return L.kinship(followers(spark, d), _seeds(spark, d))


def gra_21_tree(spark, d):
    """GRA-21: regions, nations and customers as a tree with places."""
    r = table(spark, d, "region").select(F.col("r_regionkey").cast("bigint").alias("id"), F.lit(None).cast("bigint").alias("parent"))
    n = table(spark, d, "nation").select((F.col("n_nationkey") + 100).cast("bigint").alias("id"), F.col("n_regionkey").cast("bigint").alias("parent"))
    c = table(spark, d, "customer").select((F.col("c_custkey") + 1000).cast("bigint").alias("id"), (F.col("c_nationkey") + 100).cast("bigint").alias("parent"))
    return L.tree_layout(r.unionByName(n).unionByName(c)).select("id", "depth", F.round("x", 3).alias("x"))


def gra_23_layers(spark, d):
    """GRA-23: regions and nations in two layers, ordered by barycentres in one sweep down and one up."""
    r, n = table(spark, d, "region"), table(spark, d, "nation")
    nodes = r.select(F.col("r_regionkey").cast("bigint").alias("id"), F.lit(0).alias("layer")).unionByName(n.select((F.col("n_nationkey") + 100).cast("bigint").alias("id"), F.lit(1).alias("layer")))
    return L.barycentre_layout(nodes, n.select(F.col("n_regionkey").cast("bigint").alias("src"), (F.col("n_nationkey") + 100).cast("bigint").alias("dst")), 1).select("id", "layer", F.col("y").cast("bigint").alias("y"))


def gra_25_topic_concepts(spark, d):
    """GRA-25: edges of a map: a topic to its ten most frequent types, and to its members' suppliers' nations."""
    p = table(spark, d, "part").select(F.col("p_brand").alias("topic"), F.col("p_type").alias("x"))
    top = L.head_per_group(p.groupBy("topic", "x").agg(F.count(F.lit(1)).alias("n")), ["topic"], [F.desc("n"), F.asc("x")], 10)
    li = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return top.select(F.col("topic").alias("src"), F.col("x").alias("dst"), F.lit("HAS_TYPE").alias("kind")).unionByName(li.select(F.col("p_brand").alias("src"), F.col("n_name").alias("dst"), F.lit("FROM").alias("kind")).distinct())


def gra_27_nearest(spark, d):
    """GRA-27: the supplier nearest in balance in the next nation."""
    return L.nearest_in_layer(table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), "s_nationkey", F.col("s_acctbal").cast("double").alias("bal")), "s_nationkey", "bal")


_E = "e AS MATERIALIZED (SELECT DISTINCT a.l_partkey AS src, b.l_partkey AS dst FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1 WHERE a.l_partkey <> b.l_partkey)"
_U = "u AS MATERIALIZED (SELECT src, dst FROM e UNION SELECT dst, src FROM e)"
_S = "s AS (SELECT p_partkey AS id FROM part WHERE p_size = 1)"
_M = "({0} IS NULL OR lower(trim({0}, chr(9)||chr(10)||chr(13)||' ')) IN ('', 'nan'))"
_STEM = "CASE WHEN length(t) > 6 AND t LIKE '%ation' THEN left(t, -5) WHEN length(t) > 5 AND t LIKE '%ing' THEN left(t, -3) WHEN length(t) > 4 AND t LIKE '%ed' THEN left(t, -2) WHEN length(t) > 4 AND t LIKE '%ly' THEN left(t, -2) WHEN length(t) > 5 AND t LIKE '%ment' THEN left(t, -4) WHEN length(t) > 4 AND t LIKE '%ies' THEN left(t, -3) || 'y' WHEN length(t) > 4 AND t LIKE '%s' THEN left(t, -1) ELSE t END"


def _pr(src: str) -> str:
    return f"CASE WHEN max({src}) OVER () <= 0 THEN 0 ELSE (rank() OVER (ORDER BY {src}) + (count(*) OVER (PARTITION BY {src}) - 1) / 2) / count(*) OVER () END"


_PRIO = f"i AS (SELECT p_partkey AS id, p_brand AS topic, p_retailprice::DOUBLE AS price, p_size AS size, coalesce((SELECT count(*) FROM e WHERE dst = p_partkey), 0) AS ind FROM part), pr AS MATERIALIZED (SELECT id, topic, round(0.45::DOUBLE * {_pr('price')} + 0.35::DOUBLE * {_pr('size')} + 0.2::DOUBLE * {_pr('ind')}, 8) AS priority FROM i)"
_MET = ", ".join(f"bool_or(coalesce(contains(lower(text), '{w}'), false))::INT AS {k}_{w}" for k, ws in ANCHORS.items() for w in ws)
_SHARE = ", ".join("(" + " + ".join(f"{k}_{w}" for w in ws) + f") / {len(ws)} AS {k}" for k, ws in ANCHORS.items())
_SUM = " + ".join(ANCHORS)
_SPEC = f"m AS (SELECT lower(trim(source, ' ')) AS source, {_MET} FROM documents WHERE source IS NOT NULL GROUP BY 1), h AS (SELECT source, {_SHARE} FROM m), sp AS (SELECT source, " + ", ".join(f"coalesce({k} / nullif({_SUM}, 0), 0) AS {k}" for k in ANCHORS) + " FROM h)"
_JAR = "(" + " + ".join(f"contains(lower(coalesce(text, '')), '{t}')::INT" for t in JARGON) + ")"
_W = ", ".join(f"'{w}'" for w in QUERY_WORDS)
_IDEA = (
    rf"f AS (SELECT _ord AS doc, 'title' AS field, title AS x FROM candidate_papers UNION ALL SELECT _ord, 'abstract', abstract FROM candidate_papers), t AS (SELECT doc, field, list_filter(list_transform(list_filter(string_split(trim(regexp_replace(regexp_replace(lower(coalesce(x, '')), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')), ' '), lambda t: length(t) > 1), lambda t: {_STEM}), lambda t: length(t) > 1) AS w FROM f), l AS (SELECT *, greatest(len(w), 1) AS n FROM t), m AS (SELECT field, avg(n) AS mean FROM l GROUP BY field), h AS (SELECT doc, field, n, token, count(*) AS tf FROM (SELECT doc, field, n, unnest(w) AS token FROM l) WHERE token IN ({_W}) GROUP BY ALL), dd AS (SELECT token, count(DISTINCT doc) AS df FROM h GROUP BY token), i AS (SELECT token, ln(1 + ((SELECT count(DISTINCT doc) FROM l) - df + 0.5) / (df + 0.5)) AS idf FROM dd), "
    r"b AS (SELECT doc, sum(CASE field WHEN 'title' THEN 3.4 ELSE 2.2 END * idf * tf * 2.35 / (tf + 1.35 * (0.28 + 0.72 * n / mean))) AS s FROM h JOIN i USING (token) JOIN m USING (field) GROUP BY doc), "
    rf"x AS (SELECT doc, round(s + CASE WHEN contains(lower(coalesce(title, '')), '{PHRASE}') THEN 4.5::DOUBLE ELSE 0 END + CASE WHEN contains(lower(coalesce(abstract, '')), '{PHRASE}') THEN 2.4::DOUBLE ELSE 0 END + 0.18::DOUBLE * ln(1 + greatest(coalesce(cited_by_count, 0), 0)), 6) AS score, abstract, greatest(coalesce(cited_by_count, 0), 0) AS cites FROM b JOIN candidate_papers ON _ord = doc)"
)
QUERIES = {k: v for k, v in list(globals().items()) if k.split("_")[0] in ("sel", "ir", "flt", "gra")}
ORACLE = {
    "sel_16_priority": f"WITH {_E}, {_PRIO} SELECT id, priority FROM pr",
    "sel_18_next_topics": f"WITH {_E}, l AS (SELECT a.p_brand AS topic, b.p_brand AS next_topic, count(*) AS links FROM e JOIN part a ON src = a.p_partkey JOIN part b ON dst = b.p_partkey WHERE a.p_brand <> b.p_brand GROUP BY ALL HAVING count(*) >= 2), p AS (SELECT p_brand AS next_topic, avg(p_size / 50) AS p FROM part GROUP BY 1), s AS (SELECT topic, next_topic, links, round(0.7::DOUBLE * links + 0.3::DOUBLE * p, 6) AS score FROM l JOIN p USING (next_topic)) SELECT topic, next_topic, links, row_number() OVER w AS rank_no FROM s WINDOW w AS (PARTITION BY topic ORDER BY score DESC, next_topic) QUALIFY row_number() OVER w <= 3",
    "sel_19_starters": f"WITH {_E}, {_PRIO} SELECT topic, id, row_number() OVER w AS rank_no FROM pr WINDOW w AS (PARTITION BY topic ORDER BY priority DESC, id) QUALIFY row_number() OVER w <= 3",
    "sel_22_seed_lists": "SELECT p_brand AS topic, p_partkey AS id, row_number() OVER w AS rank_no FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY CASE WHEN p_size = 1 THEN 0 ELSE 1 END, p_size, p_partkey) QUALIFY row_number() OVER w <= 14",
    "sel_23_journey": f"WITH {_E}, {_U}, {_S}, x AS (SELECT p_partkey AS id, floor(p_size / 10) AS difficulty, round(p_retailprice::DOUBLE / 1000, 6) AS relevance, (SELECT count(*) FROM u WHERE src = p_partkey AND dst IN (SELECT id FROM s)) AS overlap, (SELECT count(*) FROM e WHERE dst = p_partkey) AS cites FROM part), y AS (SELECT *, round(relevance + 2 * overlap + 1.4::DOUBLE * (cites >= 10)::INT + 0.2::DOUBLE * ln(1 + cites), 6) AS blend FROM x) SELECT 'foundation' AS stage, id, row_number() OVER (ORDER BY difficulty, relevance DESC, id) AS rank_no FROM y WHERE relevance > 0 QUALIFY row_number() OVER (ORDER BY difficulty, relevance DESC, id) <= 6 UNION ALL SELECT 'bridge', id, row_number() OVER (ORDER BY overlap DESC, id) FROM y WHERE overlap > 0 QUALIFY row_number() OVER (ORDER BY overlap DESC, id) <= 5 UNION ALL SELECT 'deep', id, row_number() OVER (ORDER BY blend DESC, id) FROM y QUALIFY row_number() OVER (ORDER BY blend DESC, id) <= 8",
    "sel_24_companions": f"WITH {_E}, {_U}, l AS (SELECT p_brand AS grp, dst AS id, count(*) AS links FROM u JOIN part ON src = p_partkey GROUP BY ALL HAVING count(*) >= 2) SELECT grp, id, links, row_number() OVER w AS rank_no FROM l JOIN part ON p_partkey = id WHERE p_brand <> grp WINDOW w AS (PARTITION BY grp ORDER BY links DESC, id) QUALIFY row_number() OVER w <= 10",
    "sel_24_anchors": f"WITH {_E}, l AS (SELECT a.p_brand AS grp, dst AS id, count(*) AS cited FROM e JOIN part a ON src = a.p_partkey JOIN part b ON dst = b.p_partkey WHERE a.p_brand = b.p_brand GROUP BY ALL) SELECT grp, id, cited, row_number() OVER w AS rank_no FROM l WINDOW w AS (PARTITION BY grp ORDER BY cited DESC, id) QUALIFY row_number() OVER w <= 5",
    "sel_12_labels": f"WITH p AS (SELECT venue AS cluster, concepts FROM candidate_papers WHERE NOT {_M.format('venue')}), b AS (SELECT cluster, count(*) AS papers FROM p GROUP BY 1 HAVING count(*) >= 5), w AS (SELECT cluster, c, count(*) AS n FROM (SELECT cluster, trim(unnest(string_split(coalesce(concepts, ''), ';')), ' ') AS c FROM p) WHERE NOT {_M.format('c')} GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, c) AS r FROM w), l AS (SELECT cluster, string_agg(c, ' / ' ORDER BY r) AS label FROM k WHERE r <= 3 GROUP BY 1) SELECT cluster, papers, coalesce(label, '') AS label FROM b LEFT JOIN l USING (cluster)",
    "sel_13_spectrum": f"WITH {_SPEC} SELECT source, " + ", ".join(f"round({k}, 6) AS {k}" for k in ANCHORS) + " FROM sp",
    "sel_14_dominant": f"WITH {_SPEC}, o AS (SELECT source, " + ", ".join(f"round({k} - avg({k}) OVER (), 9) AS {k}" for k in ANCHORS) + f" FROM sp) SELECT source, CASE greatest({', '.join(ANCHORS)}) " + " ".join(f"WHEN {k} THEN '{k}'" for k in ANCHORS) + f" END AS dominant, round(greatest({', '.join(ANCHORS)}), 6) AS above FROM o",
    "sel_15_difficulty": f"SELECT doc_id, {_JAR} AS words, CASE WHEN {_JAR} >= 10 THEN 5 WHEN {_JAR} >= 7 THEN 4 WHEN {_JAR} >= 4 THEN 3 WHEN {_JAR} >= 2 THEN 2 ELSE 1 END AS difficulty FROM documents",
    "sel_20_categories": f"WITH t AS (SELECT canonical_paper_id, upper(trim(primary_topic_code, ' ')) AS topic, evidence_strength AS es FROM core_corpus_tracked WHERE primary_topic_code IS NOT NULL AND upper(trim(primary_topic_code, ' ')) NOT IN ('', 'NAN', 'UNMAPPED')), s AS (SELECT canonical_paper_id, min(lower(evidence_type)) AS category FROM scored_papers WHERE NOT {_M.format('evidence_type')} GROUP BY 1), v AS (SELECT topic, category, sum(coalesce(es, 0) + 1) AS votes FROM t JOIN s USING (canonical_paper_id) GROUP BY ALL), b AS (SELECT topic, category FROM v QUALIFY row_number() OVER (PARTITION BY topic ORDER BY votes DESC, category) = 1) SELECT topic, coalesce(category, 'general') AS category FROM (SELECT DISTINCT topic FROM t) LEFT JOIN b USING (topic)",
    "ir_03_selection": "WITH f AS (SELECT p_brand AS topic, p_partkey AS id, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_retailprice, p_partkey) AS r FROM part), a AS (SELECT p_brand AS topic, p_partkey AS id, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS r FROM part WHERE p_partkey NOT IN (SELECT id FROM f WHERE r <= 8)) SELECT topic, id, 'foundational' AS kind, r AS rank_no FROM f WHERE r <= 8 UNION ALL SELECT topic, id, 'advanced', r FROM a WHERE r <= 8",
    "ir_04_priors": f"WITH {_IDEA} SELECT doc, score FROM x",
    "ir_06_idea_match": f"WITH {_IDEA}, p AS (SELECT doc, score FROM x WHERE NOT {_M.format('abstract')} AND cites >= 5) SELECT doc, score FROM p WHERE score >= 0.5 AND score >= 0.4::DOUBLE * (SELECT max(score) FROM p) ORDER BY score DESC, doc LIMIT 30",
    "flt_13_lineage_filters": f"WITH RECURSIVE {_E}, v AS MATERIALIZED (SELECT src AS id FROM e UNION SELECT dst FROM e), r(id, d) USING KEY (id) AS (SELECT id, 0 AS d FROM v WHERE id NOT IN (SELECT src FROM e) UNION SELECT e.src, min(r.d) + 1 FROM r JOIN e ON e.dst = r.id WHERE e.src NOT IN (SELECT id FROM recurring.r) GROUP BY e.src), g AS (SELECT v.id FROM v LEFT JOIN r USING (id) WHERE coalesce(d, 0) <= 3), k AS (SELECT p_partkey AS id FROM part WHERE p_size BETWEEN 5 AND 30 AND p_brand NOT IN ('Brand#11', 'Brand#12') AND p_partkey IN (SELECT id FROM g)) SELECT src, dst FROM e WHERE src IN (SELECT id FROM k) AND dst IN (SELECT id FROM k)",
    "flt_14_importance": f"WITH {_E}, dg AS (SELECT id FROM (SELECT src AS id FROM e UNION ALL SELECT dst FROM e) GROUP BY id HAVING count(*) >= 36) SELECT src, dst FROM e WHERE src IN (SELECT id FROM dg) AND dst IN (SELECT id FROM dg)",
    "flt_15_visible": f"WITH {_E}, {_U}, h AS (SELECT p_partkey AS id FROM part WHERE contains(lower(p_name), 'a') AND p_size = 7), n AS (SELECT dst AS id, false AS hit FROM u WHERE src IN (SELECT id FROM h) UNION ALL SELECT id, true FROM h) SELECT id, max(hit) AS hit FROM n GROUP BY id",
    "gra_18_kin": f"WITH {_E}, {_S} SELECT DISTINCT src AS id, dst AS other, 'parent' AS kind FROM e WHERE src IN (SELECT id FROM s) UNION ALL SELECT DISTINCT dst, src, 'child' FROM e WHERE dst IN (SELECT id FROM s)",
    "gra_21_tree": "WITH n AS (SELECT r_regionkey AS r, n_nationkey + 100 AS n, c_custkey + 1000 AS c FROM region LEFT JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey), o AS (SELECT *, row_number() OVER (ORDER BY r, n NULLS FIRST, c NULLS FIRST) - 1 AS x FROM n) SELECT r AS id, 0 AS depth, (min(x) + max(x)) / 2 AS x FROM o GROUP BY r UNION ALL SELECT n, 1, (min(x) + max(x)) / 2 FROM o WHERE n IS NOT NULL GROUP BY n UNION ALL SELECT c, 2, x FROM o WHERE c IS NOT NULL",
    "gra_23_layers": "WITH r AS (SELECT r_regionkey AS id, row_number() OVER (ORDER BY r_regionkey) - 1 AS y FROM region) SELECT id, 0 AS layer, y FROM r UNION ALL SELECT n_nationkey + 100, 1, row_number() OVER (ORDER BY y, n_nationkey) - 1 FROM nation JOIN r ON n_regionkey = id",
    "gra_25_topic_concepts": "WITH t AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL) SELECT p_brand AS src, p_type AS dst, 'HAS_TYPE' AS kind FROM t QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) <= 10 UNION ALL SELECT DISTINCT p_brand, n_name, 'FROM' FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey",
    "gra_27_nearest": "SELECT a.s_suppkey AS id, b.s_suppkey AS nearest FROM supplier a JOIN supplier b ON b.s_nationkey = a.s_nationkey + 1 QUALIFY row_number() OVER (PARTITION BY a.s_suppkey ORDER BY abs(a.s_acctbal - b.s_acctbal), b.s_suppkey) = 1",
}
