"""Sections 2.7 and 2.8: window functions, sorts, limits, sampling."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.operators import windows as W
from plumbline.operators.aggregates import quantiles
from plumbline.operators.order import global_position
from plumbline.sources.tables import table


def win_01_percentile_rank(spark, d):
    """WIN-01: percentile ranks over the whole table, equal values averaged."""
    p = table(spark, d, "scored_papers").select("record_id", "cross_seed_score")
    return W.percentile_ranks(p, "cross_seed_score", "pct").select("record_id", F.round("pct", 9).alias("pct"))


def win_02_rank_in_group(spark, d):
    """WIN-02: percentile ranks within each year; a missing year is a group."""
    p = table(spark, d, "scored_papers").select("record_id", "pagerank", F.coalesce("publication_year", F.lit(-1)).alias("y"))
    return p.select("record_id", F.round(W.percentile_rank(F.col("pagerank"), [F.col("y")]), 9).alias("pct"))


def win_03_log_max(spark, d):
    """WIN-03: ln(1 + x) over its greatest."""
    p = table(spark, d, "scored_papers").select("record_id", "cross_seed_score")
    return W.log_max(p, "cross_seed_score", "norm").select("record_id", F.round("norm", 9).alias("norm"))


def win_04_max(spark, d):
    """WIN-04: x over its greatest."""
    p = table(spark, d, "scored_papers").select("record_id", "pagerank")
    top = p.agg(F.max("pagerank").alias("top"))
    return p.crossJoin(F.broadcast(top)).select("record_id", F.round(F.coalesce(F.col("pagerank") / F.col("top"), F.lit(0.0)), 9).alias("norm"))


def win_05_ranked_head(spark, d):
    """WIN-05: the head of every group, its length from another aggregate."""
    li = table(spark, d, "lineitem")
    caps = li.groupBy("l_suppkey").agg(F.greatest(F.lit(2), F.ceil(F.count(F.lit(1)) * 0.01)).alias("cap"))
    ordered = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")]
    return W.ranked_head(li.join(caps, "l_suppkey"), ["l_suppkey"], ordered, F.col("cap"), "rank_no").select("l_suppkey", "l_orderkey", "l_linenumber", "rank_no")


def win_06_rank_of_some(spark, d):
    """WIN-06: ranks of eligible rows, 0 for the others."""
    li = table(spark, d, "orders")
    some = F.col("o_orderstatus") == "F"
    w = Window.partitionBy("o_custkey", some).orderBy(F.desc("o_totalprice"), "o_orderkey")
    return li.select("o_orderkey", F.when(some, F.row_number().over(w)).otherwise(0).alias("rank_no"))


def win_07_path(spark, d):
    """WIN-07, WIN-08: the first five steps of every topic's reading path."""
    t = table(spark, d, "core_corpus_tracked").where("paper_importance_score is not null and not isnan(paper_importance_score)")
    return W.ranked_head(t, ["primary_topic_code"], [F.desc("paper_importance_score"), F.asc("row_id")], 5, "step").select("primary_topic_code", "row_id", "step")


def win_09_position(spark, d):
    """WIN-09: position in an order over the number of rows."""
    c = global_position(table(spark, d, "customer").select("c_custkey", "c_acctbal"), [F.desc("c_acctbal"), F.asc("c_custkey")], "r")
    n = c.agg(F.count(F.lit(1)).alias("total"))
    return c.crossJoin(F.broadcast(n)).select("c_custkey", F.round((F.col("total") - F.col("r")) / F.col("total"), 9).alias("position"))


def win_10_capped(spark, d):
    """WIN-10, SEL-09: the best 40 customers with at most 3 of each nation."""
    return W.capped_top(table(spark, d, "customer"), "c_nationkey", [F.desc("c_acctbal"), F.asc("c_custkey")], 3, 40).select("c_custkey", "c_nationkey", "c_acctbal")


def win_12_blend(spark, d):
    """WIN-12: three percentile ranks, blended."""
    p = table(spark, d, "scored_papers").select("record_id", "pagerank", "cross_seed_score", "review_anchor_link_count")
    for c in ("pagerank", "cross_seed_score", "review_anchor_link_count"):
        p = W.percentile_ranks(p, c, f"r_{c}")
    r = lambda c: F.coalesce(F.col(f"r_{c}"), F.lit(0.0))
    return p.select("record_id", F.round(0.5 * r("pagerank") + 0.3 * r("cross_seed_score") + 0.2 * r("review_anchor_link_count"), 6).alias("core_score"))


def win_13_spacing(spark, d):
    """WIN-13: even spacing within each year."""
    p = table(spark, d, "scored_papers").where("publication_year is not null")
    w = Window.partitionBy("publication_year")
    return p.select("record_id", F.round(F.row_number().over(w.orderBy(F.desc_nulls_last("pagerank"), "record_id")) / (F.count(F.lit(1)).over(w) + 1), 9).alias("place"))


def win_14_tiers(spark, d):
    """WIN-14: low, middle and high by the 33 and 66 % quantiles."""
    c = table(spark, d, "customer")
    q = quantiles(c, [], "c_acctbal", [0.33, 0.66], ["low", "high"])
    tier = F.when(F.col("c_acctbal") <= F.col("low"), "low").when(F.col("c_acctbal") <= F.col("high"), "middle").otherwise("high")
    return c.crossJoin(F.broadcast(q)).select("c_custkey", tier.alias("tier"))


def srt_02_top_k(spark, d):
    """SRT-01, SRT-02, SRT-03: the top 25 by several keys."""
    return table(spark, d, "scored_papers").orderBy(F.desc_nulls_last("cross_seed_score"), F.desc_nulls_last("pagerank"), "record_id").select("record_id", "cross_seed_score").limit(25)


def srt_04_representative(spark, d):
    """SRT-04: one row for each work: preprints last, then most cited, then first seen."""
    p = table(spark, d, "candidate_papers").where("openalex_id is not null")
    best = F.min_by("_ord", F.struct(F.coalesce(F.col("doi").contains("/prx."), F.lit(False)), -F.coalesce("cited_by_count", F.lit(0)), F.col("_ord")))
    return p.groupBy("openalex_id").agg(best.alias("best_ord"))


def srt_06_dense_index(spark, d):
    """SRT-06, SNK-09: a dense index from 0 in a fixed order, by range partitions and their offsets."""
    n = table(spark, d, "nation")
    return global_position(n.select("n_nationkey", "n_regionkey", "n_name"), ["n_regionkey", "n_name"], "idx").select("n_nationkey", "idx")


def srt_07_sample(spark, d):
    """SRT-07: a repeatable sample of 30, by hash order."""
    return table(spark, d, "orders").select("o_orderkey", F.md5(F.concat(F.lit("13:"), F.col("o_orderkey").cast("string"))).alias("h")).orderBy("h").limit(30).select("o_orderkey")


def srt_09_relative_cut(spark, d):
    """SRT-09: at most 12 rows with a score not far below the best."""
    t = table(spark, d, "core_corpus_tracked").where("not isnan(score_total)").select("row_id", F.col("score_total").alias("score"))
    from plumbline.operators.retrieval import relative_cut

    return relative_cut(t, 0.2, 0.16, 12, [F.desc("score"), F.asc("row_id")])


def srt_11_truncate(spark, d):
    """SRT-11: cut texts."""
    return table(spark, d, "eval_items").select("item_id", F.substring("item_text", 1, 80).alias("head"), F.length("item_text").alias("n"))


def srt_12_unknown_last(spark, d):
    """SRT-12: categories by count with the unknown one last."""
    n = table(spark, d, "scored_papers").groupBy(F.coalesce("evidence_type", F.lit("unknown")).alias("category")).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("pos", F.row_number().over(Window.orderBy((F.col("category") == "unknown"), F.desc("n"), "category")))


def _pct(c: str, part: str = "") -> str:
    p = f"PARTITION BY {part}" if part else ""
    q = f"PARTITION BY {part + ', ' if part else ''}{c}"
    return f"CASE WHEN {c} IS NOT NULL THEN (rank() OVER ({p} ORDER BY {c} NULLS LAST) + (count({c}) OVER ({q}) - 1) / 2.0) / count({c}) OVER ({p}) END"


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith(("win_", "srt_"))}
ORACLE = {
    "win_01_percentile_rank": f"SELECT record_id, round(CASE WHEN (SELECT max(cross_seed_score) FROM scored_papers) <= 0 AND cross_seed_score IS NOT NULL THEN 0 ELSE {_pct('cross_seed_score')} END, 9) AS pct FROM scored_papers",
    "win_02_rank_in_group": f"SELECT record_id, round({_pct('pagerank', 'y')}, 9) AS pct FROM (SELECT *, coalesce(publication_year, -1) AS y FROM scored_papers)",
    "win_03_log_max": "SELECT record_id, round(ln(1 + greatest(coalesce(cross_seed_score, 0), 0)) / max(ln(1 + greatest(coalesce(cross_seed_score, 0), 0))) OVER (), 9) AS norm FROM scored_papers",
    "win_04_max": "SELECT record_id, round(coalesce(pagerank / max(pagerank) OVER (), 0), 9) AS norm FROM scored_papers",
    "win_05_ranked_head": "SELECT l_suppkey, l_orderkey, l_linenumber, row_number() OVER w AS rank_no FROM lineitem WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) QUALIFY row_number() OVER w <= greatest(2, ceil(count(*) OVER (PARTITION BY l_suppkey) * 0.01))",
    "win_06_rank_of_some": "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN row_number() OVER (PARTITION BY o_custkey, o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey) ELSE 0 END AS rank_no FROM orders",
    "win_07_path": "SELECT primary_topic_code, row_id, row_number() OVER w AS step FROM core_corpus_tracked WHERE paper_importance_score IS NOT NULL AND NOT isnan(paper_importance_score) WINDOW w AS (PARTITION BY primary_topic_code ORDER BY paper_importance_score DESC, row_id) QUALIFY row_number() OVER w <= 5",
    "win_09_position": "SELECT c_custkey, round((count(*) OVER () - (row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) - 1)) / count(*) OVER (), 9) AS position FROM customer",
    "win_10_capped": "SELECT c_custkey, c_nationkey, c_acctbal FROM (SELECT * FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) <= 3) ORDER BY c_acctbal DESC, c_custkey LIMIT 40",
    "win_12_blend": "SELECT record_id, round(0.5 * coalesce({}, 0) + 0.3 * coalesce({}, 0) + 0.2 * coalesce({}, 0), 6) AS core_score FROM scored_papers".format(*map(_pct, ("pagerank", "cross_seed_score", "review_anchor_link_count"))),
    "win_13_spacing": "SELECT record_id, round(row_number() OVER (PARTITION BY publication_year ORDER BY pagerank DESC NULLS LAST, record_id) / (count(*) OVER (PARTITION BY publication_year) + 1), 9) AS place FROM scored_papers WHERE publication_year IS NOT NULL",
    "win_14_tiers": "SELECT c_custkey, CASE WHEN c_acctbal <= (SELECT quantile_cont(c_acctbal, 0.33) FROM customer) THEN 'low' WHEN c_acctbal <= (SELECT quantile_cont(c_acctbal, 0.66) FROM customer) THEN 'middle' ELSE 'high' END AS tier FROM customer",
    "srt_02_top_k": "SELECT record_id, cross_seed_score FROM scored_papers ORDER BY cross_seed_score DESC NULLS LAST, pagerank DESC NULLS LAST, record_id LIMIT 25",
    "srt_04_representative": "SELECT openalex_id, _ord AS best_ord FROM candidate_papers WHERE openalex_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY openalex_id ORDER BY coalesce(contains(doi, '/prx.'), false), coalesce(cited_by_count, 0) DESC, _ord) = 1",
    "srt_06_dense_index": "SELECT n_nationkey, row_number() OVER (ORDER BY n_regionkey, n_name) - 1 AS idx FROM nation",
    "srt_07_sample": "SELECT o_orderkey FROM orders ORDER BY md5('13:' || o_orderkey) LIMIT 30",
    "srt_09_relative_cut": "SELECT row_id, score_total AS score FROM core_corpus_tracked WHERE NOT isnan(score_total) AND score_total >= 0.2 AND score_total >= 0.16 * (SELECT max(score_total) FROM core_corpus_tracked WHERE NOT isnan(score_total)) ORDER BY score_total DESC, row_id LIMIT 12",
    "srt_11_truncate": "SELECT item_id, substr(item_text, 1, 80) AS head, length(item_text) AS n FROM eval_items",
    "srt_12_unknown_last": "SELECT coalesce(evidence_type, 'unknown') AS category, count(*) AS n, row_number() OVER (ORDER BY coalesce(evidence_type, 'unknown') = 'unknown', count(*) DESC, coalesce(evidence_type, 'unknown')) AS pos FROM scored_papers GROUP BY 1",
}
