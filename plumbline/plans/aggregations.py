"""Section 2.6: aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions.columns import present
from plumbline.functions.text import split_list
from plumbline.operators import aggregates as A
from plumbline.sources.tables import table


def agg_01_sum_either_side(spark, d):
    """AGG-01: quantity by part or supplier, whichever side it is seen from."""
    li = table(spark, d, "lineitem")
    sides = li.select(F.explode(F.array(F.concat(F.lit("p"), "l_partkey"), F.concat(F.lit("s"), "l_suppkey"))).alias("id"), "l_quantity")
    return sides.groupBy("id").agg(F.round(F.sum("l_quantity"), 2).alias("weight"))


def agg_02_count_distinct(spark, d):
    """AGG-02: distinct suppliers of every part."""
    return table(spark, d, "lineitem").groupBy("l_partkey").agg(F.count_distinct("l_suppkey").alias("suppliers"))


def agg_03_exists(spark, d):
    """AGG-03: does an order hold any returned line?"""
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max((F.col("l_returnflag") == "R").cast("int")).alias("any_returned"))


def agg_04_many(spark, d):
    """AGG-04, AGG-05: many aggregates in one pass."""
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("lines"), F.count_distinct("l_partkey").alias("parts"), F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.round(F.sum("l_extendedprice"), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("mean_discount"), F.max("l_quantity").alias("most"),
        F.min("l_quantity").alias("least"), F.count_if(F.col("l_tax") > 0.05).alias("taxed"),
    )


def agg_06_mode(spark, d):
    """AGG-06: the most frequent quantity of every supplier, the smallest of equals."""
    return A.mode_smallest(table(spark, d, "lineitem"), ["l_suppkey"], "l_quantity", "mode_quantity")


def agg_07_top_k_sum(spark, d):
    """AGG-07: the three highest prices of every supplier."""
    return A.top_k_sum(table(spark, d, "lineitem"), ["l_suppkey"], "l_extendedprice", 3, "top3").select("l_suppkey", F.round("top3", 2).alias("top3"))


def agg_08_quantile(spark, d):
    """AGG-08: the 70 % quantile by interpolation."""
    q = A.quantiles(table(spark, d, "scored_papers"), ["anchor_category"], "pagerank", [0.7], ["q70"])
    return q.select("anchor_category", F.round("q70", 9).alias("q70"))


def agg_09_value_counts(spark, d):
    """AGG-09, AGG-10, WIN-11: counts of tiers and their shares."""
    return A.value_counts(table(spark, d, "core_corpus_tracked"), F.col("tier"), "tier")


def agg_11_having(spark, d):
    """AGG-11: words of channels used often."""
    return table(spark, d, "candidate_papers").groupBy("seed_doi").agg(F.count(F.lit(1)).alias("n")).where("n >= 5")


def agg_12_rates(spark, d):
    """AGG-12: percentages of flags; an empty denominator counts as 100."""
    p = table(spark, d, "scored_papers")
    rate = lambda c: F.round(F.coalesce(F.avg(F.col(c).cast("double")) * 100, F.lit(100.0)), 4)
    return p.groupBy("record_source").agg(rate("in_final_corpus").alias("final_pct"), rate("has_ms_focus").alias("focus_pct"), F.round(F.coalesce(F.avg(present(F.col("abstract")).isNull().cast("double")) * 100, F.lit(100.0)), 4).alias("missing_abstract_pct"))


def agg_13_entropy(spark, d):
    """AGG-13: entropy of evidence types within each category."""
    return A.entropy(table(spark, d, "scored_papers"), ["anchor_category"], "evidence_type")


BINS = {"early": ("TOPIC-01", "TOPIC-02", "TOPIC-03"), "middle": ("TOPIC-03", "TOPIC-09", "TOPIC-10"), "none": ("TOPIC-99",)}


def agg_14_bins(spark, d):
    """AGG-14: a code may be in several bins; empty bins stay; all else is unmapped."""
    code = F.upper(F.trim(F.split_part("primary_topic_code", F.lit("."), F.lit(1))))
    return A.binned(table(spark, d, "core_corpus_tracked"), code, BINS, "unmapped")


def agg_15_timeline(spark, d):
    """AGG-15: papers by year and category, in columns, with the total and the mean."""
    p = table(spark, d, "scored_papers").where(F.col("publication_year").between(1971, 2029))
    cats = ["care", "epidemiology", "imaging", "pathogenesis", "trials"]
    counts = [F.count_if(F.col("anchor_category") == c).alias(c) for c in cats]
    return p.groupBy("publication_year").agg(*counts, F.count(F.lit(1)).alias("total"), F.round(F.avg("pagerank"), 9).alias("mean_rank"))


def agg_16_decades(spark, d):
    """AGG-16, MTH-05: papers by decade."""
    return table(spark, d, "candidate_papers").where(F.col("publication_year").between(1600, 2100)).groupBy((F.floor(F.col("publication_year") / 10) * 10).cast("int").alias("decade")).agg(F.count(F.lit(1)).alias("papers"))


def agg_17_venues(spark, d):
    """AGG-17, SRT-05: the ten most frequent venues."""
    v = table(spark, d, "candidate_papers").select(present(F.col("venue")).alias("venue")).where("venue is not null")
    return v.groupBy("venue").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "venue").limit(10)


def agg_18_span(spark, d):
    """AGG-18: first and last year of every venue."""
    p = table(spark, d, "candidate_papers").where(F.col("publication_year").between(1600, 2100))
    return p.groupBy("venue").agg(F.min("publication_year").alias("first_year"), F.max("publication_year").alias("last_year"))


def agg_19_split(spark, d):
    """AGG-19: rows by role against the rest."""
    return table(spark, d, "core_corpus_tracked").agg(F.count_if(F.col("corpus_role") == "core").alias("curated"), F.count_if(F.coalesce(F.col("corpus_role") != "core", F.lit(True))).alias("rest"))


def agg_20_zero_buckets(spark, d):
    """AGG-20: tiers in a fixed list, those without rows as 0."""
    tiers = spark.createDataFrame([(i, t) for i, t in enumerate(("T1", "T2", "T3", "T4", "T9"))], "pos int, core_selection_tier string")
    n = table(spark, d, "core_corpus_tracked").groupBy("core_selection_tier").agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(tiers).join(n, "core_selection_tier", "left").select("pos", "core_selection_tier", F.coalesce("n", F.lit(0)).alias("n"))


def agg_21_first_present(spark, d):
    """AGG-21, JON-21: the first abstract of every work in ingest order."""
    p = table(spark, d, "candidate_papers").select("openalex_id", "_ord", present(F.col("abstract")).alias("a"))
    return p.groupBy("openalex_id").agg(F.md5(A.first_present(F.col("a"), F.col("_ord"))).alias("abstract_md5"))


def agg_22_longest(spark, d):
    """AGG-22, SRC-04: the longest abstract of every work, the first of equals."""
    p = table(spark, d, "candidate_papers").where(present(F.col("abstract")).isNotNull())
    return p.groupBy("openalex_id").agg(A.longest(F.col("_ord"), F.lit(0)).alias("x"), F.max_by("_ord", F.struct(F.length("abstract"), -F.col("_ord"))).alias("longest_ord")).drop("x")


def agg_23_joined_set(spark, d):
    """AGG-23: the distinct channels of every work as one text."""
    p = table(spark, d, "candidate_papers").where(present(F.col("channel")).isNotNull())
    return p.groupBy("openalex_id").agg(A.joined_set(F.col("channel")).alias("channels"))


def agg_24_means(spark, d):
    """AGG-24: unweighted means of columns."""
    return table(spark, d, "core_corpus_tracked").agg(F.round(F.avg("score_total"), 9).alias("score_total"), F.round(F.avg("n_independent_signals"), 9).alias("signals"), F.round(F.avg("evidence_strength"), 9).alias("strength"))


def agg_25_terms(spark, d):
    """AGG-25, AGG-26: the ten most used values of ;-lists by venue, ties by first use."""
    p = table(spark, d, "candidate_papers").select("venue", "_ord", F.explode(split_list(F.col("topics"))).alias("term"))
    n = p.groupBy("venue", "term").agg(F.count(F.lit(1)).alias("n"), F.min("_ord").alias("first_ord"))
    from plumbline.operators.windows import ranked_head

    return ranked_head(n, ["venue"], [F.desc("n"), F.asc("first_ord"), F.asc("term")], 10, "rank_no").select("venue", "term", "n", "rank_no")


def agg_28_mean_length(spark, d):
    """AGG-28: mean text length in words by source, at least one word each."""
    t = table(spark, d, "documents").select("source", F.greatest(F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[A-Za-z0-9]+"), 0)), F.lit(1)).alias("n"))
    return t.groupBy("source").agg(F.round(F.avg("n"), 6).alias("mean_words"))


def agg_29_rollup(spark, d):
    """AGG-29: a weighted roll-up and the best item of each group."""
    li = table(spark, d, "lineitem")
    return li.groupBy("l_suppkey").agg(
        F.round(0.62 * F.log1p(F.sum("l_quantity")) + 2.4 * F.avg("l_discount") + 0.24 * F.count(F.lit(1)), 6).alias("score"),
        F.max_by("l_orderkey", F.struct("l_extendedprice", -F.col("l_orderkey"), -F.col("l_linenumber"))).alias("best_order"),
    )


def agg_31_group_means(spark, d):
    """AGG-31: mean score by topic."""
    return table(spark, d, "core_corpus_tracked").where("score_total is not null").groupBy("primary_topic_code").agg(F.round(F.avg("score_total"), 6).alias("priority"))


def agg_33_caps(spark, d):
    """AGG-33, AGG-34: groups above a cap or below a floor."""
    n = table(spark, d, "core_seeds").groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    return n.select("category", "n", F.when(F.col("n") > 12, "above").when(F.col("n") < 8, "below").otherwise("within").alias("verdict"))


_MISSING = "({0} IS NULL OR lower(trim({0}, chr(9)||chr(10)||chr(13)||' ')) IN ('', 'nan'))"
_BIN_VALUES = ", ".join(f"('{k}', '{b}')" for b, ks in BINS.items() for k in ks)

QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("agg_")}
ORACLE = {
    "agg_01_sum_either_side": "SELECT id, round(sum(l_quantity), 2) AS weight FROM (SELECT 'p' || l_partkey AS id, l_quantity FROM lineitem UNION ALL SELECT 's' || l_suppkey, l_quantity FROM lineitem) GROUP BY id",
    "agg_02_count_distinct": "SELECT l_partkey, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY l_partkey",
    "agg_03_exists": "SELECT l_orderkey, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS any_returned FROM lineitem GROUP BY l_orderkey",
    "agg_04_many": "SELECT l_suppkey, count(*) AS lines, count(DISTINCT l_partkey) AS parts, count(*) FILTER (l_returnflag = 'R') AS returned, round(sum(l_extendedprice), 2) AS revenue, round(avg(l_discount), 6) AS mean_discount, max(l_quantity) AS most, min(l_quantity) AS least, count(*) FILTER (l_tax > 0.05) AS taxed FROM lineitem GROUP BY l_suppkey",
    "agg_06_mode": "SELECT l_suppkey, l_quantity AS mode_quantity FROM (SELECT l_suppkey, l_quantity, count(*) AS n FROM lineitem GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_quantity) = 1",
    "agg_07_top_k_sum": "SELECT l_suppkey, round(sum(l_extendedprice), 2) AS top3 FROM (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC) <= 3) GROUP BY l_suppkey",
    "agg_08_quantile": "SELECT anchor_category, round(quantile_cont(pagerank, 0.7), 9) AS q70 FROM scored_papers GROUP BY anchor_category",
    "agg_09_value_counts": "SELECT tier, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM core_corpus_tracked GROUP BY tier",
    "agg_11_having": "SELECT seed_doi, count(*) AS n FROM candidate_papers GROUP BY seed_doi HAVING count(*) >= 5",
    "agg_12_rates": f"SELECT record_source, round(coalesce(avg(in_final_corpus::INT) * 100, 100.0), 4) AS final_pct, round(coalesce(avg(has_ms_focus::INT) * 100, 100.0), 4) AS focus_pct, round(coalesce(avg({_MISSING.format('abstract')}::INT) * 100, 100.0), 4) AS missing_abstract_pct FROM scored_papers GROUP BY record_source",
    "agg_13_entropy": "WITH c AS (SELECT anchor_category, evidence_type, count(*) AS n FROM scored_papers WHERE evidence_type IS NOT NULL GROUP BY ALL), p AS (SELECT anchor_category, n / sum(n) OVER (PARTITION BY anchor_category) AS p FROM c) SELECT anchor_category, count(*) AS kinds, round(-sum(p * ln(p)), 6) AS entropy, round(CASE WHEN count(*) > 1 THEN -sum(p * ln(p)) / ln(count(*)) ELSE 0 END, 6) AS evenness FROM p GROUP BY anchor_category",
    "agg_14_bins": f"WITH b(k, bin) AS (VALUES {_BIN_VALUES}), x AS (SELECT coalesce(bin, 'unmapped') AS bin, count(*) AS n FROM core_corpus_tracked LEFT JOIN b ON k = upper(trim(split_part(primary_topic_code, '.', 1))) GROUP BY 1) SELECT v.bin, coalesce(n, 0) AS n FROM (SELECT DISTINCT bin FROM b UNION ALL SELECT 'unmapped') v LEFT JOIN x USING (bin)",
    "agg_15_timeline": "SELECT publication_year, " + ", ".join(f"count(*) FILTER (anchor_category = '{c}') AS {c}" for c in ("care", "epidemiology", "imaging", "pathogenesis", "trials")) + ", count(*) AS total, round(avg(pagerank), 9) AS mean_rank FROM scored_papers WHERE publication_year BETWEEN 1971 AND 2029 GROUP BY publication_year",
    "agg_16_decades": "SELECT CAST(publication_year // 10 * 10 AS INT) AS decade, count(*) AS papers FROM candidate_papers WHERE publication_year BETWEEN 1600 AND 2100 GROUP BY 1",
    "agg_17_venues": f"SELECT venue, count(*) AS n FROM candidate_papers WHERE NOT {_MISSING.format('venue')} GROUP BY venue ORDER BY n DESC, venue LIMIT 10",
    "agg_18_span": "SELECT venue, min(publication_year) AS first_year, max(publication_year) AS last_year FROM candidate_papers WHERE publication_year BETWEEN 1600 AND 2100 GROUP BY venue",
    "agg_19_split": "SELECT count(*) FILTER (corpus_role = 'core') AS curated, count(*) FILTER (corpus_role IS DISTINCT FROM 'core') AS rest FROM core_corpus_tracked",
    "agg_20_zero_buckets": "SELECT pos, t AS core_selection_tier, (SELECT count(*) FROM core_corpus_tracked WHERE core_selection_tier = t) AS n FROM (VALUES (0, 'T1'), (1, 'T2'), (2, 'T3'), (3, 'T4'), (4, 'T9')) v(pos, t)",
    "agg_21_first_present": f"SELECT openalex_id, md5(min_by(abstract, _ord) FILTER (NOT {_MISSING.format('abstract')})) AS abstract_md5 FROM candidate_papers GROUP BY openalex_id",
    "agg_22_longest": f"SELECT openalex_id, _ord AS longest_ord FROM candidate_papers WHERE NOT {_MISSING.format('abstract')} QUALIFY row_number() OVER (PARTITION BY openalex_id ORDER BY length(abstract) DESC, _ord) = 1",
    "agg_23_joined_set": f"SELECT openalex_id, string_agg(DISTINCT channel, ';' ORDER BY channel) AS channels FROM candidate_papers WHERE NOT {_MISSING.format('channel')} GROUP BY openalex_id",
    "agg_24_means": "SELECT round(avg(score_total), 9) AS score_total, round(avg(n_independent_signals), 9) AS signals, round(avg(evidence_strength), 9) AS strength FROM core_corpus_tracked",
    "agg_25_terms": r"WITH t AS (SELECT venue, _ord, trim(unnest(string_split(topics, ';'))) AS term FROM candidate_papers), n AS (SELECT venue, term, count(*) AS n, min(_ord) AS f FROM t WHERE lower(trim(regexp_replace(term, '\s', '', 'g'))) NOT IN ('', 'nan') GROUP BY ALL) SELECT venue, term, n, row_number() OVER (PARTITION BY venue ORDER BY n DESC, f, term) AS rank_no FROM n QUALIFY rank_no <= 10",
    "agg_28_mean_length": "SELECT source, round(avg(greatest(len(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9]+')), 1)), 6) AS mean_words FROM documents GROUP BY source",
    "agg_29_rollup": "SELECT l_suppkey, round(0.62 * ln(1 + sum(l_quantity)) + 2.4 * avg(l_discount) + 0.24 * count(*), 6) AS score, arg_max(l_orderkey, (l_extendedprice, -l_orderkey, -l_linenumber)) AS best_order FROM lineitem GROUP BY l_suppkey",
    "agg_31_group_means": "SELECT primary_topic_code, round(avg(score_total), 6) AS priority FROM core_corpus_tracked WHERE score_total IS NOT NULL GROUP BY 1",
    "agg_33_caps": "SELECT category, count(*) AS n, CASE WHEN count(*) > 12 THEN 'above' WHEN count(*) < 8 THEN 'below' ELSE 'within' END AS verdict FROM core_seeds GROUP BY category",
}
