"""Sections 2.3, 2.4 and 2.11: scores, flags, classifiers and lists, beyond those of ``scalars``."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import scoring as S
from plumbline.functions import text as T
from plumbline.functions.columns import is_missing
from plumbline.operators.windows import percentile_ranks
from plumbline.sources.tables import table

WANTED, UNWANTED, FOCUS = ("lesion", "relapse", "fatigue", "imaging"), ("mice", "waiting list"), ("neuro", "myelin", "sclerosis")
RULES = (("trial", ("randomi", "placebo")), ("review", ("systematic", "review")), ("cohort", ("cohort", "registry", "followed")))
ALIASES = {"gait": ("gait", "walking"), "vision": ("visual", "optic"), "imaging": ("imaging", "lesion", "tomography")}
SYNONYMS = {"gait": ("walking", "mobility"), "vision": ("visual",), "risk": ("hazard",)}


def prj_05_blend(spark, d):
    """PRJ-05: customers by their share of the greatest spending and of the most orders."""
    c = table(spark, d, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("spent"), F.count(F.lit(1)).alias("orders"))
    return S.shares_of_greatest(c, {"spent": 0.7, "orders": 0.3}, "blend").select("o_custkey", F.round("blend", 6).alias("blend"))


def prj_06_impact(spark, d):
    """PRJ-06: a weighted sum of percentile ranks of several measures."""
    s = table(spark, d, "scored_papers").select("record_id", F.greatest(F.col("merged_cited_by_count"), F.lit(0)).alias("cites"), "pagerank", F.col("cross_seed_score").alias("seeds"))
    for c in ("cites", "pagerank", "seeds"):
        s = percentile_ranks(s, c, f"{c}_rank")
    rank = lambda c: F.coalesce(F.col(f"{c}_rank"), F.lit(0.0))
    return s.select("record_id", F.round(2 * rank("cites") + 2 * rank("pagerank") + 1.5 * rank("seeds"), 6).alias("impact"))


def prj_08_adjusted(spark, d):
    """PRJ-08: a score raised and lowered by conditions."""
    s = table(spark, d, "scored_papers")
    factors = [(F.col("has_ms_focus"), 1.2), (F.col("review_anchor_link_count") >= 3, 1.65), (is_missing(F.col("abstract")), 0.35)]
    return s.select("record_id", F.round(S.adjusted(F.coalesce("cross_seed_score", F.lit(0)) + 1.0, factors), 6).alias("score"))


def flt_06_off_topic(spark, d):
    """FLT-06: papers on something else."""
    s = table(spark, d, "scored_papers")
    text = F.concat_ws(" ", "title", "abstract")
    bad = S.off_topic(text, ("cost", "employment", "dose", "plasma", "hazard"), FOCUS, F.col("review_anchor_link_count"), 3, F.col("is_core_seed"))
    return s.where(bad).select("record_id")


def flt_07_bridges(spark, d):
    """FLT-07: papers that hold the collection together in one way or another."""
    s = table(spark, d, "scored_papers")
    keep = S.any_of(F.col("review_anchor_link_count") >= 5, (F.col("cross_seed_score") >= 3) & (F.col("pagerank") >= 1e-4), F.col("is_core_seed"))
    return s.select("record_id", keep.alias("bridge"))


def flt_12_presets(spark, d):
    """FLT-12: named sets of minima, and how many papers meet each."""
    s = table(spark, d, "scored_papers")
    presets = {"undergrad": (50, 2, 1980), "grad": (10, 1, 1950), "balanced": (20, 1, 1990)}
    met = lambda v: F.coalesce((F.col("merged_cited_by_count") >= v[0]) & (F.col("cross_seed_score") >= v[1]) & (F.col("publication_year") >= v[2]), F.lit(False))
    one = s.agg(*[F.count_if(met(v)).alias(k) for k, v in presets.items()])
    return one.unpivot([], list(presets), "preset", "papers")


def flt_19_column_fallback(spark, d):
    """FLT-19: a mask from the first column that the table has."""
    t = table(spark, d, "core_corpus_tracked")
    return t.where(T.truth(S.first_column(t, ["in_core", "in_core_corpus", "corpus_role"], F.lit("true")))).select("row_id")


def str_06_contrast(spark, d):
    """STR-06: wanted words against unwanted ones."""
    return table(spark, d, "documents").select("doc_id", S.contrast_score(F.col("text"), WANTED, UNWANTED).alias("score"))


def str_08_first_rule(spark, d):
    """STR-08: the first rule that applies."""
    return table(spark, d, "documents").select("doc_id", S.first_rule(F.col("text"), RULES, "other").alias("kind"))


def str_09_tags(spark, d):
    """STR-09: all labels of a dictionary."""
    return table(spark, d, "documents").select("doc_id", F.array_join(S.tags(F.col("text"), ALIASES), ";").alias("tags"))


def str_14_expansion(spark, d):
    """STR-14: the words of topic labels with their synonyms."""
    return table(spark, d, "topic_map").select("topic_code", F.array_join(S.expanded(T.tokenize(F.col("topic_label")), SYNONYMS), " ").alias("query"))


def str_24_numbers_and_names(spark, d):
    """STR-24: the first number of an identifier, and the last word of a name."""
    p = table(spark, d, "candidate_papers")
    return p.select("_ord", S.first_number(F.col("openalex_id")).alias("number"), S.last_word(F.col("first_author")).alias("last_word"))


def str_25_notes(spark, d):
    """STR-25: what a rationale says about its readers."""
    return table(spark, d, "core_seeds").select("corpus_id", S.note_after(F.col("rationale"), "for readers of", " at ").alias("note"))


def arr_04_structs(spark, d):
    """ARR-04: lists of objects in JSON, those with a term."""
    s = table(spark, d, "core_seeds")
    text = F.to_json(F.array(F.struct(F.coalesce("geo_scope", F.lit("")).alias("term"), F.lit("geo").alias("kind")), F.struct(F.coalesce("population", F.lit("")).alias("term"), F.lit("who").alias("kind"))))
    items = S.structs_with(text, "struct<term:string,kind:string>", "term")
    return s.select("corpus_id", F.array_join(F.transform(items, lambda x: F.concat_ws("=", x["kind"], x["term"])), ",").alias("items"))


def arr_08_merged(spark, d):
    """ARR-08: counts of categories, those of a second source by half."""
    o = table(spark, d, "orders")
    by = lambda c, name: o.groupBy("o_custkey", F.col(c).alias("k")).agg(F.count(F.lit(1)).alias("n")).groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias(name))
    early = o.where("o_orderstatus = 'F'").select("o_custkey", F.col("o_orderpriority").alias("k")).groupBy("o_custkey", "k").agg(F.count(F.lit(1)).alias("n")).groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias("b"))
    both = by("o_orderpriority", "a").join(early, "o_custkey", "left")
    return both.select("o_custkey", F.explode(S.merged_counts(F.col("a"), F.coalesce("b", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))), 0.5)).alias("k", "n"))


def agg_32_stages(spark, d):
    """AGG-32: a run report: rows left after each stage."""
    s = table(spark, d, "scored_papers")
    stages = [("has_abstract", ~is_missing(F.col("abstract"))), ("has_year", F.col("publication_year").between(1600, 2100)), ("counted", F.col("merged_cited_by_count") > 0), ("focus", F.col("has_ms_focus"))]
    return S.stage_counts(s, stages)


def srt_10_truncation(spark, d):
    """SRT-10: the first forty suppliers, and all nations."""
    s = S.limited(table(spark, d, "supplier").select("s_suppkey", "s_acctbal"), [F.desc("s_acctbal"), F.asc("s_suppkey")], 40)
    n = S.limited(table(spark, d, "nation"), [F.asc("n_nationkey")], 0)
    return s.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").cast("bigint").alias("id")).unionByName(n.select(F.lit("nation").alias("kind"), F.col("n_nationkey").cast("bigint").alias("id")))


_M = "({0} IS NULL OR lower(trim({0}, chr(9)||chr(10)||chr(13)||' ')) IN ('', 'nan'))"


def _hits(text: str, terms) -> str:
    return "(" + " + ".join(f"contains(lower(coalesce({text}, '')), '{t}')::INT" for t in terms) + ")"


def _any(text: str, terms) -> str:
    return "(" + " OR ".join(f"contains(lower(coalesce({text}, '')), '{t}')" for t in terms) + ")"


def _rank(c: str, src: str) -> str:
    return f"CASE WHEN {src} IS NULL THEN 0 WHEN max({src}) OVER () <= 0 THEN 0 ELSE (rank() OVER (ORDER BY {src} NULLS LAST) + (count({src}) OVER (PARTITION BY {src}) - 1) / 2) / count({src}) OVER () END AS {c}"


_T = "concat_ws(' ', title, abstract)"
QUERIES = {k: v for k, v in list(globals().items()) if k.split("_")[0] in ("prj", "flt", "str", "arr", "agg", "srt")}
ORACLE = {
    "prj_05_blend": "WITH c AS (SELECT o_custkey, sum(o_totalprice) AS s, count(*) AS n FROM orders GROUP BY 1) SELECT o_custkey, round(0.7::DOUBLE * s / max(s) OVER () + 0.3::DOUBLE * n / max(n) OVER (), 6) AS blend FROM c",
    "prj_06_impact": f"WITH r AS (SELECT record_id, {_rank('a', 'greatest(merged_cited_by_count, 0)')}, {_rank('b', 'pagerank')}, {_rank('c', 'cross_seed_score')} FROM scored_papers) SELECT record_id, round(2 * a + 2 * b + 1.5::DOUBLE * c, 6) AS impact FROM r",
    "prj_08_adjusted": f"SELECT record_id, round((coalesce(cross_seed_score, 0) + 1) * CASE WHEN has_ms_focus THEN 1.2::DOUBLE ELSE 1 END * CASE WHEN review_anchor_link_count >= 3 THEN 1.65::DOUBLE ELSE 1 END * CASE WHEN {_M.format('abstract')} THEN 0.35::DOUBLE ELSE 1 END, 6) AS score FROM scored_papers",
    "flt_06_off_topic": f"SELECT record_id FROM scored_papers WHERE {_hits(_T, ('cost', 'employment', 'dose', 'plasma', 'hazard'))} >= 2 AND {_hits(_T, FOCUS)} = 0 AND coalesce(review_anchor_link_count, 0) < 3 AND NOT coalesce(is_core_seed, false)",
    "flt_07_bridges": "SELECT record_id, coalesce(review_anchor_link_count >= 5, false) OR coalesce(cross_seed_score >= 3 AND pagerank >= 1e-4, false) OR coalesce(is_core_seed, false) AS bridge FROM scored_papers",
    "flt_12_presets": " UNION ALL ".join(f"SELECT '{k}' AS preset, count(*) AS papers FROM scored_papers WHERE merged_cited_by_count >= {a} AND cross_seed_score >= {b} AND publication_year >= {c}" for k, (a, b, c) in {"undergrad": (50, 2, 1980), "grad": (10, 1, 1950), "balanced": (20, 1, 1990)}.items()),
    "flt_19_column_fallback": "SELECT row_id FROM core_corpus_tracked WHERE lower(trim(in_core_corpus)) IN ('1', 'true', 'yes', 'y', 't')",
    "str_06_contrast": f"SELECT doc_id, greatest(0, {_hits('text', WANTED)} - 2 * {_hits('text', UNWANTED)}) AS score FROM documents",
    "str_08_first_rule": "SELECT doc_id, CASE " + " ".join(f"WHEN {_any('text', ts)} THEN '{k}'" for k, ts in RULES) + " ELSE 'other' END AS kind FROM documents",
    "str_09_tags": "SELECT doc_id, concat_ws(';', " + ", ".join(f"CASE WHEN {_any('text', ts)} THEN '{k}' END" for k, ts in ALIASES.items()) + ") AS tags FROM documents",
    "str_14_expansion": "WITH t AS (SELECT topic_code, tok, generate_subscripts(l, 1) AS i FROM (SELECT topic_code, l, unnest(l) AS tok FROM (SELECT topic_code, list_filter(regexp_extract_all(lower(topic_label), '([a-z0-9][a-z0-9\\-]+)', 1), lambda t: length(t) >= 3) AS l FROM topic_map))), x AS (SELECT topic_code, i, 0 AS j, tok FROM (SELECT topic_code, tok, row_number() OVER (PARTITION BY topic_code ORDER BY i) AS i FROM t) UNION ALL SELECT topic_code, i, j, s FROM (SELECT topic_code, tok, row_number() OVER (PARTITION BY topic_code ORDER BY i) AS i FROM t) JOIN (VALUES ('gait', 1, 'walking'), ('gait', 2, 'mobility'), ('vision', 1, 'visual'), ('risk', 1, 'hazard')) v(k, j, s) ON k = tok), f AS (SELECT topic_code, tok, min(i * 10 + j) AS o FROM x GROUP BY ALL) SELECT topic_code, string_agg(tok, ' ' ORDER BY o) AS query FROM f GROUP BY 1",
    "str_24_numbers_and_names": r"SELECT _ord, nullif(regexp_extract(coalesce(openalex_id, ''), '(\d+)', 1), '') AS number, nullif(string_split(trim(regexp_replace(coalesce(first_author, ''), '\s+', ' ', 'g')), ' ')[-1], '') AS last_word FROM candidate_papers",
    "str_25_notes": r"SELECT corpus_id, nullif(trim(regexp_replace(regexp_extract(coalesce(rationale, ''), '(?is)for readers of(.*?)(?: at |\z)', 1), '\s+', ' ', 'g')), '') AS note FROM core_seeds",
    "arr_04_structs": "SELECT corpus_id, concat_ws(',', CASE WHEN geo_scope <> '' THEN 'geo=' || geo_scope END, CASE WHEN population <> '' THEN 'who=' || population END) AS items FROM core_seeds",
    "arr_08_merged": "SELECT o_custkey, o_orderpriority AS k, count(*) + 0.5::DOUBLE * count(*) FILTER (o_orderstatus = 'F') AS n FROM orders GROUP BY 1, 2",
    "agg_32_stages": f"WITH f AS (SELECT NOT {_M.format('abstract')} AS a, coalesce(publication_year BETWEEN 1600 AND 2100, false) AS b, coalesce(merged_cited_by_count > 0, false) AS c, coalesce(has_ms_focus, false) AS d FROM scored_papers), n AS (SELECT count(*) AS n0, count(*) FILTER (a) AS n1, count(*) FILTER (a AND b) AS n2, count(*) FILTER (a AND b AND c) AS n3, count(*) FILTER (a AND b AND c AND d) AS n4 FROM f) SELECT 'has_abstract' AS stage, n1 AS kept, n0 - n1 AS taken FROM n UNION ALL SELECT 'has_year', n2, n1 - n2 FROM n UNION ALL SELECT 'counted', n3, n2 - n3 FROM n UNION ALL SELECT 'focus', n4, n3 - n4 FROM n",
    "srt_10_truncation": "SELECT 'supplier' AS kind, s_suppkey AS id FROM (SELECT s_suppkey FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 40) UNION ALL SELECT 'nation', n_nationkey FROM nation",
}
