"""Sections 2.3, 2.4 and 2.11: projections, predicates, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import text as T
from plumbline.functions.columns import is_missing, present
from plumbline.operators.aggregates import quantiles
from plumbline.sources.tables import table


def prj_03_flags(spark, d):
    """PRJ-03, PRJ-16, FLT-04: flags from a list, by member and by substring."""
    t = table(spark, d, "core_corpus_tracked")
    members = T.split_list(F.col("all_channels"))
    return t.select("row_id", F.array_contains(members, "seed_resolution").cast("int").alias("is_seed"), F.coalesce(F.col("all_channels").contains("seed_"), F.lit(False)).cast("int").alias("seed_like"), F.coalesce(F.col("all_channels").rlike("lexical|dataset"), F.lit(False)).alias("found"))


def prj_04_weighted(spark, d):
    """PRJ-04: a weighted sum of features."""
    t = table(spark, d, "core_corpus_tracked")
    x = lambda c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0))
    return t.select("row_id", F.round(3 * x("score_total") + 2 * x("paper_importance_score") + 1.5 * F.log1p(x("citations_per_year_raw")) + 0.5 * x("evidence_strength"), 6).alias("score"))


def prj_07_rate(spark, d):
    """PRJ-07, MTH-02, MTH-04: citations a year as of an injected year."""
    p = table(spark, d, "candidate_papers")
    age = F.greatest(F.lit(1), F.lit(2026) - F.coalesce("publication_year", F.lit(2026)) + 1)
    return p.select("_ord", age.alias("age"), F.round(F.coalesce("cited_by_count", F.lit(0)) / age, 6).alias("rate"))


def prj_10_labels(spark, d):
    """PRJ-09, PRJ-10, PRJ-17: labels by priority, and their ordinals."""
    t = table(spark, d, "core_corpus_tracked")
    label = F.when(T.truth(F.col("in_t4_expert_signal")), "T4").when(F.col("core_selection_tier") == "T1", F.when(F.col("all_channels").contains("seed_reference"), "T1-ref").otherwise("T1")).otherwise(F.coalesce("core_selection_tier", F.lit("other")))
    rank = F.create_map(*[F.lit(x) for kv in {"T4": 4, "T1": 3, "T1-ref": 3, "T2": 2}.items() for x in kv])
    return t.select("row_id", label.alias("label"), F.coalesce(rank[label], F.lit(1)).alias("ordinal"))


def prj_11_export(spark, d):
    """PRJ-11, PRJ-12, SNK-07: typed export columns from dirty text."""
    s = table(spark, d, "core_seeds")
    return s.select("corpus_id", T.safe_int(F.col("publication_year"), None).alias("year"), T.safe_int(F.col("pmid"), 0).alias("pmid"), T.truth(F.col("recency_flag")).alias("flag"), F.coalesce(present(F.col("geo_scope")), F.lit("")).alias("geo"))


def prj_13_fallback(spark, d):
    """PRJ-13, PRJ-14: the first usable of several columns."""
    s = table(spark, d, "scored_papers")
    usable = lambda c: F.when(~F.lower(F.trim(c)).isin("", "nan", "none", "unmapped"), F.col(c))
    url = F.when(T.normalize_doi(F.col("doi")) != "", F.concat(F.lit("https://doi.example/"), T.normalize_doi(F.col("doi")))).otherwise(F.coalesce(present(F.col("openalex_id")), F.get(T.split_list(F.col("all_openalex_ids")), F.lit(0)), F.lit("")))
    return s.select("record_id", F.coalesce(usable("anchor_category"), usable("evidence_type"), F.lit("unknown")).alias("category"), url.alias("url"))


def prj_15_citation(spark, d):
    """PRJ-15, STR-26: plain and BibTeX citations."""
    s = table(spark, d, "core_seeds")
    year = F.coalesce(present(F.col("publication_year")), F.lit("n.d."))
    return s.select("corpus_id", F.concat(F.col("authors"), F.lit(" ("), year, F.lit("). "), F.col("title"), F.lit(". "), F.col("journal"), F.lit(".")).alias("plain"), F.concat(F.lit("@article{"), T.slug(F.col("corpus_id")), F.lit(", title = {"), T.bibtex_escape(F.col("title")), F.lit("}}")).alias("bibtex"))


def prj_18_pivot(spark, d):
    """PRJ-18: levels to columns, with a fallback."""
    o = table(spark, d, "orders").groupBy("o_custkey").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.max("o_totalprice"))
    return o.select("o_custkey", "F", F.coalesce("O", "F").alias("O"), F.coalesce("P", "O", "F").alias("P"))


def flt_03_missing(spark, d):
    """FLT-03, FLT-17, FLT-18: missing text in every spelling."""
    p = table(spark, d, "candidate_papers")
    return p.select("_ord", is_missing(F.col("abstract")).alias("no_abstract"), (is_missing(F.col("doi")) & is_missing(F.col("openalex_id"))).alias("no_link"))


def flt_05_thresholds(spark, d):
    """FLT-05: rows over several thresholds, one of them a group's own quantile."""
    s = table(spark, d, "scored_papers").select("record_id", "anchor_category", "cross_seed_score", "pagerank")
    q = quantiles(s, ["anchor_category"], "pagerank", [0.7], ["q"])
    return s.join(q, s.anchor_category.eqNullSafe(q.anchor_category)).where((F.col("cross_seed_score") >= 2) & (F.col("pagerank") > F.col("q"))).select("record_id")


def flt_11_percentile_filter(spark, d):
    """FLT-11: rows in the upper part of a rank, with other minima."""
    from plumbline.operators.windows import percentile_ranks

    s = percentile_ranks(table(spark, d, "scored_papers").select("record_id", "pagerank", "cross_seed_score", "abstract"), "pagerank", "pct")
    return s.where((F.col("pct") >= 0.8) & (F.col("cross_seed_score") >= 1) & ~is_missing(F.col("abstract"))).select("record_id")


def flt_16_years(spark, d):
    """FLT-16, MTH-07: plausible years."""
    y = F.col("publication_year")
    return table(spark, d, "candidate_papers").select("_ord", F.when(y.between(1600, 2100), y).alias("year"), F.coalesce((y > 1970) & (y < 2030), F.lit(False)).alias("recent"))


def flt_10_fallback(spark, d):
    """FLT-10: a filter whose result is replaced by the whole pool if it is empty; one such, and one that isn't."""
    s = table(spark, d, "supplier").select("s_suppkey", "s_acctbal")

    def or_all(least: float, label: str):
        picked = s.where(F.col("s_acctbal") > least)
        n = picked.agg(F.count(F.lit(1)).alias("n"))
        return picked.unionByName(s.crossJoin(F.broadcast(n)).where("n = 0").select("s_suppkey", "s_acctbal")).withColumn("kind", F.lit(label))

    return or_all(1e9, "none").unionByName(or_all(5000, "some"))


def str_01_titles(spark, d):
    """STR-01."""
    return table(spark, d, "candidate_papers").select("_ord", T.normalize_title(F.col("title")).alias("norm"))


def str_03_dois(spark, d):
    """STR-03."""
    return table(spark, d, "candidate_papers").select("_ord", T.normalize_doi(F.col("doi")).alias("norm"))


def str_05_hits(spark, d):
    """STR-05: terms contained in a text, and a score from wanted and unwanted ones."""
    t = table(spark, d, "documents")
    good, bad = T.term_hits(F.col("text"), ("lesion", "relapse", "fatigue", "imaging")), T.term_hits(F.col("text"), ("mice", "waiting list"))
    return t.select("doc_id", good.alias("wanted"), bad.alias("unwanted"), F.greatest(F.lit(0), good - 2 * bad).alias("score"))


CATEGORIES = {"imaging": ("imaging", "tomography", "lesion"), "genetics": ("variant", "carriage", "expression"), "care": ("rehab", "clinic", "physio")}


def str_07_category(spark, d):
    """STR-07: the category with most hits, the first of equals."""
    return table(spark, d, "documents").select("doc_id", T.first_most_hits(F.col("text"), CATEGORIES, "unmapped").alias("category"))


def str_10_codes(spark, d):
    """STR-10, STR-11."""
    return table(spark, d, "core_seeds").select("corpus_id", T.topic_code(F.col("primary_topic")).alias("code"), T.topic_code(F.col("selection_source")).alias("other"))


def str_12_tokens(spark, d):
    """STR-12."""
    return table(spark, d, "eval_items").select("item_id", F.array_join(T.tokenize(F.col("item_text"), ("the", "and", "with")), " ").alias("tokens"))


def str_13_stems(spark, d):
    """STR-13."""
    return table(spark, d, "eval_items").select(F.explode(T.stemmed_tokens(F.col("item_text"), ("the", "of", "and"))).alias("stem")).groupBy("stem").agg(F.count(F.lit(1)).alias("n"))


def str_16_sentences(spark, d):
    """STR-16: sentences and their number."""
    s = T.sentences(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.size(s).alias("sentences"), F.coalesce(F.get(s, F.lit(0)), F.lit("")).alias("first"))


def str_17_html(spark, d):
    """STR-17."""
    return table(spark, d, "scored_papers").select("record_id", F.md5(T.strip_html(F.col("abstract"))).alias("plain_md5"))


def str_18_ratios(spark, d):
    """STR-18, STR-19, STR-20: similarities of titles fetched for the same work."""
    p = table(spark, d, "candidate_papers").where("openalex_id is not null and openalex_id <> ''").select("openalex_id", T.normalize_title(F.col("title")).alias("t"))
    pairs = p.groupBy("openalex_id").agg(F.min("t").alias("a"), F.max("t").alias("b")).where("a <> b")
    return pairs.select("openalex_id", F.round(T.token_sort_ratio(F.col("a"), F.col("b")), 6).alias("token_sort"), F.round(T.token_set_ratio(F.col("a"), F.col("b")), 6).alias("token_set"), F.round(T.sequence_ratio(F.col("a"), F.col("b")), 6).alias("sequence"))


def str_21_redact(spark, d):
    """STR-21, STR-22, STR-23: extraction and masking by patterns."""
    p = table(spark, d, "candidate_papers")
    url = F.concat(F.lit("https://api.example/w?token=abc&id="), F.coalesce("openalex_id", F.lit("")))
    return p.select("_ord", T.redact(url).alias("url"), F.element_at(F.split(F.coalesce("openalex_id", F.lit("")), "/"), -1).alias("short_id"), F.element_at(F.split(T.squeeze(F.coalesce("first_author", F.lit(""))), " "), -1).alias("last_word"), F.regexp_replace(F.coalesce("title", F.lit("")), r"(?i)^(effect|safety) of ", "").alias("bare_title"))


def str_27_duration(spark, d):
    """STR-27, MTH-03: durations and half-even rounding."""
    e = table(spark, d, "events")
    return e.select("event_id", T.duration(F.col("value") * 100).alias("took"), F.bround(F.col("event_id") / 2, 0).cast("bigint").alias("half_even"))


def mth_06_hashes(spark, d):
    """MTH-01, MTH-06, DED-05: hashes and logarithms."""
    p = table(spark, d, "part")
    return p.select("p_partkey", F.md5("p_name").alias("md5"), F.sha2("p_name", 256).alias("sha256"), F.round(F.log1p("p_retailprice"), 9).alias("log1p"), F.round(F.pow(F.lit(0.65), F.col("p_size") % 5), 9).alias("decay"))


def arr_01_inverted(spark, d):
    """ARR-01: text to an inverted index and back."""
    t = table(spark, d, "eval_items").select("item_id", F.filter(F.split(T.squeeze(F.col("item_text")), " "), lambda w: w != "").alias("w"))
    rows = t.select("item_id", F.posexplode("w").alias("p", "word")).groupBy("item_id", "word").agg(F.collect_list("p").alias("ps"))
    index = rows.groupBy("item_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "ps"))).alias("m"))
    return index.select("item_id", T.invert_index(F.col("m")).alias("text"))


def arr_03_json(spark, d):
    """ARR-03, ARR-05: JSON in text, tolerant."""
    e = table(spark, d, "events")
    wrapped = F.concat(F.lit("note: "), F.col("props"), F.lit(" end"))
    return e.select("event_id", F.get_json_object(T.json_object_in(wrapped), "$.k").cast("int").alias("k"), F.size(T.json_list(F.col("event_type"))).alias("n"))


def arr_07_argmax(spark, d):
    """ARR-07: the key of a map with the greatest value, the first of equals, and those near it."""
    li = table(spark, d, "lineitem").groupBy("l_partkey", "l_returnflag").agg(F.sum("l_quantity").alias("q"))
    m = li.groupBy("l_partkey").agg(F.array_sort(F.collect_list(F.struct((-F.col("q")).alias("neg"), F.col("l_returnflag").alias("flag")))).alias("m"))
    best = F.col("m")[0]
    near = F.filter(F.slice("m", 2, 10), lambda x: -x["neg"] >= 0.7 * -best["neg"])
    return m.select("l_partkey", best["flag"].alias("primary_flag"), F.array_join(F.transform(near, lambda x: x["flag"]), ",").alias("secondary"))


def arr_09_chunks(spark, d):
    """ARR-09, ARR-10: lists in chunks; allowed, distinct, limited."""
    s = table(spark, d, "supplier").withColumn("chunk", F.floor((F.col("s_suppkey") - 1) / 50))
    return s.groupBy("chunk").agg(F.array_join(F.transform(F.array_sort(F.collect_list("s_suppkey")), lambda x: x.cast("string")), "|").alias("ids"))


_M = "({0} IS NULL OR lower(trim({0}, chr(9)||chr(10)||chr(13)||' ')) IN ('', 'nan'))"
_TRUE = "coalesce(lower(trim({0})) IN ('1', 'true', 'yes', 'y', 't'), false)"
_DOI = r"regexp_replace(lower(regexp_extract(coalesce({0}, ''), '(10\.\d{{4,9}}/\S+)', 1)), '[\)\]\.,;:\"'']+$', '')"
_HITS = lambda terms: " + ".join(f"contains(lower(coalesce(text, '')), '{t}')::INT" for t in terms)
QUERIES = {k: v for k, v in list(globals().items()) if k[:4] in ("prj_", "flt_", "str_", "mth_", "arr_")}
ORACLE = {
    "str_16_sentences": r"WITH s AS (SELECT doc_id, list_filter(list_transform(string_split_regex(regexp_replace(coalesce(text, ''), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: trim(s, ' ')), lambda s: s <> '') AS l FROM documents) SELECT doc_id, len(l) AS sentences, coalesce(l[1], '') AS first FROM s",
    "prj_03_flags": "SELECT row_id, coalesce(list_contains(list_transform(string_split(all_channels, ';'), lambda x: trim(x)), 'seed_resolution'), false)::INT AS is_seed, coalesce(contains(all_channels, 'seed_'), false)::INT AS seed_like, coalesce(regexp_matches(all_channels, 'lexical|dataset'), false) AS found FROM core_corpus_tracked",
    "prj_04_weighted": "SELECT row_id, round(3 * {} + 2 * {} + 1.5 * ln(1 + {}) + 0.5 * {}, 6) AS score FROM core_corpus_tracked".format(*(f"coalesce(CASE WHEN isnan({c}::DOUBLE) THEN 0 ELSE {c} END, 0)" for c in ("score_total", "paper_importance_score", "citations_per_year_raw", "evidence_strength"))),
    "prj_07_rate": "SELECT _ord, greatest(1, 2026 - coalesce(publication_year, 2026) + 1) AS age, round(coalesce(cited_by_count, 0) / greatest(1, 2026 - coalesce(publication_year, 2026) + 1), 6) AS rate FROM candidate_papers",
    "prj_10_labels": f"WITH l AS (SELECT row_id, CASE WHEN {_TRUE.format('in_t4_expert_signal')} THEN 'T4' WHEN core_selection_tier = 'T1' THEN CASE WHEN contains(all_channels, 'seed_reference') THEN 'T1-ref' ELSE 'T1' END ELSE coalesce(core_selection_tier, 'other') END AS label FROM core_corpus_tracked) SELECT row_id, label, CASE label WHEN 'T4' THEN 4 WHEN 'T1' THEN 3 WHEN 'T1-ref' THEN 3 WHEN 'T2' THEN 2 ELSE 1 END AS ordinal FROM l",
    "prj_11_export": f"SELECT corpus_id, trunc(try_cast(publication_year AS DOUBLE))::BIGINT AS year, coalesce(trunc(try_cast(pmid AS DOUBLE))::BIGINT, 0) AS pmid, {_TRUE.format('recency_flag')} AS flag, CASE WHEN {_M.format('geo_scope')} THEN '' ELSE geo_scope END AS geo FROM core_seeds",
    "prj_13_fallback": f"SELECT record_id, coalesce(CASE WHEN lower(trim(anchor_category)) NOT IN ('', 'nan', 'none', 'unmapped') THEN anchor_category END, CASE WHEN lower(trim(evidence_type)) NOT IN ('', 'nan', 'none', 'unmapped') THEN evidence_type END, 'unknown') AS category, CASE WHEN {_DOI.format('doi')} <> '' THEN 'https://doi.example/' || {_DOI.format('doi')} ELSE coalesce(CASE WHEN NOT {_M.format('openalex_id')} THEN openalex_id END, list_filter(list_transform(string_split(all_openalex_ids, ';'), lambda x: trim(x)), lambda x: lower(trim(x, chr(9)||chr(10)||chr(13)||' ')) NOT IN ('', 'nan'))[1], '') END AS url FROM scored_papers",
    "prj_15_citation": f"SELECT corpus_id, authors || ' (' || CASE WHEN {_M.format('publication_year')} THEN 'n.d.' ELSE publication_year END || '). ' || title || '. ' || journal || '.' AS plain, '@article{{' || regexp_replace(lower(corpus_id), '[^a-z0-9]+', '-', 'g') || ', title = {{' || regexp_replace(title, '([{{}}&%$#_])', '\\\\\\1', 'g') || '}}}}' AS bibtex FROM core_seeds",
    "prj_18_pivot": "WITH x AS (SELECT o_custkey, max(o_totalprice) FILTER (o_orderstatus = 'F') AS F, max(o_totalprice) FILTER (o_orderstatus = 'O') AS O, max(o_totalprice) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1) SELECT o_custkey, F, coalesce(O, F) AS O, coalesce(P, O, F) AS P FROM x",
    "flt_03_missing": f"SELECT _ord, {_M.format('abstract')} AS no_abstract, {_M.format('doi')} AND {_M.format('openalex_id')} AS no_link FROM candidate_papers",
    "flt_05_thresholds": "SELECT record_id FROM scored_papers s JOIN (SELECT anchor_category, quantile_cont(pagerank, 0.7) AS q FROM scored_papers GROUP BY 1) g ON s.anchor_category IS NOT DISTINCT FROM g.anchor_category WHERE cross_seed_score >= 2 AND pagerank > q",
    "flt_11_percentile_filter": f"WITH r AS (SELECT *, (rank() OVER (ORDER BY pagerank NULLS LAST) + (count(pagerank) OVER (PARTITION BY pagerank) - 1) / 2.0) / count(pagerank) OVER () AS pct FROM scored_papers) SELECT record_id FROM r WHERE pagerank IS NOT NULL AND pct >= 0.8 AND cross_seed_score >= 1 AND NOT {_M.format('abstract')}",
    "flt_16_years": "SELECT _ord, CASE WHEN publication_year BETWEEN 1600 AND 2100 THEN publication_year END AS year, coalesce(publication_year > 1970 AND publication_year < 2030, false) AS recent FROM candidate_papers",
    "flt_10_fallback": "SELECT s_suppkey, s_acctbal, 'none' AS kind FROM supplier WHERE s_acctbal > 1e9 OR NOT EXISTS (SELECT 1 FROM supplier WHERE s_acctbal > 1e9) UNION ALL SELECT s_suppkey, s_acctbal, 'some' FROM supplier WHERE s_acctbal > 5000 OR NOT EXISTS (SELECT 1 FROM supplier WHERE s_acctbal > 5000)",
    "str_01_titles": rf"SELECT _ord, CASE WHEN {_M.format('title')} THEN '' ELSE trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(strip_accents(title), '[^\x00-\x7F]', '', 'g')), '\(.*?preprint.*?\)', ' ', 'g'), '\b(erratum|correction|supplementary|preprint|biorxiv|arxiv|extended version)\b', ' ', 'g'), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')) END AS norm FROM candidate_papers",
    "str_03_dois": f"SELECT _ord, {_DOI.format('doi')} AS norm FROM candidate_papers",
    "str_05_hits": f"WITH h AS (SELECT doc_id, {_HITS(('lesion', 'relapse', 'fatigue', 'imaging'))} AS wanted, {_HITS(('mice', 'waiting list'))} AS unwanted FROM documents) SELECT doc_id, wanted, unwanted, greatest(0, wanted - 2 * unwanted) AS score FROM h",
    "str_10_codes": "WITH c AS (SELECT corpus_id, x, which FROM (SELECT corpus_id, primary_topic AS x, 'code' AS which FROM core_seeds UNION ALL SELECT corpus_id, selection_source, 'other' FROM core_seeds)), e AS (SELECT corpus_id, which, nullif(regexp_extract(upper(x), '(TOPIC-\\d+)', 1), '') AS f, regexp_extract(x, '(?i)\\bT(\\d{1,2})([A-Za-z]?)\\b', 1) AS n, lower(regexp_extract(x, '(?i)\\bT(\\d{1,2})([A-Za-z]?)\\b', 2)) AS l FROM c), r AS (SELECT corpus_id, which, CASE WHEN f IS NOT NULL THEN f WHEN n <> '' AND l = '' THEN 'TOPIC-' || lpad(n, 2, '0') WHEN n <> '' THEN 'T' || n || l END AS v FROM e) SELECT corpus_id, max(v) FILTER (which = 'code') AS code, max(v) FILTER (which = 'other') AS other FROM r GROUP BY corpus_id",
    "str_12_tokens": r"SELECT item_id, array_to_string(list_filter(regexp_extract_all(lower(item_text), '([a-z0-9][a-z0-9\-]+)', 1), lambda t: length(t) >= 3 AND t NOT IN ('the', 'and', 'with')), ' ') AS tokens FROM eval_items",
    "str_13_stems": r"WITH t AS (SELECT unnest(string_split(trim(regexp_replace(regexp_replace(lower(item_text), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')), ' ')) AS t FROM eval_items), s AS (SELECT CASE WHEN length(t) > 6 AND t LIKE '%ation' THEN left(t, -5) WHEN length(t) > 5 AND t LIKE '%ing' THEN left(t, -3) WHEN length(t) > 4 AND t LIKE '%ed' THEN left(t, -2) WHEN length(t) > 4 AND t LIKE '%ly' THEN left(t, -2) WHEN length(t) > 5 AND t LIKE '%ment' THEN left(t, -4) WHEN length(t) > 4 AND t LIKE '%ies' THEN left(t, -3) || 'y' WHEN length(t) > 4 AND t LIKE '%s' THEN left(t, -1) ELSE t END AS stem FROM t WHERE length(t) > 1 AND t NOT IN ('the', 'of', 'and')) SELECT stem, count(*) AS n FROM s WHERE length(stem) > 1 AND stem NOT IN ('the', 'of', 'and') GROUP BY stem",
    "str_17_html": r"WITH x AS (SELECT record_id, regexp_replace(regexp_replace(regexp_replace(coalesce(abstract, ''), '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g') AS s FROM scored_papers) SELECT record_id, md5(trim(regexp_replace(replace(replace(replace(replace(replace(replace(s, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g'))) AS plain_md5 FROM x",
    "str_21_redact": r"SELECT _ord, 'https://api.example/w?token=***&id=' || coalesce(openalex_id, '') AS url, string_split(coalesce(openalex_id, ''), '/')[-1] AS short_id, string_split(trim(regexp_replace(coalesce(first_author, ''), '\s+', ' ', 'g')), ' ')[-1] AS last_word, regexp_replace(coalesce(title, ''), '(?i)^(effect|safety) of ', '') AS bare_title FROM candidate_papers",
    "str_27_duration": "WITH s AS (SELECT event_id, CAST(round(value * 100) AS BIGINT) AS s FROM events) SELECT event_id, (s // 3600) || ':' || lpad((s // 60 % 60)::VARCHAR, 2, '0') || ':' || lpad((s % 60)::VARCHAR, 2, '0') AS took, round_even(event_id / 2, 0)::BIGINT AS half_even FROM s",
    "mth_06_hashes": "SELECT p_partkey, md5(p_name) AS md5, sha256(p_name) AS sha256, round(ln(1 + p_retailprice), 9) AS log1p, round(pow(0.65, p_size % 5), 9) AS decay FROM part",
    "arr_01_inverted": r"SELECT item_id, trim(regexp_replace(item_text, '\s+', ' ', 'g')) AS text FROM eval_items",
    "arr_03_json": "SELECT event_id, (props::JSON ->> '$.k')::INT AS k, CASE WHEN event_type IS NULL OR trim(event_type) = '' THEN 0 ELSE 1 END AS n FROM events",
    "arr_07_argmax": "WITH q AS (SELECT l_partkey, l_returnflag AS flag, sum(l_quantity) AS q FROM lineitem GROUP BY ALL), r AS (SELECT *, row_number() OVER w AS r, max(q) OVER (PARTITION BY l_partkey) AS best FROM q WINDOW w AS (PARTITION BY l_partkey ORDER BY q DESC, flag)) SELECT l_partkey, max(flag) FILTER (r = 1) AS primary_flag, coalesce(string_agg(flag, ',' ORDER BY r) FILTER (r > 1 AND q >= 0.7 * best), '') AS secondary FROM r GROUP BY l_partkey",
    "arr_09_chunks": "SELECT floor((s_suppkey - 1) / 50)::BIGINT AS chunk, string_agg(s_suppkey::VARCHAR, '|' ORDER BY s_suppkey) AS ids FROM supplier GROUP BY 1",
}
ORACLE["str_07_category"] = "WITH h AS (SELECT doc_id, " + ", ".join(f"{_HITS(v)} AS {k}" for k, v in CATEGORIES.items()) + " FROM documents) SELECT doc_id, CASE greatest(imaging, genetics, care) WHEN 0 THEN 'unmapped' WHEN imaging THEN 'imaging' WHEN genetics THEN 'genetics' ELSE 'care' END AS category FROM h"
