"""Sections 2.10 and 2.12: entity resolution, ranked retrieval, selection."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.functions import text as T
from plumbline.functions.columns import is_missing
from plumbline.operators import resolve as D
from plumbline.operators import retrieval as R
from plumbline.operators import selection as S
from plumbline.sources.tables import table


def _records(spark, d):
    p = table(spark, d, "candidate_papers")
    return p.select(F.col("_ord").alias("ord"), T.normalize_doi(F.col("doi")).alias("doi"), "title", F.col("publication_year").alias("year"), F.col("first_author").alias("author"), "openalex_id", "channel", "cited_by_count")


def ded_02_clusters(spark, d):
    """DED-01 to DED-03: pivot clusters of fetched works."""
    r = _records(spark, d)
    return D.resolve_records(r)


def ded_04_survivors(spark, d):
    """DED-04, DED-05: one row for each cluster, attributes merged over its versions."""
    r = _records(spark, d)
    c = D.resolve_records(r)
    rows = r.join(c, "ord")
    rep = F.min_by(F.struct("doi", "title", "year"), F.struct(-F.coalesce("cited_by_count", F.lit(0)), F.col("ord")))
    merged = rows.groupBy("pivot").agg(rep.alias("rep"), F.count(F.lit(1)).alias("versions"), F.sum(F.coalesce("cited_by_count", F.lit(0))).alias("cited"), F.array_join(F.array_sort(F.collect_set("channel")), ";").alias("channels"))
    return merged.select("pivot", D.canonical_id(F.col("rep.doi"), T.normalize_title(F.col("rep.title")), F.col("rep.year")).alias("canonical_id"), "versions", "cited", "channels")


def ded_06_authors(spark, d):
    """DED-06: authors by normalised name, the first spelling kept."""
    p = table(spark, d, "candidate_papers").where(~is_missing(F.col("first_author")))
    n = T.normalize_name(F.col("first_author"))
    return p.select(n.alias("norm"), "first_author", "_ord").where("norm <> ''").groupBy("norm").agg(F.min_by("first_author", "_ord").alias("display"))


def ir_01_postings(spark, d):
    """IR-01, AGG-27: postings of the evaluation items with their inverse document frequency."""
    items = table(spark, d, "eval_items")
    post = R.postings(items, "item_id", T.tokenize(F.col("item_text")))
    n = items.count()
    return post.join(R.idf(post, n), "token").select("token", "doc", "tf", F.round("idf", 6).alias("idf"))


def ir_02_tfidf(spark, d):
    """IR-02: the best documents for every topic label."""
    docs = table(spark, d, "documents").where("text is not null")
    queries = table(spark, d, "topic_map").select(F.col("topic_code").alias("query"), F.explode(T.tokenize(F.col("topic_label"))).alias("token")).groupBy("query", "token").agg(F.count(F.lit(1)).alias("qtf"))
    scores = R.tfidf_scores(R.postings(docs, "doc_id", T.tokenize(F.col("text"))), queries, docs.count()).withColumn("score", F.round("score", 6))
    with_group = scores.join(docs.select(F.col("doc_id").alias("doc"), F.coalesce("corpus_id", F.lit("")).alias("grp")), "doc")
    return R.diversified(with_group, "grp", [F.desc("score"), F.asc("doc")], 3, 20).select("query", "doc", "score", "rank_no")


def ir_04_bm25(spark, d):
    """IR-04, AGG-28: field-weighted BM25 over titles and abstracts."""
    p = table(spark, d, "candidate_papers").select("_ord", "title", "abstract")
    fields = p.select(F.col("_ord").alias("doc"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), T.stemmed_tokens(F.col(f)).alias("tokens")) for f in ("title", "abstract")])).alias("f")).select("doc", "f.field", "f.tokens")
    scores = R.bm25_scores(fields, ["fatigu", "lesion", "rehabilit", "fatigue"], {"title": 3.4, "abstract": 2.2})
    return scores.select("doc", F.round("score", 6).alias("score"))


def ir_05_search(spark, d):
    """IR-05, SRT-08: titles that contain a text."""
    p = table(spark, d, "candidate_papers")
    return R.substring_search(p, F.col("title"), "fatigue", [F.desc_nulls_last("cited_by_count"), F.asc("_ord")]).select("_ord", "title")


def ir_07_prototypes(spark, d):
    """IR-07, JON-16: the topic label nearest to every venue, by token sets. Both sides are lists of distinct names."""
    v = table(spark, d, "candidate_papers").where(~is_missing(F.col("venue"))).select(T.normalize_title(F.col("venue")).alias("venue")).where("venue <> ''").distinct()
    proto = table(spark, d, "topic_map").select("topic_code", T.normalize_title(F.col("topic_label")).alias("label"))
    words = lambda c: F.explode(F.array_distinct(F.split(c, " ")))
    pairs = v.select("venue", words(F.col("venue")).alias("w")).join(proto.select("topic_code", "label", words(F.col("label")).alias("w")), "w").where("length(w) > 3").select("venue", "topic_code", "label").distinct()
    best = pairs.withColumn("s", F.round(T.token_set_ratio(F.col("venue"), F.col("label")), 4)).groupBy("venue").agg(F.min(F.struct((-F.col("s")).alias("n"), "topic_code")).alias("b"))
    return best.select("venue", F.col("b.topic_code").alias("topic_code"), (-F.col("b.n")).alias("score"))


def ir_08_validation(spark, d):
    """IR-08: references to unknown keys and repeated keys, as a table of errors."""
    docs, seeds = table(spark, d, "documents"), table(spark, d, "core_seeds")
    unknown = docs.where("corpus_id is not null").join(seeds.select("corpus_id"), "corpus_id", "left_anti").select(F.col("corpus_id").alias("key"), F.lit("unknown").alias("error"))
    twice = docs.groupBy("text").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("key")).where("n > 1 and text is not null").select(F.col("key").cast("string"), F.lit("repeated").alias("error"))
    return unknown.unionByName(twice)


def sel_04_diverse_cap(spark, d):
    """SEL-04: at most 20 customers of each nation, filled from the segments least represented."""
    c = table(spark, d, "customer")
    return S.diverse_cap(c, "c_nationkey", "c_mktsegment", [F.desc("c_acctbal"), F.asc("c_custkey")], 20, 0.4).select("c_custkey", "c_nationkey")


def sel_06_share_cap(spark, d):
    """SEL-06: no segment above a fifth of what remains; the largest accounts are never dropped."""
    c = table(spark, d, "customer")
    return S.cap_shares(c, "c_mktsegment", F.col("c_acctbal") > 9000, [F.asc("c_acctbal"), F.desc("c_custkey")], 0.2).select("c_custkey", "c_mktsegment")


def sel_08_tiers(spark, d):
    """SEL-08: tiers in order, each with its own cap."""
    o = table(spark, d, "orders")
    big = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    tiers = [("open", F.col("o_orderstatus") == "O", big, 100), ("urgent", F.col("o_orderpriority") == "1-URGENT", big, 50), ("rest", F.lit(True), big, 25)]
    return S.tiered(o, "o_orderkey", tiers).select("o_orderkey", "tier")


def sel_11_cascade(spark, d):
    """SEL-11: the label from the first of several sources that has one."""
    t = table(spark, d, "core_corpus_tracked")
    own = F.when(~is_missing(F.col("primary_topic_code")), F.upper(F.trim("primary_topic_code")))
    listed = T.topic_code(F.col("topic_codes"))
    return t.select("row_id", F.coalesce(own, listed, F.lit("UNMAPPED")).alias("code"), F.when(own.isNotNull(), "own").when(listed.isNotNull(), "listed").otherwise("none").alias("method"))


def sel_17_next(spark, d):
    """SEL-17: of two kinds of neighbours the best five, each neighbour once."""
    from plumbline.plans.graphs import followers

    e = followers(spark, d)
    price = table(spark, d, "part").select(F.col("p_partkey").alias("other"), F.col("p_retailprice").alias("w"))
    both = e.select(F.col("src").alias("id"), F.col("dst").alias("other"), F.lit("next").alias("kind"), F.lit(0.7).alias("f")).unionByName(e.select(F.col("dst").alias("id"), F.col("src").alias("other"), F.lit("before").alias("kind"), F.lit(0.65).alias("f")))
    scored = both.join(price, "other").select("id", "other", "kind", F.round(F.col("f") * F.col("w"), 4).alias("score"))
    one = scored.groupBy("id", "other").agg(F.min(F.struct((-F.col("score")).alias("n"), "kind")).alias("b"))
    w = Window.partitionBy("id").orderBy("b.n", "other")
    return one.withColumn("rank_no", F.row_number().over(w)).where("rank_no <= 5").select("id", "other", F.col("b.kind").alias("kind"), "rank_no")


def dis_10_checks(spark, d):
    """DIS-10, GOV-03, GOV-04: several checks, the failed ones listed in order."""
    s = table(spark, d, "scored_papers")
    checks = [("abstract", is_missing(F.col("abstract"))), ("doi", is_missing(F.col("doi"))), ("year", F.col("publication_year").isNull()), ("count", F.coalesce(F.col("merged_cited_by_count") < 0, F.lit(True)))]
    failed = F.array_compact(F.array(*[F.when(bad, F.lit(n)) for n, bad in checks]))
    return s.select("record_id", F.when(F.size(failed) == 0, "none").otherwise(F.array_join(failed, "; ")).alias("reasons"))


def gov_01_report(spark, d):
    """GOV-02: a report by source with flags."""
    t = table(spark, d, "documents")
    g = t.groupBy(F.lower(F.trim("source")).alias("source")).agg(F.count(F.lit(1)).alias("documents"), F.count_if(is_missing(F.col("lang"))).alias("no_lang"), F.count_if(F.coalesce(F.col("n_chars") != F.length("text"), F.lit(True))).alias("wrong_size"), F.date_format(F.max("fetched_at"), "yyyy-MM-dd HH:mm:ss").alias("latest"))
    return g.select("*", F.array_join(F.array_compact(F.array(F.when(F.col("documents") < 20, F.lit("few")), F.when(F.col("no_lang") * 10 > F.col("documents"), F.lit("unlabelled")))), ",").alias("flags"))


def dis_09_cache(spark, d):
    """DIS-09, SRC-18: rows whose content hash is already known are reused."""
    t = table(spark, d, "documents").select("doc_id", F.sha1(F.coalesce("text", F.lit(""))).alias("h"))
    first = t.groupBy("h").agg(F.min("doc_id").alias("first_doc"))
    return t.join(first, "h").select("doc_id", (F.col("doc_id") != F.col("first_doc")).alias("reused"))


_M = "({0} IS NULL OR lower(trim({0}, chr(9)||chr(10)||chr(13)||' ')) IN ('', 'nan'))"
_TOK = r"list_filter(regexp_extract_all(lower({0}), '([a-z0-9][a-z0-9\-]+)', 1), lambda t: length(t) >= 3)"
_E = "e AS MATERIALIZED (SELECT DISTINCT a.l_partkey AS src, b.l_partkey AS dst FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1 WHERE a.l_partkey <> b.l_partkey)"
_STEM = "CASE WHEN length(t) > 6 AND t LIKE '%ation' THEN left(t, -5) WHEN length(t) > 5 AND t LIKE '%ing' THEN left(t, -3) WHEN length(t) > 4 AND t LIKE '%ed' THEN left(t, -2) WHEN length(t) > 4 AND t LIKE '%ly' THEN left(t, -2) WHEN length(t) > 5 AND t LIKE '%ment' THEN left(t, -4) WHEN length(t) > 4 AND t LIKE '%ies' THEN left(t, -3) || 'y' WHEN length(t) > 4 AND t LIKE '%s' THEN left(t, -1) ELSE t END"
QUERIES = {k: v for k, v in list(globals().items()) if k.split("_")[0] in ("ded", "ir", "sel", "dis", "gov") and k[-1] != "_"}
ORACLE = {
    "ded_06_authors": rf"WITH n AS (SELECT trim(regexp_replace(regexp_replace(lower(regexp_replace(strip_accents(first_author), '[^\x00-\x7F]', '', 'g')), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')) AS norm, first_author, _ord FROM candidate_papers WHERE NOT {_M.format('first_author')}) SELECT norm, min_by(first_author, _ord) AS display FROM n WHERE norm <> '' GROUP BY norm",
    "ir_01_postings": f"WITH t AS (SELECT item_id AS doc, unnest({_TOK.format('item_text')}) AS token FROM eval_items), p AS (SELECT token, doc, count(*) AS tf FROM t GROUP BY ALL) SELECT token, doc, tf, round(ln(((SELECT count(*) FROM eval_items) + 1.0) / (count(*) OVER (PARTITION BY token) + 1)) + 1, 6) AS idf FROM p",
    "ir_02_tfidf": f"WITH q AS (SELECT query, token, count(*) AS qtf FROM (SELECT topic_code AS query, unnest({_TOK.format('topic_label')}) AS token FROM topic_map) GROUP BY ALL), p AS (SELECT token, doc, count(*) AS tf FROM (SELECT doc_id AS doc, unnest({_TOK.format('text')}) AS token FROM documents WHERE text IS NOT NULL) WHERE token IN (SELECT token FROM q) GROUP BY ALL), i AS (SELECT token, ln(((SELECT count(*) FROM documents WHERE text IS NOT NULL) + 1.0) / (count(*) + 1)) + 1 AS idf FROM p GROUP BY token), s AS (SELECT query, doc, round(sum((1 + ln(qtf)) * idf * (1 + ln(tf))), 6) AS score FROM p JOIN i USING (token) JOIN q USING (token) GROUP BY ALL), g AS (SELECT s.*, coalesce(corpus_id, '') AS grp FROM s JOIN documents ON doc_id = doc), k AS (SELECT *, row_number() OVER (PARTITION BY query, grp ORDER BY score DESC, doc) AS k FROM g) SELECT query, doc, score, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc) AS rank_no FROM k WHERE k <= 3 OR grp = '' QUALIFY row_number() OVER (PARTITION BY query ORDER BY score DESC, doc) <= 20",
    "ir_04_bm25": rf"WITH f AS (SELECT _ord AS doc, 'title' AS field, title AS x FROM candidate_papers UNION ALL SELECT _ord, 'abstract', abstract FROM candidate_papers), t AS (SELECT doc, field, list_filter(list_transform(list_filter(string_split(trim(regexp_replace(regexp_replace(lower(coalesce(x, '')), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')), ' '), lambda t: length(t) > 1), lambda t: {_STEM}), lambda t: length(t) > 1) AS w FROM f), l AS (SELECT *, greatest(len(w), 1) AS n FROM t), m AS (SELECT field, avg(n) AS mean FROM l GROUP BY field), h AS (SELECT doc, field, n, token, count(*) AS tf FROM (SELECT doc, field, n, unnest(w) AS token FROM l) WHERE token IN ('fatigu', 'lesion', 'rehabilit', 'fatigue') GROUP BY ALL), d AS (SELECT token, count(DISTINCT doc) AS df FROM h GROUP BY token), i AS (SELECT token, ln(1 + ((SELECT count(DISTINCT doc) FROM l) - df + 0.5) / (df + 0.5)) AS idf FROM d) SELECT doc, round(sum(CASE field WHEN 'title' THEN 3.4 ELSE 2.2 END * idf * tf * 2.35 / (tf + 1.35 * (0.28 + 0.72 * n / mean))), 6) AS score FROM h JOIN i USING (token) JOIN m USING (field) GROUP BY doc",
    "ir_05_search": "SELECT _ord, title FROM candidate_papers WHERE contains(lower(title), 'fatigue') ORDER BY lower(title) = 'fatigue' DESC, starts_with(lower(title), 'fatigue') DESC, cited_by_count DESC NULLS LAST, _ord LIMIT 20",
    "ir_08_validation": "SELECT corpus_id AS key, 'unknown' AS error FROM documents WHERE corpus_id IS NOT NULL AND corpus_id NOT IN (SELECT corpus_id FROM core_seeds) UNION ALL SELECT min(doc_id)::VARCHAR, 'repeated' FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1",
    "sel_04_diverse_cap": "WITH r AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS r FROM customer), u AS (SELECT c_nationkey, c_mktsegment, count(*) AS used FROM r WHERE r <= 12 GROUP BY ALL), f AS (SELECT r.*, row_number() OVER (PARTITION BY r.c_nationkey ORDER BY coalesce(used, 0), r) AS s FROM r LEFT JOIN u USING (c_nationkey, c_mktsegment) WHERE r > 12) SELECT c_custkey, c_nationkey FROM r WHERE r <= 12 UNION ALL SELECT c_custkey, c_nationkey FROM f WHERE s <= 8",
    "sel_08_tiers": "WITH a AS (SELECT o_orderkey, 'open' AS tier FROM orders WHERE o_orderstatus = 'O' ORDER BY o_totalprice DESC, o_orderkey LIMIT 100), b AS (SELECT o_orderkey, 'urgent' AS tier FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey NOT IN (SELECT o_orderkey FROM a) ORDER BY o_totalprice DESC, o_orderkey LIMIT 50), c AS (SELECT o_orderkey, 'rest' AS tier FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a UNION ALL SELECT o_orderkey FROM b) ORDER BY o_totalprice DESC, o_orderkey LIMIT 25) SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c",
    "sel_11_cascade": f"WITH x AS (SELECT row_id, CASE WHEN NOT {_M.format('primary_topic_code')} THEN upper(trim(primary_topic_code, ' ')) END AS own, nullif(regexp_extract(upper(topic_codes), '(TOPIC-\\d+)', 1), '') AS listed FROM core_corpus_tracked) SELECT row_id, coalesce(own, listed, 'UNMAPPED') AS code, CASE WHEN own IS NOT NULL THEN 'own' WHEN listed IS NOT NULL THEN 'listed' ELSE 'none' END AS method FROM x",
    "sel_17_next": f"WITH {_E}, b AS (SELECT src AS id, dst AS other, 'next' AS kind, 0.7 AS f FROM e UNION ALL SELECT dst, src, 'before', 0.65 FROM e), s AS (SELECT id, other, kind, round(f::DOUBLE * p_retailprice, 4) AS score FROM b JOIN part ON p_partkey = other), o AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY id, other ORDER BY score DESC, kind) = 1) SELECT id, other, kind, row_number() OVER (PARTITION BY id ORDER BY score DESC, other) AS rank_no FROM o QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, other) <= 5",
    "dis_10_checks": f"SELECT record_id, coalesce(nullif(concat_ws('; ', CASE WHEN {_M.format('abstract')} THEN 'abstract' END, CASE WHEN {_M.format('doi')} THEN 'doi' END, CASE WHEN publication_year IS NULL THEN 'year' END, CASE WHEN coalesce(merged_cited_by_count < 0, true) THEN 'count' END), ''), 'none') AS reasons FROM scored_papers",
    "gov_01_report": f"WITH g AS (SELECT lower(trim(source)) AS source, count(*) AS documents, count(*) FILTER ({_M.format('lang')}) AS no_lang, count(*) FILTER (coalesce(n_chars <> length(text), true)) AS wrong_size, strftime(max(fetched_at), '%Y-%m-%d %H:%M:%S') AS latest FROM documents GROUP BY 1) SELECT *, concat_ws(',', CASE WHEN documents < 20 THEN 'few' END, CASE WHEN no_lang * 10 > documents THEN 'unlabelled' END) AS flags FROM g",
    "dis_09_cache": "SELECT doc_id, doc_id <> min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS reused FROM documents",
}
