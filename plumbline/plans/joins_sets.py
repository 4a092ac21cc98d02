"""Sections 2.5 and 2.9: joins, set operations, distinct."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.functions.columns import present
from plumbline.functions.text import normalize_doi, normalize_title, split_list
from plumbline.operators.cascade import title_cascade
from plumbline.sources.tables import table


def _works(spark, d):
    return table(spark, d, "candidate_papers").select("_ord", "openalex_id", "doi", "title", "publication_year", "seed_doi", "seed_title", "cited_by_count", "abstract", "channel")


def jon_01_left(spark, d):
    """JON-01, JON-02: orders with their customers' facts, all orders kept."""
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    return o.join(c, o.o_custkey == c.c_custkey, "left").select("o_orderkey", "c_name", "c_mktsegment")


def jon_03_aggregates_back(spark, d):
    """JON-03: aggregates joined back, with a fallback name."""
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    n = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("spent"))
    return c.join(n, c.c_custkey == n.o_custkey, "left").select("c_custkey", F.coalesce("c_name", F.lit("?")).alias("name"), F.coalesce("orders", F.lit(0)).alias("orders"), F.coalesce("spent", F.lit(0.0)).alias("spent"))


def jon_04_default_label(spark, d):
    """JON-04, JON-19: labels of topics, UNMAPPED where there is none; topic_map is small and fixed."""
    code = F.upper(F.trim(F.split_part("primary_topic_code", F.lit("."), F.lit(1))))
    t = table(spark, d, "core_corpus_tracked").select("row_id", code.alias("topic_code"))
    return t.join(table(spark, d, "topic_map"), "topic_code", "left").select("row_id", F.coalesce("topic_label", F.lit("UNMAPPED")).alias("label"))


def jon_05_fresher_side(spark, d):
    """JON-05, JON-24: the right side's value unless it is blank."""
    s = table(spark, d, "scored_papers").select("record_id", "canonical_paper_id", "evidence_type")
    t = table(spark, d, "core_corpus_tracked").groupBy("canonical_paper_id").agg(F.max_by("tier", F.struct("scored_at", "row_id")).alias("tier"))
    return s.join(t, "canonical_paper_id", "left").select("record_id", F.coalesce(present(F.col("tier")), F.col("evidence_type")).alias("value"))


def jon_06_lookup(spark, d):
    """JON-06: lookup with a default; the engine broadcasts the small side when its size allows."""
    n, s = table(spark, d, "nation"), table(spark, d, "supplier")
    return s.join(n, s.s_nationkey == n.n_nationkey, "left").select("s_suppkey", F.coalesce("n_name", F.lit("?")).alias("nation"))


def jon_07_two_keys(spark, d):
    """JON-07: by DOI first, then by title, each attribute by itself."""
    seeds = table(spark, d, "core_seeds").select(normalize_doi(F.col("doi")).alias("k"), F.lower(F.trim("title")).alias("t"), "category", "doc_type")
    by_doi = seeds.where("k <> ''").groupBy("k").agg(F.min("category").alias("c1"), F.min("doc_type").alias("d1"))
    by_title = seeds.where("t <> ''").groupBy("t").agg(F.min("category").alias("c2"), F.min("doc_type").alias("d2"))
    p = _works(spark, d).select("_ord", normalize_doi(F.col("seed_doi")).alias("k"), F.lower(F.trim("title")).alias("t"))
    out = p.join(by_doi, "k", "left").join(by_title, "t", "left")
    return out.select("_ord", (F.col("c1").isNotNull() | F.col("c2").isNotNull()).alias("hit"), F.coalesce(F.nullif("c1", F.lit("")), "c2", F.lit("")).alias("category"), F.coalesce(F.nullif("d1", F.lit("")), "d2", F.lit("")).alias("doc_type"))


def jon_08_one_to_many(spark, d):
    """JON-08, JON-09: all works that share a seed's DOI."""
    seeds = table(spark, d, "core_seeds").select("corpus_id", normalize_doi(F.col("doi")).alias("k")).where("k <> ''")
    works = table(spark, d, "scored_papers").select("record_id", normalize_doi(F.col("doi")).alias("k"))
    cited = _works(spark, d).select("_ord", normalize_doi(F.col("seed_doi")).alias("k"))
    n = seeds.join(cited, "k").groupBy("corpus_id").agg(F.count(F.lit(1)).alias("citing"))
    return n.join(seeds.join(works, "k").groupBy("corpus_id").agg(F.count(F.lit(1)).alias("records")), "corpus_id", "left").select("corpus_id", "citing", F.coalesce("records", F.lit(0)).alias("records"))


def jon_11_semi(spark, d):
    """JON-10, JON-11, FLT-02: lines of urgent orders."""
    urgent = table(spark, d, "orders").where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, d, "lineitem").join(urgent, "l_orderkey", "left_semi").select("l_orderkey", "l_linenumber")


def jon_12_anti(spark, d):
    """JON-12, SET-05: customers without urgent orders that are finished."""
    c, o = table(spark, d, "customer"), table(spark, d, "orders").where("o_orderpriority = '1-URGENT' and o_orderstatus = 'F'")
    return c.join(o.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


def jon_13_rekey(spark, d):
    """JON-13: edges from external to canonical ids; both ends must resolve, self loops go."""
    ids = table(spark, d, "scored_papers").where("doi is not null").groupBy(normalize_doi(F.col("doi")).alias("k")).agg(F.min("canonical_paper_id").alias("id")).where("k <> ''")
    e = _works(spark, d).select(normalize_doi(F.col("doi")).alias("a"), normalize_doi(F.col("seed_doi")).alias("b")).where("a <> '' and b <> ''")
    src = e.join(ids.withColumnRenamed("k", "a").withColumnRenamed("id", "src"), "a")
    seeds = table(spark, d, "core_seeds").select(normalize_doi(F.col("doi")).alias("b"), F.col("corpus_id").alias("dst")).where("b <> ''")
    return src.join(seeds, "b").where("src <> dst").select("src", "dst").distinct()


def jon_14_exploded_references(spark, d):
    """JON-14, JON-25: ids in lists, exploded and joined to their owners."""
    s = table(spark, d, "scored_papers")
    short = lambda c: F.element_at(F.split(c, "/"), -1)
    listed = s.select("record_id", F.explode(split_list(F.col("all_openalex_ids"))).alias("x")).select("record_id", short(F.col("x")).alias("work"))
    owned = _works(spark, d).where("openalex_id is not null").select(short(F.col("openalex_id")).alias("work"), "_ord")
    return listed.where("lower(work) not in ('', 'nan')").join(owned, "work").select("record_id", "_ord").distinct()


def jon_18_cascade(spark, d):
    """JON-18: seeds among the works named by others: by DOI, else by title, else by the most similar title."""
    seeds = table(spark, d, "core_seeds")
    title = normalize_title(F.col("title"))
    some = F.when(F.col("population") == "Mixed", F.substring(title, F.lit(1), F.floor(F.length(title) * 0.85).cast("int"))).otherwise(title)
    wanted = seeds.select(F.col("corpus_id").alias("id"), F.when(F.col("recency_flag") == "anchor", normalize_doi(F.col("doi"))).otherwise("").alias("doi"), some.alias("title"), F.lit(None).cast("int").alias("year"))
    named = _works(spark, d).select("_ord", normalize_doi(F.col("seed_doi")).alias("doi"), normalize_title(F.col("seed_title")).alias("title")).where("title <> ''")
    works = named.groupBy("title").agg(F.min("_ord").alias("work"), F.max("doi").alias("doi")).withColumn("year", F.lit(None).cast("int"))
    return title_cascade(wanted, works)


def jon_20_pair_counts(spark, d):
    """JON-20, GRA-24: pairs of categories met across an edge."""
    li = table(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()
    p, s, n = table(spark, d, "part"), table(spark, d, "supplier"), table(spark, d, "nation")
    e = li.join(p, li.l_partkey == p.p_partkey).join(s, li.l_suppkey == s.s_suppkey).join(n, s.s_nationkey == n.n_nationkey)
    return e.groupBy("p_brand", "n_name").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")


def jon_22_refresh(spark, d):
    """JON-21, JON-22: a column replaced by that of another table where it is missing."""
    s = table(spark, d, "scored_papers").select("record_id", "canonical_paper_id", "abstract")
    other = s.where(present(F.col("abstract")).isNotNull()).groupBy("canonical_paper_id").agg(F.min_by("abstract", "record_id").alias("a"))
    return s.join(other, "canonical_paper_id", "left").select("record_id", F.md5(F.coalesce(present(F.col("abstract")), "a")).alias("abstract_md5"))


def jon_23_upsert(spark, d):
    """JON-23, DIS-13: keyed update: new values win, rows only on one side stay."""
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    b = table(spark, d, "supplier").select((F.col("s_suppkey") + 50).alias("k"), F.col("s_acctbal").alias("w"))
    return a.join(b, "k", "full").select("k", F.coalesce("w", "v").alias("value"))


def jon_26_overlap(spark, d):
    """JON-26: how many works each pair of seed and channel share."""
    p = _works(spark, d).where("seed_doi is not null and channel is not null and channel <> ''")
    return p.groupBy("seed_doi", "channel").agg(F.count_distinct("openalex_id").alias("works"))


def jon_27_padded_union(spark, d):
    """JON-27, SET-01: tables with different columns, one below the other."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), "c_mktsegment")
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return c.unionByName(s, allowMissingColumns=True)


def set_02_keep_first(spark, d):
    """SET-02: the first row of every key in ingest order."""
    return _works(spark, d).groupBy("openalex_id", "channel").agg(F.min("_ord").alias("first_ord"))


def set_03_distinct(spark, d):
    """SET-03."""
    return table(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()


def set_04_intersect(spark, d):
    """SET-04: parts both returned and kept."""
    li = table(spark, d, "lineitem")
    return li.where("l_returnflag = 'R'").select("l_partkey").intersect(li.where("l_returnflag = 'N'").select("l_partkey"))


def set_06_masks(spark, d):
    """SET-06, FLT-01, SEL-03: boolean algebra on masks."""
    t = table(spark, d, "core_corpus_tracked")
    one, two, three = (F.col("core_selection_tier") == x for x in ("T1", "T2", "T3"))
    keep = F.coalesce(one | (two & (F.col("evidence_strength") >= 3)) | (three & ~(F.col("n_independent_signals") < 2)), F.lit(False))
    return t.select("row_id", keep.alias("kept"))


def set_07_ordered_distinct(spark, d):
    """SET-07, SRC-22: distinct list values in their first order."""
    return table(spark, d, "core_corpus_tracked").select("row_id", F.array_join(F.array_distinct(split_list(F.col("all_channels"))), ";").alias("channels"))


def set_08_richest(spark, d):
    """SET-08: of records with the same title and year the richest, the first of equals."""
    p = table(spark, d, "candidate_papers")
    rich = sum((F.when(present(F.col(c)).isNotNull(), w).otherwise(0) for c, w in (("doi", 4), ("title", 2), ("first_author", 1))), F.when(F.col("publication_year").isNotNull(), 1).otherwise(0))
    k = p.select("_ord", F.lower(F.trim("title")).alias("t"), "publication_year", rich.alias("rich")).where("t is not null and t <> ''")
    return k.groupBy("t", "publication_year").agg(F.min_by("_ord", F.struct(-F.col("rich"), F.col("_ord"))).alias("best_ord")).select("best_ord")


_DOI = r"regexp_replace(lower(regexp_extract(coalesce({0}, ''), '(10\.\d{{4,9}}/\S+)', 1)), '[\)\]\.,;:\"'']+$', '')"
_NORM = r"CASE WHEN {0} IS NULL OR lower(trim({0}, chr(9)||chr(10)||chr(13)||' ')) IN ('', 'nan') THEN '' ELSE trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(strip_accents({0}), '[^\x00-\x7F]', '', 'g')), '\(.*?preprint.*?\)', ' ', 'g'), '\b(erratum|correction|supplementary|preprint|biorxiv|arxiv|extended version)\b', ' ', 'g'), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')) END"
_M = "({0} IS NULL OR lower(trim({0}, chr(9)||chr(10)||chr(13)||' ')) IN ('', 'nan'))"
QUERIES = {k: v for k, v in list(globals().items()) if k.startswith(("jon_", "set_"))}
ORACLE = {
    "jon_01_left": "SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
    "jon_03_aggregates_back": "SELECT c_custkey, coalesce(c_name, '?') AS name, count(o_orderkey) AS orders, coalesce(round(sum(o_totalprice), 2), 0.0) AS spent FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name",
    "jon_04_default_label": "SELECT row_id, coalesce(topic_label, 'UNMAPPED') AS label FROM core_corpus_tracked LEFT JOIN topic_map ON topic_code = upper(trim(split_part(primary_topic_code, '.', 1)))",
    "jon_05_fresher_side": f"SELECT record_id, CASE WHEN {_M.format('t.tier')} THEN evidence_type ELSE t.tier END AS value FROM scored_papers s LEFT JOIN (SELECT canonical_paper_id, tier FROM core_corpus_tracked WHERE tier IS NOT NULL QUALIFY row_number() OVER (PARTITION BY canonical_paper_id ORDER BY scored_at DESC, row_id DESC) = 1) t USING (canonical_paper_id)",
    "jon_06_lookup": "SELECT s_suppkey, coalesce(n_name, '?') AS nation FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey",
    "jon_07_two_keys": f"WITH s AS (SELECT {_DOI.format('doi')} AS k, lower(trim(title)) AS t, category, doc_type FROM core_seeds), a AS (SELECT k, min(category) AS c1, min(doc_type) AS d1 FROM s WHERE k <> '' GROUP BY k), b AS (SELECT t, min(category) AS c2, min(doc_type) AS d2 FROM s WHERE t <> '' GROUP BY t) SELECT _ord, c1 IS NOT NULL OR c2 IS NOT NULL AS hit, coalesce(nullif(c1, ''), c2, '') AS category, coalesce(nullif(d1, ''), d2, '') AS doc_type FROM candidate_papers LEFT JOIN a ON a.k = {_DOI.format('seed_doi')} LEFT JOIN b ON b.t = lower(trim(title))",
    "jon_08_one_to_many": f"WITH s AS (SELECT corpus_id, {_DOI.format('doi')} AS k FROM core_seeds), c AS (SELECT corpus_id, count(*) AS citing FROM s JOIN candidate_papers ON k = {_DOI.format('seed_doi')} WHERE k <> '' GROUP BY 1), r AS (SELECT corpus_id, count(*) AS records FROM s JOIN scored_papers p ON k = {_DOI.format('p.doi')} WHERE k <> '' GROUP BY 1) SELECT corpus_id, citing, coalesce(records, 0) AS records FROM c LEFT JOIN r USING (corpus_id)",
    "jon_11_semi": "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')",
    "jon_12_anti": "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')",
    "jon_13_rekey": f"WITH i AS (SELECT {_DOI.format('doi')} AS k, min(canonical_paper_id) AS id FROM scored_papers WHERE doi IS NOT NULL GROUP BY 1), s AS (SELECT {_DOI.format('doi')} AS b, corpus_id FROM core_seeds) SELECT DISTINCT id AS src, corpus_id AS dst FROM candidate_papers JOIN i ON k = {_DOI.format('doi')} JOIN s ON b = {_DOI.format('seed_doi')} WHERE k <> '' AND b <> '' AND id <> corpus_id",
    "jon_14_exploded_references": r"WITH l AS (SELECT record_id, string_split(trim(unnest(string_split(all_openalex_ids, ';'))), '/')[-1] AS work FROM scored_papers) SELECT DISTINCT record_id, _ord FROM l JOIN candidate_papers ON work = string_split(openalex_id, '/')[-1] WHERE lower(work) NOT IN ('', 'nan')",
    "jon_18_cascade": f"WITH n AS (SELECT {_NORM.format('seed_title')} AS title, min(_ord) AS work, max({_DOI.format('seed_doi')}) AS doi FROM candidate_papers GROUP BY 1), w AS (SELECT corpus_id AS id, CASE WHEN recency_flag = 'anchor' THEN {_DOI.format('doi')} ELSE '' END AS doi, {_NORM.format('title')} AS full_title, population = 'Mixed' AS part FROM core_seeds), o AS (SELECT id, 1 AS how, work FROM w JOIN n USING (doi) WHERE doi <> '' UNION ALL SELECT id, CASE WHEN coalesce(part, false) THEN 3 ELSE 2 END, work FROM w JOIN n ON full_title = title WHERE title <> '') SELECT id, how, work FROM o QUALIFY row_number() OVER (PARTITION BY id ORDER BY how, work) = 1",
    "jon_20_pair_counts": "SELECT p_brand, n_name, count(*) AS n FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL HAVING count(*) >= 2",
    "jon_22_refresh": f"SELECT record_id, md5(coalesce(CASE WHEN {_M.format('abstract')} THEN NULL ELSE abstract END, a)) AS abstract_md5 FROM scored_papers LEFT JOIN (SELECT canonical_paper_id, min_by(abstract, record_id) AS a FROM scored_papers WHERE NOT {_M.format('abstract')} GROUP BY 1) USING (canonical_paper_id)",
    "jon_23_upsert": "SELECT k, coalesce(w, v) AS value FROM (SELECT c_custkey AS k, c_acctbal AS v FROM customer) FULL JOIN (SELECT s_suppkey + 50 AS k, s_acctbal AS w FROM supplier) USING (k)",
    "jon_26_overlap": "SELECT seed_doi, channel, count(DISTINCT openalex_id) AS works FROM candidate_papers WHERE seed_doi IS NOT NULL AND channel <> '' GROUP BY ALL",
    "jon_27_padded_union": "SELECT c_custkey AS key, c_name AS name, c_mktsegment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier",
    "set_02_keep_first": "SELECT openalex_id, channel, min(_ord) AS first_ord FROM candidate_papers GROUP BY ALL",
    "set_03_distinct": "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem",
    "set_04_intersect": "SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'N'",
    "set_06_masks": "SELECT row_id, coalesce(core_selection_tier = 'T1' OR (core_selection_tier = 'T2' AND evidence_strength >= 3) OR (core_selection_tier = 'T3' AND NOT n_independent_signals < 2), false) AS kept FROM core_corpus_tracked",
    "set_07_ordered_distinct": "WITH x AS (SELECT row_id, unnest(string_split(all_channels, ';')) AS c, generate_subscripts(string_split(all_channels, ';'), 1) AS i FROM core_corpus_tracked), y AS (SELECT row_id, trim(c) AS c, min(i) AS i FROM x WHERE lower(trim(c)) NOT IN ('', 'nan') GROUP BY ALL) SELECT row_id, coalesce(string_agg(c, ';' ORDER BY i), '') AS channels FROM core_corpus_tracked LEFT JOIN y USING (row_id) GROUP BY row_id",
    "set_08_richest": f"SELECT _ord AS best_ord FROM candidate_papers WHERE trim(title, ' ') <> '' QUALIFY row_number() OVER (PARTITION BY lower(trim(title, ' ')), publication_year ORDER BY (CASE WHEN {_M.format('doi')} THEN 0 ELSE 4 END + CASE WHEN {_M.format('title')} THEN 0 ELSE 2 END + CASE WHEN {_M.format('first_author')} THEN 0 ELSE 1 END + CASE WHEN publication_year IS NULL THEN 0 ELSE 1 END) DESC, _ord) = 1",
}
