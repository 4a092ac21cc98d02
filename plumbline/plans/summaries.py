"""Section 2.12, abstracts, summaries, governance: cascades of sources, short texts, reports and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import summary as S
from plumbline.functions import text as T
from plumbline.functions.columns import is_missing, present
from plumbline.operators import cascade as C
from plumbline.sources.tables import table

BOILERPLATE = ("All rights reserved.", "Sign in to continue reading.", "Related articles you may like.")


def abs_01_cascade(spark, d):
    """ABS-01: the abstract of every work: its own, that of another record of it, that of a fetched work, its title."""
    s = table(spark, d, "scored_papers").select("record_id", "canonical_paper_id", "abstract", "title", T.normalize_doi(F.col("doi")).alias("doi"))
    has = s.where(~is_missing(F.col("abstract")))
    own = has.select("record_id", F.col("abstract").alias("text"))
    best = has.groupBy("canonical_paper_id").agg(F.max_by("abstract", F.struct(F.length("abstract"), "abstract")).alias("text"))
    other = s.join(best, "canonical_paper_id").select("record_id", "text")
    fetched = table(spark, d, "candidate_papers").where(~is_missing(F.col("abstract"))).groupBy(T.normalize_doi(F.col("doi")).alias("doi")).agg(F.max_by("abstract", F.struct(F.length("abstract"), "abstract")).alias("text")).where("doi <> ''")
    work = s.join(fetched, "doi").select("record_id", "text")
    got = C.first_source(s, "record_id", [("own", own), ("other record", other), ("fetched", work), ("title", s.select("record_id", F.col("title").alias("text")))])
    return got.select("record_id", "source", F.length("text").alias("n"))


def abs_03_best_record(spark, d):
    """ABS-03, JON-17: of the records with the same DOI the one whose title is most like the wanted one."""
    seeds = table(spark, d, "candidate_papers").groupBy(T.normalize_doi(F.col("doi")).alias("doi")).agg(F.min_by("title", "_ord").alias("t"), F.min("_ord").alias("id")).where("doi <> ''")
    wanted = seeds.select("id", "doi", T.normalize_title(F.col("t")).alias("title"))
    records = table(spark, d, "scored_papers").select(F.col("record_id").alias("record"), T.normalize_doi(F.col("doi")).alias("doi"), T.normalize_title(F.col("title")).alias("title"))
    return C.best_record(wanted, records, "doi", 100.0).select("id", "record")


def jon_16_scored(spark, d):
    """JON-16: the best fetched work for every record, among works with the same DOI, by a score."""
    s, p = table(spark, d, "scored_papers"), table(spark, d, "candidate_papers")
    title, doi = T.normalize_title(F.col("title")), T.normalize_doi(F.col("doi"))
    wanted = s.select(F.col("record_id").alias("id"), doi.alias("doi"), title.alias("title"), F.col("publication_year").alias("year"), F.lit(None).cast("string").alias("author")).where("doi <> ''")
    works = p.select(F.col("_ord").alias("work"), doi.alias("doi"), title.alias("title"), F.col("publication_year").alias("year"), F.col("first_author").alias("author"))
    return C.scored_matches(wanted, works, "doi", 100.0).select("id", "work")


def sel_01_rebalance(spark, d):
    """SEL-01: customers with good balances, segments kept within shares."""
    c = table(spark, d, "customer")
    bounds = {"BUILDING": (0.0, 0.18), "MACHINERY": (0.25, 0.4), "FURNITURE": (0.1, 0.3)}
    kept = C.rebalanced(c, "c_mktsegment", "c_custkey", "c_acctbal", F.col("c_acctbal") > 5000, F.col("c_acctbal") > 0, bounds)
    return kept.select("c_custkey", "c_mktsegment")


def dis_01_source(spark, d):
    """DIS-01: what a summary of a seed is made from: the longest document, else the rationale, else nothing."""
    s = table(spark, d, "core_seeds")
    docs = table(spark, d, "documents").where("corpus_id is not null and source = 'fulltext_oa'").select("corpus_id", "text")
    got = C.first_source(s, "corpus_id", [("full text", docs), ("rationale", s.select("corpus_id", F.col("rationale").alias("text")))])
    return got.select("corpus_id", "source", F.length("text").alias("n"))


def dis_02_key_sentence(spark, d):
    """DIS-02: the sentence that tells the result."""
    return table(spark, d, "documents").select("doc_id", F.md5(F.coalesce(S.key_sentence(F.col("text")), F.lit(""))).alias("sentence_md5"))


def dis_03_takeaways(spark, d):
    """DIS-03: four takeaways from a title, a summary and an abstract."""
    s = table(spark, d, "scored_papers")
    four = S.takeaways(F.array(F.col("title"), F.upper("title")), F.col("title"), F.col("abstract"))
    return s.select("record_id", F.size(four).alias("n"), F.md5(F.array_join(four, "|")).alias("digest"))


def dis_04_difficulty(spark, d):
    """DIS-04: how hard a text is to read."""
    return table(spark, d, "documents").select("doc_id", S.difficulty(F.col("text")).alias("difficulty"))


def dis_05_overlap(spark, d):
    """DIS-05, DIS-06: the share of an evaluation item's words that its best document has, whole texts against whole
    texts, and how certain that makes it. Items are a small table by nature; documents are met by the words in common,
    counted in partial sums."""
    items = table(spark, d, "eval_items").select("item_id", T.overlap_tokens(F.col("item_text")).alias("s"))
    docs = table(spark, d, "documents").where("text is not null").select("doc_id", T.overlap_tokens(F.col("text")).alias("t"))
    words = items.select("item_id", F.size("s").alias("size"), F.explode("s").alias("w"))
    met = docs.select("doc_id", F.explode("t").alias("w")).join(words.select("w").distinct(), "w", "left_semi")
    shared = words.join(met, "w").groupBy("item_id", "size", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    best = shared.groupBy("item_id").agg(F.max(F.col("n") / F.col("size")).alias("share"))
    share = F.coalesce("share", F.lit(0.0))
    sure = S.certainty(0.3, [(share >= 0.5, 0.3), (share >= 0.9, 0.25), (F.size("s") < 20, -0.2)])
    return items.join(best, "item_id", "left").select("item_id", F.round(share, 6).alias("overlap"), F.round(sure, 2).alias("certainty"), S.certainty_label(F.round(sure, 2)).alias("label"))


def dis_07_disclaimer(spark, d):
    """DIS-07: the line that tells what a summary was made from."""
    s = table(spark, d, "scored_papers")
    said = F.when(is_missing(F.col("abstract")), "Only the title was available.").otherwise(F.concat(F.lit("Made from the abstract ("), F.length("abstract").cast("string"), F.lit(" characters), not from the full text.")))
    return s.select("record_id", said.alias("disclaimer"))


def dis_08_clean(spark, d):
    """DIS-08: summaries without boilerplate, cut at a word, with a default."""
    s = table(spark, d, "scored_papers")
    return s.select("record_id", S.without_boilerplate(present(F.col("abstract")), BOILERPLATE, 300, "No summary yet.").alias("summary"))


def dis_11_overview(spark, d):
    """DIS-11: a line about every topic from its five best papers."""
    from plumbline.operators.learning import head_per_group

    t = table(spark, d, "core_corpus_tracked").where("paper_importance_score is not null and not isnan(paper_importance_score)").select(F.upper(F.trim("primary_topic_code")).alias("topic"), "row_id", "paper_importance_score").where("topic is not null and topic not in ('', 'NAN')")
    n = t.groupBy("topic").agg(F.count(F.lit(1)).alias("papers"))
    top = head_per_group(t, ["topic"], [F.desc("paper_importance_score"), F.asc("row_id")], 5).groupBy("topic").agg(F.array_sort(F.collect_list(F.struct("rank_no", "row_id"))).alias("l"))
    ids = F.array_join(F.transform("l", lambda x: x["row_id"].cast("string")), ", ")
    return n.join(top, "topic").select("topic", F.concat(F.col("topic"), F.lit(": "), F.col("papers").cast("string"), F.lit(" papers, first "), ids).alias("overview"))


def gov_01_metadata(spark, d):
    """GOV-01: seeds resolved against the works named by others, or not, with a hint."""
    s = table(spark, d, "core_seeds").select("corpus_id", "title", T.normalize_doi(F.col("doi")).alias("k"))
    named = table(spark, d, "candidate_papers").groupBy(T.normalize_doi(F.col("seed_doi")).alias("k")).agg(F.count(F.lit(1)).alias("uses"), F.min("seed_title").alias("seen")).where("k <> ''")
    j = s.join(named, "k", "left")
    state = F.when(F.col("uses").isNull(), "unresolved").when(F.lower("seen") == F.lower("title"), "resolved").otherwise("differs")
    hint = F.when(F.col("k") == "", "no doi").when(F.coalesce("uses", F.lit(0)) >= 20, "bridge").otherwise("")
    return j.select("corpus_id", state.alias("state"), F.coalesce("uses", F.lit(0)).alias("uses"), hint.alias("hint"))


def gov_05_briefs(spark, d):
    """GOV-05: numbers and flags of every topic."""
    t = table(spark, d, "core_corpus_tracked").select("canonical_paper_id", F.upper(F.trim("primary_topic_code")).alias("topic"), "evidence_strength").where("topic is not null and topic not in ('', 'NAN', 'UNMAPPED')")
    years = table(spark, d, "scored_papers").groupBy("canonical_paper_id").agg(F.max("publication_year").alias("y"))
    g = t.join(years, "canonical_paper_id", "left").groupBy("topic").agg(F.count_distinct("canonical_paper_id").alias("papers"), F.count_if(F.col("y") >= 2018).alias("recent"), F.count_if(F.col("evidence_strength") <= 1).alias("weak"))
    flags = F.array_join(F.array_compact(F.array(F.when(F.col("recent") < 3, "few recent"), F.when(F.col("weak") > 0, "weak evidence"))), "; ")
    return g.select("topic", "papers", "recent", "weak", flags.alias("flags"))


def gov_06_fallback(spark, d):
    """GOV-06: the first of several tables that is there."""
    from plumbline.sources.tables import first_existing

    return first_existing(spark, d, ["selected_papers", "core_corpus_tracked", "scored_papers"]).groupBy("tier").agg(F.count(F.lit(1)).alias("n"))


def gov_07_console(spark, d):
    """GOV-07: the lines of a quality report."""
    s = table(spark, d, "scored_papers")
    one = s.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_missing(F.col("abstract"))).alias("no_abstract"), F.count_if(F.col("is_core_seed")).alias("seeds"))
    lines = [("records", F.col("n")), ("without abstract", F.col("no_abstract")), ("seeds", F.col("seeds"))]
    return one.select(F.explode(F.array(*[F.struct(F.lit(i).alias("line_no"), F.concat(F.lit(f"{name}: "), v.cast("string")).alias("line")) for i, (name, v) in enumerate(lines, 1)])).alias("x")).select("x.*")


_M = "({0} IS NULL OR lower(trim({0}, chr(9)||chr(10)||chr(13)||' ')) IN ('', 'nan'))"
_DOI = r"regexp_replace(lower(regexp_extract(coalesce({0}, ''), '(10\.\d{{4,9}}/\S+)', 1)), '[\)\]\.,;:\"'']+$', '')"
_NORM = r"CASE WHEN {0} IS NULL OR lower(trim({0}, chr(9)||chr(10)||chr(13)||' ')) IN ('', 'nan') THEN '' ELSE trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(strip_accents({0}), '[^\x00-\x7F]', '', 'g')), '\(.*?preprint.*?\)', ' ', 'g'), '\b(erratum|correction|supplementary|preprint|biorxiv|arxiv|extended version)\b', ' ', 'g'), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')) END"
_SORTED = "array_to_string(list_sort(string_split({0}, ' ')), ' ')"
_SENT = r"list_filter(list_transform(string_split_regex(regexp_replace(coalesce({0}, ''), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: trim(s, ' ')), lambda s: s <> '')"
_CERT = "0.3 + CASE WHEN share >= 0.5 THEN 0.3 ELSE 0 END + CASE WHEN share >= 0.9 THEN 0.25 ELSE 0 END - CASE WHEN size < 20 THEN 0.2 ELSE 0 END"
_CLEAN = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(CASE WHEN NOT {m} THEN abstract END, ''), '(?i)All rights reserved\.', ' ', 'g'), '(?i)Sign in to continue reading\.', ' ', 'g'), '(?i)Related articles you may like\.', ' ', 'g'), '\s+', ' ', 'g'))".replace("{m}", _M.format("abstract"))


def _hard(c: str) -> str:
    return " + ".join(f"contains(lower(coalesce({c}, '')), '{w}')::INT" for w in S.COMPLEX_WORDS)


QUERIES = {k: v for k, v in list(globals().items()) if k.split("_")[0] in ("abs", "dis", "gov", "sel", "jon")}
ORACLE = {
    "abs_01_cascade": f"WITH s AS (SELECT record_id, canonical_paper_id AS c, CASE WHEN NOT {_M.format('abstract')} THEN abstract END AS a, CASE WHEN NOT {_M.format('title')} THEN title END AS t, {_DOI.format('doi')} AS k FROM scored_papers), o AS (SELECT c, max(length(a)) AS n FROM s WHERE a IS NOT NULL GROUP BY c), f AS (SELECT {_DOI.format('doi')} AS k, max(length(abstract)) AS n FROM candidate_papers WHERE NOT {_M.format('abstract')} GROUP BY 1) SELECT record_id, CASE WHEN a IS NOT NULL THEN 'own' WHEN o.n IS NOT NULL THEN 'other record' WHEN f.n IS NOT NULL AND s.k <> '' THEN 'fetched' WHEN t IS NOT NULL THEN 'title' ELSE 'none' END AS source, coalesce(length(a), o.n, CASE WHEN s.k <> '' THEN f.n END, length(t)) AS n FROM s LEFT JOIN o USING (c) LEFT JOIN f USING (k)",
    "abs_03_best_record": f"WITH w AS (SELECT {_DOI.format('doi')} AS doi, min_by(title, _ord) AS t, min(_ord) AS id FROM candidate_papers GROUP BY 1), x AS (SELECT id, doi, {_NORM.format('t')} AS n FROM w WHERE doi <> ''), r AS (SELECT record_id, {_DOI.format('doi')} AS doi, {_NORM.format('title')} AS n FROM scored_papers) SELECT id, min(record_id) AS record FROM x JOIN r USING (doi) WHERE {_SORTED.format('x.n')} = {_SORTED.format('r.n')} GROUP BY id",
    "jon_16_scored": f"WITH s AS (SELECT record_id AS id, {_DOI.format('doi')} AS doi, {_NORM.format('title')} AS n, publication_year AS y FROM scored_papers), p AS (SELECT _ord AS work, {_DOI.format('doi')} AS doi, {_NORM.format('title')} AS n, publication_year AS y FROM candidate_papers), m AS (SELECT id, work, abs(s.y - p.y) AS a FROM s JOIN p USING (doi) WHERE doi <> '' AND {_SORTED.format('s.n')} = {_SORTED.format('p.n')}) SELECT id, work FROM m WHERE coalesce(a <= 3, true) QUALIFY row_number() OVER (PARTITION BY id ORDER BY CASE WHEN a = 0 THEN 4 WHEN a = 1 THEN 2 WHEN a IS NOT NULL THEN -least(24, 6 * a) ELSE 0 END DESC, work) = 1",
    "sel_01_rebalance": "WITH c AS (SELECT c_custkey, c_mktsegment AS g, c_acctbal AS b, c_acctbal > 5000 AS i, c_acctbal > 0 AS e FROM customer), n AS (SELECT count(*) AS total, count(*) FILTER (g = 'BUILDING') AS nb, count(*) FILTER (g = 'MACHINERY') AS nm, count(*) FILTER (g = 'FURNITURE') AS nf FROM c WHERE i), o AS (SELECT *, greatest(0, nb - floor(total * 0.18::DOUBLE)) AS ob, greatest(0, nm - floor(total * 0.4::DOUBLE)) AS om, greatest(0, nf - floor(total * 0.3::DOUBLE)) AS f FROM n), a AS (SELECT *, total - ob - om - f AS after FROM o), k AS (SELECT *, greatest(0, ceil(after * 0.25::DOUBLE) - (nm - om)) AS cm, greatest(0, ceil(after * 0.1::DOUBLE) - (nf - f)) AS cf FROM a), r AS (SELECT c.*, row_number() OVER (PARTITION BY g, i ORDER BY b, c_custkey DESC) AS low, row_number() OVER (PARTITION BY g, i, e ORDER BY b DESC, c_custkey) AS high FROM c) SELECT c_custkey, g AS c_mktsegment FROM r, k WHERE (i AND low > CASE g WHEN 'BUILDING' THEN ob WHEN 'MACHINERY' THEN om WHEN 'FURNITURE' THEN f ELSE 0 END) OR (NOT i AND e AND high <= CASE g WHEN 'MACHINERY' THEN cm WHEN 'FURNITURE' THEN cf ELSE 0 END)",
    "dis_01_source": f"WITH f AS (SELECT corpus_id, max(length(text)) AS n FROM documents WHERE source = 'fulltext_oa' AND NOT {_M.format('text')} GROUP BY 1) SELECT corpus_id, CASE WHEN f.n IS NOT NULL THEN 'full text' WHEN NOT {_M.format('rationale')} THEN 'rationale' ELSE 'none' END AS source, coalesce(f.n, CASE WHEN NOT {_M.format('rationale')} THEN length(rationale) END) AS n FROM core_seeds LEFT JOIN f USING (corpus_id)",
    "dis_02_key_sentence": f"WITH s AS (SELECT doc_id, {_SENT.format('text')} AS l FROM documents) SELECT doc_id, md5(coalesce(list_filter(l, lambda x: " + " OR ".join(f"contains(lower(x), '{w}')" for w in S.RESULT_WORDS) + ")[1], l[1], '')) AS sentence_md5 FROM s",
    "dis_03_takeaways": f"WITH s AS (SELECT record_id, list_filter(list_transform(list_concat([title, upper(title)], list_concat({_SENT.format('title')}, {_SENT.format('abstract')})), lambda x: trim(x, ' ')), lambda x: x <> '') AS l FROM scored_papers), f AS (SELECT record_id, list_filter(l, lambda x, i: list_position(list_transform(l, lambda y: lower(y)), lower(x)) = i)[1:4] AS four FROM s) SELECT record_id, len(four) AS n, md5(array_to_string(four, '|')) AS digest FROM f",
    "dis_04_difficulty": rf"WITH s AS (SELECT doc_id, text, len({_SENT.format('text')}) AS n, regexp_extract_all(lower(coalesce(text, '')), '(\p{{L}}+)', 1) AS w FROM documents), f AS (SELECT doc_id, len(w) / greatest(n, 1) AS m, len(list_filter(w, lambda x: length(x) >= 9)) / greatest(len(w), 1) AS l, {_hard('text')} AS h FROM s) SELECT doc_id, greatest(1, least(5, 1 + (m > 18)::INT + (m > 26)::INT + (l > 0.2)::INT + (l > 0.32)::INT + (h >= 2)::INT)) AS difficulty FROM f",
    "dis_05_overlap": f"WITH i AS (SELECT item_id, list_distinct(regexp_extract_all(lower(coalesce(item_text, '')), '([a-z]{{3,}})', 1)) AS s FROM eval_items), w AS (SELECT item_id, len(s) AS size, unnest(s) AS w FROM i), d AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '([a-z]{{3,}})', 1))) AS w FROM documents WHERE text IS NOT NULL), h AS (SELECT item_id, size, doc_id, count(*) AS n FROM w JOIN d USING (w) GROUP BY ALL), b AS (SELECT item_id, max(n / size) AS share FROM h GROUP BY 1), c AS (SELECT i.item_id, len(s) AS size, coalesce(share, 0) AS share FROM i LEFT JOIN b USING (item_id)) SELECT item_id, round(share, 6) AS overlap, round(greatest(0.05, least(0.98, {_CERT})), 2)::DOUBLE AS certainty, CASE WHEN round(greatest(0.05, least(0.98, {_CERT})), 2) >= 0.82 THEN 'high' WHEN round(greatest(0.05, least(0.98, {_CERT})), 2) >= 0.62 THEN 'medium' ELSE 'low' END AS label FROM c",
    "dis_07_disclaimer": f"SELECT record_id, CASE WHEN {_M.format('abstract')} THEN 'Only the title was available.' ELSE 'Made from the abstract (' || length(abstract) || ' characters), not from the full text.' END AS disclaimer FROM scored_papers",
    "dis_08_clean": rf"WITH s AS (SELECT record_id, {_CLEAN} AS t FROM scored_papers), c AS (SELECT record_id, CASE WHEN length(t) > 300 THEN regexp_replace(left(t, 300), '\s+\S*$', '') ELSE t END AS c FROM s) SELECT record_id, CASE WHEN c <> '' THEN c ELSE 'No summary yet.' END AS summary FROM c",
    "dis_11_overview": "WITH t AS (SELECT upper(trim(primary_topic_code, ' ')) AS topic, row_id, paper_importance_score AS s FROM core_corpus_tracked WHERE paper_importance_score IS NOT NULL AND NOT isnan(paper_importance_score)), k AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY s DESC, row_id) AS r, count(*) OVER (PARTITION BY topic) AS n FROM t WHERE topic IS NOT NULL AND topic NOT IN ('', 'NAN')) SELECT topic, topic || ': ' || any_value(n) || ' papers, first ' || string_agg(row_id::VARCHAR, ', ' ORDER BY r) AS overview FROM k WHERE r <= 5 GROUP BY topic",
    "gov_01_metadata": f"WITH s AS (SELECT corpus_id, title, {_DOI.format('doi')} AS k FROM core_seeds), n AS (SELECT {_DOI.format('seed_doi')} AS k, count(*) AS uses, min(seed_title) AS seen FROM candidate_papers GROUP BY 1) SELECT corpus_id, CASE WHEN uses IS NULL THEN 'unresolved' WHEN lower(seen) = lower(title) THEN 'resolved' ELSE 'differs' END AS state, coalesce(uses, 0) AS uses, CASE WHEN s.k = '' THEN 'no doi' WHEN coalesce(uses, 0) >= 20 THEN 'bridge' ELSE '' END AS hint FROM s LEFT JOIN n ON s.k = n.k AND n.k <> ''",
    "gov_05_briefs": "WITH t AS (SELECT canonical_paper_id AS c, upper(trim(primary_topic_code, ' ')) AS topic, evidence_strength AS es FROM core_corpus_tracked), y AS (SELECT canonical_paper_id AS c, max(publication_year) AS y FROM scored_papers GROUP BY 1), g AS (SELECT topic, count(DISTINCT c) AS papers, count(*) FILTER (y >= 2018) AS recent, count(*) FILTER (es <= 1) AS weak FROM t LEFT JOIN y USING (c) WHERE topic IS NOT NULL AND topic NOT IN ('', 'NAN', 'UNMAPPED') GROUP BY 1) SELECT *, concat_ws('; ', CASE WHEN recent < 3 THEN 'few recent' END, CASE WHEN weak > 0 THEN 'weak evidence' END) AS flags FROM g",
    "gov_06_fallback": "SELECT tier, count(*) AS n FROM core_corpus_tracked GROUP BY 1",
    "gov_07_console": f"WITH o AS (SELECT count(*) AS n, count(*) FILTER ({_M.format('abstract')}) AS a, count(*) FILTER (is_core_seed) AS s FROM scored_papers) SELECT 1 AS line_no, 'records: ' || n AS line FROM o UNION ALL SELECT 2, 'without abstract: ' || a FROM o UNION ALL SELECT 3, 'seeds: ' || s FROM o",
}
