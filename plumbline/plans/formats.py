"""Sections 2.1 and 2.2: lookups, caches, documents of other formats, exports, over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import text as T
from plumbline.functions.columns import is_missing
from plumbline.sources import lookup as K
from plumbline.sources import readers, writers
from plumbline.sources.tables import table


def snk_08_cards(spark, d):
    """SNK-08: Markdown cards of the seeds."""
    s = table(spark, d, "core_seeds").withColumn("url", F.concat(F.lit("https://doi.example/"), T.normalize_doi(F.col("doi"))))
    return writers.markdown_cards(s, "title", "url", "rationale").select("corpus_id", "card")


def snk_11_files(spark, d):
    """SNK-11: size and SHA-256 of every table's files."""
    p = writers.provenance(spark, [f"{d}/*.parquet"])
    return p.select(F.element_at(F.split("path", "/"), -1).alias("name"), "length", "sha256")


def snk_11_provenance(spark, d):
    """SNK-11: a digest of a table's contents: a sum of numbers from the rows' digests, which no order changes."""
    c = table(spark, d, "customer")
    row = F.md5(F.concat_ws("|", F.col("c_custkey").cast("string"), "c_name", F.col("c_nationkey").cast("string"), "c_mktsegment"))
    return c.agg(F.count(F.lit(1)).alias("n"), F.sum(F.conv(F.substring(row, 1, 12), 16, 10).cast("decimal(20,0)")).cast("string").alias("digest"))


def snk_12_round_trip(spark, d):
    """SNK-12: a selection written in three forms, and its identifiers read back."""
    s = K.export_selection(table(spark, d, "scored_papers").where("is_core_seed"), "record_id", "title")
    back = K.import_selection(s.unionByName(s), "json")
    return s.join(back.select(F.col("id").cast("bigint").alias("id")), "id").select("id", "markdown", F.md5("bibtex").alias("bibtex_md5"))


def src_04_longest(spark, d):
    """SRC-04: a folder of texts: the longest of every identifier."""
    t = readers.read_longest_text(spark, f"{d}/documents.parquet", "corpus_id", "text")
    return t.select("id", F.length("text").alias("n"))


def src_13_lookup(spark, d):
    """SRC-13: works by DOI or identifier, found or not."""
    keys = table(spark, d, "candidate_papers").select(F.explode(F.array("doi", "openalex_id")).alias("key")).where(~is_missing(F.col("key")))
    return K.lookup(table(spark, d, "scored_papers"), keys)


def src_14_citing(spark, d):
    """SRC-14: the works that cite each seed."""
    works = table(spark, d, "candidate_papers").select(F.col("_ord").alias("row"), T.normalize_doi(F.col("seed_doi")).alias("cites"))
    return K.citing(works, table(spark, d, "core_seeds").select(T.normalize_doi(F.col("doi")).alias("target")).where("target <> ''"))


def src_15_multi_get(spark, d):
    """SRC-15: works of a list of identifiers, in requests of fifty."""
    ids = table(spark, d, "scored_papers").select(F.explode(K.listed_ids(F.col("all_openalex_ids"))).alias("id")).where(F.col("id").rlike(r"^W[0-9]{11}\z"))
    return K.multi_get(table(spark, d, "candidate_papers").where("openalex_id is not null").select("_ord", "openalex_id"), ids, "openalex_id").select("_ord", "request")


def src_16_references(spark, d):
    """SRC-16: the first three references of every answer."""
    p = table(spark, d, "candidate_papers").where("seed_doi is not null")
    refs = F.array(*[F.struct(F.coalesce(c, F.lit("")).alias("DOI")) for c in (F.col("doi"), F.col("seed_doi"), F.lit(""), F.col("doi"))])
    body = F.to_json(F.struct(F.struct(refs.alias("reference")).alias("message")))
    return K.references(p.select("_ord", body.alias("body")), "_ord", "body", 3)


def src_18_cache(spark, d):
    """SRC-18: requests met from a cache that also knows what does not exist."""
    key = lambda c: K.request_key(F.lit("/works"), F.create_map(F.lit("filter"), F.concat(F.lit("doi:"), c), F.lit("cursor"), F.lit("*")))
    asked = table(spark, d, "candidate_papers").select(F.coalesce("doi", F.lit("")).alias("doi"), "_ord").withColumn("key", key(F.col("doi")))
    known = table(spark, d, "scored_papers").where("doi is not null")
    known = known.select(key(F.col("doi")).alias("key"), F.when(F.col("cross_seed_score") > 0, F.col("record_id").cast("string")).alias("body"), F.struct("updated_at", "record_id").alias("at"))
    return K.with_cache(asked, known).select("_ord", "key", "body", "state")


def src_19_xml(spark, d):
    """SRC-19: records in XML."""
    s = table(spark, d, "core_seeds")
    plain = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), "[<>&]", " ")
    tag = lambda name, *inner: F.concat(F.lit(f"<{name}>"), *inner, F.lit(f"</{name}>"))
    article = tag("Article", tag("ArticleTitle", plain("title")), tag("Abstract", tag("AbstractText", plain("rationale")), tag("AbstractText", plain("population"), F.lit("."))))
    xml = tag("PubmedArticleSet", tag("PubmedArticle", tag("MedlineCitation", tag("PMID", plain("pmid")), article)))
    return K.xml_records(s.select(xml.alias("xml")), "xml")


def src_20_linked_data(spark, d):
    """SRC-20, ARR-06: the longest description in a page's linked data, at any depth."""
    s = table(spark, d, "scored_papers").where(~is_missing(F.col("abstract")))
    node = F.struct(F.lit("short").alias("description"), F.struct(T.strip_html(F.col("abstract")).alias("Description")).alias("more"))
    doc = F.to_json(F.struct(F.lit("Article").alias("@type"), F.array(F.struct(node.alias("node"))).alias("@graph")))
    page = F.concat(F.lit('<html><script type="application/ld+json">'), doc, F.lit("</script><script>var description = 1</script></html>"))
    return K.page_descriptions(s.select("record_id", page.alias("html")), "record_id", "html").select("record_id", F.length("text").alias("n"))


def src_21_full_text(spark, d):
    """SRC-21: texts of fetched files of several kinds."""
    t = table(spark, d, "documents")
    kind = F.when(F.col("text").contains("#"), "html").when(F.coalesce("lang", F.lit("")) == "", "pdf").otherwise("plain")
    content = F.when(kind == "html", F.concat(F.lit("<html><script>x < 1</script><p>"), "text", F.lit("</p></html>"))).otherwise(F.col("text"))
    return K.full_texts(t.select("doc_id", content.alias("content"), kind.alias("kind")), "doc_id", "content", "kind").select("doc_id", "state", F.length("text").alias("n"))


def _doi(c: str) -> str:
    return rf"regexp_replace(lower(regexp_extract(coalesce({c}, ''), '(10\.\d{{4,9}}/\S+)', 1)), '[\)\]\.,;:\"'']+$', '')"


def _html(c: str) -> str:
    out = f"regexp_replace({c}, '<[^>]+>', ' ', 'g')"
    for entity, plain in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{plain}')"
    return rf"trim(regexp_replace({out}, '\s+', ' ', 'g'))"


def _key(c: str) -> str:
    return f"""sha256('{{"params":{{"cursor":"*","filter":' || to_json('doi:' || {c})::VARCHAR || '}},"path":["/works"]}}')"""


_MISS = "(key IS NULL OR lower(trim(key, chr(9)||chr(10)||chr(13)||' ')) IN ('', 'nan'))"
QUERIES = {k: v for k, v in list(globals().items()) if k.startswith(("src_", "snk_"))}
ORACLE = {
    "snk_08_cards": f"SELECT corpus_id, '### [' || coalesce(title, 'untitled') || '](' || 'https://doi.example/' || {_doi('doi')} || ')' || chr(10) || chr(10) || coalesce(left(rationale, 400), '') || chr(10) AS card FROM core_seeds",
    "snk_11_provenance": "SELECT count(*) AS n, CAST(sum(CAST(CAST('0x' || substr(md5(concat_ws('|', c_custkey, c_name, c_nationkey, c_mktsegment)), 1, 12) AS BIGINT) AS HUGEINT)) AS VARCHAR) AS digest FROM customer",
    "snk_12_round_trip": r"SELECT record_id AS id, '- **' || coalesce(title, '') || '** (' || record_id || ')' AS markdown, md5('@misc{' || record_id || ', title = {' || regexp_replace(coalesce(title, ''), '([{}&%$#_])', '\\\1', 'g') || '}}') AS bibtex_md5 FROM scored_papers WHERE is_core_seed",
    "src_04_longest": "SELECT corpus_id AS id, max(length(text)) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1",
    "src_13_lookup": f"WITH k AS (SELECT DISTINCT key FROM (SELECT doi AS key FROM candidate_papers UNION ALL SELECT openalex_id FROM candidate_papers) WHERE NOT {_MISS}), w AS (SELECT record_id, {_doi('doi')} AS d, string_split(coalesce(openalex_id, ''), '/')[-1] AS w FROM scored_papers), a AS (SELECT d, min(record_id) AS r FROM w WHERE d <> '' GROUP BY 1), b AS (SELECT w, min(record_id) AS r FROM w WHERE w <> '' GROUP BY 1), x AS (SELECT key, {_doi('key')} AS d, string_split(key, '/')[-1] AS w FROM k) SELECT key, CASE WHEN x.d <> '' THEN a.r ELSE b.r END AS row, CASE WHEN x.d <> '' THEN a.r ELSE b.r END IS NOT NULL AS found FROM x LEFT JOIN a ON a.d = x.d LEFT JOIN b ON b.w = x.w",
    "src_14_citing": f"WITH s AS (SELECT DISTINCT {_doi('doi')} AS target FROM core_seeds), w AS (SELECT _ord AS row, {_doi('seed_doi')} AS c FROM candidate_papers) SELECT target, row FROM w JOIN s ON c = target WHERE target <> ''",
    "src_15_multi_get": "WITH l AS (SELECT DISTINCT string_split(trim(unnest(string_split(coalesce(all_openalex_ids, ''), ';')), ' '), '/')[-1] AS w FROM scored_papers), a AS (SELECT w, floor((row_number() OVER (ORDER BY w) - 1) / 50)::BIGINT AS request FROM l WHERE regexp_matches(w, '^W[0-9]{11}$')) SELECT _ord, request FROM candidate_papers JOIN a ON string_split(openalex_id, '/')[-1] = w",
    "src_16_references": f"WITH p AS (SELECT _ord, {_doi('doi')} AS a, {_doi('seed_doi')} AS b FROM candidate_papers WHERE seed_doi IS NOT NULL) SELECT _ord, 1 AS pos, a AS doi FROM p WHERE a <> '' UNION ALL SELECT _ord, 2, b FROM p WHERE b <> ''",
    "src_18_cache": f"WITH k AS (SELECT {_key('doi')} AS key, CASE WHEN cross_seed_score > 0 THEN record_id::VARCHAR END AS body FROM scored_papers WHERE doi IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doi ORDER BY updated_at DESC NULLS LAST, record_id DESC) = 1), a AS (SELECT _ord, {_key('coalesce(doi, chr(0)[1:0])')} AS key FROM candidate_papers) SELECT _ord, a.key, body, CASE WHEN k.key IS NULL THEN 'miss' WHEN body IS NULL THEN 'absent' ELSE 'hit' END AS state FROM a LEFT JOIN k ON a.key = k.key",
    "src_19_xml": r"SELECT coalesce(pmid, '') AS pmid, trim(regexp_replace(regexp_replace(coalesce(title, ''), '[<>&]', ' ', 'g'), '\s+', ' ', 'g')) AS title, CASE WHEN rationale <> '' THEN regexp_replace(rationale, '[<>&]', ' ', 'g') || ' ' ELSE '' END || regexp_replace(coalesce(population, ''), '[<>&]', ' ', 'g') || '.' AS abstract FROM core_seeds",
    "src_20_linked_data": f"SELECT record_id, length({_html('abstract')}) AS n FROM scored_papers WHERE abstract IS NOT NULL AND length({_html('abstract')}) >= 120",
    "src_21_full_text": rf"WITH k AS (SELECT doc_id, CASE WHEN contains(text, '#') THEN 'html' WHEN coalesce(lang, '') = '' THEN 'pdf' ELSE 'plain' END AS kind, CASE WHEN contains(text, '#') THEN {_html('text')} ELSE trim(regexp_replace(text, '\s+', ' ', 'g')) END AS t FROM documents), s AS (SELECT doc_id, t, CASE WHEN kind = 'pdf' THEN 'unread' WHEN coalesce(length(t), 0) < 1000 THEN 'too short' ELSE 'ok' END AS state FROM k) SELECT doc_id, state, CASE WHEN state = 'ok' THEN length(t) END AS n FROM s",
}
