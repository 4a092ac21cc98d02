"""Sections 2.1 and 2.2 over the tables: what sources and sinks compute, and exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import text as T
from plumbline.functions.columns import is_missing
from plumbline.operators.graph import vertices
from plumbline.plans.graphs import followers
from plumbline.sources import readers, writers
from plumbline.sources.tables import table


def src_07_latest(spark, d):
    """SRC-07: the latest row of every key."""
    t = table(spark, d, "core_corpus_tracked")
    return t.groupBy("canonical_paper_id").agg(F.max_by("row_id", F.struct("scored_at", -F.col("row_id"))).alias("latest_row"))


def src_20_pages(spark, d):
    """SRC-20: pages made of abstracts, and the best description found in them."""
    p = table(spark, d, "scored_papers").where(~is_missing(F.col("abstract")))
    plain = F.replace(T.strip_html(F.col("abstract")), F.lit('"'), F.lit(""))
    page = F.concat(F.lit('<html><meta name="description" content="short"><meta name="citation_abstract" content="'), F.replace(plain, F.lit("'"), F.lit("")), F.lit('"></html>'))
    return readers.page_abstracts(p.select("record_id", page.alias("html")), "record_id", "html").select("id", "name", F.length("text").alias("n"))


def src_23_roundtrip(spark, d):
    """SRC-23, SNK-09: a graph as index pairs and back."""
    e = followers(spark, d)
    nodes, pairs = writers.indexed_graph(vertices(e), e, [F.asc("id")])
    key = nodes.select("id", "idx")
    back = pairs.join(key.select(F.col("idx").alias("a"), F.col("id").alias("src")), "a").join(key.select(F.col("idx").alias("b"), F.col("id").alias("dst")), "b")
    return back.select("src", "dst")


def snk_05_graphml(spark, d):
    """SNK-05: the lines of a GraphML file, counted by kind."""
    e = followers(spark, d)
    lines = writers.graphml_lines(vertices(e), e)
    return lines.groupBy("part").agg(F.count(F.lit(1)).alias("lines"), F.max(F.length("line")).alias("longest"))


def snk_07_export(spark, d):
    """SNK-07, PRJ-11: the curated export."""
    s = table(spark, d, "scored_papers")
    return s.select("record_id", F.to_json(F.struct(F.coalesce("title", F.lit("")).alias("title"), F.coalesce("publication_year", F.lit(0)).alias("year"), T.normalize_doi(F.col("doi")).alias("doi"))).alias("json"))


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith(("src_", "snk_"))}
_E = "e AS MATERIALIZED (SELECT DISTINCT a.l_partkey AS src, b.l_partkey AS dst FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1 WHERE a.l_partkey <> b.l_partkey)"
_DOI = r"regexp_replace(lower(regexp_extract(coalesce(doi, ''), '(10\.\d{4,9}/\S+)', 1)), '[\)\]\.,;:\"'']+$', '')"
_PAGE = r"trim(regexp_replace(replace(replace(regexp_replace(replace(replace(replace(replace(replace(replace(trim(regexp_replace(regexp_replace(abstract, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', ''), '&#39;', ''), '&amp;', '&'), '<[^>]+>', ' ', 'g'), chr(34), ''), chr(39), ''), '\s+', ' ', 'g'))"
ORACLE = {
    "src_20_pages": f"SELECT record_id AS id, 'citation_abstract' AS name, length({_PAGE}) AS n FROM scored_papers WHERE abstract IS NOT NULL AND length({_PAGE}) >= 120",
    "src_07_latest": "SELECT canonical_paper_id, row_id AS latest_row FROM core_corpus_tracked QUALIFY row_number() OVER (PARTITION BY canonical_paper_id ORDER BY scored_at DESC NULLS LAST, row_id) = 1",
    "src_23_roundtrip": f"WITH {_E} SELECT src, dst FROM e",
    "snk_05_graphml": f"WITH {_E}, v AS (SELECT src AS id FROM e UNION SELECT dst FROM e) SELECT 0 AS part, 1 AS lines, length('<?xml version=\"1.0\" encoding=\"UTF-8\"?><graphml xmlns=\"http://graphml.graphdrawing.org/xmlns\"><graph edgedefault=\"directed\">') AS longest UNION ALL SELECT 1, count(*), max(length('<node id=\"' || id || '\"/>')) FROM v UNION ALL SELECT 2, count(*), max(length('<edge source=\"' || src || '\" target=\"' || dst || '\"/>')) FROM e UNION ALL SELECT 3, 1, 18",
    "snk_07_export": f"SELECT record_id, to_json({{'title': coalesce(title, ''), 'year': coalesce(publication_year, 0), 'doi': {_DOI}}})::VARCHAR AS json FROM scored_papers",
}
