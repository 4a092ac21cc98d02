"""Sources of section 2.1: files in, frames out, with declared schemas."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from plumbline.functions.text import strip_html

WORK_SCHEMA = "id string, doi string, title string, publication_year int, cited_by_count bigint, authorships array<struct<author struct<display_name string>>>, primary_location struct<source struct<display_name string>, pdf_url string, landing_page_url string>, concepts array<struct<display_name string>>, topics array<struct<display_name string>>, abstract_inverted_index map<string, array<int>>, referenced_works array<string>".replace("struct<author struct", "struct<author: struct").replace("struct<display_name string>", "struct<display_name: string>").replace("struct<source struct", "struct<source: struct").replace("pdf_url string", "pdf_url: string").replace("landing_page_url string", "landing_page_url: string")


def read_csv(spark: SparkSession, path: str, schema: str, columns: Sequence[str] | None = None) -> DataFrame:
    """SRC-01 to SRC-03: CSV with quotes and line breaks in fields; only ``columns`` are parsed where given."""
    df = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return df.select(*columns) if columns else df


def read_longest_text(spark: SparkSession, path: str, ident: str, text: str) -> DataFrame:
    """SRC-04: a folder of Parquet files: the longest text of every identifier."""
    df = spark.read.parquet(path).select(F.col(ident).alias("id"), F.col(text).alias("text")).where("text is not null")
    return df.groupBy("id").agg(F.max_by("text", F.struct(F.length("text"), "text")).alias("text"))


def read_works(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """SRC-05, SRC-06: cached JSON documents, one work each or a list under ``results``; broken files are passed over."""
    raw = spark.read.schema(f"{WORK_SCHEMA}, results array<struct<{_as_struct(WORK_SCHEMA)}>>").option("multiLine", True).option("mode", "DROPMALFORMED").json(path)
    names = [f.name for f in T._parse_datatype_string(WORK_SCHEMA).fields]
    single = raw.where("results is null").select(*names)
    listed = raw.where("results is not null").select(F.explode("results").alias("w")).select(*[F.col(f"w.{n}") for n in names])
    return single.unionByName(listed).where(F.col("id").startswith(prefix))


def _as_struct(schema: str) -> str:
    return ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in T._parse_datatype_string(schema).fields)


def candidate_rows(works: DataFrame, channel: str) -> DataFrame:
    """PRJ-01, PRJ-02: work documents as flat candidate rows."""
    names = lambda c, n: F.array_join(F.transform(F.slice(F.coalesce(c, F.array().cast("array<struct<display_name:string>>")), 1, n), lambda x: x["display_name"]), ";")
    return works.select(
        F.md5(F.coalesce("id", "doi", "title")).alias("candidate_id"), F.col("id").alias("openalex_id"), "doi", "title", "publication_year",
        F.get("authorships", F.lit(0))["author"]["display_name"].alias("first_author"), F.col("primary_location.source.display_name").alias("venue"),
        F.coalesce("cited_by_count", F.lit(0)).alias("cited_by_count"), names(F.col("concepts"), 10).alias("concepts"), names(F.col("topics"), 5).alias("topics"), F.lit(channel).alias("channel"),
    )


def read_latest_jsonl(spark: SparkSession, path: str, schema: str, ident: str, seq: str) -> DataFrame:
    """SRC-07: a log of JSON lines; the last record of every identifier; bad lines are passed over."""
    df = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path).where(F.col(ident).isNotNull())
    return df.groupBy(ident).agg(F.max_by(F.struct(*df.columns), F.col(seq)).alias("r")).select("r.*")


def read_front_matter(spark: SparkSession, path: str) -> DataFrame:
    """SRC-10: Markdown with a head of ``key: value`` lines: path, fields as a map, and the body."""
    df = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    head = F.regexp_extract("value", r"(?s)\A---\s*\n(.*?)\n---", 1)
    pairs = F.regexp_extract_all(head, F.lit(r"(?m)^([A-Za-z_][\w.]*:[^\n]*)$"), 1)
    fields = F.map_from_entries(F.array_distinct(F.transform(pairs, lambda p: F.struct(F.split_part(p, F.lit(":"), F.lit(1)), F.trim(F.regexp_replace(p, r"^[^:]*:\s*", ""), F.lit("\"'"))))))
    return df.where(head != "").select("path", fields.alias("fields"), F.trim(F.regexp_replace("value", r"(?s)\A---.*?\n---\s*", "")).alias("body"))


def read_candidate_list(spark: SparkSession, path: str) -> DataFrame:
    """SRC-11: lines like ``- Authors (2020). Title. Journal.`` of a Markdown list."""
    lines = spark.read.text(path)
    pattern = r"^\s*[-*]\s+(.+?)\s+\((\d{4})\)\.\s+(.+?)\.\s+(.+?)\.?\s*$"
    part = lambda i: F.regexp_extract("value", pattern, i)
    return lines.where(F.col("value").rlike(pattern)).select(part(1).alias("authors"), part(2).cast("int").alias("year"), part(3).alias("title"), part(4).alias("journal"))


def page_abstracts(pages: DataFrame, ident: str, html: str, least: int = 120) -> DataFrame:
    """SRC-20: the best description in a page's meta tags: by priority of the tag, then the longest."""
    tags = ("citation_abstract", "dc.description", "og:description", "description")
    found = F.regexp_extract_all(html, F.lit(r"(?is)(<meta\b[^>]*>)"), 1)
    attribute = lambda tag, name: F.regexp_extract(tag, rf"(?is)\b{name}\s*=\s*[\"']([^\"']*)[\"']", 1)
    tag = pages.select(F.col(ident).alias("id"), F.explode(found).alias("tag")).select(
        "id", F.lower(F.coalesce(F.nullif(attribute(F.col("tag"), "name"), F.lit("")), attribute(F.col("tag"), "property"))).alias("name"), strip_html(attribute(F.col("tag"), "content")).alias("text")
    )
    rank = F.array_position(F.array(*[F.lit(t) for t in tags]), F.col("name"))
    return tag.where((rank > 0) & (F.length("text") >= least)).groupBy("id").agg(F.min_by(F.struct("name", "text"), F.struct(rank, -F.length("text"), "text")).alias("b")).select("id", "b.name", "b.text")


def decode_graph(payload: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SRC-23: ``nodes`` (array of ids) and ``edges`` (array of index pairs) back to frames."""
    nodes = payload.select(F.posexplode("nodes").alias("idx", "id"))
    pairs = payload.select(F.explode("edges").alias("e")).select(F.col("e")[0].alias("a"), F.col("e")[1].alias("b"))
    src, dst = nodes.select(F.col("idx").alias("a"), F.col("id").alias("src")), nodes.select(F.col("idx").alias("b"), F.col("id").alias("dst"))
    return nodes, pairs.join(src, "a").join(dst, "b").select("src", "dst")


# --- paged services (SRC-12 to SRC-19): a Python data source over an injected page function ---------------------


class PagedPartition(InputPartition):
    def __init__(self, query: str):
        self.query = query


class PagedReader(DataSourceReader):
    """One task a query; each asks for page after page until none is left, or ``max_results`` is reached where it is not 0.

    A page that fails is asked for again after a wait that doubles each time; if it fails ``retries`` times more, the scan
    fails, so a result is never short without a word. ``EOFError`` from the service ends a query as it stands.
    """

    def __init__(self, fetch: Callable[[str, str], tuple[list[tuple], str | None]], queries: Sequence[str], max_results: int, retries: int, wait: float = 0.5):
        self.fetch, self.queries, self.max_results, self.retries, self.wait = fetch, queries, max_results, retries, wait

    def partitions(self):
        return [PagedPartition(q) for q in self.queries]

    def read(self, partition) -> Iterator[tuple]:
        cursor, given = "*", 0
        while cursor is not None and (not self.max_results or given < self.max_results):
            for attempt in range(self.retries + 1):
                try:
                    rows, cursor = self.fetch(partition.query, cursor)
                    break
                except EOFError:
                    return
                except OSError:
                    if attempt == self.retries:
                        raise
                    time.sleep(self.wait * 2**attempt)
            for row in rows[: self.max_results - given] if self.max_results else rows:
                yield (partition.query, *row)
            given += len(rows)
            if not rows:
                return


def paged_source(name: str, schema: str, fetch: Callable[[str, str], tuple[list[tuple], str | None]]) -> type[DataSource]:
    """A registered source whose rows come from ``fetch(query, cursor) -> (rows, next cursor)``. Options: ``queries``
    (separated by line breaks), ``max_results`` (0: all), ``retries``, ``wait`` (seconds before the first retry)."""

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return f"query string, {schema}"

        def reader(self, schema) -> DataSourceReader:
            return PagedReader(fetch, [q for q in self.options.get("queries", "").split("\n") if q], int(self.options.get("max_results", "0")), int(self.options.get("retries", "2")), float(self.options.get("wait", "0.5")))

    return Paged


def link_steps(markdown: DataFrame, text: str) -> DataFrame:
    """SEL-21: the links of a Markdown text in order, each target once."""
    links = F.array_distinct(F.regexp_extract_all(text, F.lit(r"\[[^\]]*\]\(([^)\s]+)\)"), 1))
    return markdown.select("*", F.posexplode(links).alias("step", "target"))


