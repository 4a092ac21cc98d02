"""Keyed lookups, caches and documents of other formats (SRC-08 to SRC-21): frames in, frames out, no network."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.columns import col, fresh
from plumbline.functions.text import normalize_doi, split_list, squeeze, strip_html


def short_id(c: Column) -> Column:
    """An identifier without its resolver."""
    return F.element_at(F.split(F.coalesce(c, F.lit("")), "/"), -1)


# --- small documents on the driver ------------------------------------------------------------------------------


def read_yaml(path: str, overrides: Mapping[str, str] | None = None) -> dict:
    """SRC-08: a YAML file; ``overrides`` names environment variables that replace top-level values where they are set.

    An empty file is an empty mapping."""
    import yaml

    with open(path, encoding="utf-8") as f:
        out = yaml.safe_load(f) or {}
    return out | {k: os.environ[v] for k, v in (overrides or {}).items() if os.environ.get(v)}


def yaml_rows(spark: SparkSession, path: str, under: str, schema: str) -> DataFrame:
    """SRC-08: the list ``under`` a YAML file's top as rows; fields that are not there are NULL."""
    names = [f.name for f in spark.createDataFrame([], schema).schema]
    return spark.createDataFrame([tuple(x.get(n) for n in names) for x in read_yaml(path).get(under) or []], schema)


def read_registry(spark: SparkSession, path: str, schema: str, under: Sequence[str] = ("decisions", "updates")) -> DataFrame:
    """SRC-09: a registry: a JSON list, an object that holds the list under one of the names ``under``, or CSV."""
    if path.endswith(".csv"):
        return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)
    fields = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in spark.createDataFrame([], schema).schema)
    text = spark.read.text(path, wholetext=True)
    item = f"array<struct<{fields}>>"
    named = F.coalesce(*[F.from_json("value", f"struct<`{u}`: {item}>")[u] for u in under])
    rows = F.when(F.ltrim("value").startswith("["), F.from_json("value", item)).otherwise(named)
    return text.select(F.explode(rows).alias("r")).select("r.*")


# --- keyed lookups over cached works ----------------------------------------------------------------------------


def lookup(works: DataFrame, keys: DataFrame, ident: str = "openalex_id", doi: str = "doi", row: str = "record_id") -> DataFrame:
    """SRC-13: for every key, a DOI in any form or a work identifier with or without resolver: ``key, row, found``.

    The smallest row is taken; keys that nothing has come out with NULL. Each key once; NULL keys don't count.
    """
    k = keys.select("key").where("key is not null").distinct().withColumn("d", normalize_doi(F.col("key"))).withColumn("w", short_id(F.col("key")))
    by_doi = works.select(normalize_doi(F.col(doi)).alias("d"), row).where("d <> ''").groupBy("d").agg(F.min(row).alias("r1"))
    by_id = works.select(short_id(F.col(ident)).alias("w"), row).where("w <> ''").groupBy("w").agg(F.min(row).alias("r2"))
    found = k.join(by_doi, "d", "left").join(by_id, "w", "left").select("key", F.when(F.col("d") != "", F.col("r1")).otherwise(F.col("r2")).alias("row"))
    return found.withColumn("found", F.col("row").isNotNull())


def citing(works: DataFrame, targets: DataFrame) -> DataFrame:
    """SRC-14: the works that cite each target: ``target, row``. ``works``: row, cites. ``targets``: target."""
    return works.join(targets.select(F.col("target").alias("cites")).distinct(), "cites").select(F.col("cites").alias("target"), "row")


def multi_get(works: DataFrame, ids: DataFrame, ident: str, chunk: int = 50) -> DataFrame:
    """SRC-15: the works of a list of identifiers, with the request of ``chunk`` identifiers that would have asked for each.

    Requests are numbered by range partitions, so the list may be of any length."""
    from plumbline.operators.order import global_position

    (w,) = fresh(works, "w")
    asked = global_position(ids.select(short_id(F.col("id")).alias(w)).where(col(w) != "").distinct(), [w], "at").select(w, F.floor(F.col("at") / chunk).alias("request"))
    return works.withColumn(w, short_id(col(ident))).join(asked, w).drop(w)


def references(messages: DataFrame, ident: str, body: str, most: int = 0) -> DataFrame:
    """SRC-16, SRC-17: references of a message, ``{"message": {"reference": [{"DOI": ...}]}}``: ``ident, pos, doi``; the
    first ``most`` of them, or all (0). References without a DOI keep their place but give no row."""
    refs = F.from_json(body, "struct<message: struct<reference: array<struct<DOI: string>>>>")["message"]["reference"]
    some = F.slice(refs, 1, most) if most else refs
    return messages.select(ident, F.posexplode(some).alias("p", "r")).select(ident, (F.col("p") + 1).alias("pos"), normalize_doi(F.col("r.DOI")).alias("doi")).where("doi <> ''")


# --- cached answers ---------------------------------------------------------------------------------------------


def request_key(path: Column, params: Column) -> Column:
    """SRC-18: SHA-256 of the request as JSON, parameters in the order of their names."""
    ordered = F.map_from_entries(F.array_sort(F.map_entries(params)))
    return F.sha2(F.concat(F.lit('{"params":'), F.to_json(ordered), F.lit(',"path":'), F.to_json(F.array(path)), F.lit("}")), 256)


def with_cache(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """SRC-18: requests (``key`` and others) with what is cached: ``body``, and ``state``: hit, absent (an answer that
    there is nothing, cached too, with a NULL body) or miss. The latest answer to a key counts. ``cache``: key, body, at."""
    latest = cache.groupBy("key").agg(F.max_by(F.struct("body"), "at").alias("c"))
    state = F.when(F.col("c").isNull(), "miss").when(F.col("c.body").isNull(), "absent").otherwise("hit")
    return requests.join(latest, "key", "left").select(*requests.columns, F.col("c.body").alias("body"), state.alias("state"))


# --- other formats ----------------------------------------------------------------------------------------------


def xml_records(pages: DataFrame, xml: str) -> DataFrame:
    """SRC-19: records of an XML answer: ``pmid, title, abstract`` (its parts joined), one row an article."""
    parts = F.regexp_extract_all(xml, F.lit(r"(?s)(<PubmedArticle\b.*?</PubmedArticle>)"), 1)
    a = pages.select(F.explode(parts).alias("x"))
    return a.select(
        F.xpath_string("x", F.lit("PubmedArticle//PMID")).alias("pmid"), squeeze(F.xpath_string("x", F.lit("PubmedArticle//ArticleTitle"))).alias("title"),
        F.array_join(F.xpath("x", F.lit("PubmedArticle//AbstractText/text()")), " ").alias("abstract"),
    )


def _values_of(node, name: str, out: list[str]) -> None:
    stack = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, dict):
            for k, v in reversed(x.items()):
                stack.append(v)
                if k.lower() == name and isinstance(v, str):
                    stack[-1] = (v,)
        elif isinstance(x, list):
            stack.extend(reversed(x))
        elif isinstance(x, tuple):
            out.append(x[0])


def json_values(text: Column, name: str) -> Column:
    """ARR-06: all texts under a name, at any depth, in the order in which they stand; broken JSON gives none."""

    def find(texts: pd.Series) -> pd.Series:
        rows = []
        for t in texts:
            out: list[str] = []
            try:
                _values_of(json.loads(t), name.lower(), out)
            except (TypeError, ValueError):
                pass
            rows.append(out)
        return pd.Series(rows)

    find.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(find, "array<string>")(text)


def linked_data(html: Column) -> Column:
    """SRC-20: the JSON documents in the script tags of a page."""
    return F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), 1)


def page_descriptions(pages: DataFrame, ident: str, html: str, least: int = 120) -> DataFrame:
    """SRC-20: the longest description of at least ``least`` characters in a page's linked data: ``ident, text``."""
    found = pages.select(ident, F.explode(linked_data(F.col(html))).alias("j")).select(ident, F.explode(json_values(F.col("j"), "description")).alias("t"))
    clean = found.select(ident, strip_html(F.col("t")).alias("text")).where(F.length("text") >= least)
    return clean.groupBy(ident).agg(F.max_by("text", F.struct(F.length("text"), "text")).alias("text"))


def full_texts(files: DataFrame, ident: str, content: str, kind: str, least: int = 1000, most_bytes: int = 25_000_000) -> DataFrame:
    """SRC-21: the text of fetched files: ``ident, text, state``. HTML loses its tags; plain text its superfluous blanks.

    ``state``: ok, too large, too short, or unread (other kinds, PDF among them); only ok rows have a text.
    """
    text = F.when(F.col(kind) == "html", strip_html(F.col(content))).when(F.col(kind) == "plain", squeeze(F.col(content)))
    large = F.octet_length(F.coalesce(F.col(content), F.lit(""))) > most_bytes
    state = F.when(large, "too large").when(~F.coalesce(F.col(kind), F.lit("")).isin("html", "plain"), "unread").when(F.coalesce(F.length("t"), F.lit(0)) < least, "too short").otherwise("ok")
    return files.withColumn("t", F.when(~large, text)).select(ident, state.alias("state"), F.when(state == "ok", F.col("t")).alias("text"))


# --- selections -------------------------------------------------------------------------------------------------


def export_selection(df: DataFrame, ident: str, title: str) -> DataFrame:
    """SNK-12: one row a selected item: its identifier and its JSON, Markdown and BibTeX forms."""
    from plumbline.functions.text import bibtex_escape, slug

    t = F.coalesce(title, F.lit(""))
    return df.select(
        F.col(ident).alias("id"), F.to_json(F.struct(F.col(ident).alias("id"), t.alias("title"))).alias("json"),
        F.concat(F.lit("- **"), t, F.lit("** ("), F.col(ident).cast("string"), F.lit(")")).alias("markdown"),
        F.concat(F.lit("@misc{"), slug(F.col(ident).cast("string")), F.lit(", title = {"), bibtex_escape(t), F.lit("}}")).alias("bibtex"),
    )


def import_selection(lines: DataFrame, line: str) -> DataFrame:
    """SNK-12: identifiers read back from JSON lines, objects or lists; each once, broken lines passed over."""
    one = F.from_json(line, "struct<id: string>")["id"]
    many = F.from_json(line, "array<string>")
    ids = F.when(F.ltrim(F.col(line)).startswith("["), many).otherwise(F.array(one))
    return lines.select(F.explode(ids).alias("id")).where("id is not null and trim(id) <> ''").distinct()


def listed_ids(c: Column) -> Column:
    """The identifiers of a packed list, without resolvers, in order."""
    return F.transform(split_list(c), short_id)
