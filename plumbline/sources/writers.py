"""Sinks of section 2.2."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.order import global_position


def write_by_suffix(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-01 to SNK-03, SNK-06: ``.parquet``, ``.json`` (lines) or CSV with a header, empty tables too."""
    if path.endswith(".parquet"):
        df.write.mode(mode).parquet(path)
    elif path.endswith((".json", ".jsonl")):
        df.write.mode(mode).json(path)
    else:
        df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    """SNK-06: JSON lines added to what is there."""
    write_by_suffix(df, path if path.endswith((".json", ".jsonl")) else path + ".jsonl", "append")


def write_report(df: DataFrame, path: str, most: int = 10_000) -> None:
    """SNK-04: a small report as indented JSON. Larger frames are refused: they belong in a table."""
    rows = df.limit(most + 1).toJSON().collect()
    if len(rows) > most:
        raise ValueError(f"a report of more than {most} rows")
    with open(path, "w") as f:
        json.dump([json.loads(r) for r in rows], f, indent=2, sort_keys=True)


def graphml_lines(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """SNK-05: GraphML as ordered lines (``part``, ``line``), written with ``DataFrameWriter.text`` at any size."""
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.replace(F.replace(c.cast("string"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;")), F.lit('"'))
    spark = nodes.sparkSession
    frame = [(0, '<?xml version="1.0" encoding="UTF-8"?><graphml xmlns="http://graphml.graphdrawing.org/xmlns"><graph edgedefault="directed">'), (3, "</graph></graphml>")]
    ends = spark.createDataFrame(frame, "part int, line string")
    n = nodes.select(F.lit(1).alias("part"), F.concat(F.lit("<node id="), quoted(F.col("id")), F.lit("/>")).alias("line"))
    e = edges.select(F.lit(2).alias("part"), F.concat(F.lit("<edge source="), quoted(F.col("src")), F.lit(" target="), quoted(F.col("dst")), F.lit("/>")).alias("line"))
    return ends.unionByName(n).unionByName(e).orderBy("part", "line")


def indexed_graph(nodes: DataFrame, edges: DataFrame, order: list) -> tuple[DataFrame, DataFrame]:
    """SNK-09: nodes with a dense index and edges as index pairs."""
    indexed = global_position(nodes, order, "idx")
    key = indexed.select("id", "idx")
    pairs = edges.join(key.select(F.col("id").alias("src"), F.col("idx").alias("a")), "src").join(key.select(F.col("id").alias("dst"), F.col("idx").alias("b")), "dst")
    return indexed, pairs.select("a", "b")


def provenance(spark: SparkSession, paths: list[str]) -> DataFrame:
    """SNK-11: size and SHA-256 of files."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def markdown_cards(df: DataFrame, title: str, url: str, text: str) -> DataFrame:
    """SNK-08, SNK-12: one Markdown card a row."""
    return df.select("*", F.format_string("### [%s](%s)\n\n%s\n", F.coalesce(title, F.lit("untitled")), F.coalesce(url, F.lit("")), F.coalesce(F.substring(text, 1, 400), F.lit(""))).alias("card"))
