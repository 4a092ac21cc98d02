"""Queries of the packed-field operator."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.packed import CODES, IDENTIFIERS, NAMES, PackedSpec, split_packed
from plumbline.sources.tables import table

#: table, its key, the packed field, what may separate its values
PACKED_FIELDS: tuple[tuple[str, str, str, PackedSpec], ...] = (
    ("candidate_papers", "_ord", "concepts", NAMES),
    ("candidate_papers", "_ord", "topics", NAMES),
    ("scored_papers", "record_id", "all_openalex_ids", IDENTIFIERS),
    ("core_corpus_tracked", "row_id", "topic_codes", CODES),
)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of the four packed fields with its position."""
    parts = [
        split_packed(table(spark, sf_dir, name), key, field, spec).select(F.lit(field).alias("field_name"), "row_key", "pos", "item")
        for name, key, field, spec in PACKED_FIELDS
    ]
    return reduce(DataFrame.unionByName, parts)


def p5_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every identifier of a packed list with its position."""
    return split_packed(table(spark, sf_dir, "scored_papers"), "record_id", "all_openalex_ids", IDENTIFIERS)


def p5_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every topic code of a packed list with its position."""
    return split_packed(table(spark, sf_dir, "core_corpus_tracked"), "row_id", "topic_codes", CODES)


def _plain_sql(name: str, key: str, field: str, marks: str) -> str:
    """Identifiers and codes hold none of the marks between them, nor quotes and brackets."""
    return f"WITH l AS (SELECT {key} AS k, list_filter(string_split_regex(translate({field}, '\"[]', '   '), '[{marks}]+'), lambda x: x <> '' AND lower(x) NOT IN ('nan', 'null')) AS l FROM {name}) SELECT k AS row_key, unnest(generate_series(1, len(l))) AS pos, unnest(l) AS item FROM l"


QUERIES = {"p5_found": p5_found, "p5_ids": p5_ids, "p5_codes": p5_codes}
ORACLE: dict[str, str] = {
    "p5_ids": _plain_sql("scored_papers", "record_id", "all_openalex_ids", r"\s;,|"),
    "p5_codes": _plain_sql("core_corpus_tracked", "row_id", "topic_codes", r"\s;,|/+&"),
}
