"""Scores, flags and classifiers as column expressions over words and columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import col
from plumbline.functions.text import term_hits


def shares_of_greatest(df: DataFrame, parts: Mapping[str, float], out: str) -> DataFrame:
    """PRJ-05: a weighted sum of columns, each over its greatest value in the whole table (0 where that is 0).

    The greatest values are one aggregate row, joined to all others.
    """
    tops = df.agg(*[F.max(col(c).cast("double")).alias(f"top{i}__") for i, c in enumerate(parts)])
    joined = df.crossJoin(F.broadcast(tops))
    share = [F.coalesce(col(c).cast("double") / F.nullif(F.col(f"top{i}__"), F.lit(0.0)), F.lit(0.0)) * w for i, (c, w) in enumerate(parts.items())]
    return joined.withColumn(out, sum(share, F.lit(0.0))).drop(*[f"top{i}__" for i in range(len(parts))])


def adjusted(score: Column, factors: Sequence[tuple[Column, float]]) -> Column:
    """PRJ-08: the score times the factor of every condition that holds; NULL conditions don't."""
    out = score
    for holds, factor in factors:
        out = out * F.when(F.coalesce(holds, F.lit(False)), F.lit(factor)).otherwise(F.lit(1.0))
    return out


def off_topic(text: Column, generic: Sequence[str], focus: Sequence[str], affinity: Column, least_affinity: int, kept: Column) -> Column:
    """FLT-06: two or more generic terms, no term of the focus, little affinity, and nothing that keeps the row."""
    return (term_hits(text, tuple(generic)) >= 2) & (term_hits(text, tuple(focus)) == 0) & (F.coalesce(affinity, F.lit(0)) < least_affinity) & ~F.coalesce(kept, F.lit(False))


def any_of(*conditions: Column) -> Column:
    """FLT-07: whether one of the conditions holds; NULL is no."""
    out = F.lit(False)
    for c in conditions:
        out = out | F.coalesce(c, F.lit(False))
    return out


def contrast_score(text: Column, wanted: Sequence[str], unwanted: Sequence[str], penalty: int = 2) -> Column:
    """STR-06: wanted terms less ``penalty`` times the unwanted ones, 0 at least."""
    return F.greatest(F.lit(0), term_hits(text, tuple(wanted)) - penalty * term_hits(text, tuple(unwanted)))


def first_rule(text: Column, rules: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """STR-08: the label of the first rule with a term in the text."""
    low = F.lower(F.coalesce(text, F.lit("")))
    out = None
    for label, terms in rules:
        hit = any_of(*[low.contains(t) for t in terms])
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def tags(text: Column, aliases: Mapping[str, Sequence[str]]) -> Column:
    """STR-09: all labels of which an alias stands in the text, in the order given."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.array_compact(F.array(*[F.when(any_of(*[low.contains(a) for a in names]), F.lit(label)) for label, names in aliases.items()]))


def expanded(tokens: Column, synonyms: Mapping[str, Sequence[str]]) -> Column:
    """STR-14: query tokens, each followed by what it stands for, every token once."""
    if not synonyms:
        return F.array_distinct(tokens)
    known = F.create_map(*[x for k, vs in synonyms.items() for x in (F.lit(k), F.array(*[F.lit(v) for v in vs]))])
    return F.array_distinct(F.flatten(F.transform(tokens, lambda t: F.concat(F.array(t), F.coalesce(known[t], F.array().cast("array<string>"))))))


def first_number(text: Column) -> Column:
    """STR-24: the first run of digits; NULL if there is none."""
    return F.nullif(F.regexp_extract(F.coalesce(text.cast("string"), F.lit("")), r"(\d+)", 1), F.lit(""))


def last_word(name: Column) -> Column:
    """STR-24: the last word of a name; NULL for blank ones."""
    words = F.split(F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), r"\s+", " ")), " ")
    return F.nullif(F.element_at(words, -1), F.lit(""))


def note_after(text: Column, mark: str, end: str) -> Column:
    """STR-25: what stands between two marks, over line ends too, blanks squeezed; NULL if there is none."""
    found = F.regexp_extract(F.coalesce(text, F.lit("")), rf"(?is){mark}(.*?)(?:{end}|\z)", 1)
    return F.nullif(F.trim(F.regexp_replace(found, r"\s+", " ")), F.lit(""))


def structs_with(text: Column, schema: str, needed: str) -> Column:
    """ARR-04: a JSON list of objects, those with a value in the needed field; broken or missing text gives an empty list."""
    parsed = F.from_json(text, f"array<{schema}>", {"mode": "PERMISSIVE"})
    return F.filter(F.coalesce(parsed, F.from_json(F.lit("[]"), f"array<{schema}>")), lambda x: F.coalesce(x[needed], F.lit("")) != "")


def merged_counts(base: Column, other: Column, weight: float) -> Column:
    """ARR-08: counts by key, those of ``other`` by a weight."""
    zero = F.lit(0.0)
    return F.map_zip_with(base, other, lambda _, a, b: F.coalesce(a.cast("double"), zero) + weight * F.coalesce(b.cast("double"), zero))


def first_column(df: DataFrame, names: Sequence[str], otherwise: Column) -> Column:
    """FLT-19, GOV-06: the first of these columns that the table has."""
    have = {c.lower() for c in df.columns}
    return next((col(n) for n in names if n.lower() in have), otherwise)


def stage_counts(df: DataFrame, stages: Sequence[tuple[str, Column]]) -> DataFrame:
    """AGG-32: how many rows are left after each stage, and how many it took: one aggregate, one row a stage."""
    holds, sums = F.lit(True), []
    for _, condition in stages:
        holds = holds & F.coalesce(condition, F.lit(False))
        sums.append(F.count_if(holds))
    counts = df.agg(F.count(F.lit(1)).alias("all"), F.array(*sums).alias("left"))
    names = F.array(*[F.lit(n) for n, _ in stages])
    rows = counts.select("all", "left", F.posexplode(names).alias("step", "stage"))
    before = F.when(F.col("step") == 0, F.col("all")).otherwise(F.get("left", F.col("step") - 1))
    return rows.select("stage", F.get("left", F.col("step")).alias("kept"), (before - F.get("left", F.col("step"))).alias("taken"))


def limited(df: DataFrame, order: Sequence[Column], most: int) -> DataFrame:
    """SRT-10: the first ``most`` rows in order; 0 means all."""
    return df.orderBy(*order).limit(most) if most else df
