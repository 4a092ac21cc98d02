"""Short texts from long ones: takeaways, rules-based summaries, difficulty, certainty, clean-up (DIS-02 to DIS-08)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.text import overlap_tokens, sentences

#: Words of sentences that report a result.
RESULT_WORDS = ("found", "showed", "increased", "decreased", "improved", "reduced", "associated", "associated with", "significant", "results", "conclusion")
#: Words of hard texts.
COMPLEX_WORDS = ("randomi", "hazard", "confidence interval", "propensity", "multivariable", "longitudinal", "heterogene", "pharmaco")


def key_sentence(text: Column, words: Sequence[str] = RESULT_WORDS) -> Column:
    """DIS-02: the first sentence that reports a result, else the first; NULL for a text without sentences."""
    all_ = sentences(text)
    low = lambda s: F.lower(s)
    hit = F.filter(all_, lambda s: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(low(s), w)))
    return F.coalesce(F.get(hit, F.lit(0)), F.get(all_, F.lit(0)))


def takeaways(candidates: Column, summary: Column, text: Column, most: int = 4) -> Column:
    """DIS-03: candidates, then the summary's sentences, then the text's, each once without regard to case, the first ``most``."""
    listed = F.concat(F.coalesce(candidates, F.array().cast("array<string>")), sentences(summary), sentences(text))
    clean = F.filter(F.transform(listed, lambda s: F.trim(s)), lambda s: F.coalesce(s != "", F.lit(False)))
    low = F.transform(clean, lambda s: F.lower(s))
    first = F.filter(clean, lambda s, i: F.array_position(low, F.lower(s)) == i + 1)
    return F.slice(first, 1, most)


def difficulty(text: Column) -> Column:
    """DIS-04: 1 to 5 from the mean length of sentences, the share of words of nine or more letters, and hard words."""
    n = F.size(sentences(text))
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(\p{L}+)"), 1)
    mean = F.size(words) / F.greatest(n, F.lit(1))
    long_ = F.size(F.filter(words, lambda w: F.length(w) >= 9)) / F.greatest(F.size(words), F.lit(1))
    low = F.lower(F.coalesce(text, F.lit("")))
    hard = sum((low.contains(w).cast("int") for w in COMPLEX_WORDS), F.lit(0))
    points = (mean > 18).cast("int") + (mean > 26).cast("int") + (long_ > 0.2).cast("int") + (long_ > 0.32).cast("int") + (hard >= 2).cast("int")
    return F.greatest(F.lit(1), F.least(F.lit(5), 1 + points))


def overlap_share(a: Column, b: Column) -> Column:
    """DIS-05: the share of the words of ``a`` that ``b`` has; 0 without words."""
    s, t = overlap_tokens(a), overlap_tokens(b)
    return F.when(F.size(s) > 0, F.size(F.array_intersect(s, t)) / F.size(s)).otherwise(F.lit(0.0))


def certainty(base: float, signals: Sequence[tuple[Column, float]]) -> Column:
    """DIS-06: a base and the points of the signals that hold, within .05 and .98."""
    out = F.lit(base)
    for holds, points in signals:
        out = out + F.when(F.coalesce(holds, F.lit(False)), F.lit(points)).otherwise(F.lit(0.0))
    return F.greatest(F.lit(0.05), F.least(F.lit(0.98), out))


def certainty_label(score: Column) -> Column:
    """DIS-06."""
    return F.when(score >= 0.82, "high").when(score >= 0.62, "medium").otherwise("low")


def without_boilerplate(text: Column, phrases: Sequence[str], most: int, otherwise: str) -> Column:
    """DIS-08: the text without the phrases, blanks squeezed, at most ``most`` characters at a word's end; a default if
    nothing is left."""
    out = F.coalesce(text, F.lit(""))
    for p in phrases:
        out = F.regexp_replace(out, r"(?i)" + "".join(f"\\{c}" if not c.isalnum() and not c.isspace() else c for c in p), " ")
    out = F.trim(F.regexp_replace(out, r"\s+", " "))
    cut = F.when(F.length(out) > most, F.regexp_replace(F.substring(out, 1, most), r"\s+\S*$", "")).otherwise(out)
    return F.when(cut != "", cut).otherwise(F.lit(otherwise))
