"""Text functions as column expressions; they stay inside whole-stage code generation unless said otherwise."""

from __future__ import annotations

import difflib
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.columns import is_missing, present

# Letters with a plain base letter, worked out from the Unicode decompositions.
_ACCENTED = [chr(c) for c in range(0xC0, 0x250) if (d := unicodedata.normalize("NFKD", chr(c))) and d[0].isascii() and d[0].isalpha() and len(d) > 1]
_BASES = "".join(unicodedata.normalize("NFKD", c)[0] for c in _ACCENTED)

#: Words that say nothing about a title.
TITLE_NOISE = "erratum|correction|supplementary|preprint|biorxiv|arxiv|extended version"


def ascii_fold(c: Column) -> Column:
    """Accents taken off; what then is not ASCII is dropped."""
    return F.regexp_replace(F.translate(F.coalesce(c, F.lit("")), "".join(_ACCENTED), _BASES), r"[^\x00-\x7F]", "")


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def normalize_title(c: Column) -> Column:
    """STR-01: folded lower case, preprint remarks and noise words out, only letters and digits; '' for NULL."""
    s = F.regexp_replace(F.lower(ascii_fold(present(c))), r"\(.*?preprint.*?\)", " ")
    s = F.regexp_replace(s, rf"\b({TITLE_NOISE})\b", " ")
    return squeeze(F.regexp_replace(s, r"[^a-z0-9\s]", " "))


def normalize_name(c: Column) -> Column:
    """STR-02."""
    return squeeze(F.regexp_replace(F.lower(ascii_fold(present(c))), r"[^a-z0-9\s]", " "))


def normalize_doi(c: Column) -> Column:
    """STR-03: the DOI from its ``10.`` on in lower case, without closing punctuation; '' if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.coalesce(c, F.lit("")), r"(10\.\d{4,9}\/\S+)", 1)), r"[\)\]\.,;:\"']+$", "")


def tokenize(c: Column, stop_words: tuple[str, ...] = (), least: int = 3) -> Column:
    """STR-12: words of letters, digits and inner hyphens, in order."""
    found = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"([a-z0-9][a-z0-9\-]+)"), 1)
    stops = F.array(*[F.lit(w) for w in stop_words]) if stop_words else F.array().cast("array<string>")
    return F.filter(found, lambda t: (F.length(t) >= least) & ~F.array_contains(stops, t))


def stem(t: Column) -> Column:
    """STR-13: the first suffix rule that applies."""
    n = F.length(t)
    less = lambda k: t.substr(F.lit(1), n - k)
    return (
        F.when((n > 6) & t.endswith("ation"), less(5)).when((n > 5) & t.endswith("ing"), less(3)).when((n > 4) & t.endswith("ed"), less(2))
        .when((n > 4) & t.endswith("ly"), less(2)).when((n > 5) & t.endswith("ment"), less(4)).when((n > 4) & t.endswith("ies"), F.concat(less(3), F.lit("y")))
        .when((n > 4) & t.endswith("s"), less(1)).otherwise(t)
    )


def stemmed_tokens(c: Column, stop_words: tuple[str, ...] = ()) -> Column:
    """STR-13: plain words, stemmed, stop words taken out before and after."""
    plain = F.split(squeeze(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^a-z0-9\s]", " ")), " ")
    stops = F.array(*[F.lit(w) for w in stop_words]) if stop_words else F.array().cast("array<string>")
    keep = lambda t: (F.length(t) > 1) & ~F.array_contains(stops, t)
    return F.filter(F.transform(F.filter(plain, keep), stem), keep)


def overlap_tokens(c: Column) -> Column:
    """STR-15: the set of words of three or more letters."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"([a-z]{3,})"), 1))


def sentences(c: Column) -> Column:
    """STR-16."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"(?<=[.!?])\s+"), lambda s: F.trim(s)), lambda s: s != "")


def strip_html(c: Column) -> Column:
    """STR-17: without scripts, styles and tags; common entities resolved."""
    s = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?is)<(script|style)[^>]*>.*?<\/\1>", " ")
    s = F.regexp_replace(s, r"(?s)<[^>]+>", " ")
    for entity, plain in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        s = F.replace(s, F.lit(entity), F.lit(plain))
    return squeeze(s)


def term_hits(c: Column, terms: tuple[str, ...]) -> Column:
    """STR-05: how many of the terms the text contains, as substrings."""
    low = F.lower(F.coalesce(c, F.lit("")))
    return sum((low.contains(t).cast("int") for t in terms), F.lit(0))


def first_most_hits(c: Column, categories: dict[str, tuple[str, ...]], default: str) -> Column:
    """STR-07: the category with most hits; of equals the first; the default without hits."""
    hits = {k: term_hits(c, v) for k, v in categories.items()}
    best = F.greatest(*hits.values(), F.lit(0)) if len(hits) else F.lit(0)
    out = F.when(best == 0, F.lit(default))
    for k, h in hits.items():
        out = out.when(h == best, F.lit(k))
    return out


def topic_code(c: Column) -> Column:
    """STR-10: TOPIC-nn anywhere in the text, in upper case; or a legacy Tn, TnB. NULL if there is none."""
    text = F.coalesce(c, F.lit(""))
    full = F.regexp_extract(F.upper(text), r"(TOPIC-\d+)", 1)
    legacy, letter = F.regexp_extract(text, r"(?i)\bT(\d{1,2})([A-Za-z]?)\b", 1), F.lower(F.regexp_extract(text, r"(?i)\bT(\d{1,2})([A-Za-z]?)\b", 2))
    return F.when(full != "", full).when((legacy != "") & (letter == ""), F.concat(F.lit("TOPIC-"), F.lpad(legacy, 2, "0"))).when(legacy != "", F.concat(F.lit("T"), legacy, letter))


def truth(c: Column) -> Column:
    """A tolerant boolean from text: 1, true, yes, y, t. All else, NULL too, is false."""
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("1", "true", "yes", "y", "t"), F.lit(False))


def safe_int(c: Column, default: int | None = 0) -> Column:
    """PRJ-12: truncated number, the default if it is none."""
    return F.coalesce(F.expr("0L") + F.when(F.isnan(F.coalesce(c.try_cast("double"), F.lit(float("nan")))), None).otherwise(c.try_cast("double")).cast("bigint"), F.lit(default).cast("bigint"))


def split_list(c: Column, mark: str = ";") -> Column:
    """ARR-02: trimmed parts without blanks."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), re.escape(mark)), lambda x: F.trim(x)), lambda x: ~is_missing(x))


def json_list(c: Column) -> Column:
    """ARR-03: a JSON list of text; other text becomes a list of itself; missing text an empty one."""
    parsed = F.from_json(c, "array<string>", {"mode": "PERMISSIVE"})
    return F.when(is_missing(c), F.array().cast("array<string>")).otherwise(F.coalesce(F.when(F.trim(c).startswith("["), parsed), F.array(c)))


def json_object_in(c: Column) -> Column:
    """ARR-05: the text from the first brace to the last; NULL if there is none."""
    return F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), r"(?s)(\{.*\})", 1), F.lit(""))


def invert_index(positions: Column) -> Column:
    """ARR-01: a map of word -> positions, back to text."""
    placed = F.flatten(F.transform(F.map_entries(positions), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    return F.coalesce(F.array_join(F.transform(F.array_sort(placed), lambda x: x["w"]), " "), F.lit(""))


def redact(c: Column, keys: tuple[str, ...] = ("api_key", "key", "token", "mailto")) -> Column:
    """STR-21: values of secret query parameters are masked."""
    return F.regexp_replace(c, rf"(?i)([?&](?:{'|'.join(keys)})=)[^&\s]+", "$1***")


def duration(seconds: Column) -> Column:
    """STR-27: H:MM:SS."""
    s = F.round(seconds).cast("bigint")
    return F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)


def slug(c: Column) -> Column:
    """PRJ-19: lower case letters and digits joined by hyphens."""
    return F.regexp_replace(F.regexp_replace(F.lower(ascii_fold(c)), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def bibtex_escape(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"([{}&%$#_])", r"\\$1")


def letter_counts(c: Column) -> Column:
    """How often each letter, digit and blank stands in a plain text, and last how many other characters it has."""
    n = F.length(c)
    some = F.array(*[n - F.length(F.replace(c, F.lit(x), F.lit(""))) for x in "abcdefghijklmnopqrstuvwxyz0123456789 "])
    return F.concat(some, F.array(n - F.aggregate(some, F.lit(0), lambda x, y: x + y)))


def may_match(a: Column, b: Column, la: Column, lb: Column, least: float) -> Column:
    """Whether texts with these letter counts and lengths can have twice their common subsequence, or their matching
    blocks, at ``least`` of both lengths: letters in common, in any order, are no fewer."""
    common = F.aggregate(F.zip_with(a, b, lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y)
    return 2 * common >= least * (la + lb)


def length_ranges(n: Column, least: float, width: int = 16) -> Column:
    """The ranges of ``width`` lengths in which a text lies that matches one of ``n`` characters at ``least``."""
    bound = least / (2 - least)
    return F.sequence(F.floor(n * bound / width), F.floor(n / bound / width))


# --- similarities that have no built-in form: Arrow UDFs ---------------------------------------------------------


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel addition."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        hit = row & where.get(y, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - bin(row).count("1")


def indel_ratio(a: str, b: str) -> float:
    """0..100: twice the longest common subsequence over both lengths; 100 for two empty texts."""
    n = len(a) + len(b)
    return 100.0 if n == 0 else 200.0 * _lcs(a, b) / n


def token_sort(a: str, b: str) -> float:
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    p, q = " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not p or not q):
        return 100.0
    left, right = (both + " " + p).strip(), (both + " " + q).strip()
    out = indel_ratio(left, right)
    return max(out, indel_ratio(both, left), indel_ratio(both, right)) if both else out


def _pairs(fn):
    def apply(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else fn(x, y) for x, y in zip(a, b)], dtype="float64")

    apply.__annotations__ = {"a": pd.Series, "b": pd.Series, "return": pd.Series}
    return F.pandas_udf(apply, T.DoubleType())


def token_sort_ratio(a: Column, b: Column) -> Column:
    """STR-18."""
    return _pairs(token_sort)(a, b)


def token_set_ratio(a: Column, b: Column) -> Column:
    """STR-19."""
    return _pairs(token_set)(a, b)


def sequence_ratio(a: Column, b: Column) -> Column:
    """STR-20: matching blocks of both texts over their lengths."""
    return _pairs(lambda x, y: difflib.SequenceMatcher(None, x, y).ratio())(a, b)
