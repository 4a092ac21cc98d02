"""Entity resolution by blocking and pivots (section 2.10), and matching of records to candidates."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.text import length_ranges, letter_counts, may_match, normalize_name, normalize_title, token_sort_ratio
from plumbline.operators.graph import components
from plumbline.session import cut


def candidate_links(df: DataFrame, threshold: float = 85.0, max_year_delta: int = 2, least_words: int = 4) -> DataFrame:
    """DED-01, DED-03, JON-15: all links ``i < j`` between records of one block that match.

    ``df``: ord, doi, title, year, author. Same DOI always matches. Fuzzy matches compare distinct (author, title, year)
    within an author's block. Years may be missing. Every pair of a block stands in the result; ``resolve_records`` gets
    the same clusters without the pairs.
    """
    records, kin = _blocks(df, threshold, max_year_delta, least_words)
    i, j = (records.select(F.col("ord").alias(x), F.col("doi").alias(f"doi_{x}"), F.col("rep").alias(f"rep_{x}")) for x in "ij")
    same = i.join(j, F.col("doi_i") == F.col("doi_j")).select("i", "j")
    alike = i.join(kin, F.col("rep_i") == F.col("rep")).join(j, F.col("other") == F.col("rep_j")).select("i", "j")
    return same.unionByName(alike).where("i < j").distinct()


def _blocks(df: DataFrame, threshold: float, max_year_delta: int, least_words: int) -> tuple[DataFrame, DataFrame]:
    """``ord, doi, rep`` of all records, and ``rep, other`` both ways for what matches without a DOI.

    ``rep`` is the first record with the same (author, title, year), and NULL where these cannot match.
    """
    base = df.select(
        "ord", F.nullif(F.lower(F.trim("doi")), F.lit("")).alias("doi"), normalize_title(F.col("title")).alias("title"), "year", F.nullif(normalize_name(F.col("author")), F.lit("")).alias("author")
    )
    base = cut(base)
    long = base.where((F.size(F.split("title", " ")) >= least_words) & F.col("author").isNotNull())
    reps = cut(long.groupBy("author", "title", "year").agg(F.min("ord").alias("rep")))
    of = long.alias("l").join(reps.alias("r"), (F.col("l.author") == F.col("r.author")) & (F.col("l.title") == F.col("r.title")) & F.col("l.year").eqNullSafe(F.col("r.year"))).select("ord", "rep")
    a, b = reps.alias("a"), reps.alias("b")
    years = _years_ok(F.col("a.year"), F.col("b.year"), max_year_delta)
    both = [F.col("a.rep").alias("rep"), F.col("b.rep").alias("other")]
    exact = a.join(b, (F.col("a.author") == F.col("b.author")) & (F.col("a.title") == F.col("b.title"))).where(years).select(*both)
    # titles at this similarity have lengths within a bounded factor and enough letters in common: an author's titles meet
    # by ranges of length, and few pairs are compared in full
    least = threshold / 100
    bags = reps.withColumn("bag", letter_counts(F.col("title"))).withColumn("n", F.length("title"))
    a, b = bags.withColumn("range", F.explode(length_ranges(F.col("n"), least))).alias("a"), bags.withColumn("range", F.floor(F.col("n") / 16)).alias("b")
    near = a.join(b, (F.col("a.author") == F.col("b.author")) & (F.col("a.range") == F.col("b.range")) & (F.col("a.rep") < F.col("b.rep")) & (F.col("a.title") != F.col("b.title")))
    near = near.where(years).where(may_match(F.col("a.bag"), F.col("b.bag"), F.col("a.n"), F.col("b.n"), least))
    fuzzy = cut(near.where(token_sort_ratio(F.col("a.title"), F.col("b.title")) >= threshold).select(*both))
    kin = exact.unionByName(fuzzy).unionByName(fuzzy.select(F.col("other").alias("rep"), F.col("rep").alias("other")))
    return cut(base.select("ord", "doi").join(of, "ord", "left")), cut(kin)


def _first_near(records: DataFrame, members: DataFrame, kin: DataFrame) -> DataFrame:
    """``ord, doi, rep`` and the smallest of ``members`` in a record's blocks or itself, ``near``; NULL if there is none."""
    by_doi = members.where("doi is not null").groupBy("doi").agg(F.min("ord").alias("m"))
    by_rep = members.where("rep is not null").groupBy(F.col("rep").alias("other")).agg(F.min("ord").alias("n"))
    by_kin = kin.join(by_rep, "other").groupBy("rep").agg(F.min("n").alias("n"))
    return records.join(by_doi, "doi", "left").join(by_kin, "rep", "left").select("ord", "doi", "rep", F.least("m", "n").alias("near"))


def resolve_records(df: DataFrame, threshold: float = 85.0, max_year_delta: int = 2, least_words: int = 4) -> DataFrame:
    """DED-01 to DED-03: ``ord, pivot`` as ``pivot_clusters`` gives over all ``candidate_links``.

    Worked out in rounds over blocks, so the records of a block are never paired: an undecided record that is the first
    one of its DOI and of all it matches is a pivot, and all undecided records near it are taken. Each round decides at
    least the first record left; rounds go on until none is left.
    """
    records, kin = _blocks(df, threshold, max_year_delta, least_words)
    left, pivots = records.where("doi is not null or rep is not null"), None
    while not left.isEmpty():
        new = cut(_first_near(left, left, kin).where("ord = near").select("ord", "doi", "rep"))
        pivots = new if pivots is None else pivots.unionByName(new)
        left = cut(_first_near(left, new, kin).where("near is null").select("ord", "doi", "rep"))
    if pivots is None:
        return records.select("ord", F.col("ord").alias("pivot"))
    # a record belongs to the first pivot that it is linked to
    return _first_near(records, pivots, kin).select("ord", F.coalesce("near", "ord").alias("pivot"))


def _years_ok(a: Column, b: Column, delta: int) -> Column:
    return a.isNull() | b.isNull() | (F.abs(a - b) <= delta)


def pivot_clusters(links: DataFrame, ids: DataFrame, rounds: int = 24) -> DataFrame:
    """DED-02: in order, every record not yet taken is a pivot that takes all later records linked to it.

    ``ids``: ord. Result: ord, pivot. Worked out in rounds over all records at once: a record without an undecided
    earlier neighbour is a pivot, and takes its later neighbours; what is decided leaves the links. A group of any size
    around one record is done in one round. What chains of links are left after ``rounds``, each far longer than that,
    are worked through one connected component at a time.
    """
    whole = left = cut(links.select("i", "j"))
    taken = None  # records that are no pivots
    for _ in range(rounds):
        if left.isEmpty():
            break
        pivots = left.select(F.col("i").alias("ord")).distinct().join(left.select(F.col("j").alias("ord")), "ord", "left_anti")
        got = cut(left.join(pivots.withColumnRenamed("ord", "i"), "i", "left_semi").select(F.col("j").alias("ord")).distinct())
        taken = got if taken is None else taken.unionByName(got)
        gone = got.unionByName(pivots)
        left = cut(left.join(gone.withColumnRenamed("ord", "i"), "i", "left_anti").join(gone.withColumnRenamed("ord", "j"), "j", "left_anti").select("i", "j"))
    if taken is None:
        return ids.select("ord", F.col("ord").alias("pivot"))
    if not left.isEmpty():
        comp = components(left.select(F.col("i").alias("src"), F.col("j").alias("dst")))
        work = left.join(comp, F.col("i") == F.col("id")).select("component", "i", "j")
        taken = taken.unionByName(work.groupBy("component").applyInPandas(_in_order, "ord bigint, pivot bigint").where("ord <> pivot").select("ord"))
    # a record belongs to the first pivot that it is linked to
    heads = whole.join(taken.withColumnRenamed("ord", "i"), "i", "left_anti").groupBy(F.col("j").alias("ord")).agg(F.min("i").alias("pivot"))
    return ids.select("ord").join(heads, "ord", "left").select("ord", F.coalesce("pivot", "ord").alias("pivot"))


def _in_order(pdf: pd.DataFrame) -> pd.DataFrame:
    later: dict[int, list[int]] = {}
    for i, j in zip(pdf["i"], pdf["j"]):
        later.setdefault(int(i), []).append(int(j))
    pivot: dict[int, int] = {}
    for i in sorted({*later, *(j for js in later.values() for j in js)}):
        if i not in pivot:
            pivot[i] = i
            for j in later.get(i, ()):
                pivot.setdefault(j, i)
    return pd.DataFrame({"ord": list(pivot), "pivot": list(pivot.values())}, dtype="int64")


def canonical_id(doi: Column, title: Column, year: Column) -> Column:
    """DED-05."""
    key = F.when(F.coalesce(doi, F.lit("")) != "", doi).otherwise(title)
    return F.md5(F.concat(F.lit("canonical||"), F.coalesce(key, F.lit("")), F.lit("||"), F.coalesce(year.cast("string"), F.lit(""))))
