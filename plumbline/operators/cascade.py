"""Values from several sources in turn, best records by key, exact and then fuzzy matching, balanced categories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import col, is_missing
from plumbline.functions.text import length_ranges, letter_counts, may_match, sequence_ratio, token_sort_ratio


def first_source(df: DataFrame, ident: str, sources: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """ABS-01, DIS-01: for every row the text of the first source that has one: ``ident, text, source`` (NULL and ``none``
    where no source does). Each source: ident, text.

    All sources become one table of offers, of which an aggregate keeps the first of each key, so any number of sources
    is one shuffle. Of several texts in a source the longest is taken, then the smallest.
    """
    offers = None
    for k, (name, s) in enumerate(sources):
        part = s.select(col(ident).alias("k"), F.lit(k).alias("o"), F.lit(name).alias("source"), F.col("text")).where(~is_missing(F.col("text")))
        offers = part if offers is None else offers.unionByName(part)
    best = offers.groupBy("k").agg(F.min_by(F.struct("source", "text"), F.struct("o", -F.length("text"), "text")).alias("b"))
    keys = df.select(col(ident)).distinct()
    return keys.join(best, col(ident) == F.col("k"), "left").select(col(ident), F.col("b.text").alias("text"), F.coalesce("b.source", F.lit("none")).alias("source"))


def best_record(wanted: DataFrame, records: DataFrame, key: str, least: float = 90.0) -> DataFrame:
    """ABS-03, JON-17: of the records with the same key the one whose title is most like the wanted one, if like enough:
    ``id, record, similarity``; the smallest record of equals. ``wanted``: id, key, title. ``records``: record, key, title.

    Only titles whose lengths allow ``least`` are compared.
    """
    bound = least / (200 - least)
    pairs = wanted.select("id", key, F.col("title").alias("a")).join(records.select("record", key, F.col("title").alias("b")), key)
    fit = pairs.where((F.length("a") >= bound * F.length("b")) & (F.length("b") >= bound * F.length("a")))
    scored = fit.withColumn("similarity", F.round(token_sort_ratio(F.col("a"), F.col("b")), 6)).where(F.col("similarity") >= least)
    return scored.groupBy("id").agg(F.min(F.struct((-F.col("similarity")).alias("n"), "record")).alias("b")).select("id", "b.record", (-F.col("b.n")).alias("similarity"))


def scored_matches(wanted: DataFrame, works: DataFrame, key: str, least: float = 85.0, most_years: int = 3) -> DataFrame:
    """JON-16: of a wanted record's candidates (same ``key``) the best by similarity of titles, with points for the year
    (4 for the same, 2 for the next, else up to 24 off, 6 a year) and 2.5 for the same author: ``id, work, score``.

    Candidates must be like enough and near enough in years, where both are known. ``wanted``: id, key, title, year,
    author; ``works``: work and the same.
    """
    a = wanted.select("id", key, F.col("title").alias("ta"), F.col("year").alias("ya"), F.col("author").alias("aa"))
    b = works.select("work", key, F.col("title").alias("tb"), F.col("year").alias("yb"), F.col("author").alias("ab"))
    apart = F.abs(F.col("ya") - F.col("yb"))
    pairs = a.join(b, key).where(F.coalesce(apart <= most_years, F.lit(True))).withColumn("sim", token_sort_ratio(F.col("ta"), F.col("tb"))).where(F.col("sim") >= least)
    years = F.when(apart == 0, 4.0).when(apart == 1, 2.0).when(apart.isNotNull(), -F.least(F.lit(24.0), 6.0 * apart)).otherwise(0.0)
    score = F.round(F.col("sim") + years + F.when(F.coalesce(F.lower("aa") == F.lower("ab"), F.lit(False)), 2.5).otherwise(0.0), 6)
    return pairs.withColumn("score", score).groupBy("id").agg(F.min(F.struct((-F.col("score")).alias("n"), "work")).alias("b")).select("id", "b.work", (-F.col("b.n")).alias("score"))


def title_cascade(wanted: DataFrame, works: DataFrame, least: float = 0.82, most_years: int = 3) -> DataFrame:
    """JON-18: matched by DOI, else by equal title, else by the most similar title: ``id, how, work``; years, where both
    are known, at most ``most_years`` apart for titles. ``wanted``: id, doi, title, year. ``works``: work, doi, title, year.

    ``wanted`` is a stated set of records, met with all works. Titles that match at ``least`` have lengths within a bounded
    factor, so they are joined by ranges of length; letters that they share in any order bound what they share in
    order, so few pairs are compared in full, and none that could match is left out. Distinct titles are compared once.
    """
    near = F.coalesce(F.abs(F.col("ya") - F.col("yb")) <= most_years, F.lit(True))
    a = wanted.select("id", F.col("doi").alias("da"), F.col("title").alias("ta"), F.col("year").alias("ya"))
    b = works.select("work", F.col("doi").alias("db"), F.col("title").alias("tb"), F.col("year").alias("yb"))
    one = a.join(b, (F.col("da") == F.col("db")) & (F.col("da") != "")).select("id", F.lit(1).alias("how"), F.lit(0.0).alias("far"), "work")
    two = a.join(b, (F.col("ta") == F.col("tb")) & (F.col("ta") != "")).where(near).select("id", F.lit(2).alias("how"), F.lit(0.0).alias("far"), "work")
    titles = lambda df, t: df.select(t).where(F.col(t) != "").distinct().select(t, letter_counts(F.col(t)).alias(f"{t}_bag"))
    n, m = F.length("ta"), F.length("tb")
    pairs = titles(a, "ta").withColumn("range", F.explode(length_ranges(n, least))).join(titles(b, "tb").withColumn("range", F.floor(m / 16)), "range").where("ta <> tb")
    pairs = pairs.where(may_match(F.col("ta_bag"), F.col("tb_bag"), n, m, least)).withColumn("sim", sequence_ratio(F.col("ta"), F.col("tb"))).where(F.col("sim") >= least).select("ta", "tb", "sim")
    three = a.join(pairs, "ta").join(b, "tb").where(near).select("id", F.lit(3).alias("how"), (-F.round("sim", 9)).alias("far"), "work")
    best = one.unionByName(two).unionByName(three).groupBy("id").agg(F.min(F.struct("how", "far", "work")).alias("b"))
    return best.select("id", "b.how", "b.work")


def rebalanced(df: DataFrame, category: str, ident: str, score: str, chosen: Column, eligible: Column, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """SEL-01: the chosen rows after trimming and promoting: ``df``'s rows that are in.

    A category above its greatest share of the chosen rows loses its lowest scores; one below its least share of what
    then is chosen gets its best eligible rows. Only counts of the categories in ``bounds`` reach the driver; the rows
    that go or come are ranked in two stages, so a category of any size is no task's own.
    """
    marked = df.withColumn("in__", F.coalesce(chosen, F.lit(False))).withColumn("may__", F.coalesce(eligible, F.lit(False)))
    counts = {r[0]: r[1] for r in marked.where("in__").where(col(category).isin(*bounds)).groupBy(col(category)).agg(F.count(F.lit(1))).collect()}
    total = marked.where("in__").count()
    out = {g: max(0, counts.get(g, 0) - int(total * most)) for g, (_, most) in bounds.items()}
    after = total - sum(out.values())
    come = {g: max(0, -int(-round(after * least, 9) // 1) - (counts.get(g, 0) - out[g])) for g, (least, _) in bounds.items()}
    gone, new = None, None
    for g in bounds:  # one small ranking a bound
        if out[g]:
            rows = marked.where(col(category) == g).where("in__").orderBy(col(score).asc_nulls_first(), col(ident).desc()).limit(out[g]).select(ident)
            gone = rows if gone is None else gone.unionByName(rows)
        if come[g]:
            rows = marked.where(col(category) == g).where("not in__ and may__").orderBy(col(score).desc_nulls_last(), col(ident).asc()).limit(come[g]).select(ident)
            new = rows if new is None else new.unionByName(rows)
    kept = marked.where("in__")
    kept = kept if gone is None else kept.join(gone, ident, "left_anti")
    added = None if new is None else marked.join(new, ident, "left_semi")
    return (kept if added is None else kept.unionByName(added.select(*kept.columns))).drop("in__", "may__")
