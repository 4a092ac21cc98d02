"""Ranked text retrieval over posting frames (token, doc, tf)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.learning import head_per_group


def postings(df: DataFrame, ident: str, tokens: Column) -> DataFrame:
    """IR-01: ``token, doc, tf``."""
    return df.select(F.col(ident).alias("doc"), F.explode(tokens).alias("token")).groupBy("token", "doc").agg(F.count(F.lit(1)).alias("tf"))


def idf(post: DataFrame, docs: int) -> DataFrame:
    """AGG-27: ln((N + 1) / (df + 1)) + 1."""
    return post.groupBy("token").agg(F.count(F.lit(1)).alias("df")).withColumn("idf", F.log(F.lit(docs + 1.0) / (F.col("df") + 1)) + 1)


def tfidf_scores(post: DataFrame, queries: DataFrame, docs: int) -> DataFrame:
    """IR-02: ``query, doc, score`` for every document that shares a token with a query.

    ``queries``: query, token, qtf. Only the postings of query tokens are touched, and their weights are one small
    join; scores are partial sums.
    """
    wanted = post.join(queries.select("token").distinct(), "token", "left_semi")
    weight = queries.join(idf(wanted, docs), "token").select("query", "token", ((1 + F.log(F.col("qtf").cast("double"))) * F.col("idf")).alias("w"))
    hits = wanted.join(weight, "token")
    return hits.groupBy("query", "doc").agg(F.sum(F.col("w") * (1 + F.log(F.col("tf").cast("double")))).alias("score"))


def bm25_scores(fields: DataFrame, query_terms: Sequence[str], weights: Mapping[str, float], k1: float = 1.35, b: float = 0.72) -> DataFrame:
    """IR-04: field-weighted BM25: ``doc, score``.

    ``fields``: doc, field, tokens (arrays). Field lengths (1 at least) and their means are over all documents; a term's
    document frequency counts documents with the term in any field.
    """
    terms = sorted(set(query_terms))
    lengths = fields.select("doc", "field", F.greatest(F.size("tokens"), F.lit(1)).alias("len"), F.filter("tokens", lambda t: t.isin(*terms)).alias("hits"))
    mean = lengths.groupBy("field").agg(F.avg("len").alias("mean"))
    tf = lengths.where(F.size("hits") > 0).select("doc", "field", "len", F.explode("hits").alias("token")).groupBy("doc", "field", "len", "token").agg(F.count(F.lit(1)).alias("tf"))
    n = fields.agg(F.count_distinct("doc").alias("n"))
    df = tf.select("token", "doc").distinct().groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    idf_ = df.crossJoin(F.broadcast(n)).select("token", F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    weight = F.create_map(*[x for f, w in weights.items() for x in (F.lit(f), F.lit(w))])
    part = F.col("idf") * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("len") / F.col("mean")))
    scored = tf.join(F.broadcast(idf_), "token").join(F.broadcast(mean), "field").withColumn("s", part * F.coalesce(weight[F.col("field")], F.lit(0.0)))
    return scored.groupBy("doc").agg(F.sum("s").alias("score"))


def relative_cut(scores: DataFrame, least: float, share: float, limit: int, order: Sequence[Column]) -> DataFrame:
    """SRT-09: scores of at least ``least`` and ``share`` of the best, the first ``limit``."""
    best = scores.agg(F.max("score").alias("best"))
    return scores.crossJoin(F.broadcast(best)).where((F.col("score") >= least) & (F.col("score") >= share * F.col("best"))).drop("best").orderBy(*order).limit(limit)


def substring_search(df: DataFrame, field: Column, needle: str, order: Sequence[Column], limit: int = 20) -> DataFrame:
    """IR-05: rows that contain the text: exact first, then beginnings, then the given order."""
    low, n = F.lower(F.coalesce(field, F.lit(""))), needle.lower()
    return df.where(low.contains(n)).orderBy((low == n).desc(), low.startswith(n).desc(), *order).limit(limit)


def phrase_bonus(title: Column, text: Column, query: str, in_title: float = 4.5, in_text: float = 2.4) -> Column:
    return F.when(F.lower(title).contains(query), F.lit(in_title)).otherwise(0.0) + F.when(F.lower(text).contains(query), F.lit(in_text)).otherwise(0.0)


def diversified(scores: DataFrame, group: str, order: Sequence[Column], per_group: int, limit: int) -> DataFrame:
    """IR-02 tail: the first ``limit`` with at most ``per_group`` of each group and query; blank groups uncapped."""
    blank = F.coalesce(F.col(group), F.lit("")) == ""
    few = head_per_group(scores.where(~blank), ["query", group], order, per_group, "k").drop("k")
    return head_per_group(few.unionByName(scores.where(blank)), ["query"], order, limit)
