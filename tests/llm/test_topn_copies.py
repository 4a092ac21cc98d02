import random

from pyspark.sql import functions as F

from plumbline.llm.copies import canonical_key, copies, copy_pairs, sort_key
from plumbline.llm.topn import latest_per_key, top_n_per_group


def test_top_n_against_brute_force(spark):
    random.seed(1)
    rows = [(random.choice("ab") if random.random() < 0.9 else None, random.choice([None, 1.0, 2.0, 3.0]), i % 50, "x") for i in range(400)]
    df = spark.createDataFrame(rows, "g string, score double, id int, salt string")
    order = [F.desc_nulls_last("score"), F.asc("id")]
    got = sorted((r.g or "", r.rank_no, r.score or 0, r.id) for r in top_n_per_group(df, ["g"], order, 3, ["id"], salts=4).collect())
    want = []
    for g in {r[0] for r in rows}:
        best = sorted((r for r in rows if r[0] == g), key=lambda r: (-(r[1] or 0), r[2]))[:3]
        want += [(g or "", k, r[1] or 0, r[2]) for k, r in enumerate(best, 1)]
    assert got == sorted(want)


def test_top_n_edges(spark):
    df = spark.createDataFrame([("a", 1.0, 7, 0)], "g string, score double, id int, rank_no int")
    assert top_n_per_group(df, ["g"], [F.desc("score")], 5, ["id"]).collect()[0].rank_no == 1
    assert top_n_per_group(df.limit(0), ["g"], [F.desc("score")], 5, ["id"]).count() == 0


def test_latest_per_key(spark):
    rows = [("p", 1, 5, "a"), ("p", 2, 9, "b"), ("p", 2, 3, "c"), ("q", None, 1, "d"), (None, 4, 1, "e")]
    df = spark.createDataFrame(rows, "k string, t int, id int, newest string")
    assert sorted(map(tuple, latest_per_key(df, "k", "t", "id", ["newest"]).collect())) == [("p", "c"), ("q", "d")]


def test_copies_by_brute_force_over_partitions(spark):
    random.seed(3)
    titles = ["Alpha beta", "ALPHA-BETA!", " alpha  Beta", "Gamma", "gamma.", None, "nan", "10.5555/x.1", "Hot"]
    dois = [None, "", "nan", "10.5555/X.1", "https://doi.example/10.5555/x.1", "DOI: 10.5555/x.1.", "Gamma"]
    rows = [(i, random.choice(titles) if i % 3 else "Hot", random.choice(dois) if i % 3 else None, "k") for i in range(900)]
    df = spark.createDataFrame(rows, "id bigint, title string, doi string, key string").repartition(7)
    key = canonical_key(F.col("title"), F.col("doi"))
    keyed = {r.id: r.k for r in df.select("id", key.alias("k")).collect()}
    groups = {}
    for i, k in keyed.items():
        if k is not None:
            groups.setdefault(k, []).append(i)
    want = sorted((min(g), i) for g in groups.values() for i in g if i != min(g))
    assert sorted(map(tuple, copy_pairs(df, key, "id").collect())) == want
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:  # small batches: runs go over batches and partitions
        assert sorted(map(tuple, copy_pairs(df, key, "id").collect())) == want
        assert sorted(map(tuple, copies(df, key, "id").collect())) == sorted((min(g), len(g)) for g in groups.values())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_copy_keys(spark):
    rows = [("Title one", "10.5555/ab", 1), ("TITLE—one", "http://dx.example/10.5555/AB", 2), ("10.5555/ab", "Title one", 3), ("Title one", None, 4), (None, "Title one", 5), (None, "10.5555/ab", 6), (None, None, 7)]
    df = spark.createDataFrame(rows, "t string, d string, i int")
    k = [r.k for r in df.select(canonical_key(F.col("t"), F.col("d")).alias("k"), "i").orderBy("i").collect()]
    assert k[0] == k[1] == k[2] and k[3] == k[4] and k[0] != k[3] and k[5] is None and k[6] is None
    assert copies(df.limit(0), canonical_key(F.col("t"), F.col("d")), "i").count() == 0
    assert copies(df.withColumn("t", F.lit("x" * 100_000)), canonical_key(F.col("t"), F.lit(None).cast("string")), "i").collect()[0].copies == 7
    any_order = spark.createDataFrame([("A b", "C"), ("c.", "a-B")], "x string, y string").select(sort_key([F.col("x"), F.col("y")]).alias("k")).distinct()
    assert any_order.count() == 1
