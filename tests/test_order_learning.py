import random

import pytest
from pyspark.sql import functions as F

from plumbline.functions import scoring as S
from plumbline.operators import learning as L
from plumbline.operators.aggregates import quantiles
from plumbline.operators.order import global_position, running_total
from plumbline.operators.windows import percentile_ranks


def test_running_totals_over_partitions(spark):
    rng = random.Random(3)
    rows = [(rng.choice("aab"), i, rng.randrange(5) if i % 9 else None, "x") for i in range(500)]
    df = spark.createDataFrame(rows, "part string, id bigint, within bigint, step string").repartition(5)
    got = {r.id: r.total for r in running_total(df, ["part", "id"], "within", "total", 7).collect()}
    total = 0
    for _, i, v, _ in sorted(rows, key=lambda r: (r[0], r[1])):
        total += v or 0
        assert got[i] == total
    place = {r.id: r.at for r in global_position(df, ["part", "id"], "at", 6).collect()}
    assert [place[r[1]] for r in sorted(rows, key=lambda r: (r[0], r[1]))] == list(range(500))
    assert global_position(df.limit(0), ["id"], "at").count() == 0


def test_ranks_and_quantiles(spark):
    rows = [(g, v) for g, vs in {"a": [1.0, 2.0, 2.0, 9.0], "b": [5.0], None: [3.0, 4.0]}.items() for v in vs] + [("c", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.q, r.m) for r in quantiles(df, ["g"], "v", [0.7, 0.5], ["q", "m"]).collect()}
    assert got == {"a": pytest.approx((2.7, 2.0)), "b": (5.0, 5.0), None: pytest.approx((3.7, 3.5))}
    assert quantiles(df, [], "v", [0.0, 1.0], ["lo", "hi"]).collect()[0] == (1.0, 9.0)
    ranks = {(r.g, r.v): r.r for r in percentile_ranks(df, "v", "r").collect()}
    assert ranks["a", 2.0] == pytest.approx(2.5 / 7) and ranks["a", 9.0] == 1 and ranks["c", None] is None


def test_heads_of_hot_groups(spark):
    df = spark.range(3000).select(F.lit("hot").alias("g"), "id", (F.col("id") % 50).alias("s"))
    got = [(r.id, r.rank_no) for r in L.head_per_group(df, ["g"], [F.desc("s"), F.asc("id")], 3).orderBy("rank_no").collect()]
    assert got == [(49, 1), (99, 2), (149, 3)]


def test_layouts(spark):
    parents = spark.createDataFrame([(1, None), (2, 1), (3, 1), (4, 3), (5, 3), (8, 9), (9, 8)], "id bigint, parent bigint")
    got = {r.id: (r.depth, r.x) for r in L.tree_layout(parents).collect()}
    assert got == {1: (0, 1.0), 2: (1, 0.0), 3: (1, 1.5), 4: (2, 1.0), 5: (2, 2.0)}  # a cycle has no place
    nodes = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, 1)], "id bigint, layer int")
    edges = spark.createDataFrame([(1, 4), (2, 3)], "src bigint, dst bigint")
    got = {r.id: r.y for r in L.barycentre_layout(nodes, edges, 2).collect()}
    assert (got[1] < got[2]) == (got[4] < got[3])
    layered = spark.createDataFrame([(1, 0, 1.0), (2, 1, 0.0), (3, 1, 2.0), (4, 1, 5.0), (5, 2, 1.0)], "id bigint, l int, y double")
    assert {r.id: r.nearest for r in L.nearest_in_layer(layered, "l", "y").collect()} == {1: 2, 2: 5, 3: 5, 4: 5}


def test_scores(spark):
    df = spark.createDataFrame([(1, "Gait and gait risk", 4, None), (2, None, 0, True)], "id int, t string, n int, k boolean")
    row = {r.id: r for r in df.select("id", F.array_join(S.expanded(F.split(F.lower(F.coalesce("t", F.lit("x"))), " "), {"gait": ("walking",), "risk": ("hazard", "gait")}), " ").alias("q"), S.adjusted(F.col("n"), [(F.col("k"), 2.0), (F.col("n") > 3, 1.5)]).alias("s"), S.first_number(F.col("t")).alias("f"), S.last_word(F.col("t")).alias("w"), S.tags(F.col("t"), {"a": ("risk",), "b": ("zzz",)}).alias("g")).collect()}
    assert row[1].q == "gait walking and risk hazard" and row[1].s == 6.0 and row[1].f is None and row[1].w == "risk" and row[1].g == ["a"]
    assert row[2].s == 0 and row[2].w is None and row[2].g == []
    assert S.shares_of_greatest(df, {"n": 1.0}, "b").select("b").orderBy("id").collect() == [(1.0,), (0.0,)]
    assert [tuple(r) for r in S.stage_counts(df, [("a", F.col("n") > 0), ("b", F.col("k"))]).collect()] == [("a", 1, 1), ("b", 0, 1)]
    assert S.stage_counts(df.limit(0), [("a", F.col("n") > 0)]).collect()[0].kept == 0
    notes = spark.createDataFrame([("x NOTE: one\n two END y",), (None,)], "t string")
    assert [r[0] for r in notes.select(S.note_after(F.col("t"), "NOTE:", "END")).collect()] == ["one two", None]
    lists = spark.createDataFrame([('[{"term":"a"},{"term":""},{"kind":"b"}]',), ("broken",), (None,)], "t string")
    assert [len(r[0]) for r in lists.select(S.structs_with(F.col("t"), "struct<term:string,kind:string>", "term")).collect()] == [1, 0, 0]
