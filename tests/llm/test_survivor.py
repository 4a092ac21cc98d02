import itertools
import random

from pyspark.sql import functions as F

from plumbline.llm.survivor import Bundle, Dependency, best_representative, choose, well_formed_ids, with_group_facts


def test_branch_and_bound_against_all_choices():
    random.seed(2)
    for _ in range(200):
        cands, ident = [], itertools.count(1)
        for b in range(3):
            own = [(random.randrange(1, 50), next(ident), {f"f{b}": random.choice("xyz")}) for _ in range(random.randrange(0, 4))]
            cands.append(sorted(own, key=lambda c: -c[0]))
        banned = {(random.choice("xyz"), random.choice("xyz")) for _ in range(4)}

        def allowed(have, own):
            both = have | own
            return not ("f0" in both and "f2" in both and (both["f0"], both["f2"]) in banned)

        got = choose(cands, allowed)
        best = 0
        for pick in itertools.product(*[[None, *c] for c in cands]):
            values, total, ok = {}, 0, True
            for c in pick:
                if c is not None:
                    ok = ok and allowed(values, c[2])
                    values |= c[2]
                    total += c[0]
            if ok:
                best = max(best, total)
        trust = {i: t for c in cands for t, i, _ in c}
        assert sum(trust[i] for i in got if i is not None) == best


ROWS = [
    # key, id, at, count, abstract, title
    ("p", 1, "2020-01-01", 5, "Whole text. It ends.", "T"),
    ("p", 2, "2021-01-01", 0, "<p>Whole text. It ends.</p>", "T"),
    ("p", 3, "2021-01-01", 9, "Whole te...", "T"),
    ("p", 4, "2022-01-01", 99999999, "Whole text. It ends. All rights reserved.", "T"),
    ("p", 5, None, None, None, None),
    ("q", 6, "2020-01-01", 0, "N/A", "T"),
    ("q", 7, "2020-01-01", 0, "t", "T"),
    ("one", 8, "2020-01-01", 3, "Alone.", "T"),
    (None, 9, "2020-01-01", 3, "Alone.", "T"),
    (None, 10, "2020-01-01", 3, "Alone.", "T"),
]


def test_facts_and_choice(spark):
    df = spark.createDataFrame(ROWS, "k string, id bigint, at string, n bigint, longest string, bare string").withColumn("at", F.to_timestamp("at"))
    noted = with_group_facts(df, "k", "id", "at", "longest", "bare", "n", {"size": F.length("longest")})
    assert noted.columns == ["k", "id", "at", "whole", "counted", "size"]
    assert {r.id: (r.whole, r.counted) for r in noted.collect()} == {
        1: (True, True), 2: (False, False), 3: (False, True), 4: (False, False), 5: (False, False), 6: (False, True), 7: (False, True)
    }
    bundles = [Bundle("text", ("longest",), F.col("whole")), Bundle("n", ("n",), F.col("counted"))]
    got = sorted(map(tuple, best_representative(noted, "k", "id", "at", bundles).collect()))
    assert got == [("p", "n", 3), ("p", "text", 1), ("q", "n", 6)]
    assert best_representative(noted.limit(0), "k", "id", "at", bundles).count() == 0


def test_dependency_forces_consistent_bundles(spark):
    rows = [("p", 1, "2020-01-01", "d1", 2000), ("p", 2, "2021-01-01", "d2", None), ("p", 3, "2022-01-01", None, 2001), ("p", 3, "2022-01-01", None, 2001)]
    df = spark.createDataFrame(rows, "k string, id bigint, at string, doi string, y int")
    bundles = [Bundle("doi", ("doi",), F.col("doi").isNotNull(), weight=2), Bundle("year", ("y",), F.col("y").isNotNull())]
    got = dict((r[1], r[2]) for r in best_representative(df, "k", "id", "at", bundles, [Dependency("doi", "y")]).collect())
    assert got == {"doi": 1, "year": 1}  # d2 has no year with it; the pair from record 1 outweighs d2 alone
    assert dict((r[1], r[2]) for r in best_representative(df, "k", "id", "at", bundles).collect()) == {"doi": 2, "year": 3}


def test_ids(spark):
    df = spark.createDataFrame([("https://r.example/W12345678901;W12345678901,W1 A12345678901", ), (None,)], "x string")
    assert [r[0] for r in df.select(well_formed_ids(F.col("x"))).collect()] == [["W12345678901"], None]


def test_bounded_candidates_give_the_best_choice(spark):
    rng = random.Random(6)
    rows = [(f"k{rng.randrange(40)}", i, rng.randrange(60), rng.choice([None, "a", "b", "c", "d"]), rng.choice([None, 1, 2, 3])) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, id bigint, at int, x string, y int").withColumn("at", F.timestamp_seconds("at"))
    bundles = [Bundle("x", ("x",), F.col("x").isNotNull(), weight=2), Bundle("y", ("y",), F.col("y").isNotNull())]
    got = {}
    for r in best_representative(df, "k", "id", "at", bundles, [Dependency("x", "y")], least_records=1).collect():
        got.setdefault(r.k, {})[r.bundle] = r.id
    at, xs, ys = {r[1]: r[2] for r in rows}, {r[1]: r[3] for r in rows}, {r[1]: r[4] for r in rows}
    for k in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == k]
        together = {(r[3], r[4]) for r in own}
        whole = [(2 * at[i] + at[j], -2 * i - j) for i in (r[1] for r in own if r[3]) for j in (r[1] for r in own if r[4]) if (xs[i], ys[j]) in together]
        if whole:
            i, j = got[k]["x"], got[k]["y"]
            assert (xs[i], ys[j]) in together and (2 * at[i] + at[j], -2 * i - j) == max(whole)
    # a hot key: thousands of different values, of which few can be in the best choice
    hot = spark.range(5000).select(F.lit("h").alias("k"), "id", F.timestamp_seconds("id").alias("at"), F.concat(F.lit("x"), "id").alias("x"), F.col("id").cast("int").alias("y"))
    assert {(r.bundle, r.id) for r in best_representative(hot, "k", "id", "at", bundles, [Dependency("x", "y")]).collect()} == {("x", 4999), ("y", 4999)}
