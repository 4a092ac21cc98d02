import difflib
import random

from pyspark.sql import functions as F

from plumbline.functions import summary as S
from plumbline.operators import cascade as C
from plumbline.operators.selection import share_cap_removals


def test_first_source(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "id string")
    one = spark.createDataFrame([("a", " "), ("b", "x"), ("b", "longer"), ("z", "y")], "id string, text string")
    two = spark.createDataFrame([("a", "t"), ("b", "t")], "id string, text string")
    got = {r.id: (r.text, r.source) for r in C.first_source(df, "id", [("one", one), ("two", two)]).collect()}
    assert got == {"a": ("t", "two"), "b": ("longer", "one"), "c": (None, "none")}


def test_title_cascade_against_all_pairs(spark):
    rng = random.Random(2)
    words = ["alpha", "bravo", "carbon", "delta", "engine", "fabric", "garden", "harbor"]
    title = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(2, 7)))

    def typo(t):
        t = list(t)
        for _ in range(rng.randrange(0, 4)):
            t[rng.randrange(len(t))] = rng.choice("xyz")
        return "".join(t)

    works = [(i, f"d{i}" if i % 4 == 0 else "", title(), rng.choice([2000, 2005, None])) for i in range(120)]
    wanted = [(f"w{i}", w[1] if i % 5 == 0 else "", typo(w[2]) if i % 2 else w[2], rng.choice([2001, 2009, None])) for i, w in enumerate(rng.sample(works, 40))] + [("none", None, None, None)]
    want = {}
    for i, d, t, y in wanted:
        offers = []
        for j, wd, wt, wy in works:
            near = y is None or wy is None or abs(y - wy) <= 3
            if d and d == wd:
                offers.append((1, 0.0, j))
            elif t and near and t == wt:
                offers.append((2, 0.0, j))
            elif t and near and (s := difflib.SequenceMatcher(None, t, wt).ratio()) >= 0.82:
                offers.append((3, -round(s, 9), j))
        if offers:
            want[i] = (min(offers)[0], min(offers)[2])
    a = spark.createDataFrame(wanted, "id string, doi string, title string, year int")
    b = spark.createDataFrame(works, "work long, doi string, title string, year int")
    assert {r.id: (r.how, r.work) for r in C.title_cascade(a, b).collect()} == want
    assert C.title_cascade(a.limit(0), b).count() == C.title_cascade(a, b.limit(0)).count() == 0


def test_best_record_and_score(spark):
    wanted = spark.createDataFrame([(1, "k", "gait in ms", 2000, "Ann A")], "id int, key string, title string, year int, author string")
    records = spark.createDataFrame([(7, "k", "ms in gait", 2002, "ann a"), (8, "k", "gait in ms", 1980, None), (9, "k", "gait in ms", 2001, None), (5, "x", "gait in ms", 2000, None)], "record int, key string, title string, year int, author string")
    assert [tuple(r) for r in C.best_record(wanted, records, "key").collect()] == [(1, 7, 100.0)]
    got = C.scored_matches(wanted, records.withColumnRenamed("record", "work"), "key").collect()
    assert [tuple(r) for r in got] == [(1, 9, 102.0)]  # 7 has 100 - 12 + 2.5, 8 is too far away


def test_rebalance(spark):
    rows = [(i, "A", i, True) for i in range(6)] + [(10 + i, "B", i, i < 1) for i in range(4)] + [(20, "C", 1, True), (30, None, 1, True)]
    df = spark.createDataFrame(rows, "id int, g string, s int, t boolean")
    got = {r.id for r in C.rebalanced(df, "g", "id", "s", F.col("t"), F.col("s") > 0, {"A": (0.0, 0.4), "B": (0.3, 1.0)}).collect()}
    assert got == {3, 4, 5, 10, 13, 20, 30}  # A loses its three lowest of six, B gets its best: two of six are a third
    assert C.rebalanced(df.limit(0), "g", "id", "s", F.col("t"), F.lit(True), {"A": (0.5, 1.0)}).count() == 0


def test_share_caps_in_bulk_equal_one_at_a_time():
    def slow(counts, removable, share):
        counts, left, out = dict(counts), dict(removable), {g: 0 for g in counts}
        while over := [g for g, n in counts.items() if n > max(1, int(sum(counts.values()) * share)) and left[g] > 0]:
            g = min(over, key=lambda g: (-counts[g], g))
            counts[g] -= 1
            left[g] -= 1
            out[g] += 1
        return out

    rng = random.Random(5)
    for _ in range(300):
        counts = {g: rng.randrange(0, 60) for g in "abcdef"[: rng.randrange(1, 7)]}
        removable = {g: rng.randrange(0, n + 1) for g, n in counts.items()}
        share = rng.choice([0.05, 0.2, 0.34, 0.5])
        assert share_cap_removals(counts, removable, share) == slow(counts, removable, share)
    assert share_cap_removals({"a": 10**12, "b": 10**9}, {"a": 10**12, "b": 10**9}, 0.5)["a"] == 10**12 - 10**9


def test_summaries(spark):
    text = "We looked. It showed a gain. It showed more."
    row = spark.createDataFrame([(text, None)], "t string, n string").select(
        S.key_sentence(F.col("t")).alias("k"), S.key_sentence(F.col("n")).alias("none"), S.takeaways(F.array(F.lit("Gain"), F.lit(None), F.lit("gain")), F.col("n"), F.col("t")).alias("four"),
        S.difficulty(F.col("n")).alias("d"), S.overlap_share(F.lit("gain more zzz"), F.col("t")).alias("o"), S.overlap_share(F.col("n"), F.col("t")).alias("o0"),
        S.without_boilerplate(F.lit("Keep this [x] text here"), ["[x]"], 12, "-").alias("c"), S.without_boilerplate(F.col("n"), [], 5, "-").alias("c0"), S.certainty(0.9, [(F.lit(True), 0.3), (F.lit(None).cast("boolean"), 1.0)]).alias("s"),
    ).first()
    assert row.k == "It showed a gain." and row.none is None and row.four == ["Gain", "We looked.", "It showed a gain.", "It showed more."]
    assert row.d == 1 and round(row.o, 6) == 0.666667 and row.o0 == 0 and row.c == "Keep this" and row.c0 == "-" and row.s == 0.98
