import json
import random

import pytest
from pyspark.sql import functions as F

from plumbline.functions import text as T
from plumbline.operators import aggregates as A
from plumbline.operators import resolve as D
from plumbline.operators import selection as S
from plumbline.operators import windows as W
from plumbline.sources import readers, writers


def test_percentile_ranks(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 2.0), (4, 4.0), (5, None)], "id int, v double")
    assert [r.pct for r in W.percentile_ranks(df, "v", "pct").orderBy("id").collect()] == [0.25, 0.625, 0.625, 1.0, None]
    zero = spark.createDataFrame([(1, 0.0), (2, 0.0)], "id int, v double")
    assert [r.pct for r in W.percentile_ranks(zero, "v", "pct").collect()] == [0.0, 0.0]
    assert W.percentile_ranks(df.limit(0), "v", "pct").count() == 0
    assert [round(r.n, 6) for r in W.log_max(spark.createDataFrame([(0.0,), (1.0,), (3.0,)], "v double"), "v", "n").orderBy("v").collect()] == [0, 0.5, 1]


def test_entropy(spark):
    df = spark.createDataFrame([("g", x) for x in "aaabc"] + [("h", "a")], "g string, v string")
    got = {r.g: (r.entropy, r.evenness) for r in A.entropy(df, ["g"], "v").collect()}
    assert got["g"] == pytest.approx((0.950271, 0.864974), abs=1e-6) and got["h"] == (0.0, 0.0)


def test_capped_top(spark):
    df = spark.createDataFrame([("a", 9), ("a", 8), ("a", 7), ("b", 6), (None, 5), (None, 4)], "g string, v int")
    assert [r.v for r in W.capped_top(df, "g", [F.desc("v")], 2, 4).collect()] == [9, 8, 6, 5]


def test_share_cap():
    assert S.share_cap_removals({"A": 6, "B": 3, "C": 2, "D": 2}, {"A": 6, "B": 3, "C": 2, "D": 2}, 0.4) == {"A": 2, "B": 0, "C": 0, "D": 0}
    assert S.share_cap_removals({"A": 5}, {"A": 0}, 0.1) == {"A": 0}


def test_ratios():
    a = "diagnostic criteria for multiple sclerosis 2010 revisions to the mcdonald criteria"
    b = "diagnostic criteria for multiple sclerosis 2010 revisions mcdonald criteria update"
    assert T.token_sort(a, b) == pytest.approx(95.122, abs=0.5) or T.token_sort(a, b) >= 85
    assert T.token_set("ocrelizumab for relapsing multiple sclerosis", "ocrelizumab in relapsing multiple sclerosis") == pytest.approx(96.386, abs=1e-3)
    rng = random.Random(3)
    for _ in range(200):
        x, y = ("".join(rng.choice("abc") for _ in range(rng.randrange(9))) for _ in range(2))
        table = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i in range(len(x)):
            for j in range(len(y)):
                table[i + 1][j + 1] = table[i][j] + 1 if x[i] == y[j] else max(table[i][j + 1], table[i + 1][j])
        assert T._lcs(x, y) == table[-1][-1]


def test_text_functions(spark):
    one = lambda c, v: spark.createDataFrame([(v,)], "x string").select(c(F.col("x"))).first()[0]
    assert one(T.normalize_title, "Étude: Erratum (a bioRxiv preprint) of β-Cells") == "etude of cells"
    assert one(T.normalize_doi, "https://doi.org/10.1000/ABC.123).") == "10.1000/abc.123" and one(T.normalize_doi, "") == "" and one(T.normalize_doi, None) == ""
    assert [one(T.topic_code, x) for x in ("TOPIC-00 x", "topic-17", "T4", "T12b y", "none", None)] == ["TOPIC-00", "TOPIC-17", "TOPIC-04", "T12b", None, None]
    assert one(T.json_list, '["a","b"]') == ["a", "b"] and one(T.json_list, "plain") == ["plain"] and one(T.json_list, None) == []
    assert one(T.strip_html, "<p>a &amp; b<script>x</script></p>") == "a & b"
    assert one(T.sentences, "One. Two! Three") == ["One.", "Two!", "Three"]
    assert one(T.split_list, "1a; b1 ;;nan") == ["1a", "b1"]
    assert one(T.json_object_in, 'say {"a": {"b": 1}} now') == '{"a": {"b": 1}}'
    assert [one(lambda c: T.safe_int(c, 7), x) for x in ("3.9", "x", None, "NaN")] == [3, 7, 7, 7]
    assert one(lambda c: T.duration(c.cast("double")), "3725") == "1:02:05"


def test_pivot_clusters_are_not_transitive(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (4, 5)], "i long, j long")
    ids = spark.createDataFrame([(i,) for i in range(1, 7)], "ord long")
    assert {r.ord: r.pivot for r in D.pivot_clusters(links, ids).collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 6}


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_pivot_clusters_against_a_scan(spark, seed):
    rng = random.Random(seed)
    pairs = sorted({tuple(sorted((rng.randrange(60), rng.randrange(60)))) for _ in range(110)} - {(i, i) for i in range(60)})
    want = {}
    for i in range(60):
        if i not in want:
            want[i] = i
            for a, b in pairs:
                if a == i:
                    want.setdefault(b, i)
    links, ids = spark.createDataFrame(pairs, "i long, j long"), spark.createDataFrame([(i,) for i in range(60)], "ord long")
    assert {r.ord: r.pivot for r in D.pivot_clusters(links, ids).collect()} == want
    assert {r.ord: r.pivot for r in D.pivot_clusters(links, ids, rounds=1).collect()} == want
    assert {r.ord: r.pivot for r in D.pivot_clusters(links.limit(0), ids).collect()} == {i: i for i in range(60)}


def test_dedupe_guards(spark):
    rows = [
        (1, "10.1/a", "Short", 2010, "Ann"), (2, "10.1/A", "Other", 2018, "Bob"),  # same DOI always
        (3, None, "one two three four five six seven", 2010, "Cy"), (4, None, "one two three four five six seven", 2016, "Cy"),  # six years
        (5, None, "alpha beta gamma delta epsilon zeta eta", 2010, "Di"), (6, None, "beta alpha gamma delta epsilon zeta eta", 2011, "Di"),  # reordered
        (7, "10.1/x", "two words", 2010, "Ed"), (8, "10.1/y", "two words", 2010, "Ed"), (9, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "ord long, doi string, title string, year int, author string")
    got = {r.ord: r.pivot for r in D.pivot_clusters(D.candidate_links(df), df).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, 8: 8, 9: 9}


def test_dedupe_against_a_scan_of_records(spark):
    rng = random.Random(9)
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    title = lambda: " ".join(words[:6] + [rng.choice(words)] if rng.random() < 0.7 else rng.sample(words, rng.choice([3, 5])))
    rows = [(1, None, "the same long title", 2010, "P"), (2, "10.1/d", "the same long title", 2010, "P"), (3, "10.1/d", "quite another long one", 2010, "Q"), (4, "10.1/d", "a third and longer one", 2010, "R")]
    rows += [(i, rng.choice([None, "", *[f"10.1/{k}" for k in range(12)]]), title(), rng.choice([None, 2010, 2012, 2013, 2016]), rng.choice(["Ann", "Bob", "Cy", None])) for i in range(5, 90)]

    def match(a, b):
        if a[1] and a[1] == b[1]:
            return True
        if not a[4] or a[4] != b[4] or min(len(a[2].split()), len(b[2].split())) < 4:
            return False
        return (a[3] is None or b[3] is None or abs(a[3] - b[3]) <= 2) and T.token_sort(a[2], b[2]) >= 85

    want = {}
    for a in rows:
        if a[0] not in want:
            for b in rows:
                if b[0] == a[0] or b[0] > a[0] and b[0] not in want and match(a, b):
                    want[b[0]] = a[0]
    df = spark.createDataFrame(rows, "ord long, doi string, title string, year int, author string")
    assert {r.ord: r.pivot for r in D.pivot_clusters(D.candidate_links(df), df).collect()} == want
    assert {r.ord: r.pivot for r in D.resolve_records(df).collect()} == want
    assert (want[2], want[3], want[4]) == (1, 3, 3)
    assert D.resolve_records(df.limit(0)).count() == 0


def test_sources(spark, tmp_path):
    work = {"id": "https://r.example/W1", "title": "T", "publication_year": 2020, "authorships": [{"author": {"display_name": "Ann"}}], "concepts": [{"display_name": "c1"}, {"display_name": "c2"}]}
    (tmp_path / "a.json").write_text(json.dumps(work))
    (tmp_path / "b.json").write_text(json.dumps({"results": [work | {"id": "https://r.example/W2"}, work | {"id": "x"}]}, indent=1))
    works = readers.read_works(spark, str(tmp_path / "*.json"), "https://r.example/W")
    rows = readers.candidate_rows(works, "lexical").orderBy("openalex_id").collect()
    assert [(r.openalex_id[-2:], r.first_author, r.concepts) for r in rows] == [("W1", "Ann", "c1;c2"), ("W2", "Ann", "c1;c2")]
    (tmp_path / "log.jsonl").write_text('{"id": "a", "n": 1}\nbroken\n{"id": "a", "n": 2}\n')
    assert [(r.id, r.n) for r in readers.read_latest_jsonl(spark, str(tmp_path / "log.jsonl"), "id string, n int", "id", "n").collect()] == [("a", 2)]
    (tmp_path / "c.md").write_text('---\nid: x1\ntitle: "A: b"\n---\n\nBody [one](a.md) and [two](b.md), [one](a.md)\n\n- Ann, B (2020). The title. Journal X.\n')
    page = readers.read_front_matter(spark, str(tmp_path / "c.md"))
    assert page.first().fields["id"] == "x1" and page.first().fields["title"] == "A: b"
    assert [r.target for r in readers.link_steps(page, F.col("body")).orderBy("step").collect()] == ["a.md", "b.md"]
    assert readers.read_candidate_list(spark, str(tmp_path / "c.md")).first().journal == "Journal X"
    writers.write_by_suffix(spark.createDataFrame([(1, 'q "x", y')], "a int, b string"), str(tmp_path / "t.csv"))
    assert readers.read_csv(spark, str(tmp_path / "t.csv"), "a int, b string", ["b"]).first().b == 'q "x", y'


def test_paged_source(spark):
    def fetch(query, cursor):
        n = 0 if cursor == "*" else int(cursor)
        return [(f"{query}{i}",) for i in range(n, n + 2)], (str(n + 2) if n < 4 else None)

    spark.dataSource.register(readers.paged_source("pages_test", "id string", fetch))
    got = spark.read.format("pages_test").option("queries", "a\nb").option("max_results", "5").load()
    assert got.groupBy("query").count().orderBy("query").collect() == [("a", 5), ("b", 5)]


def test_stream(spark, tmp_path):
    from plumbline.streaming.dedupe import intake

    spark.createDataFrame([("k1", "2024-01-01 00:00:00"), ("k1", "2024-01-01 01:00:00"), ("k2", "2024-01-01 02:00:00")], "k string, t string").select("k", F.to_timestamp("t").alias("t")).write.parquet(str(tmp_path / "in"))
    q = intake(spark, str(tmp_path / "in"), "k string, t timestamp", "t", ["k"]).writeStream.format("memory").queryName("intake").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("intake").count() == 2
