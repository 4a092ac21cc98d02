import json

import pytest
from pyspark.sql import functions as F

from plumbline.sources import lookup as K
from plumbline.sources import readers, writers


def test_yaml_and_registries(spark, tmp_path, monkeypatch):
    pytest.importorskip("yaml")
    y = tmp_path / "c.yaml"
    y.write_text("mail: a@b\nseeds:\n  - {id: 1, name: x}\n  - {id: 2}\n")
    monkeypatch.setenv("MAIL_TEST", "z@z")
    assert K.read_yaml(str(y), {"mail": "MAIL_TEST", "other": "NOT_SET"})["mail"] == "z@z"
    assert [tuple(r) for r in K.yaml_rows(spark, str(y), "seeds", "id int, name string").collect()] == [(1, "x"), (2, None)]
    y.write_text("")
    assert K.read_yaml(str(y)) == {} and K.yaml_rows(spark, str(y), "seeds", "id int").count() == 0
    rows = [{"id": "a", "n": 1}, {"id": "b"}]
    for name, text in {"l.json": json.dumps(rows), "d.json": json.dumps({"decisions": rows}), "u.json": json.dumps({"updates": rows}), "c.csv": "id,n\na,1\nb,\n"}.items():
        (tmp_path / name).write_text(text)
        assert sorted(map(tuple, K.read_registry(spark, str(tmp_path / name), "id string, n int").collect())) == [("a", 1), ("b", None)]
    (tmp_path / "x.json").write_text("{broken")
    assert K.read_registry(spark, str(tmp_path / "x.json"), "id string, n int").count() == 0


def test_lookup_and_cache(spark):
    works = spark.createDataFrame([(1, "https://r.example/W1", "10.1234/a"), (2, "W2", None), (3, None, "https://doi.example/10.1234/A")], "record_id int, openalex_id string, doi string")
    keys = spark.createDataFrame([("doi:10.1234/a",), ("W2",), ("x/W9",), (None,), ("W2",)], "key string")
    assert {r.key: r.row for r in K.lookup(works, keys).collect()} == {"doi:10.1234/a": 1, "W2": 2, "x/W9": None}
    assert K.lookup(works.limit(0), keys).where("found").count() == 0
    cache = spark.createDataFrame([("k", "old", 1), ("k", "new", 2), ("gone", None, 1)], "key string, body string, at int")
    asked = spark.createDataFrame([("k",), ("gone",), ("other",), (None,)], "key string")
    assert {r.key: (r.body, r.state) for r in K.with_cache(asked, cache).collect()} == {"k": ("new", "hit"), "gone": (None, "absent"), "other": (None, "miss"), None: (None, "miss")}
    two = spark.range(1).select(K.request_key(F.lit("/w"), F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2"))) == K.request_key(F.lit("/w"), F.create_map(F.lit("b"), F.lit("2"), F.lit("a"), F.lit("1"))))
    assert two.first()[0]


def test_references_and_ids(spark):
    body = json.dumps({"message": {"reference": [{"DOI": "10.1234/a"}, {"x": 1}, {"DOI": "https://doi.example/10.1234/B"}]}})
    m = spark.createDataFrame([("p", body), ("q", "broken"), ("r", None)], "id string, body string")
    assert [tuple(r) for r in K.references(m, "id", "body").collect()] == [("p", 1, "10.1234/a"), ("p", 3, "10.1234/b")]
    assert K.references(m, "id", "body", 2).count() == 1
    works = spark.createDataFrame([(f"r/W{i}",) for i in range(7)], "w string")
    got = K.multi_get(works, works.select(F.col("w").alias("id")), "w", 3)
    assert sorted(r.request for r in got.collect()) == [0, 0, 0, 1, 1, 1, 2] and got.columns == ["w", "request"]


def test_documents(spark):
    values = spark.createDataFrame([('{"a":[{"Description":"x"},{"b":{"description":"y"}}],"description":{"description":"z"}}',), ("{",), (None,)], "j string")
    assert [r[0] for r in values.select(K.json_values(F.col("j"), "description")).collect()] == [["x", "y", "z"], [], []]
    xml = "<S><PubmedArticle><PMID>7</PMID><ArticleTitle>T <i>x</i></ArticleTitle><AbstractText>a</AbstractText><AbstractText>b</AbstractText></PubmedArticle><PubmedArticle><PMID>8</PMID></PubmedArticle></S>"
    assert [tuple(r) for r in K.xml_records(spark.createDataFrame([(xml,)], "x string"), "x").collect()] == [("7", "T x", "a b"), ("8", "", "")]
    files = spark.createDataFrame([(1, "<p>" + "w " * 900 + "</p>", "html"), (2, "short", "plain"), (3, "%PDF", "pdf"), (4, None, None), (5, "y " * 2000, "plain")], "id int, c string, k string")
    assert {r.id: (r.state, r.text is not None) for r in K.full_texts(files, "id", "c", "k", most_bytes=3000).collect()} == {1: ("ok", True), 2: ("too short", False), 3: ("unread", False), 4: ("unread", False), 5: ("too large", False)}


def test_selection_round_trip_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "T {x}"), ("b", None)], "id string, title string")
    out = K.export_selection(df, "id", "title")
    assert sorted(r.id for r in K.import_selection(out.union(out), "json").collect()) == ["a", "b"]
    lists = spark.createDataFrame([('["a","a"," "]',), ("nope",), (None,)], "l string")
    assert [r.id for r in K.import_selection(lists, "l").collect()] == ["a"]
    for _ in range(2):
        writers.append_jsonl(df, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log.jsonl")).count() == 4
    writers.write_report(df, str(tmp_path / "r.json"))
    assert json.loads((tmp_path / "r.json").read_text())[0]["id"] == "a"
    with pytest.raises(ValueError):
        writers.write_report(df, str(tmp_path / "r.json"), 1)


def test_a_failing_page_fails_the_scan():
    calls = []

    def fetch(query, cursor):
        calls.append(cursor)
        if len(calls) == 2:
            raise OSError("busy")
        return [("r",)], "next" if len(calls) < 4 else None

    reader = readers.PagedReader(fetch, ["q"], 0, 2, wait=0)
    assert len(list(reader.read(readers.PagedPartition("q")))) == 3

    def broken(query, cursor):
        raise OSError("down")

    with pytest.raises(OSError):
        list(readers.PagedReader(broken, ["q"], 0, 1, wait=0).read(readers.PagedPartition("q")))

    def ends(query, cursor):
        raise EOFError

    assert list(readers.PagedReader(ends, ["q"], 0, 1, wait=0).read(readers.PagedPartition("q"))) == []
