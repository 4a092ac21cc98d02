import random

from plumbline.llm.names import edit_distance, folded, given_cost, link_names, radius_join, readings, seed_names, split_authors


def test_radius_join_is_exact(spark):
    random.seed(4)
    word = lambda: "".join(random.choice("abc") for _ in range(random.randrange(0, 9)))
    left, right = [word() for _ in range(300)] + [None], [word() for _ in range(120)]
    l_df, r_df = spark.createDataFrame([(x,) for x in left], "q string"), spark.createDataFrame([(x,) for x in right], "x string")
    for radius in (0, 1, 2):
        got = {tuple(r) for r in radius_join(l_df, "q", r_df, "x", radius, n_pivots=5, sample=40).collect()}
        want = {(a, b, edit_distance(a, b)) for a in set(left) - {None} for b in set(right) if edit_distance(a, b) <= radius}
        assert got == want
    assert radius_join(l_df, "q", r_df.limit(0), "x", 1).count() == 0
    assert radius_join(l_df.limit(0), "q", r_df, "x", 1).count() == 0


def test_reading():
    assert folded("Møller-Ängström Goethe") == "moller-angstrom gothe"
    assert ("person", "moller", ["a", "b"], False) in readings("Dr. Møller AB*")
    assert ("person", "moller", ["anna"], True) in readings("van der MØLLER Anna, et al.")
    assert readings("The Oskby-Study-Grp (OSG)") == readings("Study Group Oskby")
    assert readings("") == readings("...") == []
    assert given_cost(["bill"], ["william", "john"]) is not None and given_cost(["w", "j"], ["william"]) is None
    assert given_cost(["nick"], ["richard"]) is None and given_cost(["wiliam"], ["william"]) is not None


def test_authors_fields():
    assert split_authors("Aba B, Cad E et al") == ["Aba B", "Cad E"]
    assert split_authors("Aba, Bob; Cad E; et al") == ["Aba, Bob", "Cad E"]
    assert split_authors("Aba, B.C.") == ["Aba, B.C."]
    assert split_authors("Bob Aba and E Cad & Z Zed") in (["Bob Aba and E Cad", "Z Zed"], ["Bob Aba", "E Cad", "Z Zed"])
    assert split_authors(None) == split_authors(" ") == []


def test_linking(spark):
    registry = spark.createDataFrame(
        [("1", "Josephine Wyckestøl", "x"), ("2", "Christopher Wyckestøl", "x"), ("3", "Clara Wyckestøl", "x"), ("4", "Oskby Study Group", "x"), ("5", None, "x")],
        "id string, name string, uses string",
    )
    typed = {"Wyckestol, Josie": "1", "J. Wykestøl": "1", "WYCKESTOEL Christopher": "2", "C Wyckestøl": None, "Elizabeth Wyckestøl": None, "Study Grp Oskby": "4", "nan": None, None: None}
    names = spark.createDataFrame([(n, 1) for n in typed], "name string, uses int")
    got = {r[0]: r[1] for r in link_names(names, "name", "uses", registry, "id", "name").collect()}
    assert got == {k: v for k, v in typed.items() if v}
    assert link_names(names.limit(0), "name", "uses", registry, "id", "name").count() == 0
    assert link_names(names, "name", "uses", registry.limit(0), "id", "name").count() == 0


def test_group_names_link_however_often_they_are_typed(spark):
    registry = spark.createDataFrame([("1", "Oskby Study Group"), ("2", "Narvik Trial Group"), ("3", "Narvek Trial Group")], "id string, name string")
    typed = [("Osky Study Group", 50), ("Oskby Study Group", 1), ("Narvik Trial Group", 1), ("Narvek Trial Group", 9), ("Narvk Trial Group", 5)]
    for rows in (typed, typed[:1]):
        names = spark.createDataFrame(rows, "name string, uses int")
        got = {r[0]: r[1] for r in link_names(names, "name", "uses", registry, "id", "name").collect()}
        want = {"Osky Study Group": "1", "Oskby Study Group": "1", "Narvik Trial Group": "2", "Narvek Trial Group": "3"}
        assert got == {n: want[n] for n, _ in rows if n in want}


def test_initials_outweighed_by_people_outside(spark):
    registry = spark.createDataFrame([("2", "Christopher Wyckestøl")], "id string, name string")
    names = spark.createDataFrame([("C Wyckestøl", 3), ("Charlotte Wyckestøl", 9), ("Christopher Wyckestøl", 2)], "name string, uses int")
    assert {r[0] for r in link_names(names, "name", "uses", registry, "id", "name").collect()} == {"Christopher Wyckestøl"}
    more = names.union(spark.createDataFrame([("Chris Wyckestøl", 20)], "name string, uses int"))
    assert "C Wyckestøl" in {r[0] for r in link_names(more, "name", "uses", registry, "id", "name").collect()}


def test_seed_names(spark):
    df = spark.createDataFrame([("s", "Aba B; et al; Cad E", 1), ("t", None, 2)], "key string, authors string, pos int")
    assert [tuple(r) for r in seed_names(df, "key", "authors").orderBy("pos").collect()] == [("s", 1, "Aba B"), ("s", 2, "Cad E")]
