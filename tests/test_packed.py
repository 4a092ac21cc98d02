import pytest

from plumbline.operators.packed import CODES, IDENTIFIERS, NAMES, Spans, ValueModel, expected_counts, learn_values, split_packed, split_text


@pytest.mark.parametrize(
    ("text", "spec", "expected"),
    [
        (None, NAMES, []),
        ("", NAMES, []),
        (" NaN ", NAMES, []),
        (";", NAMES, []),
        ("A;;nan; B ", NAMES, ["A", "B"]),
        ('"Patient preference; stated"|Axon', NAMES, ["Patient preference; stated", "Axon"]),
        ('"Lesion ""rim"" sign";HLA, class II', NAMES, ['Lesion "rim" sign', "HLA, class II"]),
        ("Axon,Pain , Vision", NAMES, ["Axon", "Pain", "Vision"]),
        ('["a, b", "c \\"d\\"", null, 3]', NAMES, ["a, b", 'c "d"', "3"]),
        ("[not json; x", NAMES, ["[not json", "x"]),
        ('un"closed;x', NAMES, ['un"closed', "x"]),
        ('A\t"Lesion ""rim"" sign"', NAMES, ["A", 'Lesion "rim" sign']),
        ('"https://r.example/W1" "W2"\nW3,W4;W5|W6', IDENTIFIERS, ["https://r.example/W1", "W2", "W3", "W4", "W5", "W6"]),
        ("T-01/T-02.1+T-03 & T-04", CODES, ["T-01", "T-02.1", "T-03", "T-04"]),
    ],
)
def test_split(text, spec, expected):
    assert split_text(text, spec) == expected


def test_model_keeps_known_compounds_whole():
    model = ValueModel({"HLA, class II": -2.0, "Axon": -2.0, "HLA": -12.0, "class II": -12.0}, Spans(frozenset(["HLA, class II"]), widest=2))
    assert split_text("HLA, class II,Axon", NAMES, model) == ["HLA, class II", "Axon"]


def test_e_step_conserves_weight():
    pieces, marks, spans = [("a", False), ("b", False), ("c", False)], [";", ";"], Spans(joins=frozenset([("a", ";", "b"), ("b", ";", "c")]))
    into = {}
    expected_counts(pieces, marks, 2.0, spans, None, into)
    assert sum(n * (k.count(";") + 1) for k, n in into.items()) == pytest.approx(6.0)
    assert into["a;b;c"] == pytest.approx(0.5) and into["a"] == pytest.approx(1.0)  # four paths, equally likely
    long = [(f"p{i}", False) for i in range(3000)]
    expected_counts(long, [";"] * 2999, 1.0, Spans(frozenset(["p1;p2"]), widest=2), ValueModel({"p1;p2": -3.0}), into := {})
    assert into["p1;p2"] == pytest.approx(1.0) and len(into) == 2999
    wide = Spans(joins=frozenset((f"p{i}", ";", f"p{i + 1}") for i in range(300)))
    expected_counts(long[:300], [";"] * 299, 1.0, wide, None, into := {})  # 2^299 paths
    assert sum(into[f"p{i}"] for i in range(300)) == pytest.approx(75.5)


def test_pieces_that_never_part_are_one_value(spark):
    rows = [f"Topic {i} | Heart; Lungs | Other {i % 7}" for i in range(200)]
    rows += [f"Left; Right {i % 5}; Topic {i}" for i in range(200)] + ["Left; Up", "Up; Topic 3"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows * 3)], "id bigint, f string")
    model = learn_values(df, "f")
    assert split_text(rows[0], NAMES, model) == ["Topic 0", "Heart; Lungs", "Other 0"]
    assert split_text("Heart; Lungs; Left", NAMES, model) == ["Heart; Lungs", "Left"]
    # neighbours that also stand apart, and lists that are only repeated, are no values
    assert split_text(rows[200], NAMES, model) == ["Left", "Right 0", "Topic 0"]
    same = spark.createDataFrame([(i, "Xylem; Phloem") for i in range(500)], "id bigint, f string")
    assert split_text("Xylem; Phloem", NAMES, learn_values(same, "f")) == ["Xylem", "Phloem"]


def test_values_of_any_width(spark):
    five, thirty = "A; B; C; D; E", "; ".join(f"part {i}" for i in range(30))
    rows = [(i, f'"{five}"') for i in range(1000)] + [(2000, f"X; {five}; Y"), (2001, f'"{thirty}"'), (2002, f"{thirty}; Z")]
    df = spark.createDataFrame(rows, "id bigint, f string")
    model = learn_values(df, "f")
    assert split_text(rows[1000][1], NAMES, model) == ["X", five, "Y"]
    assert split_text(rows[1002][1], NAMES, model) == [thirty, "Z"]


def test_learning_uses_the_whole_column(spark):
    rows = [(i, '"Red, dark"') for i in range(40)] + [(100 + i, "Blue") for i in range(40)] + [(200, "Red, dark,Blue"), (201, None)]
    df = spark.createDataFrame(rows, "id bigint, f string")
    model = learn_values(df, "f")
    assert split_text("Red, dark,Blue", NAMES, model) == ["Red, dark", "Blue"]
    got = split_packed(df, "id", "f", NAMES, model).where("row_key = 200").orderBy("pos").collect()
    assert [(r.pos, r.item) for r in got] == [(1, "Red, dark"), (2, "Blue")]


def test_rare_pieces_of_ambiguous_stretches_keep_their_frequency(spark):
    rows = [(i, '"Red, dark"') for i in range(40)] + [(100 + i, "Blue") for i in range(40)] + [(200, "Red, dark,Blue")]
    df = spark.createDataFrame(rows, "id bigint, f string")
    some, all_ = learn_values(df, "f", min_share=0.9), learn_values(df, "f", min_share=0.0)
    assert some.logp["Blue"] == pytest.approx(all_.logp["Blue"])
    assert some.spans.values == all_.spans.values == {"Red, dark"}


def test_frames(spark):
    df = spark.createDataFrame([(1, "a;b", "x"), (1, "a;b", "y"), (2, "z" * 100_000 + ";q", "x")], "id bigint, `row_key` string, item string")
    out = split_packed(df, "id", "row_key")
    assert out.columns == ["row_key", "pos", "item"]
    assert sorted((r[0], r[1], len(r[2])) for r in out.collect()) == [(1, 1, 1), (1, 1, 1), (1, 2, 1), (1, 2, 1), (2, 1, 100_000), (2, 2, 1)]
    assert split_packed(df.limit(0), "id", "row_key").count() == 0
