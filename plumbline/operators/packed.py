"""Several values packed in one field: split them, position kept, by an EM-trained segmentation.

A field is cut into atoms: quoted spans (never cut), text, and delimiters. *Hard* delimiters always separate.
*Soft* ones may also be part of a value, so every stretch between hard delimiters is a lattice whose edges are the
candidate values: each piece between soft delimiters, and every span of pieces, of any width, that is a hypothesis.

Two things make a span a hypothesis, both counted over the whole column. It stands whole somewhere: quoted, or alone
between hard delimiters where the soft ones in it separate nothing. Or its pieces cohere: they hardly ever stand without
each other, in many different surroundings. The frequencies of values are then learnt by expectation-maximisation from a
neutral start, in which all paths through a lattice are equally likely, until the likelihood stays as it is. The most
likely path (Viterbi) is the split.

Defined results for odd input: NULL, empty, blank and ``nan`` fields give no row; empty values and ``nan`` inside a
field are dropped and take no position; a quote that is never closed is ordinary text; a field that looks like a JSON
list but cannot be parsed is split as plain text; repeated rows are split each on their own; other columns of the
input, whatever their names, are ignored; empty tables give empty results.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import col
from plumbline.session import cut

BLANKS = " \t\n\r\f\v  "


@dataclass(frozen=True)
class PackedSpec:
    """What may separate values. ``hard``: always. ``soft``: perhaps part of a value. ``yielding``: soft delimiters
    that are part of a value wherever another delimiter separates the same field."""

    hard: str = "|\t\n\r"
    soft: str = ";,"
    yielding: str = ","

    @property
    def lattice(self) -> bool:
        return bool(self.soft)


#: Names may hold blanks, commas, semicolons and quotation marks.
NAMES = PackedSpec()
#: Identifiers hold no blanks, commas or semicolons.
IDENTIFIERS = PackedSpec(hard=";," + BLANKS, soft="|", yielding="")
#: Codes hold no blanks, commas or semicolons.
CODES = PackedSpec(hard=";," + BLANKS, soft="|/+&", yielding="")


@dataclass(frozen=True)
class Spans:
    """Spans of several pieces that may be one value: known ``values``, or chains of ``joins`` (piece, mark, piece).

    ``widest``: the most pieces of a known value."""

    values: frozenset[str] = frozenset()
    joins: frozenset[tuple[str, str, str]] = frozenset()
    widest: int = 1


@dataclass(frozen=True)
class ValueModel:
    """Learnt log frequencies of values, those of several pieces being ``spans``. ``floor`` is the log frequency of a
    piece never seen."""

    logp: dict[str, float]
    spans: Spans = Spans()
    floor: float = math.log(1e-9)

    def __call__(self, value: str) -> float:
        return self.logp.get(value, self.floor)


EMPTY_MODEL = ValueModel({})


def pieces_of(value: str, spec: PackedSpec) -> int:
    return 1 + sum(value.count(c) for c in spec.soft)


def _dropped(value: str) -> bool:
    return value == "" or value.lower() == "nan"


def atoms(text: str, spec: PackedSpec) -> list[tuple[str, str]]:
    """``("q", quoted text)``, ``("t", text)`` and ``("d", delimiter)`` from left to right."""
    marks = spec.hard + spec.soft
    step = _scanner(marks)
    out: list[tuple[str, str]] = []
    at, fresh_value = 0, True
    for m in iter(lambda: step.match(text, at), None):
        if m.end() == at:
            break
        piece = m.group()
        if m.lastgroup == "d":
            out.append(("d", piece))
            fresh_value = True
        elif m.lastgroup == "q" and fresh_value:
            out.append(("q", piece.strip()[1:-1].replace('""', '"')))
            fresh_value = False
        else:
            if m.lastgroup == "q":  # a quote inside a value is text, up to the next delimiter
                m = _plain(marks).match(text, at)
                piece = m.group()
            if out and out[-1][0] == "t":
                out[-1] = ("t", out[-1][1] + piece)
            else:
                out.append(("t", piece))
            fresh_value = fresh_value and not piece.strip()
        at = m.end()
    return out


_SCANNERS: dict[str, re.Pattern] = {}
_PLAINS: dict[str, re.Pattern] = {}


def _scanner(marks: str) -> re.Pattern:
    if marks not in _SCANNERS:
        d, blank = f"[{re.escape(marks)}]", rf"[^\S{re.escape(marks)}]*"
        # a quoted span counts only where it makes up the whole value
        _SCANNERS[marks] = re.compile(rf'(?P<q>{blank}"(?:[^"]|"")*"{blank}(?={d}|\Z))|(?P<d>{d})|(?P<t>"|[^"{re.escape(marks)}]+)', re.S)
    return _SCANNERS[marks]


def _plain(marks: str) -> re.Pattern:
    if marks not in _PLAINS:
        _PLAINS[marks] = re.compile(rf'"?[^"{re.escape(marks)}]*', re.S)
    return _PLAINS[marks]


def stretches(text: str, spec: PackedSpec) -> list[list[tuple[str, str]]]:
    """The field between hard delimiters: each stretch is a list of atoms with soft delimiters only."""
    s = text.strip()
    if s.startswith("[") and s.endswith("]"):
        try:
            items = json.loads(s)
        except ValueError:
            items = None
        if isinstance(items, list):
            return [[("q", x if isinstance(x, str) else "" if x is None else json.dumps(x))] for x in items]
    if '"' not in s:
        marks = [c for c in spec.hard + spec.soft if c in s]
        if not marks:
            return [[("t", s)]]
        if len(marks) == 1 and marks[0] not in spec.soft:
            return [[("t", x)] for x in s.split(marks[0])]
    parts = atoms(s, spec)
    others = {v for k, v in parts if k == "d" and v not in spec.yielding}
    out: list[list[tuple[str, str]]] = [[]]
    for k, v in parts:
        if k == "d" and v in spec.hard:
            out.append([])
        elif k == "d" and v in spec.yielding and others:
            if out[-1] and out[-1][-1][0] == "t":
                out[-1][-1] = ("t", out[-1][-1][1] + v)
            else:
                out[-1].append(("t", v))
        elif k == "t" and out[-1] and out[-1][-1][0] == "t":
            out[-1][-1] = ("t", out[-1][-1][1] + v)
        else:
            out[-1].append((k, v))
    return out


def _cells(stretch: list[tuple[str, str]]) -> tuple[list[tuple[str, bool]], list[str]]:
    """The pieces between soft delimiters as (text, quoted), and the delimiters between them."""
    pieces: list[tuple[str, bool]] = []
    marks: list[str] = []
    text, quoted = "", False
    for k, v in stretch:
        if k == "d":
            pieces.append((text, quoted))
            marks.append(v)
            text, quoted = "", False
        elif k == "q" and not text.strip():
            text, quoted = v, True
        else:
            text += v
    pieces.append((text, quoted))
    return pieces, marks


def _edges(pieces: list[tuple[str, bool]], marks: list[str], spans: Spans) -> list[tuple[int, int, str]]:
    """Lattice edges (from, to, value): one piece, or several unquoted pieces with their delimiters between."""
    n = len(pieces)
    out = []
    for i in range(n):
        text = pieces[i][0]
        out.append((i, i + 1, text.strip()))
        if pieces[i][1] or not text.strip():
            continue
        chain = True
        for j in range(i + 1, n):
            if pieces[j][1] or not pieces[j][0].strip():
                break
            chain = chain and (pieces[j - 1][0].strip(), marks[j - 1], pieces[j][0].strip()) in spans.joins
            if not chain and j - i >= spans.widest:
                break
            text += marks[j - 1] + pieces[j][0]
            if chain or text.strip() in spans.values:
                out.append((i, j + 1, text.strip()))
    return out


def viterbi(stretch: list[tuple[str, str]], model: ValueModel) -> list[str]:
    """The most likely values of one stretch; of equally likely paths the one with more values."""
    if len(stretch) == 1 and stretch[0][0] != "d":
        return [stretch[0][1].strip()]
    pieces, marks = _cells(stretch)
    edges = _edges(pieces, marks, model.spans)
    if len(edges) == len(pieces):  # a single path
        return [v for _, _, v in edges]
    best: list[tuple[float, int]] = [(0.0, 0)] + [(-math.inf, 0)] * len(pieces)
    back = [0] * (len(pieces) + 1)
    text = [""] * (len(pieces) + 1)
    for i, j, value in edges:
        cost = 0.0 if _dropped(value) else model(value)
        if (x := (best[i][0] + cost, best[i][1] + 1)) > best[j]:
            best[j], back[j], text[j] = x, i, value
    out, at = [], len(pieces)
    while at:
        out.append(text[at])
        at = back[at]
    return out[::-1]


def split_text(text: str | None, spec: PackedSpec, model: ValueModel = EMPTY_MODEL) -> list[str]:
    """The values of one field in order."""
    if text is None:
        return []
    return [v for s in stretches(text, spec) for v in viterbi(s, model) if not _dropped(v)]


# --- learning ---------------------------------------------------------------------------------------------------


def evidence(text: str, spec: PackedSpec) -> Iterator[tuple[str, str, str, str, int]]:
    """What a field says about spans: ("v", value) for values of several pieces that stand whole, ("p", piece) for each
    use of a piece, and ("j", piece, mark, piece) with a number for its surroundings, for neighbours at a soft delimiter."""
    cells = [_cells(s) for s in stretches(text, spec)]
    flat = [t.strip() for pieces, _ in cells for t, _ in pieces]
    at = 0
    for pieces, marks in cells:
        for k, (t, quoted) in enumerate(pieces):
            value = t.strip()
            if not _dropped(value):
                if (quoted or len(pieces) == 1) and pieces_of(value, spec) > 1:
                    yield "v", value, "", "", 0
                yield "p", value, "", "", 0
            if k and not quoted and not pieces[k - 1][1] and not _dropped(value) and not _dropped(flat[at - 1]):
                around = (flat[at - 2] if at > 1 else "") + "\0" + (flat[at + 1] if at + 1 < len(flat) else "")
                yield "j", flat[at - 1], marks[k - 1], value, zlib.crc32(around.encode())
            at += 1


def expected_counts(pieces: list[tuple[str, bool]], marks: list[str], weight: float, spans: Spans, model: ValueModel | None, into: dict[str, float]) -> float:
    """E-step for one stretch: adds the expected number of times that each value is used; the log likelihood.

    Without a model all paths are equally likely.
    """
    edges = [(i, j, v, 0.0 if model is None or _dropped(v) else model(v)) for i, j, v in _edges(pieces, marks, spans)]
    n = len(pieces)
    fore, behind = [0.0] + [-math.inf] * n, [-math.inf] * n + [0.0]  # in logarithms: there may be very many paths
    for i, j, _, p in edges:
        fore[j] = _log_sum(fore[j], fore[i] + p)
    for i, j, _, p in reversed(edges):
        behind[i] = _log_sum(behind[i], behind[j] + p)
    for i, j, v, p in edges:
        share = math.exp(fore[i] + p + behind[j] - fore[n])
        if share > 1e-12 and not _dropped(v):
            into[v] = into.get(v, 0.0) + weight * share
    return weight * fore[n]


def _log_sum(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def learn_values(
    df: DataFrame, field: str, spec: PackedSpec = NAMES, rounds: int = 20, min_share: float = 1e-6, least_cohesion: float = 0.9, least_surroundings: int = 8
) -> ValueModel:
    """Learn the value frequencies of a whole column.

    The column is first collapsed to its distinct fields with their counts, so a field that makes up a third of the rows
    costs as much as a rare one; what a stretch says about spans counts once for each distinct field. Pieces cohere if
    ``least_cohesion`` of the uses of either are beside the other, in ``least_surroundings`` or more different
    surroundings. Where nothing is a hypothesis every lattice has a single path, and nothing is left to learn.

    Rounds of EM work on the distinct ambiguous stretches only; all other values are counted once. They stop when the
    log likelihood changes by less than one in 10,000, or after ``rounds``. The model keeps all spans and all pieces of
    ambiguous stretches; of other pieces, which decide nothing in this column, those that make up at least ``min_share``
    of all values. What reaches the driver and the tasks thus grows with the number of different spans and pieces that
    are open, not with the rows.
    """
    if not spec.lattice:
        return EMPTY_MODEL
    fields = cut(df.select(col(field).cast("string").alias("text")).where(F.col("text").isNotNull()).groupBy("text").agg(F.count(F.lit(1)).alias("n")))
    spans = _hypotheses(fields, spec, least_cohesion, least_surroundings)
    if not spans.values and not spans.joins:
        return EMPTY_MODEL
    sorted_out = cut(fields.mapInArrow(_sort_out(spec, spans), "ambiguous boolean, value string, n double").groupBy("ambiguous", "value").agg(F.sum("n").alias("n")))
    sure, open_ = sorted_out.where("not ambiguous").select("value", "n"), sorted_out.where("ambiguous").select("value", "n")
    model, before = None, None
    for step in range(rounds):
        used = cut(open_.mapInArrow(_e_step(spans, model), "value string, n double").groupBy("value").agg(F.sum("n").alias("n")))
        likelihood = used.where("value is null").agg(F.sum("n")).first()[0]
        parts = sure.withColumn("open", F.lit(False)).unionByName(used.where("value is not null").withColumn("open", F.lit(True)))
        counts = cut(parts.groupBy("value").agg(F.sum("n").alias("n"), F.max("open").alias("open")))
        model = _model_of(counts, spec, spans, min_share)
        if likelihood is None or (before is not None and abs(likelihood - before) <= 1e-4 * abs(before)):
            break
        before = likelihood if step else None  # that of the neutral start is of no model
    values = frozenset(v for v in model.logp if pieces_of(v, spec) > 1)
    return ValueModel(model.logp, Spans(values, frozenset(), max((pieces_of(v, spec) for v in values), default=1)))


def _hypotheses(fields: DataFrame, spec: PackedSpec, least_cohesion: float, least_surroundings: int) -> Spans:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[tuple, int] = {}
            for text in b.column(0).to_pylist():
                for row in evidence(text, spec):
                    seen[row] = seen.get(row, 0) + 1
            cols = list(zip(*seen)) if seen else [[]] * 5
            yield pa.RecordBatch.from_arrays([*(pa.array(list(c), t) for c, t in zip(cols, [pa.string()] * 4 + [pa.int64()])), pa.array(list(seen.values()), pa.int64())], ["kind", "a", "mark", "b", "around", "n"])

    seen = fields.select("text").mapInArrow(run, "kind string, a string, mark string, b string, around bigint, n bigint")
    counts = cut(seen.groupBy("kind", "a", "mark", "b").agg(F.sum("n").alias("n"), F.approx_count_distinct("around").alias("surroundings")))
    whole = [r[0] for r in counts.where("kind = 'v'").select("a").collect()]
    uses = counts.where("kind = 'p'").select(F.col("a").alias("piece"), F.col("n").alias("uses"))
    pairs = counts.where((F.col("kind") == "j") & (F.col("surroundings") >= least_surroundings)).select("a", "mark", "b", "n")
    of = lambda c: uses.select(F.col("piece").alias(c), F.col("uses").alias(f"uses_{c}"))
    joins = pairs.join(of("a"), "a").join(of("b"), "b").where(F.col("n") >= least_cohesion * F.greatest("uses_a", "uses_b"))
    chains = [tuple(r) for r in joins.select("a", "mark", "b").collect()]
    return Spans(frozenset(whole), frozenset(chains), max((pieces_of(v, spec) for v in whole), default=1))


def _sort_out(spec: PackedSpec, spans: Spans):
    """Values of stretches with a single path, and the stretches with several, as JSON."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            into: dict[tuple[bool, str], float] = {}
            for text, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for stretch in stretches(text, spec):
                    pieces, marks = _cells(stretch)
                    edges = _edges(pieces, marks, spans) if len(pieces) > 1 else None
                    if edges and len(edges) > len(pieces):
                        keys = [(True, json.dumps([pieces, marks], ensure_ascii=False))]
                    else:
                        keys = [(False, t.strip()) for t, _ in pieces if not _dropped(t.strip())]
                    for key in keys:
                        into[key] = into.get(key, 0.0) + n
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in into], pa.bool_()), pa.array([k[1] for k in into], pa.string()), pa.array(list(into.values()), pa.float64())], ["ambiguous", "value", "n"])

    return run


def _e_step(spans: Spans, model: ValueModel | None):
    """Expected counts of a task's stretches; the row without a value is the log likelihood."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            into: dict[str, float] = {}
            likelihood = 0.0
            for text, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                pieces, marks = json.loads(text)
                likelihood += expected_counts([tuple(p) for p in pieces], marks, n, spans, model, into)
            yield pa.RecordBatch.from_arrays([pa.array([*into, None], pa.string()), pa.array([*into.values(), likelihood], pa.float64())], ["value", "n"])

    return run


def _model_of(counts: DataFrame, spec: PackedSpec, spans: Spans, min_share: float) -> ValueModel:
    """M-step. A span that is left with less than half a use is given up."""
    marks = F.col("value").rlike("[" + "".join(re.escape(c) for c in spec.soft) + "]")
    total = counts.agg(F.sum("n")).first()[0] or 0.0
    rows = counts.where((marks & (F.col("n") >= 0.5)) | (~marks & (F.col("open") | (F.col("n") >= total * min_share)))).collect()
    logp = {r[0]: math.log(r[1] / total) for r in rows}
    return ValueModel(logp, spans, math.log(min(1e-9, 0.5 / max(total, 1.0))))


def split_packed(df: DataFrame, key: str, field: str, spec: PackedSpec = NAMES, model: ValueModel | None = None) -> DataFrame:
    """One row per value: ``row_key`` (bigint), ``pos`` (int, from 1), ``item``. Narrow: no shuffle."""
    model = learn_values(df, field, spec) if model is None else model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            memo: dict[str, list[str]] = {}
            keys, pos, items = [], [], []
            for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got = memo.get(text)
                if got is None:
                    got = memo[text] = split_text(text, spec, model)
                keys += [k] * len(got)
                pos += range(1, len(got) + 1)
                items += got
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(pos, pa.int32()), pa.array(items, pa.string())], ["row_key", "pos", "item"])

    text = col(field).cast("string")
    return df.select(col(key).cast("bigint").alias("row_key"), text.alias("text")).where(F.col("text").isNotNull()).mapInArrow(run, "row_key bigint, pos int, item string")
