"""Best representative of each duplicate group: whole bundles of fields, chosen by branch and bound.

Fields that depend on each other form a *bundle*, which is taken from one record as a whole. Every record that
qualifies for a bundle is a candidate with a trust (an exact number, then recency, then the smaller identifier).
*Dependencies* tie bundles together: where a functional dependency X -> Y crosses two bundles, the chosen values of X
and Y must stand together in at least one record of the group. Branch and bound finds the choice of candidates with
the greatest total trust under all dependencies.

Candidates are thinned before any group comes together: of records with the same values of the dependency's fields,
only the most trusted can be in the best choice, so an aggregate with map-side combining keeps one for each distinct
value. Bundles that no dependency touches thus have a single candidate, however many records the group has. The first
bound is also worked out by an aggregate: taking all tied bundles from one record is always allowed, so a candidate that
cannot reach the best such total, even beside the most trusted candidates of the other bundles, never comes together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import col, is_missing
from plumbline.session import cut


@dataclass(frozen=True)
class Bundle:
    """``fields`` are taken together from one record; ``qualifies`` says which records may give them; ``quality``
    (whole number, larger is better) comes before recency."""

    name: str
    fields: tuple[str, ...]
    qualifies: Column
    quality: Column | None = None
    weight: int = 1


@dataclass(frozen=True)
class Dependency:
    """``determinant`` (a field of one bundle) fixes ``dependent`` (a field of another)."""

    determinant: str
    dependent: str


def choose(candidates: Sequence[Sequence[tuple[int, int, dict]]], allowed: Callable[[dict, dict], bool]) -> list[int | None]:
    """Branch and bound over one group.

    ``candidates[b]`` are (trust, identifier, values) of bundle b, best first; ``allowed(values so far, values)`` tells
    whether a candidate may be joined to the choice. Returns an identifier, or None, for each bundle. Leaving a bundle
    open is always allowed and worth nothing, so there is a choice for every group. Ties go to the first candidates.
    """
    n = len(candidates)
    rest = [0] * (n + 1)  # the most that the bundles from b on can add
    for b in range(n - 1, -1, -1):
        rest[b] = rest[b + 1] + (candidates[b][0][0] if candidates[b] else 0)
    best_total, best = -1, [None] * n
    stack: list[tuple[int, int, dict, list]] = [(0, 0, {}, [])]
    while stack:
        b, total, values, picked = stack.pop()
        if total + rest[b] <= best_total:
            continue
        if b == n:
            best_total, best = total, picked
            continue
        later = []
        for trust, ident, own in candidates[b]:
            if total + trust + rest[b + 1] <= best_total:
                break  # candidates come best first
            if allowed(values, own):
                later.append((b + 1, total + trust, values | own, [*picked, ident]))
                if not own:
                    break  # ties no other bundle, so no worse candidate can be needed
        if not later or candidates[b][0][2]:
            later.append((b + 1, total, values, [*picked, None]))
        stack.extend(reversed(later))
    return best


def best_representative(df: DataFrame, key: str, ident: str, when: str, bundles: Sequence[Bundle], dependencies: Sequence[Dependency] = (), least_records: int = 2) -> DataFrame:
    """``key``, ``bundle`` and ``ident`` of the record that each bundle is taken from.

    Only groups with ``least_records`` or more records come out, and only bundles for which a record qualifies and
    that fit the choice. Records with a NULL key form no group; those with a NULL identifier are not candidates; a
    NULL ``when`` counts as oldest. Repeated rows are candidates like others and change nothing. Column names of the
    input may be any.
    """
    names = [b.name for b in bundles]
    crossing = sorted({x for d in dependencies for x in (d.determinant, d.dependent)})
    inside = {b.name: [f for f in crossing if f in b.fields] for b in bundles}
    stamp = F.coalesce(F.unix_micros(col(when).cast("timestamp")), F.lit(-(2**62)))
    offers = [
        F.when(
            F.coalesce(b.qualifies, F.lit(False)),
            F.struct(
                F.lit(i).alias("b"),
                F.array(*[F.coalesce(col(f).cast("string"), F.lit("")) for f in inside[b.name]]).cast("array<string>").alias("tie"),
                F.struct(
                    (F.lit(0) if b.quality is None else b.quality).cast("bigint").alias("quality"), stamp.alias("at"), (-col(ident).cast("bigint")).alias("id")
                ).alias("trust"),
            ),
        )
        for i, b in enumerate(bundles)
    ]
    records = df.where(col(key).isNotNull() & col(ident).isNotNull())
    offered = records.select(col(key).alias("k"), F.explode(F.array_compact(F.array(*offers))).alias("o"))
    thinned = offered.groupBy("k", F.col("o.b").alias("b"), F.col("o.tie").alias("tie")).agg(F.max("o.trust").alias("trust"))
    tied = [i for i, b in enumerate(bundles) if inside[b.name]]
    if dependencies:
        thinned = _within_bound(thinned, records.select(col(key).alias("k"), *[offers[i].alias(f"o{i}") for i in tied]), tied, [b.weight for b in bundles])
    grouped = thinned.groupBy("k").agg(F.collect_list(F.struct("b", "tie", "trust")).alias("c"))
    if least_records > 1:
        sizes = records.groupBy(col(key).alias("k")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_records).select("k")
        grouped = grouped.join(sizes, "k", "left_semi")
    if dependencies:
        text = lambda name: F.coalesce(col(name).cast("string"), F.lit(""))
        pairs = F.array(*[F.struct(F.lit(i).alias("d"), text(d.determinant).alias("x"), text(d.dependent).alias("y")) for i, d in enumerate(dependencies)])
        seen = records.select(col(key).alias("k"), F.explode(pairs).alias("p")).distinct().select("k", "p.d", "p.x", "p.y")
        # only pairs of values that are still candidates
        place = {f: (i, inside[b.name].index(f)) for i, b in enumerate(bundles) for f in inside[b.name]}
        value = lambda f: F.when(F.col("b") == place[f][0], F.col("tie")[place[f][1]])
        for side, fields in (("x", [d.determinant for d in dependencies]), ("y", [d.dependent for d in dependencies])):
            own = F.array(*[F.struct(F.lit(i).alias("d"), value(f).alias(side)) for i, f in enumerate(fields)])
            left = thinned.select("k", F.explode(own).alias("v")).select("k", "v.d", f"v.{side}").where(F.col(side).isNotNull()).distinct()
            seen = seen.join(left, ["k", "d", side], "left_semi")
        seen = seen.groupBy("k").agg(F.collect_list(F.struct("d", "x", "y")).alias("seen"))
        grouped = grouped.join(seen, "k", "left")
    else:
        grouped = grouped.withColumn("seen", F.lit(None).cast("array<struct<d:int,x:string,y:string>>"))
    weights = [b.weight for b in bundles]
    ties = [inside[n] for n in names]
    deps = [(d.determinant, d.dependent) for d in dependencies]
    schema = df.select(col(key).alias("k")).schema["k"].dataType.simpleString()

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_k, out_b, out_i = [], [], []
            for k, cands, seen in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                groups: list[list] = [[] for _ in names]
                for c in cands:
                    t = c["trust"]
                    # one exact number: quality, then recency, then the smaller identifier
                    trust = weights[c["b"]] * (((t["quality"] << 65) + (t["at"] + 2**63)) * 2**64 + t["id"] + 2**63)
                    groups[c["b"]].append((trust, -t["id"], dict(zip(ties[c["b"]], c["tie"]))))
                for g in groups:
                    g.sort(key=lambda x: -x[0])
                together = {(p["d"], p["x"], p["y"]) for p in seen or ()}

                def allowed(have: dict, own: dict, together=together) -> bool:
                    for d, (x, y) in enumerate(deps):
                        both = have | own
                        if (x in own or y in own) and x in both and y in both and (d, both[x], both[y]) not in together:
                            return False
                    return True

                for name, ident_ in zip(names, choose(groups, allowed)):
                    if ident_ is not None:
                        out_k.append(k)
                        out_b.append(name)
                        out_i.append(ident_)
            yield pa.RecordBatch.from_arrays([pa.array(out_k, batch.schema.field(0).type), pa.array(out_b, pa.string()), pa.array(out_i, pa.int64())], ["k", "b", "i"])

    solved = grouped.select("k", "c", "seen").mapInArrow(solve, f"k {schema}, b string, i bigint")
    return solved.select(F.col("k").alias(key), F.col("b").alias("bundle"), F.col("i").alias(ident))


def _within_bound(thinned: DataFrame, records: DataFrame, tied: Sequence[int], weights: Sequence[int]) -> DataFrame:
    """Candidates that can reach the best total that a single record gives. Identifiers, the last part of a trust, count
    for less than one unit here, so the bound is loosened by one for each unit of weight."""
    number = lambda t, w: (t["quality"].cast("decimal(20,0)") * F.lit(Decimal(2**65)) + t["at"].cast("decimal(20,0)") + F.lit(Decimal(2**63))).cast("decimal(38,0)") * F.lit(w)
    sums = records.select("k", *[F.coalesce(number(F.col(f"o{i}")["trust"], weights[i]), F.lit(Decimal(0))).cast("decimal(38,0)").alias(f"v{i}") for i in tied])
    together = sum((F.col(f"v{i}") for i in tied[1:]), F.col(f"v{tied[0]}")).cast("decimal(38,0)")
    bounds = sums.groupBy("k").agg(F.max(together).alias("reached"), *[F.max(f"v{i}").alias(f"top{i}") for i in tied])
    others = {i: sum((F.col(f"top{j}") for j in tied if j != i), F.lit(Decimal(0))) for i in tied}
    own = F.coalesce(*[F.when(F.col("b") == i, number(F.col("trust"), weights[i]) + others[i]) for i in tied])
    loose = thinned.where(F.col("b").isin(*tied)).join(bounds, "k").where(F.coalesce(own + sum(weights) >= F.col("reached"), F.lit(True)))
    return thinned.where(~F.col("b").isin(*tied)).unionByName(loose.select(*thinned.columns))


# --- what makes a value whole -----------------------------------------------------------------------------------

#: Notices that stand in for an abstract.
STAND_INS = r"n\s*/?\s*a|none|null|nan|nil|unknown|untitled|tba|tbd|to be (?:added|announced)|no (?:abstract|summary|text)\b.{0,40}|(?:the )?(?:abstract|summary)(?: is| was)? (?:not|un)\s?\w*.{0,40}"

#: Openings of page furniture that is no part of an abstract.
FURNITURE = (
    "Sign in to continue reading", "All rights reserved", "Related articles you may like", "This site stores small files",
    "Subscribe to alerts", "No part of this work may be", "Article history:", "Most read this month", "Advertise with us",
    "Submit a manuscript", "Editorial board", "Instructions for authors", "Reprints and permissions",
)

#: Marks of a text that was cut off.
CUT_MARKS = r"(?:\x{2026}|\.\.\.|\[\s*(?:truncated|\x{2026}|\.\.\.|more)\s*\]|\(\s*(?:truncated|more|continued|\x{2026})\s*\)|(?i:read more))\s*$"

_FURNITURE_SENTENCE = r"(?i)(?:" + "|".join(FURNITURE) + r")[^.]*(?:\.|$)"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _has_any(text: Column, phrases: Sequence[str]) -> Column:
    return _bound(F.lower(text), lambda low: reduce(Column.__or__, [low.contains(x.lower()) for x in phrases]))


def bare_abstract(text: Column) -> Column:
    """The text without mark-up, page furniture and marks of a cut, and without blanks at its ends.

    Patterns run only on texts that hold what they look for, which a plain search tells at a fraction of their cost.
    """

    def without(x: Column, phrases: Sequence[str], pattern: str) -> Column:
        return _bound(x, lambda t: F.when(_has_any(t, phrases), F.regexp_replace(t, pattern, "")).otherwise(t))

    bare = without(text, ("<",), r"<\/?[A-Za-z][^<>]*>")
    bare = without(bare, FURNITURE, _FURNITURE_SENTENCE)
    bare = without(bare, ("\u2026", "...", "[", "(", "read more"), CUT_MARKS)
    return F.regexp_replace(bare, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def own_abstract(abstract: Column, title: Column) -> Column:
    """The bare abstract, or NULL where the text is missing, a notice, or the title again."""
    stand_in = is_missing(abstract) | abstract.rlike(r"(?is)^[^\p{L}\p{N}]*(?:" + STAND_INS + r")[^\p{L}\p{N}]*$")
    plain = lambda x: F.trim(F.lower(F.regexp_replace(x, r"[^\p{L}\p{N}]+", " ")))
    first = lambda x: F.lower(F.regexp_extract(x, r"[\p{L}\p{N}]+", 0))
    is_title = F.when(first(abstract) == first(title), plain(abstract) == plain(title))
    bare = F.when(~stand_in & ~F.coalesce(is_title, F.lit(False)), bare_abstract(abstract))
    return F.nullif(bare, F.lit(""))


def ends_a_sentence(text: Column) -> Column:
    return text.rlike(r"[.!?][\"'\)\]\x{201d}\x{2019}]*$")


def filler_number(c: Column) -> Column:
    """Numbers typed or set where none was known: five or more nines, and the greatest values of integer types."""
    digits = c.cast("string")
    return digits.rlike("^9{5,}$") | c.isin(2**31 - 1, 2**32 - 1, 2**63 - 1)


def well_formed_ids(c: Column) -> Column:
    """The distinct work identifiers in a packed list: W and eleven digits, with or without a resolver in front."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"(?<![^\s;,|\"\[])(?:https?:\/\/[a-z.]+\/)?(W\d{11})(?=[\s;,|\"\]]|$)"), 1))


def with_group_facts(df: DataFrame, key: str, ident: str, when: str, abstract: str, title: str, count: str, kept: Mapping[str, Column], least_records: int = 2) -> DataFrame:
    """``key``, ``ident``, ``when`` and ``kept`` of every record, and what the whole group says of it: columns ``whole``
    and ``counted`` (booleans).

    ``whole``: the abstract is the group's complete one and nothing else: as it stands it is the longest bare text, and
    that ends as a sentence does. ``counted``: the count is real, so it is neither NULL, negative nor a filler, nor 0
    after an earlier real count above 0. Groups below ``least_records`` are left out.

    Texts are read once: what is written to the checkpoint folder holds a digest and the length of the bare text instead.
    The group's facts are one aggregate over that, combined in every map task, with one row for each key; joined back, a
    key that fills a third of the rows is split by the engine's skew handling.
    """
    number, k = col(count), col(key)
    bare = own_abstract(F.col("abstract"), F.col("title"))
    as_it_stands = F.regexp_replace(col(abstract), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    read = df.where(k.isNotNull()).select(
        k.alias("k"), col(ident).alias("i"), col(when).alias("w"), number.alias("c"), col(abstract).alias("abstract"), col(title).alias("title"), as_it_stands.alias("stands"), *[c.alias(f"kept_{n}") for n, c in kept.items()]
    )
    facts_of = lambda t: F.struct(F.when(t.isNotNull(), F.struct(F.length(t).alias("l"), F.md5(t).alias("d"))).alias("size"), F.coalesce((F.col("stands") == t) & ends_a_sentence(t), F.lit(False)).alias("alone"))
    real = F.coalesce((F.col("c") >= 0) & ~filler_number(F.col("c")), F.lit(False))
    noted = read.select("k", "i", "w", "c", _bound(bare, facts_of).alias("text"), real.alias("real"), *[f"kept_{n}" for n in kept])
    noted = cut(noted.select("k", "i", "w", "c", "text.size", "text.alone", "real", *[f"kept_{n}" for n in kept]))
    facts = noted.groupBy("k").agg(F.max("size").alias("longest"), F.min(F.when(F.col("real") & (F.col("c") > 0), F.col("w"))).alias("above"), F.count(F.lit(1)).alias("n"))
    joined = noted.join(facts.where(F.col("n") >= least_records), "k")
    late_zero = F.coalesce((F.col("c") == 0) & (F.col("w") > F.col("above")), F.lit(False))
    whole = F.coalesce(F.col("alone") & (F.col("size") == F.col("longest")), F.lit(False))
    out = joined.select(F.col("k").alias(key), F.col("i").alias(ident), F.col("w").alias(when), whole.alias("whole"), (F.col("real") & ~late_zero).alias("counted"), *[F.col(f"kept_{n}").alias(n) for n in kept])
    return cut(out)
