"""Variant spellings of typed names, linked to a registry by exact radius joins in a partitioned metric space.

Every distinct spelling is read in all the ways it can be meant (which part is the surname). The surnames, and the whole
names of groups, are points in the metric space of edit distance. Pivots are chosen among the registry's names; a
registry name lies in the cell of its nearest pivot, and a typed name is sent to every cell that may hold a name within
the radius, which the triangle inequality decides. Inside a cell, distances to the pivot narrow the search further, and
the true edit distance is exact. The given names then decide between those with a fitting surname.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import col, present
from plumbline.session import cut

# --- the metric space -------------------------------------------------------------------------------------------


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance: insertions, deletions and substitutions. A metric."""
    if len(a) < len(b):
        a, b = b, a
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def choose_pivots(points: Sequence[str], n: int) -> list[str]:
    """Farthest-first pivots: each is as far as possible from those before it."""
    points = sorted(set(points))
    if not points:
        return []
    pivots = [points[len(points) // 2]]
    nearest = {x: edit_distance(x, pivots[0]) for x in points}
    while len(pivots) < min(n, len(points)):
        far = max(points, key=lambda x: nearest[x])
        if not nearest[far]:
            break
        pivots.append(far)
        for x in points:
            nearest[x] = min(nearest[x], edit_distance(x, far))
    return pivots


def radius_join(left: DataFrame, left_key: str, right: DataFrame, right_key: str, radius: int, n_pivots: int = 24, sample: int = 2000) -> DataFrame:
    """All pairs of keys within ``radius`` edits: columns ``left_key``, ``right_key``, ``distance``.

    Exact for any choice of pivots; they are taken from at most ``sample`` keys of the right side. A right key x lies in
    the cell of its nearest pivot p. If d(q, x) <= radius, then d(q, p) <= d(q, p') + 2 radius for every pivot p', and
    d(q, p) <= R + radius, with R the cell's extent: a left key q is sent to these cells only. There, d(q, p) and d(x, p)
    differ by at most the radius, so cell and distance to the pivot together are the join key. Keys are made distinct
    first; NULL keys have no neighbours. Either side may be empty.
    """
    spark = left.sparkSession
    q = left.select(col(left_key).cast("string").alias("q")).where("q is not null").distinct()
    x = right.select(col(right_key).cast("string").alias("x")).where("x is not null").distinct()
    pivots = choose_pivots([r[0] for r in x.orderBy(F.xxhash64("x"), "x").limit(sample).collect()], n_pivots)
    names = f"`{left_key}` string, `{right_key}` string, distance int"
    if not pivots:
        return spark.createDataFrame([], names)
    to_pivots = lambda c: F.array(*[F.levenshtein(c, F.lit(p)) for p in pivots])
    cells = x.withColumn("d", to_pivots(F.col("x"))).select("x", F.expr("int(array_position(d, array_min(d)) - 1)").alias("cell"), F.array_min("d").alias("ring"))
    extent = {r[0]: r[1] for r in cells.groupBy("cell").agg(F.max("ring")).collect()}  # one row a pivot
    extents = F.array(*[F.lit(extent.get(i, -(10**6))) for i in range(len(pivots))])
    sent = (
        q.withColumn("d", to_pivots(F.col("q"))).withColumn("extent", extents).withColumn("least", F.array_min("d"))
        .select("q", F.explode(F.expr(f"filter(transform(d, (v, i) -> struct(int(i) as cell, v as at, element_at(extent, int(i) + 1) as far)), c -> c.at <= c.far + {radius} and c.at <= least + {2 * radius})")).alias("c"))
        .select("q", "c.cell", F.explode(F.expr(f"sequence(greatest(0, c.at - {radius}), c.at + {radius})")).alias("ring"))
    )
    near = sent.join(cells, ["cell", "ring"]).withColumn("distance", F.levenshtein("q", "x", radius))
    return near.where(F.col("distance").between(0, radius)).select(F.col("q").alias(left_key), F.col("x").alias(right_key), "distance")


# --- reading a typed name ---------------------------------------------------------------------------------------

#: Common short forms of given names.
SHORT_FORMS = {
    "alexander": "alex sasha", "andreas": "andi dre", "benjamin": "ben benny", "charlotte": "lotte charlie", "christopher": "chris kit",
    "dmitri": "dima mitya", "edward": "ned eddie ted", "elizabeth": "liz beth betty lisa", "francisco": "paco fran", "friedrich": "fritz fred",
    "gabriella": "gaby ella", "giuseppe": "pino beppe", "henrietta": "hetty etta", "ignacio": "iggy nacho", "isabella": "bella isa",
    "johanna": "hanna jo", "josephine": "josie fina jo", "katherine": "kate kathy kit", "laurence": "laurie larry", "leonardo": "leo nardo",
    "magdalena": "magda lena", "margaret": "peggy maggie", "michael": "mike mick", "natalia": "talia natasha", "nicholas": "nick klaas",
    "oliver": "ollie noll", "patricia": "pat tricia", "richard": "rick dick", "robert": "rob bob", "susanna": "susi sanna",
    "theodor": "theo ted", "ursula": "ulla uschi", "veronika": "vera nika", "victoria": "vicky tori", "wilhelmina": "mina willa",
    "william": "will bill", "yevgenia": "zhenya jenia", "zachary": "zach zak", "james": "jim", "john": "jack", "thomas": "tom",
    "anthony": "tony", "samuel": "sam", "daniel": "dan", "david": "dave", "joseph": "joe", "charles": "chuck", "matthew": "matt", "stephen": "steve",
}

#: Particles before a surname, titles, words of groups.
PARTICLES = frozenset("van der den de la von zu al el di da du le ter ten bin".split())
TITLES = frozenset("dr prof professor mr mrs ms phd md msc bsc mph frcp jr sr ii iii".split())
GROUP_WORDS = frozenset("group network alliance consortium party working study trial registry imaging collaboration society initiative team committee investigators".split())
GROUP_SHORT = {"grp": "group", "gp": "group", "netw": "network", "consort": "consortium", "cons": "consortium", "all": "alliance", "allian": "alliance", "reg": "registry", "wkg": "working", "collab": "collaboration", "soc": "society", "inv": "investigators"}
GROUP_NOISE = frozenset("the of for and on investigators".split())

_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*\.?")
_LETTERS = str.maketrans({"ø": "o", "Ø": "O", "đ": "d", "ł": "l", "ß": "ss", "æ": "a", "œ": "o", "ð": "d", "þ": "th", "ı": "i"})


def unaccented(text: str) -> str:
    """Lower case without accents."""
    return "".join(c for c in unicodedata.normalize("NFD", text.lower().translate(_LETTERS)) if not unicodedata.combining(c))


def folded(text: str) -> str:
    """Lower case without accents; ae, oe and ue as typed for them count as a, o and u."""
    return re.sub(r"([aou])e", r"\1", unaccented(text))


_SHORT = {full: tuple(forms.split()) for full, forms in SHORT_FORMS.items()}
_FULL = {x: frozenset(full for full, forms in _SHORT.items() if x in forms) for forms in _SHORT.values() for x in forms}


def _et_al(name: str) -> tuple[str, bool]:
    cut = re.sub(r"(?i)[\s,;&]*\bet\.?\s+al\b\.?\s*$", "", name)
    return cut, cut != name


def split_authors(text: str | None) -> list[str]:
    """The names in an authors field in order. ``et al`` is no name."""
    if text is None:
        return []
    s, _ = _et_al(text.strip())
    for mark in (r"\s*;\s*", r"\s*\|\s*", r"\s+&\s+", r"\s+and\s+"):
        if re.search(mark, s):
            return [p.strip() for p in re.split(mark, s) if p.strip() and not re.fullmatch(r"(?i)et\.?\s+al\.?|nan", p.strip())]
    parts = [p.strip() for p in s.split(",") if p.strip()]
    # "Surname AB, Surname C" is a list; "Surname, Given" is one name
    listed = [bool(re.search(r"\S\s+(?:[^\W\d_]\.?\s?-?){1,3}$", p)) and p[-1:].upper() == p[-1:] for p in parts]
    if len(parts) > 2 or (len(parts) == 2 and all(listed)):
        return parts
    return [s] if s and s.lower() != "nan" else []


def _initials(token: str) -> bool:
    bare = token.rstrip(".")
    return len(bare) == 1 or (len(bare) <= 3 and bare.isupper())


@lru_cache(maxsize=100_000)
def _group_word(word: str) -> str:
    """The word of groups that this one is typed for, else the word itself."""
    if word in GROUP_WORDS or len(word) < 4:
        return word
    near = sorted((edit_distance(word, g), g) for g in GROUP_WORDS if abs(len(word) - len(g)) < 3 and len(g) > 4)
    return near[0][1] if near and (near[0][0] == 1 or (near[0][0] == 2 and len(word) > 6) or _one_typo(word, near[0][1])) else word


def readings(name: str) -> list[tuple[str, str, list[str], bool]]:
    """The ways to read a name: (kind, key of surname or group, given names, has particle). Kinds: person, group.

    Given names come as typed: folded words, with a full stop kept after cut ones and single letters for initials.
    """
    s, _ = _et_al(name)
    s = re.sub(r"\([^()]*\)", " ", s)
    words = [folded(w.rstrip(".")) for w in _TOKEN.findall(s.replace("-", " "))]
    expanded = [_group_word(GROUP_SHORT.get(w, w)) for w in words]
    if sum(w in GROUP_WORDS for w in expanded) >= 2:
        return [("group", "".join(sorted(w for w in expanded if w not in GROUP_NOISE)), [], False)]

    head, comma, tail = s.partition(",")

    def tokens(part: str) -> tuple[list[str], bool]:
        found = []
        particle = False
        bare = (raw.strip(",*†‡§0123456789") for raw in part.split())
        plain = [t for t in bare if any(ch.isalpha() for ch in t)]
        shouting = any(len(t) > 3 and t.isupper() for t in plain)
        for i, t in enumerate(plain):
            low = folded(t.rstrip("."))
            # two or three capitals at the end are initials, even if they spell a particle or, after one word, a title
            capitals = t.isupper() and 1 < len(t) < 4 and i == len(plain) - 1 and not shouting
            if low in TITLES and not (capitals and (low not in ("md", "jr", "sr", "dr", "phd") or (len(plain) == 2 and not comma and len(t) == 2))):
                continue
            if low in PARTICLES and not capitals:
                particle = True
                continue
            found.append(t)
        return found, particle

    def key(parts: Sequence[str]) -> str:
        return "".join(ch for ch in folded(" ".join(parts)) if ch.isalpha())

    def given(parts: Sequence[str]) -> list[str]:
        out: list[str] = []
        for t in parts:
            bits = [b for b in re.split(r"(?<=\.)|-", t) if b]
            for b in bits:
                bare = b.rstrip(".")
                if not bare:
                    continue
                if len(bare) <= 3 and bare.isupper() and len(bare) > 1:
                    out += [unaccented(ch) for ch in bare]
                elif len(bare) == 1:
                    out.append(unaccented(bare))
                else:
                    out.append(unaccented(bare) + ("." if b.endswith(".") else ""))
        return out

    if comma:
        tail = tail.replace(",", " ")
        a, pa_ = tokens(head)
        b, pb = tokens(tail)
        if a and b:
            return [("person", key(a), given(b), pa_ or pb)]
        s = f"{head} {tail}"
    t, particle = tokens(s)
    if len(t) < 2:
        return [("person", key(t), [], particle)] if t and key(t) else []
    shouted = [i for i, x in enumerate(t) if len(x.rstrip(".")) > 3 and x.isupper()]
    splits: list[tuple[int, int]] = []
    if shouted and len(shouted) < len(t):
        splits.append((shouted[0], shouted[-1] + 1))
    else:
        n = len(t)
        front = not all(_initials(x) for x in t[:1])  # the first word can be a surname
        back = not _initials(t[-1])
        if back:
            splits.append((n - 1, n))
            if n > 2:
                splits.append((n - 2, n))
        if front:
            splits.append((0, 1))
            if n > 2:
                splits.append((0, 2))
    out = []
    for i, j in splits:
        rest = t[:i] + t[j:]
        if rest and key(t[i:j]):
            out.append(("person", key(t[i:j]), given(rest), particle))
    return out


def _one_typo(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    d = edit_distance(a, b)
    return d == 1 or (d == 2 and len(a) == len(b) and sorted(a) == sorted(b))


def _token_cost(typed: str, full: str) -> int | None:
    """How far a typed given name is from a registered one: 0 equal, 1 a short form, 2 cut, 3 typing error, 4 initial."""
    bare = typed.rstrip(".")
    if bare == full:
        return 0
    if len(bare) == 1:
        return 4 if full[:1] == bare else None
    if full in _FULL.get(bare, ()):
        return 1
    forms = [full, *_SHORT.get(full, ())]
    if typed.endswith(".") or len(bare) == 3:
        if any(f.startswith(bare) for f in forms):
            return 2
    if bare in _SHORT or bare in _FULL:
        return None  # a name of its own, no typing error
    if typed.endswith("."):
        if len(bare) < 3 or any(f.startswith(bare) for f in (*_SHORT, *_FULL)):
            return None  # cut from another name
        return 3 if bare[0] == full[0] and any(edit_distance(bare, full[:k]) <= 1 for k in (len(bare) - 1, len(bare), len(bare) + 1)) else None
    return 3 if any(len(f) > 3 and _one_typo(bare, f) for f in forms) else None


def given_cost(typed: Sequence[str], registered: Sequence[str]) -> int | None:
    """Cost of reading the typed given names as the registered ones; None if they contradict each other.

    Later given names may be left out when typing, but not be added.
    """
    if not typed or len(typed) > len(registered):
        return None
    total = 0
    for i, (a, b) in enumerate(zip(typed, registered)):
        c = _token_cost(a, b)
        if c is None:
            return None
        total += c * (10 if i == 0 else 1)
    return total + (len(registered) - len(typed))


# --- linking ----------------------------------------------------------------------------------------------------

_READING = "name string, kind string, point string, given array<string>, particle boolean"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [(n, *r) for n in b.column(0).to_pylist() for r in readings(n)]
        cols = list(zip(*rows)) if rows else [[]] * 5
        types = [pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], ["name", "kind", "point", "given", "particle"])


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        typed, reg, kind, distance, pt, pr = (b.column(i).to_pylist() for i in (3, 4, 2, 5, 6, 7))
        costs = []
        for t, r, k, d, x, y in zip(typed, reg, kind, distance, pt, pr):
            c = 0 if k == "group" else given_cost(t, r)
            costs.append(None if c is None else c + 5 * d + (2 if x != y else 0))
        initial = [k == "person" and all(len(x) == 1 for x in t) for t, k in zip(typed, kind)]
        keep = pa.array([c is not None for c in costs])
        out = pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(costs, pa.int32()), pa.array(initial, pa.bool_())], ["name", "id", "cost", "initial"])
        yield out.filter(keep)


def link_names(names: DataFrame, name: str, weight: str, registry: DataFrame, ident: str, display: str, radius: int = 2) -> DataFrame:
    """``name`` and ``ident`` for every distinct spelling that means an entry of the registry.

    ``names`` has one row for each spelling with the number of times it is used (``weight``). A spelling is linked to
    the entry that it fits best; if several fit equally well, or typed initials are at least as likely to mean people
    outside the registry who are written in full with the same surname and initial, it is linked to none. Missing names
    have no link. Registry entries with missing names, or equal in all parts, are never chosen by themselves. Empty
    sides give an empty result.
    """
    typed = names.select(present(col(name)).alias("name"), col(weight).alias("weight")).where("name is not null").groupBy("name").agg(F.sum("weight").alias("weight"))
    entries = registry.select(col(ident).cast("string").alias("id"), present(col(display)).alias("name")).where("id is not null and name is not null")
    read = typed.select("name").mapInArrow(_read, _READING)
    # a registry name is clean: given names first, the surname last
    known = entries.select("name").distinct().mapInArrow(_read_clean, _READING).join(entries, "name").select("id", "kind", "point", F.col("given").alias("full"), F.col("particle").alias("full_particle"))
    marked = lambda df: df.withColumn("at", F.concat(F.substring("kind", 1, 1), "point"))
    left, right = cut(marked(read)), cut(marked(known))  # read once, used by several joins
    near = radius_join(left, "at", right.withColumnRenamed("at", "place"), "place", radius)
    # a typed group name that is itself in the registry is no typing error of another; else the one nearest entry counts
    groups = near.where(F.col("at").startswith("g")).withColumn("least", F.min("distance").over(Window.partitionBy("at"))).where("distance = least").drop("least")
    near = cut(near.where(~F.col("at").startswith("g")).unionByName(groups))
    matched = left.join(near.select("at", "place", "distance"), "at").join(right.select("id", "full", "full_particle", F.col("at").alias("place")), "place")
    fits = matched.select("name", "id", "kind", "given", "full", "distance", "particle", "full_particle").mapInArrow(_fit, "name string, id string, cost int, initial boolean")
    best = fits.groupBy("name", "id").agg(F.min("cost").alias("cost"), F.min("initial").alias("initial"))
    w = Window.partitionBy("name")  # the entries that one spelling fits
    best = best.withColumn("least", F.min("cost").over(w)).where("cost = least").withColumn("ways", F.count(F.lit(1)).over(w)).where("ways = 1")
    best = cut(best.select("name", "id", "cost", "initial"))
    return _outweighed(best, left, typed, near, right).select(F.col("name").alias(name), F.col("id").alias(ident))


def _read_clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [(n, *readings(n)[0]) for n in b.column(0).to_pylist() if readings(n)]
        cols = list(zip(*rows)) if rows else [[]] * 5
        types = [pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], ["name", "kind", "point", "given", "particle"])


def _outweighed(best: DataFrame, read: DataFrame, typed: DataFrame, near: DataFrame, known: DataFrame) -> DataFrame:
    """Drops initials that more likely mean people outside: by how often either is written in full."""
    places = near.select("at", "place")
    spelled = read.where("kind = 'person'").join(places, "at").join(typed, "name").where(F.length(F.rtrim(F.get("given", F.lit(0)), F.lit("."))) > 1)
    first = F.substring(F.get("given", F.lit(0)), 1, 1)
    linked = best.where("not initial").select("name", "id")
    full = spelled.select("name", "place", first.alias("letter"), "weight").join(linked, "name", "left")
    inside = full.where("id is not null").groupBy("id").agg(F.sum("weight").alias("inside"))
    outside = full.where("id is null").groupBy("place", "letter").agg(F.sum("weight").alias("outside"))
    own = known.select("id", F.col("at").alias("place"), F.substring(F.get("full", F.lit(0)), 1, 1).alias("letter"))
    rivals = own.join(outside, ["place", "letter"], "left").join(inside, "id", "left")
    lost = rivals.where(F.coalesce("outside", F.lit(0)) > F.coalesce("inside", F.lit(0))).select("id", F.lit(True).alias("lost")).distinct()
    return best.join(lost, "id", "left").where(~(F.col("initial") & F.coalesce("lost", F.lit(False))))


def seed_names(seeds: DataFrame, key: str, authors: str) -> DataFrame:
    """``record_key``, ``pos`` (from 1), ``name`` for each name in an authors field."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(k, i, n) for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for i, n in enumerate(split_authors(t), 1)]
            cols = list(zip(*rows)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.string()))], ["record_key", "pos", "name"])

    return seeds.select(col(key).cast("string"), col(authors).cast("string")).mapInArrow(run, "record_key string, pos int, name string")


def link_tables(spark: SparkSession, parts: Sequence[tuple[str, DataFrame]], registry: DataFrame, ident: str, display: str) -> DataFrame:
    """``table_name``, ``record_key``, ``pos``, ``ident`` for names of several tables (``record_key, pos, name``).

    Spellings are counted first, with partial sums in every task, so a name that fills a third of the rows is read and
    linked once.
    """
    rows = None
    for table_name, df in parts:
        part = df.select(F.lit(table_name).alias("table_name"), "record_key", "pos", present(F.col("name")).alias("name")).where("name is not null")
        rows = part if rows is None else rows.unionByName(part)
    counted = rows.groupBy("name").agg(F.count(F.lit(1)).alias("uses"))
    links = link_names(counted, "name", "uses", registry, ident, display)
    return rows.join(links, "name").select("table_name", "record_key", "pos", ident)
