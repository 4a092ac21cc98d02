"""Evaluation texts inside training text: a BM25 index of the test items, queried by every training passage.

The items make an inverted index with BM25 impacts in blocks. Every document is cut into overlapping passages, and each
passage is a query, answered by block-max WAND: lists of postings are skipped, by the greatest impact of a term and of
its block, wherever no item can reach the threshold. The threshold of an item is the least score that any ``run`` words
in a row of it can have; impacts are divided by it, so one threshold, 1, serves all items, and a passage that holds
``run`` words of an item in a row always reaches it. What WAND retrieves is verified word by word.

Passages are stretches of words that occur in the index: a word outside it ends every run that an item could share.
Stretches shorter than ``run`` hold no such run. Long ones are cut into windows that overlap by ``run - 1`` words.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from plumbline.functions.columns import col
from plumbline.llm.words import words

_SLACK = 1.0 - 1e-9


@dataclass
class Postings:
    """One term: item numbers in ascending order, their impacts, and the greatest impact of all and of each block."""

    items: list[int] = field(default_factory=list)
    impacts: list[float] = field(default_factory=list)
    most: float = 0.0
    block_most: list[float] = field(default_factory=list)


class ItemIndex:
    """BM25 inverted index over a shard of test items."""

    def __init__(self, items: Sequence[tuple[int, str]], run: int = 8, k1: float = 1.2, b: float = 0.75, block: int = 16):
        self.run, self.block = run, block
        texts = [(i, words(t)) for i, t in items]
        texts = [(i, w) for i, w in texts if len(w) >= run]  # shorter items hold no run
        self.ids = [i for i, _ in texts]
        self.vocabulary: dict[str, int] = {}
        coded = [[self.vocabulary.setdefault(x, len(self.vocabulary)) for x in w] for _, w in texts]
        n, mean = len(coded), sum(map(len, coded)) / max(1, len(coded))
        df = Counter(t for w in coded for t in set(w))
        self.postings = [Postings() for _ in self.vocabulary]
        self.grams: list[set[tuple[int, ...]]] = []
        self.coded = coded
        for number, w in enumerate(coded):
            weight = {
                t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(w) / mean))
                for t, tf in Counter(w).items()
            }
            runs = {tuple(w[i : i + run]) for i in range(len(w) - run + 1)}
            least = min(sum(weight[t] for t in set(g)) for g in runs) * _SLACK
            self.grams.append(runs)
            for t, x in weight.items():
                self.postings[t].items.append(number)
                self.postings[t].impacts.append(x / least)
        for p in self.postings:
            p.block_most = [max(p.impacts[i : i + block]) for i in range(0, len(p.impacts), block)]
            p.most = max(p.block_most, default=0.0)

    def search(self, terms: set[int]) -> list[int]:
        """Block-max WAND: the numbers of all items that score 1 or more for these terms."""
        lists = [self.postings[t] for t in terms]
        if sum(p.most for p in lists) < 1.0:
            return []
        end, block = len(self.ids), self.block
        cursors = [[p.items[0], 0, p] for p in lists]
        found = []
        while cursors:
            cursors.sort(key=_at)
            bound, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                bound += c[2].most
                if bound >= 1.0:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            # the same sum with the greatest impacts of the blocks that would hold the item
            bound, upto = 0.0, end if pivot + 1 >= len(cursors) else cursors[pivot + 1][0]
            for c in cursors[: pivot + 1]:
                k = bisect_left(c[2].items, item, c[1]) // block
                if k < len(c[2].block_most):
                    bound += c[2].block_most[k]
                    last = min((k + 1) * block, len(c[2].items)) - 1
                    upto = min(upto, c[2].items[last] + 1)
            if bound < 1.0:
                target = max(upto, item + 1)  # nothing before the nearest end of a block can reach the threshold
            elif cursors[0][0] == item:
                if sum(c[2].impacts[c[1]] for c in cursors[: pivot + 1]) >= 1.0:
                    found.append(item)
                target = item + 1
            else:
                target = item
            for c in cursors[: pivot + 1]:
                if c[0] < target:
                    c[1] = bisect_left(c[2].items, target, c[1])
                    c[0] = c[2].items[c[1]] if c[1] < len(c[2].items) else end
            cursors = [c for c in cursors if c[0] < end]
        return found

    def passages(self, text: str | None, window: int = 24) -> Iterator[list[int]]:
        """The text's stretches of indexed words, in windows of ``window`` words."""
        run, code = self.run, self.vocabulary.get
        stretch: list[int] = []
        for w in words(text):
            t = code(w)
            if t is not None:
                stretch.append(t)
            elif stretch:
                yield from _windows(stretch, run, window)
                stretch = []
        yield from _windows(stretch, run, window)

    def leaks(self, text: str | None) -> dict[int, int]:
        """Item id -> number of the item's runs that the text holds, for every item with at least one."""
        out: dict[int, set] = {}
        for p in self.passages(text):
            for number in self.search(set(p)):
                grams = self.grams[number]
                shared = {g for g in zip(*[p[k:] for k in range(self.run)]) if g in grams}
                if shared:
                    out.setdefault(number, set()).update(shared)
        return {self.ids[number]: len(g) for number, g in out.items()}


def _at(cursor: list) -> int:
    return cursor[0]


def _windows(stretch: list[int], run: int, window: int) -> Iterator[list[int]]:
    if len(stretch) >= run:
        for i in range(0, max(1, len(stretch) - run + 1), window - run + 1):
            yield stretch[i : i + window]


def find_leaks(documents: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, run: int = 8, shard_items: int = 20_000) -> DataFrame:
    """``doc_id``, ``item_id``, ``shared_runs`` for every document that holds ``run`` words in a row of an item.

    Narrow over the documents: no shuffle. The index travels with the tasks; it is built for at most ``shard_items``
    items at a time, so its size is bounded, and more items mean more passes. Documents and items with NULL or short
    texts share nothing. Repeated documents are searched each; items with the same text are all reported. Empty tables
    give an empty result. Other columns are ignored.
    """
    spark = documents.sparkSession
    names = f"{_quoted(doc_id)} bigint, {_quoted(item_id)} bigint, shared_runs int"
    texts = documents.select(col(doc_id).cast("bigint"), col(text).cast("string"))
    rows = items.select(col(item_id).cast("bigint"), col(item_text).cast("string")).where(col(item_id).isNotNull() & col(item_text).isNotNull()).toLocalIterator()
    out = None
    while shard := [(r[0], r[1]) for _, r in zip(range(shard_items), rows)]:
        index = ItemIndex(sorted(shard), run)
        part = texts.mapInArrow(_search(index, doc_id, item_id), names)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], names)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _search(index: ItemIndex, doc_id: str, item_id: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, items, shared = [], [], []
            for d, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for i, n in index.leaks(text).items():
                    docs.append(d)
                    items.append(i)
                    shared.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(items, pa.int64()), pa.array(shared, pa.int32())], [doc_id, item_id, "shared_runs"])

    return run
