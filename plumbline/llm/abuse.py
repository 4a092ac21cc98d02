"""Abusive, hateful or sexual content: a convolutional text classifier, trained here in numpy.

Words are hashed to embeddings; filters of several widths slide over the whole text, and the greatest value of each
filter, wherever it is, makes the document's features (so one passage in a long text is enough). Trained on the labelled
documents, at most ``max_documents`` of them by the hash of their identifier. Raters err, so training is done twice:
scores of held-out parts are calibrated, and labels against which they are strong evidence are left out of the final
training. What counts is how far the evidence moves the odds from the rate of positives: scores that know nothing, as
with few labels, move no odds and remove no label.

A threshold for each language is chosen after all documents are scored. Labelled documents are no random sample, so held-
out scores of all labels, from nets trained without the doubtful ones, each counted by the probability that it is right,
give the rates at which positive and negative documents pass a threshold, and the numbers of all documents that pass it
give the share of positive ones.

Spellings meant to hide a word (leetspeak, asterisks, letters set apart, stretched letters) are undone where that gives
a word of the vocabulary. Rare words, numbers and codes share embeddings, so nothing is learnt by heart from them.
"""

from __future__ import annotations

import pickle
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.columns import col, present, trimmed
from plumbline.session import cut

# --- text to numbers --------------------------------------------------------------------------------------------

_LEET = str.maketrans("013457$@!|", "oleastsail")
_LEET_I = str.maketrans("013457$@!|", "oieastsaii")
_APART = re.compile(r"(?<![^\W\d_])(?:[^\W\d_](?:[ .·_\-])){2,}[^\W\d_](?![^\W\d_])")
_MAYBE_APART = re.compile(r"[ .·_\-][^\W\d_][ .·_\-][^\W\d_](?:[ .·_\-]|$|\W)|^[^\W\d_][ .·_\-][^\W\d_][ .·_\-]|\W[^\W\d_][ .·_\-][^\W\d_][ .·_\-]")
_CHUNK = re.compile(r"[^\s,;:?\"“”„«»()\[\]{}<>…–—/]+")
_PLAIN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_STRETCHED = re.compile(r"([^\W\d_])\1{2,}")
_FIRST = 3  # 0: padding, 1: rare word, 2: number or code


def _joined(m: re.Match) -> str:
    return re.sub(r"[ .·_\-]", "", m.group())


class _Memo(dict):
    """What has been read of a piece before."""

    def __init__(self, read: Callable[[str], list[int]]):
        self.read = read

    def __missing__(self, raw: str) -> list[int]:
        out = self[raw] = self.read(raw)
        return out


class Reader:
    """Words to embedding rows: a hash for the words of the vocabulary, shared rows for all others."""

    def __init__(self, vocabulary: frozenset[str], rows: int):
        self.vocabulary, self.rows, self.memo = vocabulary, rows, _Memo(self.chunk)

    def __reduce__(self):
        return Reader, (self.vocabulary, self.rows)

    def row(self, word: str) -> int:
        return _FIRST + hash_word(word) % (self.rows - _FIRST)

    def chunk(self, raw: str) -> list[int]:
        """Rows of one blank-separated piece."""
        word = raw.lower()
        bare = word.strip(".!*'’-_~#·")
        if not bare:
            return []
        if bare in self.vocabulary:
            return [self.row(bare)]
        if bare.isalpha() and word[0] not in "$@" and not _STRETCHED.search(bare):
            return [1]  # nothing is hidden in plain letters
        hidden = self.uncover(bare if not word.startswith("$") and not word.startswith("@") else word.strip(".!'’"))
        if hidden is not None:
            return [self.row(hidden)]
        out = []
        for part in re.split(r"[-.*_]+", bare):
            if not part:
                continue
            if part in self.vocabulary:
                out.append(self.row(part))
            elif (hidden := self.uncover(part)) is not None:
                out.append(self.row(hidden))
            else:
                out.append(1 if _PLAIN.fullmatch(part) else 2)
        return out

    def uncover(self, word: str) -> str | None:
        """The word of the vocabulary that a hidden spelling stands for."""
        known = self.vocabulary
        for w in (word, _STRETCHED.sub(r"\1\1", word), _STRETCHED.sub(r"\1", word)):
            if w in known:
                return w
            if any(c in "013457$@!|" for c in w) and any(c.isalpha() for c in w):
                for table in (_LEET, _LEET_I):
                    if (t := w.translate(table)) in known:
                        return t
            joined = re.sub(r"[.\-_·*]", "", w)
            if joined != w and len(joined) > 3 and joined in known:
                return joined
        if "*" in word and len(word) > 2:
            pattern = re.compile(re.escape(word).replace(r"\*", r"[^\W\d_]"))
            fits = sorted(w for w in self.by_length.get(len(word), ()) if pattern.fullmatch(w))
            if fits:
                return fits[0]
        return None

    @property
    def by_length(self) -> dict[int, list[str]]:
        if "lengths" not in self.__dict__:
            lengths: dict[int, list[str]] = {}
            for w in self.vocabulary:
                lengths.setdefault(len(w), []).append(w)
            self.__dict__["lengths"] = lengths
        return self.__dict__["lengths"]

    def read(self, text: str | None) -> list[int]:
        if not text:
            return []
        if not text.isascii():
            text = unicodedata.normalize("NFKC", text)
        if _MAYBE_APART.search(text):
            text = _APART.sub(_joined, text)
        if len(self.memo) > 200_000:
            self.memo.clear()
        return list(chain.from_iterable(map(self.memo.__getitem__, _CHUNK.findall(text))))


def hash_word(word: str) -> int:
    import xxhash

    return xxhash.xxh32_intdigest(word)


def plain_words(text: str | None) -> list[str]:
    """Words in lower case as typed, for the vocabulary."""
    return _PLAIN.findall(unicodedata.normalize("NFKC", text).lower()) if text else []


# --- the network ------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class CnnParams:
    """``wrong_labels``: share of labels expected to be wrong; ``most_doubted``: greatest share of the positive, and of
    the negative, labels left out; ``least_steps``: a net takes as many, however few labels there are;
    ``least_documents``: labelled documents a word must stand in to be learnt, fewer where there are few labels;
    ``max_documents``: bound of the sample."""

    rows: int = 1 << 16
    dim: int = 24
    widths: tuple[int, ...] = (1, 2, 3, 4, 5)
    filters: int = 20
    epochs: int = 8
    least_steps: int = 600
    batch: int = 64
    rate: float = 4e-3
    dropout: float = 0.3
    decay: float = 1e-4
    folds: int = 3
    nets: int = 2
    wrong_labels: float = 0.1
    most_doubted: float = 0.3
    least_documents: int = 4
    max_documents: int = 12_000
    seed: int = 11


def _layout(texts: Sequence[Sequence[int]], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens laid end to end, each text followed by ``pad`` padding tokens, and where each text starts."""
    sizes = np.array([len(t) + pad for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    flat = np.zeros(int(sizes.sum()), np.int64)
    for s, t in zip(starts, texts):
        flat[s : s + len(t)] = t
    return flat, starts


class Cnn:
    """Embedding, convolutions of several widths, max over the text, logistic output."""

    def __init__(self, p: CnnParams, rng: np.random.Generator):
        self.p = p
        self.emb = rng.normal(0, 0.3, (p.rows, p.dim)).astype(np.float32)
        self.emb[0] = 0
        self.conv = [rng.normal(0, (2 / (w * p.dim)) ** 0.5, (w * p.dim, p.filters)).astype(np.float32) for w in p.widths]
        self.bias = [np.zeros(p.filters, np.float32) for _ in p.widths]
        self.out = rng.normal(0, 0.1, len(p.widths) * p.filters).astype(np.float32)
        self.out_bias = np.zeros(1, np.float32)

    def _windows(self, x: np.ndarray, w: int) -> np.ndarray:
        """A view of all windows of ``w`` tokens as rows."""
        n, d = x.shape
        return np.lib.stride_tricks.as_strided(x, (n - w + 1, w * d), x.strides)

    def _slide(self, x: np.ndarray, k: np.ndarray, w: int, n: int) -> np.ndarray:
        """The filters of one width at each of the first ``n`` places."""
        d = self.p.dim
        y = x[:n] @ k[:d]
        for j in range(1, w):
            y += x[j : n + j] @ k[j * d : (j + 1) * d]
        return y

    def features(self, flat: np.ndarray, starts: np.ndarray, argmax: bool = False):
        x = np.ascontiguousarray(self.emb[flat])
        widest = max(self.p.widths)
        x = np.concatenate([x, np.zeros((widest, self.p.dim), np.float32)])
        tops, where = [], []
        for w, k, b in zip(self.p.widths, self.conv, self.bias):
            y = self._slide(x, k, w, len(flat))
            top = np.maximum.reduceat(y, starts, axis=0)
            tops.append(top + b)
            if argmax:
                ends = np.append(starts[1:], len(flat))
                where.append(np.stack([s + y[s:e].argmax(0) for s, e in zip(starts.tolist(), ends.tolist())]))
        return np.maximum(np.concatenate(tops, 1), 0), x, where

    def score(self, texts: Sequence[Sequence[int]]) -> np.ndarray:
        """Log odds of each text."""
        if not len(texts):
            return np.zeros(0)
        out = []
        for s in range(0, len(texts), 256):
            flat, starts = _layout(texts[s : s + 256], 1)
            f, _, _ = self.features(flat, starts)
            out.append(f @ self.out + self.out_bias[0])
        return np.concatenate(out)

    def train(self, texts: Sequence[Sequence[int]], target: np.ndarray, weight: np.ndarray, rng: np.random.Generator) -> Cnn:
        p = self.p
        params = [self.emb, *self.conv, *self.bias, self.out, self.out_bias]
        m, v, step = [np.zeros_like(x) for x in params], [np.zeros_like(x) for x in params], 0
        if not len(texts):
            return self
        batches = -(-len(texts) // p.batch)
        epochs = max(p.epochs, -(-p.least_steps // batches))
        total = epochs * batches
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for s in range(0, len(order), p.batch):
                pick = order[s : s + p.batch]
                step += 1
                rows, grads = self._gradient([texts[i] for i in pick], target[pick], weight[pick], rng)
                rate = p.rate * (1 - step / (total + 1))
                for x, g, a, b, at in zip(params, grads, m, v, [rows, *[slice(None)] * (len(params) - 1)]):
                    # moments of embeddings move only where a word was seen
                    a[at] = 0.9 * a[at] + 0.1 * g
                    b[at] = 0.99 * b[at] + 0.01 * g * g
                    x[at] -= rate * (a[at] / (1 - 0.9**step)) / (np.sqrt(b[at] / (1 - 0.99**step)) + 1e-6)
        return self

    def _gradient(self, texts, target, weight, rng):
        p = self.p
        flat, starts = _layout(texts, 1)
        f, x, where = self.features(flat, starts, argmax=True)
        keep = (rng.random(f.shape) >= p.dropout).astype(np.float32) / (1 - p.dropout)
        h = f * keep
        prob = 1 / (1 + np.exp(-(h @ self.out + self.out_bias[0])))
        err = ((prob - target) * weight / len(texts)).astype(np.float32)
        g_out = h.T @ err + p.decay * self.out
        g_f = err[:, None] * self.out * keep * (f > 0)
        g_conv, g_bias, touched, pushed = [], [], [], []
        for i, (w, k) in enumerate(zip(p.widths, self.conv)):
            g = g_f[:, i * p.filters : (i + 1) * p.filters]
            at = where[i]
            windows = self._windows(x, w)[at.ravel()]  # (texts * filters, w * dim)
            g_conv.append((windows * g.ravel()[:, None]).reshape(len(texts), p.filters, -1).sum(0).T + p.decay * k)
            g_bias.append(g.sum(0))
            back = (g.ravel()[:, None] * np.tile(k.T, (len(texts), 1))).reshape(-1, w, p.dim)
            pos = at.ravel()[:, None] + np.arange(w)
            ok = pos < len(flat)
            touched.append(flat[pos[ok]])
            pushed.append(back[ok])
        rows = np.concatenate(touched)
        order = np.argsort(rows, kind="stable")
        rows, first = np.unique(rows[order], return_index=True)
        g_emb = np.add.reduceat(np.concatenate(pushed)[order], first, axis=0)
        g_emb[rows == 0] = 0
        return rows, [g_emb, *g_conv, *g_bias, g_out, np.array([err.sum()], np.float32)]


# --- languages --------------------------------------------------------------------------------------------------

#: Frequent words that tell the languages apart.
STOP_WORDS = {
    "en": "the of and to in was is that for with you were at by from this not are on it my as but",
    "de": "der die und das ist nicht mit ein eine im den auf für von zu ich wurden nach bei war sich",
    "fr": "le la les des et une est dans pour pas qui sur avec par ont été du au ce vous ne mais",
    "es": "el los las una en que por con del se fue para no su más pero lo como al un es y",
}
_STOPS = {w: lang for lang, ws in STOP_WORDS.items() for w in ws.split()}


def guess_language(text: str | None, named: str | None) -> str:
    """The language whose frequent words stand in the text most often; else the one named; else ``und``."""
    hits = Counter(_STOPS[w] for w in plain_words(text) if w in _STOPS)
    if hits:
        best = max(hits.values())
        return min(lang for lang, n in hits.items() if n == best)
    short = re.match(r"[a-z]{2}", (named or "").strip().lower())
    return short.group() if short and short.group() in STOP_WORDS else "und"


# --- fitting ----------------------------------------------------------------------------------------------------


#: Thresholds are chosen among these scores, even in log odds.
GRID = 1 / (1 + np.exp(-np.linspace(-6, 6, 241)))


@dataclass
class Classifier:
    """Nets, and what held-out scores say: the score of each label, the probability that it is positive, its language."""

    reader: Reader
    nets: list[Cnn]
    held: np.ndarray
    likely: np.ndarray
    languages: Sequence[str]

    def scores(self, texts: Sequence[str | None]) -> np.ndarray:
        read = [self.reader.read(t) for t in texts]
        z = np.mean([n.score(read) for n in self.nets], 0) if len(read) else np.zeros(0)
        return 1 / (1 + np.exp(-z))

    def thresholds(self, passing: dict[str, np.ndarray], least: int = 30) -> tuple[dict[str, float], float]:
        """A threshold for each language with ``least`` labels of either kind, and one for all others.

        ``passing``: by language, how many documents score at least each score of ``GRID``; the first number counts all.
        """
        total = sum(passing.values(), np.zeros(len(GRID)))
        out = {}
        for lang, counts in passing.items():
            at = np.array([x == lang for x in self.languages], bool)
            if self.likely[at].sum() >= least and (1 - self.likely[at]).sum() >= least:
                out[lang] = best_threshold(self.held[at], self.likely[at], counts)
        return out, best_threshold(self.held, self.likely, total)


def best_threshold(held: np.ndarray, likely: np.ndarray, passing: np.ndarray, slack: float = 0.02) -> float:
    """The threshold with the best expected F1 over all documents: the middle of all that are as good to ``slack``.

    The share of positive documents is the median of what thresholds tell that few negative labels pass, but half of the
    positive ones.
    """
    pass_rate = lambda w: np.array([w[held >= g].sum() for g in GRID]) / max(w.sum(), 1e-9)
    right, wrong, share = pass_rate(likely), pass_rate(1 - likely), passing / max(passing[0], 1)
    last = int(np.flatnonzero(right >= min(0.5, right.max()))[-1])
    told = slice(min(last, len(GRID) // 2), last + 1)
    positive = np.median((share[told] - wrong[told]) / np.maximum(right[told] - wrong[told], 1e-6))
    positive = np.clip(positive, share[last] / 10, 1)
    f1 = 2 * np.minimum(positive * right, share) / np.maximum(share + positive, 1e-12)
    return float(GRID[int(np.flatnonzero(f1 >= f1.max() - slack).mean())])


def calibrated(scores: np.ndarray, target: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Log odds of the labels given the scores, by logistic regression on the scores' log odds; it never turns them round."""
    z = np.log(np.clip(scores, 1e-6, 1 - 1e-6) / np.clip(1 - scores, 1e-6, 1))
    z = (z - z.mean()) / (z.std() + 1e-9)
    x, w = np.stack([z, np.ones_like(z)], 1), np.zeros(2)
    for _ in range(rounds):
        prob = 1 / (1 + np.exp(-(x @ w)))
        hessian = x.T @ (x * (prob * (1 - prob))[:, None]) + np.eye(2)
        w += np.linalg.solve(hessian, x.T @ (target - prob) - w)
    return x @ np.array([max(w[0], 0.0), w[1]])


def true_odds(scores: np.ndarray, target: np.ndarray, wrong: float) -> tuple[np.ndarray, np.ndarray]:
    """What held-out scores say of each label: the log odds they add for the positive side, and those with the label.

    ``wrong`` is the share of labels expected to be wrong. Votes between 0 and 1 count in proportion.
    """
    base = np.clip(target.mean(), 1e-6, 1 - 1e-6)
    evidence = calibrated(scores, target) - np.log(base / (1 - base))
    return evidence, evidence + (2 * target - 1) * np.log((1 - wrong) / wrong)


def doubtful_labels(scores: np.ndarray, target: np.ndarray, p: CnnParams) -> np.ndarray:
    """Labels that are more likely wrong than right.

    Raters who disagree make a vote between 0 and 1, which is not doubted. Of the positive and of the negative labels no
    more than ``most_doubted`` are doubted, those with the strongest evidence against them.
    """
    _, odds = true_odds(scores, target, p.wrong_labels)
    out = np.zeros(len(target), bool)
    for label, against in ((1, -odds), (0, odds)):
        at = np.flatnonzero((target == label) & (against > 0))
        most = int(p.most_doubted * (target == label).sum())
        out[at[np.argsort(-against[at], kind="stable")[:most]]] = True
    return out


def _one_by_one(jobs: Sequence[Callable[[], object]]) -> list:
    return [job() for job in jobs]


def in_tasks(spark: SparkSession) -> Callable[[Sequence[Callable[[], object]]], list]:
    """Runs a few jobs as tasks of the cluster, one each. What they carry and give back is bounded by the sample."""

    def run_all(jobs: Sequence[Callable[[], object]]) -> list:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                done = [pickle.dumps(jobs[k]()) for k in b.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(done, pa.binary())], ["k", "out"])

        if not jobs:
            return []
        rows = spark.range(0, len(jobs), 1, len(jobs)).mapInArrow(run, "k bigint, out binary").collect()
        return [pickle.loads(r["out"]) for r in sorted(rows, key=lambda r: r["k"])]

    return run_all


def fit(texts: Sequence[str], votes: np.ndarray, languages: Sequence[str], p: CnnParams = CnnParams(), run_all: Callable = _one_by_one) -> Classifier:
    """Train on documents with the mean vote (0..1) of their raters. ``run_all`` runs the trainings of a round."""
    df = Counter(w for t in texts for w in set(plain_words(t)))
    least = min(p.least_documents, 2 + len(texts) // 500)
    reader = Reader(frozenset(w for w, n in df.items() if n >= least), p.rows)
    read = [reader.read(t) for t in texts]
    target = np.asarray(votes, np.float32)
    folds = min(p.folds, len(read))
    fold = np.random.default_rng(p.seed).permutation(len(read)) % max(1, folds)

    def train(seed: int, into: np.ndarray) -> Cnn:
        rng = np.random.default_rng([p.seed, seed])
        return Cnn(p, rng).train([read[i] for i in into], target[into], np.ones(len(into), np.float32), rng)

    def held_out(k: int, seed: int, allowed: np.ndarray) -> np.ndarray:
        net = train(seed, np.flatnonzero((fold != k) & allowed))
        return 1 / (1 + np.exp(-net.score([read[i] for i in np.flatnonzero(fold == k)])))

    def round_of(seed: int, allowed: np.ndarray) -> list[Callable]:
        return [lambda k=k: held_out(k, seed + k, allowed) for k in range(folds)] if folds > 1 else []

    held = np.full(len(read), 0.5)
    for k, scores in enumerate(run_all(round_of(0, np.ones(len(read), bool)))):
        held[fold == k] = scores
    kept = ~doubtful_labels(held, target, p)
    # once more without the doubtful labels, beside the nets that stay: these scores are of nets like those
    again = round_of(500, kept)
    done = run_all([*again, *[lambda k=k: train(1000 + k, np.flatnonzero(kept)) for k in range(p.nets)]])
    for k, scores in enumerate(done[: len(again)]):
        held[fold == k] = scores
    likely = 1 / (1 + np.exp(-true_odds(held, target, p.wrong_labels)[1]))
    return Classifier(reader, done[len(again) :], held, likely, list(languages))


def labelled_sample(documents: DataFrame, labels: DataFrame, doc_id: str, text: str, lang: str, vote: str, p: CnnParams) -> pd.DataFrame:
    """At most ``p.max_documents`` labelled documents, by the hash of their identifier, with the mean vote."""
    votes = labels.where(col(vote).isin(0, 1)).groupBy(col(doc_id).alias("doc")).agg(F.avg(col(vote)).alias("vote"), F.count(F.lit(1)).alias("raters"))
    picked = votes.orderBy(F.xxhash64("doc"), "doc").limit(p.max_documents)
    docs = documents.select(col(doc_id).alias("doc"), present(col(text)).alias("text"), col(lang).alias("lang")).where("text is not null")
    return docs.join(F.broadcast(picked), "doc").toPandas().sort_values("doc")  # bounded by max_documents


def score_documents(documents: DataFrame, labels: DataFrame, doc_id: str, text: str, lang: str, source: str, vote: str, p: CnnParams = CnnParams()) -> DataFrame:
    """``doc_id``, ``source`` (trimmed, lower case), ``language``, ``score`` (0..1) and ``flagged`` for every document.

    NULL and empty texts score 0 and are not flagged. Without usable labels nothing is flagged. Very long texts are
    read whole. Repeated documents are scored each; an empty table gives an empty result; other columns are ignored.
    """
    spark = documents.sparkSession
    sample = labelled_sample(documents, labels, doc_id, text, lang, vote, p)
    languages = [guess_language(t, n) for t, n in zip(sample["text"], sample["lang"])]
    model = fit(list(sample["text"]), sample["vote"].to_numpy(float), languages, p, in_tasks(spark)) if len(sample) and (sample["vote"] > 0.5).any() else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            langs = [guess_language(t, n) for t, n in zip(texts, b.column(2).to_pylist())]
            has = np.array([bool(t) for t in texts])
            scores = np.where(has, model.scores(texts), 0.0) if model else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(3), pa.array(langs), pa.array(np.round(scores.astype(np.float64), 6)), pa.array(has)], ["doc_id", "source", "language", "score", "has"])

    rows = documents.select(col(doc_id).cast("bigint").alias("doc_id"), present(col(text)).alias("text"), col(lang).cast("string").alias("lang"), F.lower(trimmed(present(col(source)))).alias("source"))
    scored = cut(rows.mapInArrow(run, "doc_id bigint, source string, language string, score double, has boolean"))
    if model is None:
        return scored.select("doc_id", "source", "language", "score", F.lit(False).alias("flagged"))
    odds = F.greatest(F.least(F.col("score"), F.lit(1 - 1e-6)), F.lit(1e-6))
    place = F.greatest(F.lit(0), F.least(F.lit(len(GRID)), F.floor((F.log(odds / (1 - odds)) + 6) * 20) + 1)).cast("int")
    counts = scored.where("has").groupBy("language", place.alias("upto")).agg(F.count(F.lit(1)).alias("n")).collect()  # languages by GRID
    passing = {r["language"]: np.zeros(len(GRID) + 1) for r in counts}
    for r in counts:
        passing[r["language"]][r["upto"]] += r["n"]
    # from documents by how many scores of the grid they reach, to documents that reach each; the first stands for all
    passing = {k: np.concatenate([[v.sum()], np.cumsum(v[::-1])[::-1][2:]]) for k, v in passing.items()}
    own, others = model.thresholds(passing)
    least = F.coalesce(F.create_map(*[F.lit(x) for kv in own.items() for x in kv])[F.col("language")], F.lit(others)) if own else F.lit(others)
    return scored.select("doc_id", "source", "language", "score", (F.col("has") & (F.col("score") >= least)).alias("flagged"))


def rates(scored: DataFrame) -> DataFrame:
    """One row per source: documents, flagged documents, their rate and the mean score."""
    return scored.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"), F.count_if("flagged").alias("flagged"), F.round(F.avg(F.col("flagged").cast("double")), 6).alias("rate"), F.round(F.avg("score"), 6).alias("mean_score")
    )
