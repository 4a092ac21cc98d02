import random

import numpy as np
from pyspark.sql import functions as F

from plumbline.llm.leak import ItemIndex, find_leaks
from plumbline.llm.near import NearParams, RunWeights, near_documents, near_duplicates, near_pairs, sampling_tables, signatures
from plumbline.llm.queries import P6_PARAMS
from plumbline.llm.words import words


def _sets(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def _corpus(n, rng):
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        t = [rng.choice(vocab) for _ in range(60)]
        rows.append((3 * i, " ".join(t)))
        if i % 3 == 0:
            u = list(t)
            u[rng.randrange(60)] = "changed"
            rows.append((3 * i + 1, " ".join(u)))
        if i % 5 == 0:
            rows.append((3 * i + 2, " ".join(t).upper() + "!"))
    return rows


def test_pairs_against_brute_force(spark):
    rng = random.Random(5)
    rows = _corpus(60, rng) + [(9001, None), (9002, ""), (9003, "two words"), (9004, "two words")]
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "id bigint, text string, cls string").repartition(3)
    p = NearParams(shingle=3, min_similarity=0.5, weighted_floor=0.35)
    res = near_duplicates(df, "id", F.col("text"), p)
    got = {(r.ord_a, r.ord_b) for r in near_pairs(res).collect()}
    sets = {i: _sets(t, 3) for i, t in rows if t}
    want = set()
    for a in sets:
        for b in sets:
            if a < b and sets[a] != sets[b] and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.5 * len(sets[a] | sets[b]):
                want.add((a, b))
    assert got <= want and len(got) >= 0.97 * len(want)
    docs = {r.id: (r.class_id, r.copies) for r in near_documents(res).collect()}
    assert set(docs) == {i for i, t in rows if t is not None}
    assert docs[2] == docs[0] == (0, 2)


def test_samples_are_pairs_of_run_and_t():
    p = NearParams(bands=25, rows=4)
    w = RunWeights(np.zeros(0, np.uint32), np.zeros(0, int), (np.arange(1, 25) / 24) ** 2)
    table, multipliers = sampling_tables(w, p)
    rng = np.random.default_rng(3)
    for size in (200, 5000):  # unrelated sets never agree, however large they are
        ids = np.unique(rng.integers(0, 2**31, 2 * size + 99)).astype(np.uint32)
        ids = rng.permutation(ids)[: 2 * size]
        sig = signatures(np.concatenate([np.sort(ids[:size]), np.sort(ids[size:])]), np.array([size, size]), w.steps(ids), table, multipliers)
        assert not (sig[:, 0] == sig[:, 1]).any()
    x = np.sort(np.unique(rng.integers(0, 2**31, 300)).astype(np.uint32))
    y = np.sort(np.concatenate([x[:200], rng.integers(0, 2**31, 100).astype(np.uint32)]))
    both = np.concatenate([x, y])
    sig = signatures(both, np.array([len(x), len(y)]), w.steps(both), *sampling_tables(w, NearParams(bands=500, rows=4)))
    assert abs((sig[:, 0] == sig[:, 1]).mean() - len(np.intersect1d(x, y)) / len(np.union1d(x, y))) < 0.04


def test_large_buckets_lose_no_pair(spark):
    base = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join([*base[:i], f"x{i}", *base[i + 1 :]])) for i in range(40)]
    df = spark.createDataFrame(rows, "id bigint, text string")
    p = NearParams(shingle=3, min_similarity=0.5, min_share=1.0, bucket=4)  # no run counts as frequent
    assert near_pairs(near_duplicates(df, "id", F.col("text"), p)).count() == 40 * 39 // 2
    assert near_pairs(near_duplicates(df.limit(0), "id", F.col("text"), p)).count() == 0


def test_edits_of_a_third_of_the_texts_are_found(spark):
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10**6)}"
    base = [word() for _ in range(99)]
    rows = []
    for i in range(180):
        if i % 3:
            t = [word() for _ in range(99)]
        else:
            t = list(base)
            for at in rng.sample(range(2, 97, 3), 4):
                t[at] = word()
        rows.append((i, " ".join(t)))
    sets = {i: _sets(t, 3) for i, t in rows}
    share = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b}
    want = {ab for ab, s in share.items() if s >= 0.58}
    assert len(want) == 60 * 59 // 2 and min(share[ab] for ab in want) < 0.65
    df = spark.createDataFrame(rows, "id bigint, text string")
    got = {(r.ord_a, r.ord_b) for r in near_pairs(near_duplicates(df, "id", F.col("text"), P6_PARAMS)).collect()}
    assert got <= {ab for ab, s in share.items() if s >= 0.5} and len(got & want) >= 0.98 * len(want)


def test_samples_agree_as_weighted_jaccard_says():
    p = NearParams(bands=200, rows=5)
    rng = np.random.default_rng(1)
    frequent = np.sort(rng.choice(2**32, 500, replace=False).astype(np.uint32))
    w = RunWeights(frequent, rng.integers(0, 12, 500), (np.arange(1, 25) / 24) ** p.sharpness)
    table, mult = sampling_tables(w, p)
    a = np.sort(np.concatenate([frequent[:300], rng.choice(2**32, 60).astype(np.uint32)]))
    b = np.sort(np.concatenate([frequent[150:450], a[~np.isin(a, frequent)][:30]]))
    weight = lambda x: w.values[w.steps(x)].sum()
    true = weight(np.intersect1d(a, b)) / weight(np.union1d(a, b))
    both, sizes = np.concatenate([a, b]), np.array([len(a), len(b)])
    sig = signatures(both, sizes, w.steps(both), table, mult)
    assert abs((sig[:, 0] == sig[:, 1]).mean() - true) < 0.06


def test_leaks_against_brute_force(spark):
    rng = random.Random(6)
    vocab = [f"v{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(3, 40)))) for i in range(50)] + [(99, None)]
    docs = []
    for d in range(200):
        t = [rng.choice(vocab) for _ in range(rng.randrange(0, 80))]
        if d % 4 == 0:
            source = (rng.choice(items[:50])[1]).split()
            s = rng.randrange(len(source))
            t[5:5] = source[s : s + rng.randrange(5, 14)]
        docs.append((d, ", ".join(t).title() if t else None, "x"))
    runs = lambda t: _sets(t, 8) if t else set()
    want = {(d, i) for d, t, _ in docs for i, it in items if runs(t) & runs(it)}
    df, it_df = spark.createDataFrame(docs, "doc_id bigint, text string, item_id string"), spark.createDataFrame(items, "item_id bigint, item_text string")
    got = find_leaks(df, "doc_id", "text", it_df, "item_id", "item_text").collect()
    assert {(r[0], r[1]) for r in got} == want and len(got) == len(want) > 10
    assert {(r[0], r[1]) for r in find_leaks(df, "doc_id", "text", it_df, "item_id", "item_text", shard_items=7).collect()} == want
    assert find_leaks(df, "doc_id", "text", it_df.limit(0), "item_id", "item_text").count() == 0
    assert find_leaks(df.limit(0), "doc_id", "text", it_df, "item_id", "item_text").count() == 0


def test_wand_is_exhaustive():
    rng = random.Random(7)
    index = ItemIndex([(i, " ".join(rng.choice("abcdefghijklmnop") for _ in range(12))) for i in range(80)], run=3, block=4)
    for _ in range(100):
        terms = set(rng.sample(range(len(index.vocabulary)), 5))
        scores = {}
        for t in terms:
            for i, x in zip(index.postings[t].items, index.postings[t].impacts):
                scores[i] = scores.get(i, 0) + x
        assert sorted(index.search(terms)) == sorted(i for i, x in scores.items() if x >= 1.0 + 1e-12 or abs(x - 1) < 1e-12)
