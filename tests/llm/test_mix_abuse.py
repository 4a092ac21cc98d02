import os
import random

import numpy as np
import pytest

from plumbline.llm.abuse import GRID, CnnParams, Reader, best_threshold, doubtful_labels, fit, guess_language, hash_word, rates, score_documents
from plumbline.llm.mixing import TOKENIZER, block_size, mix_sources, pfair_slots, quotas, token_counts


def _late_and_early(quota, block):
    total, worst = sum(quota.values()), 0
    slots = pfair_slots(quota, block)
    taken = [t for s in slots.values() for t in s]
    assert len(taken) == len(set(taken)) == sum(-(-q // block) for q in quota.values())
    for s, q in quota.items():
        for j, t in enumerate(slots[s]):
            assert j * total // q <= t < -(-(j + 1) * total // q)
            worst = max(worst, j + 1 - (t + 1) * q / total, t * q / total - j)  # ahead after it, behind before it
    return worst


def test_every_block_between_release_and_deadline():
    random.seed(8)
    for _ in range(50):
        quota = {f"s{i}": random.randrange(1, 40_000) for i in range(random.randrange(1, 6))}
        assert _late_and_early(quota, 1000) < 1


def test_no_drift_over_a_thousand_frames():
    # weights that no short frame can express: the deviation does not add up, however long the mix is
    parts = {"a": 123_456, "b": 333_333, "c": 543_200, "d": 11}
    assert _late_and_early({s: p * 1000 for s, p in parts.items()}, sum(parts.values()) * 1000 // 300_000) < 1


def test_quotas_respect_repeats():
    q = quotas([("m", "a", 0.5, 1), ("m", "b", 0.5, 3), ("m", "none", 0.2, 2)], {"a": 100, "b": 20})
    assert {x.source: x.tokens for x in q} == {"a": 60, "b": 60, "none": 0}
    assert block_size(q, "m", 10, 1000) == 10 and block_size(q, "m", 10, 3) == 40


def test_mix(spark):
    rows = [(i, "a" if i % 3 else "b", 10 + i % 7) for i in range(3000)]
    sizes = spark.createDataFrame(rows, "id bigint, source string, tokens bigint")
    targets = spark.createDataFrame([("m", " A ", 0.6, 1), ("m", "b", 0.4, 2), ("m", "gone", 0.1, 3), ("n", None, 0.5, 1), ("o", "b", None, 1)], "mix_name string, source string, target_share double, max_repeats int")
    mix = mix_sources(sizes, targets, block_tokens=100, bucket_rows=200)
    shares = {(r.mix_name, r.source): r for r in mix.shares.collect()}
    assert abs(shares["m", "a"].actual_share - 0.6) < 0.01 and shares["m", "b"].repeats_used <= 2 and not shares["m", "gone"].in_reach
    plan = mix.schedule.collect()
    assert sum(r.tokens for r in plan) == sum(r.tokens for r in shares.values())
    assert max(r.copy_no for r in plan) <= 2 and len({(r.doc_id, r.copy_no) for r in plan}) == len(plan)
    upto = 0  # any beginning of the mix is near the shares
    got = {"a": 0, "b": 0}
    for r in sorted(plan, key=lambda r: (r.slot, r.start)):
        got[r.source] += r.tokens
        upto += r.tokens
        assert abs(got["a"] - 0.6 * upto) < 150
    for r in mix.deviation.collect():
        assert max(r.most_ahead, r.most_behind) < r.block_tokens + r.longest
    few = mix_sources(sizes, targets, block_tokens=100, bucket_rows=200, max_slots=50)
    assert few.schedule.agg({"slot": "max"}).first()[0] < 53 and few.schedule.count() == len(plan)
    assert mix_sources(sizes.limit(0), targets).schedule.count() == 0
    assert mix_sources(sizes, targets.limit(0)).shares.count() == 0


@pytest.mark.skipif(not os.path.exists(TOKENIZER), reason="no tokenizer files")
def test_token_counts(spark):
    df = spark.createDataFrame([(1, "Hello world", " Web "), (2, "", "web"), (3, None, "web"), (4, "x", None), (5, "a b" * 50_000, "nan"), (1, "Hello world", "web")], "doc_id bigint, text string, source string")
    assert sorted(map(tuple, token_counts(df, "doc_id", "source", "text").collect())) == [(1, "web", 2)]


def test_hidden_spellings():
    r = Reader(frozenset(["fuck", "idiot", "worthless", "clown", "off", "goddamn"]), 1 << 16)
    row = lambda w: r.row(w)
    assert r.read("F.u.c.k off, w0rthl3$$ cl*wn!!!") == [row("fuck"), row("off"), row("worthless"), row("clown")]
    assert r.read("g o d d a m n idiotttt") == [row("goddamn"), row("idiot")]
    assert r.read("zzz KXB30 12,5") == [1, 2, 2, 2] and r.read(None) == []
    assert hash_word("a") == hash_word("a")


def test_languages():
    assert guess_language("Das ist nicht mit der Messung", "en") == "de"
    assert guess_language("", "FR-fr") == "fr" and guess_language(None, None) == "und"


def _texts(n, rng):
    bad = ["you are a pathetic clown and everyone knows it", "nobody would miss you at all", "du bist ein idiot halt die fresse"]
    good = ["the trial enrolled adults and measured walking speed", "my neurologist says it could be the reason", "die messung ergab punkte zu beginn", "this stupid disease again"]
    out = []
    for i in range(n):
        parts = [rng.choice(good) for _ in range(6)]
        y = i % 4 == 0
        if y:
            parts[rng.randrange(6)] = rng.choice(bad)
        out.append((". ".join(parts), y))
    return out


def test_doubts_need_evidence():
    p = CnnParams()
    rng = np.random.default_rng(4)
    target = (np.arange(400) % 5 == 0).astype(float)
    blind = np.full(400, 0.2) + rng.normal(0, 0.01, 400)  # scores near the rate of positives know nothing
    assert not doubtful_labels(blind, target, p).any()
    sharp = np.clip(target * 0.9 + 0.05 + rng.normal(0, 0.02, 400), 0.01, 0.99)
    wrong = target.copy()
    flipped = np.r_[0:40:5, 1:20:5]  # eight positives called negative, four negatives called positive
    wrong[flipped] = 1 - wrong[flipped]
    doubted = set(np.flatnonzero(doubtful_labels(sharp, wrong, p)))
    assert doubted <= set(flipped) and len(doubted) >= len(flipped) - 1
    every = doubtful_labels(1 - sharp, target, p)  # scores that contradict everything remove a bounded share at most
    assert every[target == 1].mean() <= p.most_doubted and every[target == 0].mean() <= p.most_doubted


def _flags(model, scores, language):
    passing = np.array([(scores >= g).sum() for g in GRID])
    passing[0] = len(scores)
    own, others = model.thresholds({language: passing})
    return scores >= own.get(language, others)


def test_threshold_follows_the_share_among_all_documents():
    rng = np.random.default_rng(1)
    odds = lambda mean, n: 1 / (1 + np.exp(-rng.normal(mean, 1.2, n)))
    held, likely = np.concatenate([odds(2, 300), odds(-2, 700)]), np.repeat([1.0, 0.0], [300, 700])
    count = lambda x: np.array([(x >= g).sum() for g in GRID])
    as_labelled = best_threshold(held, likely, count(np.concatenate([odds(2, 3000), odds(-2, 7000)])))
    rare = best_threshold(held, likely, count(np.concatenate([odds(2, 200), odds(-2, 9800)])))
    assert 0.3 < as_labelled < 0.7 < rare


def test_few_labels_still_flag():
    rng = random.Random(3)
    train, held = _texts(48, rng), _texts(200, rng)
    model = fit([t for t, _ in train], np.array([float(y) for _, y in train]), ["en"] * 48, CnnParams(rows=4096, least_steps=120))
    flags, truth = _flags(model, model.scores([t for t, _ in held]), "en"), np.array([y for _, y in held])
    assert (flags & truth).sum() > 0.8 * truth.sum() and (flags & ~truth).sum() < 0.2 * truth.sum()
    one = fit(["bad", "good"], np.array([1.0, 0.0]), ["en", "en"], CnnParams(rows=64, least_steps=5))
    assert len(one.scores(["bad", None])) == 2


def test_held_out_accuracy(spark):
    rng = random.Random(9)
    train, held = _texts(600, rng), _texts(200, rng)
    votes = np.array([float(y != (rng.random() < 0.07)) for _, y in train])  # raters err
    model = fit([t for t, _ in train], votes, [guess_language(t, None) for t, _ in train], CnnParams(epochs=5, rows=4096))
    flags = _flags(model, model.scores([t for t, _ in held]), "en")
    assert np.mean(flags == np.array([y for _, y in held])) > 0.97
    docs = [(i, t, "en", " Web " if i % 2 else None, 1) for i, (t, _) in enumerate(train[:300])] + [(900, None, None, "web", 1), (901, "", "xx", "web", 1)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, score int")
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(votes[:300])] + [(0, None)], "doc_id bigint, objectionable int")
    args = ("doc_id", "text", "lang", "source", "objectionable", CnnParams(epochs=3, rows=4096, least_steps=0))
    scored = score_documents(df, labels, *args)
    got = {r.doc_id: r for r in scored.collect()}
    assert len(got) == 302 and not got[900].flagged and not got[901].flagged and got[1].source == "web"
    assert {r.source: r.documents for r in rates(scored).collect()} == {"web": 152, None: 150}
    assert not any(r.flagged for r in score_documents(df, labels.limit(0), *args).collect())
    assert score_documents(df.limit(0), labels, *args).count() == 0
