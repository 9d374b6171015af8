"""Katz scores against a plain model of counts in dictionaries."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import katz


def words(text):
    return [*(text or "").encode().lower().split(), b""]


def brute(rows, order):
    """(held_out, n_tokens, n_known, train_tokens, base, score) of each (key, text)."""
    train = [zlib.crc32(("" if k is None else str(k)).encode()) % 5 != 1 for k, _ in rows]
    grams = [None] + [Counter() for _ in range(order)]
    for (_, text), learn in zip(rows, train, strict=True):
        if learn:
            w = words(text)
            for i in range(len(w)):
                for n in range(1, order + 1):  # at its beginning a text's history is as long as it can be
                    start = i - n + 1
                    grams[n][(*([None] if start < 0 else []), *w[max(0, start):i + 1])] += 1
    total, distinct = sum(grams[1].values()), len(grams[1])

    def unigram(w):
        return (grams[1][(w,)] + 0.5) / (total + 0.5 * (distinct + 1))

    discounts, after = {}, {}
    for n in range(2, order + 1):
        of = Counter(grams[n].values())
        discounts[n] = katz.good_turing([float(of[r]) for r in range(1, katz.LARGEST_DISCOUNTED + 2)])
        after[n] = defaultdict(dict)
        for g, c in grams[n].items():
            after[n][g[:-1]][g[-1]] = c

    def prob(before, w, n):
        if n == 1:
            return unigram(w)
        history = tuple(before[-(n - 1):]) if len(before) >= n - 1 else (None, *before)
        lower = prob(before, w, n - 1)
        seen = after[n].get(history)
        if not seen:
            return lower
        c_h = sum(seen.values())
        d = {r: x for r, x in enumerate(discounts[n], 1)}
        saved = sum(r * (1 - d[r]) for r in seen.values() if r in d)
        cut = {c: c * (1 - d[c]) if c in d else 0.0 for c in seen.values()}
        if saved <= 0:
            saved, cut = 0.5 * len(seen), {c: 0.5 for c in seen.values()}
        if w in seen:
            return (seen[w] - cut[seen[w]]) / c_h
        left = 1 - sum(prob(before, x, n - 1) for x in seen)
        return saved / c_h / left * lower

    out = []
    for (k, text), learn in zip(rows, train, strict=True):
        w = words(text)
        out.append((k, not learn, len(w), sum(grams[1][(x,)] > 0 for x in w), total,
                    sum(math.log10(unigram(x)) for x in w),
                    sum(math.log10(prob(w[:i], x, order)) for i, x in enumerate(w))))
    return out


TEXTS = ["the cat sat on the mat", "The dog sat on the log", None, "", "a a a a a a a a a a a a b",
         "the cat sat", "the the the", "x y z x y z x y z\tx\ny  z", "on the mat the cat", "é É ß the"] * 3


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("small", [False, True])
def test_scores_match_dictionaries(spark, monkeypatch, order, small):
    if small:  # many chunks and buckets, and split histories
        monkeypatch.setattr(katz, "CHUNK_TOKENS", 20)
        monkeypatch.setattr(katz, "BUCKET_TOKENS", 25)
    rows = [(i if i != 7 else None, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[1])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = [tuple(r) for r in katz.learn(df, order).scores().collect()]
    want = brute(rows, order)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:5], round(r[5], 6))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want, strict=True):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert katz.learn(df).scores().count() == 0


def test_every_history_sums_to_one(spark):
    """One unknown word beside the training vocabulary: probabilities after any history sum to 1."""
    base = [(i, t) for i, t in enumerate(TEXTS) if zlib.crc32(str(i).encode()) % 5 != 1]
    vocabulary = sorted({w.decode() for _, t in base for w in words(t)} - {""}) + ["never-seen"]
    held = [i for i in range(1000, 9000) if zlib.crc32(str(i).encode()) % 5 == 1]
    for history in ("the", "a", "z", "never-seen"):
        probes = [(held[i], f"{history} {w}") for i, w in enumerate(vocabulary)] + [(held[-1], history)]
        df = spark.createDataFrame(base + probes, "doc_id bigint, text string")
        score = {r.doc_id: r.score for r in katz.learn(df).scores().collect()}
        # log p(history w end) - log p(end | w) is not directly given, so compare with the dictionaries
        want = {k: s for k, *_, s in brute(base + probes, 2)}
        assert all(score[k] == pytest.approx(want[k], rel=1e-9) for k in score)


def test_higher_orders_score_held_out_texts_better(spark):
    """Each order adds log probability to the documents that were not learnt from."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    scores = [katz.learn(docs, order).scores().where("held_out").agg(F.sum("score")).first()[0] for order in (1, 2, 3)]
    assert scores[0] < scores[1] < scores[2]


def test_very_long_text(spark):
    long = " ".join(f"w{i % 977}" for i in range(200_000))
    rows = [(0, long), (1, long), (2, "w1 w2 w3"), (5, "w1 w2 w3 other")]
    got = {r.doc_id: r for r in katz.learn(spark.createDataFrame(rows, "doc_id bigint, text string"), 3).scores().collect()}
    learnt = Counter(w for k, t in rows if zlib.crc32(str(k).encode()) % 5 != 1 for w in words(t))
    for k, t in rows:
        want = len(words(t)), sum(w in learnt for w in words(t)), learnt.total()
        assert (got[k].n_tokens, got[k].n_known, got[k].train_tokens) == want and got[k].score < 0


def test_names_of_ngrams_are_sent_as_steps(spark, monkeypatch):
    """What a chunk is told of its n-grams: ascending names, as the small steps between them."""
    monkeypatch.setattr(katz, "BUCKET_TOKENS", 200)
    rows = [(i, " ".join(f"w{(i * 7 + j * j) % 31}" for j in range(40))) for i in range(30)]
    model = katz.learn(spark.createDataFrame(rows, "doc_id bigint, text string"), order=3)
    answers = model.levels[1].where("kind = 'answer'").collect()
    assert len({r["bucket"] for r in answers}) > 1
    for r in answers:
        count, names, *_ = katz.get(r["payload"])
        # a bucket's n-grams are numbered from 1: the last step but for the bucket's own number leads to one of them
        assert len(count) == 0 or int(names.sum()) <= sum(len(katz.get(a["payload"])[0]) for a in answers) * model.plan.buckets + r["bucket"]
        assert (names[1:] % model.plan.buckets == 0).all() and (names > 0).all()


def test_only_histories_that_back_off_have_their_sums_sent(spark, monkeypatch):
    """Documents that are learnt need no weight; a history that was not learnt is not asked about."""
    monkeypatch.setattr(katz, "CHUNK_TOKENS", 1)  # a chunk for each document
    learnt = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 != 1]
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 1]
    rows = [(i, f"a b c{i} d e{i % 7}") for i in learnt[:40]] + [(held[0], "a b new words here"), (held[1], "x y z")]
    model = katz.learn(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2), order=3)
    chunk_of = {r["chunk"]: katz.get(r["docs"])[0][0] for r in model.chunks.collect()}
    sent = {}
    for level in (2, 3):
        for r in model.levels[level - 1].where("kind = 'answer'").collect():
            count, _, small, types, *_ = katz.get(r["payload"])
            sent[level, chunk_of[r["chunk"]]] = (len(count), len(small), len(types))
    for i in learnt[:40]:
        assert sent[2, i] == (6, 6, 0) and sent[3, i] == (6, 6, 0)
    assert sent[2, held[0]] == (3, 3, 1)  # <s> a, a b, b new: new, words and here were not learnt
    assert sent[3, held[0]] == (3, 3, 1)  # the third is a b new
    assert sent[2, held[1]] == (1, 1, 1) and sent[3, held[1]] == (1, 1, 1)  # the start alone
    got = {r.doc_id: r.score for r in model.scores().collect()}
    assert all(got[r[0]] == pytest.approx(r[6], rel=1e-9) for r in brute(rows, 3))


@pytest.mark.parametrize("top", [3, 2**40, 2**64 - 1])
def test_distinct_values_are_those_of_numpy(top):
    values = np.random.default_rng(0).integers(0, top, 1000, np.uint64, endpoint=True)
    for a in (values, values[:1], values[:0], np.sort(values)):
        for got, want in zip(katz._distinct(a), np.unique(a, return_index=True, return_inverse=True), strict=True):
            assert (got == want).all()


def test_multiples_are_kept_as_quotients():
    """Names step by multiples of the number of buckets: the quotients take the space, the products are read."""
    quotients = np.random.default_rng(0).integers(1, 200, 10_000).astype(np.uint32)
    plain, kept = katz.put(quotients.astype(np.uint64) * np.uint64(91)), katz.put((quotients, 91), quotients)
    products, same = katz.get(kept)
    assert products.dtype == np.uint64 and (products == katz.get(plain)[0]).all() and (same == quotients).all()
    assert len(katz.put((quotients, 91))) < 0.8 * len(plain)
