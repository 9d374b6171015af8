"""Found items against the plain edit-distance table; planted passages with edits."""

import random

import numpy as np
import pytest

from tidewater.llm import decontamination as D


def distance(want, text):
    """Fewest edits of ``want`` against any part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(want, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def brute(docs, items):
    out = []
    for k, t in docs:
        t = D.normal(t or "")
        for i, raw in items:
            w = D.normal(raw or "")
            if len(w) >= D.Q:
                e = distance(w, t)
                if e <= D.edit_budget(len(w), D.Q, D.EDIT_RATE):
                    out.append((k, i, e))
    return sorted(out, key=str)


def edited(text, n, rng):
    t = list(text)
    for _ in range(n):
        at = rng.randrange(len(t))
        kind = rng.randrange(3)
        if kind == 0:
            t[at] = rng.choice("xyzé ")
        elif kind == 1:
            del t[at]
        else:
            t.insert(at, rng.choice("xyzé"))
    return "".join(t)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of"]) if rng.random() < 0.3 else "".join(
        rng.choice("abcdeiouéß") for _ in range(rng.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(rng.choice([2, 3, 8, 15, 30]))) for i in range(12)] + [(50, None), (51, ""), (52, "tiny")]
    items.append((60, items[4][1]))
    docs = []
    for i in range(50):
        t = prose(rng.randint(0, 60))
        if i % 2:
            passage = rng.choice(items[:12])[1]
            passage = edited(passage, rng.randint(0, len(passage) // 7), rng)
            passage = passage.upper() if rng.random() < 0.3 and "ß" not in passage else passage
            at = rng.choice([0, len(t)])
            t = t[:at] + " " + passage.replace(" ", " \n", 1) + " " + t[at:]
        docs.append((i, t))
    return docs + [(100, None), (101, ""), (102, items[5][1]), (102, items[6][1]), (None, items[7][1])], items


@pytest.mark.parametrize("seed", range(4))
def test_matches_edit_distances(seed):
    docs, items = corpus(seed)
    index = D.Index(items)
    got = [(k, index.ids[i], e) for (k, _), found in zip(docs, D.found_in([t or "" for _, t in docs], index), strict=True)
           for i, e in found]
    assert sorted(got, key=str) == brute(docs, items)
    assert index.skipped >= 3


def test_spark_blocks_and_filter(spark, monkeypatch):
    docs, items = corpus(9)
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id bigint, text string, item_id string").repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute(docs, items)
    assert sorted((tuple(r) for r in D.leaks(df, bench).collect()), key=str) == want
    monkeypatch.setattr(D.blocks, "__defaults__", ("item_id", "text", 300))
    assert sorted((tuple(r) for r in D.leaks(df, bench).collect()), key=str) == want
    kept = D.drop_leaked(df, bench)
    assert kept.columns == df.columns
    leaked = {brute([d], items) != [] and d for d in docs}
    assert sorted((tuple(r)[:2] for r in kept.collect()), key=str) == sorted((d for d in docs if d not in leaked), key=str)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "some words that are long enough")], "item_id bigint, text string")
    assert D.leaks(docs, bench).count() == 0
    assert D.leaks(bench.toDF("doc_id", "text"), bench.where("false")).count() == 0
    assert D.drop_leaked(bench, bench.where("false")).count() == 1


def test_gram_hashes_agree_for_equal_grams():
    codes = D._codes("abcabcabcabc" * 3)
    for q in (3, 5, 8, 11):
        h = D.gram_hashes(codes, q)
        assert len(h) == len(codes) - q + 1 and (h[:-3] == h[3:]).all() and len(np.unique(h)) == 3
