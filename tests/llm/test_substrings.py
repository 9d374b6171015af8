"""Chunks, digest counts and runs against a plain count in dictionaries; planted passages."""

import random
from collections import Counter

import numpy as np
import pytest

from tidewater.llm import substrings as S


def brute(rows, min_words):
    seen, per_doc = Counter(), []
    for _, t in rows:
        d, words, starts, ends = S.chunks(t or "")
        per_doc.append((d.tolist(), np.diff(words, prepend=0).tolist(), starts.tolist(), ends.tolist()))
        seen.update(d.tolist())
    out = []
    for (k, _), (d, words, starts, ends) in zip(rows, per_doc, strict=True):
        i = 0
        while i < len(d):
            j = i
            while j < len(d) and seen[d[j]] > 1:
                j += 1
            if j > i and sum(words[i:j]) >= min_words:
                out.append((k, starts[i], ends[j - 1], sum(words[i:j]), min(seen[x] for x in d[i:j])))
            i = j + 1
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzéß中") for _ in range(rng.randint(1, 9)))
    prose = lambda n: [word() for _ in range(n)]
    passages = [prose(n) for n in (51, 60, 90, 300)]
    rows, planted = [], set()
    for i in range(60):
        w = prose(rng.randint(0, 200))
        if i % 3 == 0:
            p = passages[i // 3 % 4]
            at = rng.randint(0, len(w))
            w = w[:at] + [x.upper() if rng.random() < 0.3 and "ß" not in x else x for x in p] + w[at:]
            planted.add(i)
        rows.append((i, (" " if i % 2 else " \n\t").join(w)))
    return rows + [(100, None), (101, ""), (102, " \n "), (103, "one"), (104, "a " * 500)], planted


@pytest.mark.parametrize("small", [False, True])
def test_spans_match_dictionaries(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(S, "GROUP_CHUNKS", 40)
        monkeypatch.setattr(S, "BUCKET_CHUNKS", 100)
    rows, planted = corpus(3)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = S.repeated_passages(df).collect()
    assert sorted(((r.doc_id, r.start, r.end, r.n_words, r.n_copies) for r in got), key=str) == brute(rows, S.MIN_WORDS)
    assert {r.doc_id for r in got} - {104} == planted
    texts = dict(rows)
    assert all(abs(len(texts[r.doc_id][r.start:r.end].split()) - r.n_words) == 0 for r in got)


def test_one_copy_of_each_passage_is_first(spark):
    rng = random.Random(5)
    passage = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(80))
    df = spark.createDataFrame([(i, passage) for i in range(20)], "doc_id bigint, text string").repartition(5)
    got = S.repeated_passages(df).collect()
    assert len(got) == 20 and sum(r.is_first for r in got) == 1 and {r.n_copies for r in got} == {20}


def prose_with_passages(seed, copies=4):
    """Passages, each in several documents of words from a small vocabulary, and the ranges of their copies."""
    rng = random.Random(seed)
    common = [f"{c}{v}" for c in "bdfglmnprst" for v in "aeiou"]
    prose = lambda n: [rng.choice(common) for _ in range(n)]
    rows, planted = [], {}
    for p, n in enumerate((50, 51, 55, 60, 70, 90, 120, 200)):
        passage = prose(n)
        for _ in range(copies):
            before, after = prose(rng.randint(5, 120)), prose(rng.randint(5, 120))
            # words that end differently around it, so that the common passage is exactly this one
            before[-1], after[0] = f"x{len(rows)}", f"y{len(rows)}"
            start = len(" ".join(before)) + 1
            planted[len(rows)] = (p, start, start + len(" ".join(passage)), n)
            rows.append((len(rows), " ".join(before + passage + after)))
    return rows, planted


def windows(rows, n=S.PASSAGE_WORDS):
    """(document, first word, words) of each window, in order of documents."""
    return [(k, i, tuple(w[i:i + n])) for k, t in rows for w in [(t or "").lower().split()] for i in range(len(w) - n + 1)]


def brute_passages(rows):
    """(document, first word, words, copies) of each run of repeated windows."""
    seen, out, last = Counter(w for *_, w in windows(rows)), [], None
    for k, i, w in windows(rows):
        if seen[w] > 1 and last == (k, i - 1):
            out[-1] = (*out[-1][:2], out[-1][2] + 1, min(out[-1][3], seen[w]))
        elif seen[w] > 1:
            out.append((k, i, S.PASSAGE_WORDS, seen[w]))
        last = (k, i) if seen[w] > 1 else None
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_passages_are_exact_to_the_word(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(S, "GROUP_WORDS", 300)
        monkeypatch.setattr(S, "BUCKET_CHUNKS", 100)
    rows, planted = prose_with_passages(7)
    more, _ = corpus(3)
    rows += [(1000 + k, t) for k, t in more]
    # 49 words are too few
    rows += [(2000 + i, f"a{i} " + " ".join(f"q{j}" for j in range(49)) + f" b{i}") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    runs = {}
    for r in S.exact_passages(df).collect():
        assert r.n_words == len(dict(rows)[r.doc_id][r.start:r.end].split())
        first = len(dict(rows)[r.doc_id][:r.start].split())
        runs.setdefault(r.doc_id, []).append((first, first + r.n_words, r.n_copies))
    want = {}
    for k, i, n, copies in brute_passages(rows):
        want.setdefault(k, []).append((i, i + n, copies))
    assert runs.keys() == want.keys() and planted.keys() <= runs.keys()
    words_in = lambda spans: {w for a, z, _ in spans for w in range(a, z)}
    assert all(words_in(runs[k]) == words_in(want[k]) for k in want)
    assert all(min(c for *_, c in runs[k]) == min(c for *_, c in want[k]) for k in want)


def without(rows, found):
    """The documents without the rows that are not first."""
    gone = {(r.doc_id, i) for r in found if not r.is_first for i in range(r.start, r.end)}
    return [(k, "".join(c for i, c in enumerate(t or "") if (k, i) not in gone)) for k, t in rows]


def test_a_passage_in_other_prose_keeps_one_copy(spark):
    rows, planted = prose_with_passages(7)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    stays = {}
    for r in S.exact_passages(df).collect():
        p, start, end, n = planted[r.doc_id]
        assert (r.start, r.end, r.n_words, r.n_copies) == (start, end, n, 4)
        stays.setdefault(p, []).append(r.is_first)
    assert {p: sorted(x) for p, x in stays.items()} == {p: [False] * 3 + [True] for p in range(8)}


def test_each_window_is_left_where_passages_overlap(spark):
    rng = random.Random(2)
    a, b, c = ([f"{x}{rng.randrange(10**6)}" for _ in range(120)] for x in "abc")
    parts = [a, b, c, a + b, b + c, a[40:] + b[:70], c[:90] + a[:60], a[:55] + b[:55] + c[:55], b[10:] + c + a, a + a]
    rows = [(i, ("  " if i % 2 else "\n").join([f"s{i}", *w, f"e{i}"])) for i, w in enumerate(parts)]
    rows += [(50, "z " * 300), (51, "z " * 200 + "end")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    left = Counter(w for *_, w in windows(without(rows, S.exact_passages(df).collect())))
    seen = Counter(w for *_, w in windows(rows))
    assert all(left[w] for w, n in seen.items() if n > 1)


def test_gear_hash_rolls():
    data = np.frombuffer(b"the quick brown fox jumps over the lazy dog", np.uint8)
    h, want = 0, []
    for b in data:
        h = ((h << 1) + int(S.GEAR[b])) & 0xFFFF
        want.append(h)
    assert S.gear_hashes(data).tolist() == want


def test_empty_table_null_keys_and_no_place_to_cut(spark):
    schema = "doc_id bigint, text string"
    assert S.repeated_passages(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "x " * 1000), (None, "x " * 1000), (1, "y" * 100_000), (2, "y" * 100_000)]
    got = S.repeated_passages(spark.createDataFrame(rows, schema)).collect()
    assert {r.doc_id for r in got} == {None} and len(got) == 2
