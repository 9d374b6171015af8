"""The Jaccard join against all pairs on small tables."""

import random

import pytest

from tidewater.llm import setjoin


def words(text):
    return (text or "").encode().lower().split()


def brute(rows, percent=85):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return sorted((k, len(s), least.get(find(i)) if s else k) for i, ((k, _), s) in enumerate(zip(rows, sets, strict=True)))


def texts(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    out = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([5, 8, 9, 10, 11, 12, 14, 17, 20, 40, 80, 300]))]
        out.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 60)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            if rng.random() < 0.4:
                copy += [rng.choice(vocabulary) for _ in range(rng.randint(1, 1 + len(base) // 12))]
            out.append((" " if rng.random() < 0.5 else "\n").join(copy).upper())
    out += ["", None, " \t\n", "one", "One", "one two three", "a b c d", "a b c d", "é É ß"]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("small", [False, True])
def test_matches_all_pairs(spark, monkeypatch, seed, small):
    if small:
        monkeypatch.setattr(setjoin, "BLOCK", 3)
        monkeypatch.setattr(setjoin, "FREQUENT", 3)
        monkeypatch.setattr(setjoin, "CHUNK_SHINGLES", 100)
    rows = list(enumerate(texts(seed)))
    if seed == 1:
        rows = [(1000 - i, t) for i, t in rows] + [(5, rows[3][1]), (5, "other text of this id here")]
    # further columns may have the names that the operator uses inside
    df = spark.createDataFrame([(*r, "x", -1) for r in rows],
                               "doc_id bigint, text string, node string, size bigint").repartition(4)
    got = sorted(tuple(r)[:3] for r in setjoin.join(df).collect())
    assert got == brute(rows)


def test_heavy_only_and_light_only_agree(spark, monkeypatch):
    rows = list(enumerate(texts(7)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute(rows)
    for light in (0, 13):
        monkeypatch.setattr(setjoin, "boundary", lambda *a, n=light: n)
        assert sorted(tuple(r)[:3] for r in setjoin.join(df).collect()) == want


def test_empty_table_and_null_keys(spark):
    schema = "doc_id bigint, text string"
    assert setjoin.join(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c d e f g"), (3, "a b c d e f g"), (None, "z z z y y y")]
    got = sorted((tuple(r)[:3] for r in setjoin.join(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(None, 4, 3), (3, 4, 3), (None, 3, None)], key=str)


def test_one_document_of_each_group_stays(spark):
    text = "a b c d e f g h"
    rows = [(5, text, "x"), (3, text.upper(), "y"), (None, text, "z"), (7, "other words that stand alone", "u"),
            (7, "other words that stand alone", "v"), (7, text, "w"), (8, "", "e"), (9, None, "n"), (9, None, "n"),
            (3, "a third text under that id", "t")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, of string").repartition(3)
    got = setjoin.one_of_each(df)
    assert got.columns == df.columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    assert kept == sorted([(3, text.upper()), (3, "a third text under that id"), (7, "other words that stand alone"),
                           (8, ""), (9, None)], key=str)


def test_the_pipeline_links_five_word_shingles_at_80_percent(spark):
    import corpus_pipeline

    rng = random.Random(11)
    rows = []
    for i in range(12):  # one word after the other changed: similarities around 0.8 and 0.85
        base = [f"v{rng.randrange(500)}" for _ in range(100)]
        for changes in range(4):
            text = list(base)
            for c in range(changes):
                text[15 + 30 * c] = f"n{i}.{c}"
            rows.append((len(rows), " ".join(text)))
    sets = [{tuple(w[j:j + 5]) for j in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    rows += [(1000, "a b c d"), (1001, "a b c d"), (1002, "a b c d e")]
    want = {i for i in range(len(root)) if find(i) == i} | {1000, 1002}
    # texts of 49 words with one changed: 40 of 50 (0.80), in four-word shingles 42 of 50 (0.84)
    edge = [f"e{i}" for i in range(49)]
    rows += [(2000, " ".join(edge)), (2001, " ".join([*edge[:24], "other", *edge[25:]]))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, "").collect()}
    assert got == want | {2000}
