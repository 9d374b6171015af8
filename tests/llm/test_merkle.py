"""The Merkle manifest against a tree built level by level in plain Python."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tidewater.llm import merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, pos bigint, `group` string"


def tampering():
    return {"where": F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0,
            "changes": {"n_chars": F.col("n_chars").cast("decimal(38,0)") + 1}}


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    fields = (doc_id, source, lang, n_chars, text)
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest("".join(below[i:i + 2])) for i in range(0, len(below), 2)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        out.append((i & 1, level[i ^ 1] if (i ^ 1) < len(level) else None))
        i >>= 1
    return out


def fold(own, path):
    for is_right, sibling in path:
        own = digest(own if sibling is None else sibling + own if is_right else own + sibling)
    return own


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
        trees[g] = tree([leaf_of(*r) for r in groups[g]])
    top = tree([trees[g][-1][0] for g in names])
    out = []
    for at, g in enumerate(names):
        for i, row in enumerate(groups[g]):
            path = siblings(trees[g], i) + siblings(top, at)
            doc_id, n_chars = row[0], row[4]
            hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
            now = (*row[:4], n_chars + 1) if hit and n_chars is not None else row
            folded = fold(leaf_of(*now), path)
            proof = digest("".join(s for _, s in path if s is not None))
            out.append((doc_id, leaf_of(*row), trees[g][-1][0], top[-1][0], proof, folded, hit, len(path)))
    return sorted(out, key=repr)


def check(spark, rows, block_levels):
    docs = spark.createDataFrame([(*r, "clash", 3, "clash") for r in rows], SCHEMA)
    made = merkle.build(docs, **tampering(), block_levels=block_levels)
    got = []
    for r in made.versions().collect():
        proof = digest("".join(step[1:] for step in r.path))
        got.append((r.doc_id, r.leaf, r.subroot, r.root, proof, r.folded_root, r.copies is not None, len(r.path)))
        if r.copies is not None:  # the copied nodes alone, and as many as there are levels
            assert r.copies[-1] == r.folded_root and len(r.copies) == len(r.path) + 1
    assert sorted(got, key=repr) == brute(rows)
    return made


HOSTILE = [(1, "a", "en", "s", 1), (2, None, "en", "s", 0), (3, "", "en", None, None), (None, "x", "en", "s", 5),
           (None, "y", "en", "s", 5), (4, "é ü \U0001f600", "fr", "1:a", -3), (4, "é ü \U0001f600", "fr", "1:a", -3),
           (5, "a\x00b", "", "-", 2**63 - 1), (6, "lone", None, "s", 9), (6, "tie", "en", "s", 7), (6, "other", "en", "s", 7),
           (7, "long " * 60_000, "zz", "s", 300_000), (-8, "minus", "é", "s", 1), (2**62, "big", "Z", "s", 1)]
MANY = HOSTILE + [(100 + i, f"text {i}", ("hot" if i % 3 else f"l{i % 11}"), "s", i) for i in range(300)]


@pytest.mark.parametrize("rows,block_levels", [
    (HOSTILE, 10), (MANY, 1), (MANY, 2), (MANY, 10), ([(10, "one", "en", "s", 3)], 10),
    ([(i, "t", "en", "s", 3) for i in range(8)], 3), ([(i, "t", "en", "s", 3) for i in range(9)], 3)])
def test_against_a_tree_in_plain_python(spark, rows, block_levels):
    check(spark, rows, block_levels)


def test_more_leaves_than_a_block(spark):
    made = check(spark, [(i, f"t{i}", "en", "s", i) for i in range(2500)] + HOSTILE, merkle.BLOCK_LEVELS)
    assert {r.lang: r.n_leaves for r in made.groups().collect()}["en"] == 2500 + sum(r[2] == "en" for r in HOSTILE)
    assert made.groups().where("lang is null").count() == 1


def test_untampered_rows_are_verified(spark):
    docs = spark.createDataFrame([(*r, "c", 3, "c") for r in MANY], SCHEMA)
    rows = merkle.build(docs).versions().collect()
    assert all(r.folded_root == r.root and r.copies is None for r in rows)


def test_empty_table(spark):
    made = merkle.build(spark.createDataFrame([], SCHEMA), **tampering())
    assert made.versions().collect() == [] and made.groups().collect() == []
