"""Shifted CholeskyQR whitening against a covariance matrix and eigenvectors in plain numpy."""

import math

import numpy as np
import pytest

from tidewater.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, x string, n bigint, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "clash", 5, 1) for i, v in rows], SCHEMA).repartition(5)


def integer(v):
    if not v or any(c is None or not math.isfinite(c) for c in v):
        return None
    scaled = [256.0 * float(np.float32(c)) for c in v]
    return tuple(math.floor(c) for c in scaled) if all(abs(c) < 2.0 ** 63 for c in scaled) else None


def brute(rows, length):
    usable = [(i, x) for i, x in ((i, integer(v)) for i, v in rows) if x is not None and len(x) == length]
    listed = sorted({x for _, x in usable})
    n, sums = len(listed), [sum(col) for col in zip(*listed, strict=True)]
    centred = np.array([[float(n * a - s) for a, s in zip(x, sums, strict=True)] for x in listed]) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(values)[::-1]
    return usable, n, sums, values[order], vectors[:, order].T


def check(spark, rows, length, expected_components=4):
    usable, n, sums, values, vectors = brute(rows, length)
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) == len(usable) * expected_components
    signs = {}
    by_id = {}
    for i, x in usable:
        by_id.setdefault(i, []).append(x)
    for r in sorted(got, key=lambda r: -abs(r.whitened)):
        x = by_id[r.vec_id][0]
        assert r.n == n
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        assert r.deviation == (deviation if deviation < 2 ** 63 else None)
        k = r.component - 1
        want = float(np.dot([(n * a - s) / n for a, s in zip(x, sums, strict=True)], vectors[k])) / math.sqrt(values[k])
        sign = signs.setdefault(k, 1 if want * r.whitened >= 0 else -1)
        assert r.whitened == pytest.approx(sign * want, rel=1e-7, abs=1e-7)
        assert r.explained == pytest.approx(values[k] / values.sum(), rel=1e-9)
        assert r.identity_error <= 1e-9
    return got


def cloud(rng, rows, length, scale=0.2):
    spread = np.linspace(1.0, 0.2, length)
    return [(i, [float(c) for c in rng.normal(size=length) * spread * scale]) for i in range(rows)]


def test_against_eigenvectors_with_hostile_rows(spark):
    rng = np.random.default_rng(3)
    rows = cloud(rng, 300, 12)
    rows += [(1000 + i, rows[0][1]) for i in range(250)]            # a hot group of copies counts once
    rows += [(2000, None), (2001, []), (2002, [None] + [0.0] * 11), (2003, [float("nan")] * 12),
             (2004, [float("inf")] + [0.0] * 11), (2005, [3e38] + [0.0] * 11), (2006, [0.1] * 5),
             (None, [-0.0] * 12), (2007, [0.0] * 12), (7, rows[7][1])]
    got = check(spark, rows, 12)
    assert not {r.vec_id for r in got} & set(range(2000, 2007))
    assert sum(r.vec_id is None for r in got) == 4


def test_vectors_near_a_plane_and_constant_dimensions(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(200, 2))
    rows = [(i, [float(a), float(b), float(a + b), 0.5, float(a) * 1e-3]) for i, (a, b) in enumerate(base)]
    check(spark, rows, 5)


def test_components_without_variance_are_not_returned(spark):
    rows = [(i, [i / 256.0, 0.0, 1.0]) for i in range(20)]
    assert {r.component for r in check(spark, rows, 3, expected_components=1)} == {1}
    assert whitening.whiten(frame(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])])).collect() == []


def test_large_values_stay_exact(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(c) for c in rng.normal(size=6) * 1e6]) for i in range(50)]
    check(spark, rows, 6)
    far = [(i, [float(c) for c in rng.normal(size=3) * 1e15]) for i in range(20)]
    assert all(r.deviation is None for r in check(spark, far, 3, expected_components=3))


def test_empty_table(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, None)])).collect() == []


def test_one_dimension_and_few_vectors(spark):
    check(spark, [(i, [i * 0.1]) for i in range(7)], 1, expected_components=1)
    check(spark, [(1, [0.1, 0.9, 0.3]), (2, [0.5, -0.2, 0.1])], 3, expected_components=1)
