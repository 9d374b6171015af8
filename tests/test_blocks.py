"""Edge cases of the kNN blocks, the class matrix, AUC at size, and collection calendars."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import metrics, neighbors, periods


@pytest.mark.parametrize("offset", [0.0, 1e6, 1e8])
@pytest.mark.parametrize("sizes", [(2048, 20_000, 4096), (7, 30, 25), (7, 30, 8)])
def test_knn_is_exact_far_from_the_origin(spark, monkeypatch, offset, sizes):
    for name, size in zip(("QUERY_BLOCK", "REFERENCE_BLOCK", "CELL_REFERENCES"), sizes):
        monkeypatch.setattr(neighbors, name, size)
    rng = np.random.default_rng(3)
    q, r = rng.normal(size=(20, 5)) + offset, rng.normal(size=(200, 5)) + offset
    qs = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(q)], "id bigint, vec array<double>")
    rs = spark.createDataFrame([(i, x.tolist(), i % 3) for i, x in enumerate(r)], "id bigint, vec array<double>, label int")
    got = neighbors.knn_candidates(qs, rs, 5).collect()
    for i, x in enumerate(q):
        d = np.sqrt(((r - x) ** 2).sum(axis=1))
        want = np.lexsort((np.arange(len(r)), d))[:5].tolist()
        assert [g.ref_id for g in sorted((g for g in got if g.query_id == i), key=lambda g: g.rank)] == want


def test_knn_ties_copies_few_references_and_missing_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "REFERENCE_BLOCK", 10)
    monkeypatch.setattr(neighbors, "CELL_REFERENCES", 5)
    r = [(i, [float(i % 4), 0.0], i % 3) for i in range(40)] + [(100, None, 1)]  # ten copies of four points
    q = [(0, [0.0, 0.0]), (1, [1.5, 0.0]), (2, [9.0, 9.0]), (3, None)]
    qs = spark.createDataFrame(q, "id bigint, vec array<double>")
    rs = spark.createDataFrame(r, "id bigint, vec array<double>, label int")
    got = neighbors.knn_candidates(qs, rs, 12).collect()
    for i, x in q[:3]:
        want = sorted((((v[0] - x[0]) ** 2 + (v[1] - x[1]) ** 2) ** 0.5, j) for j, v, _ in r if v)[:12]
        assert [(g.distance, g.ref_id) for g in sorted((g for g in got if g.query_id == i), key=lambda g: g.rank)] == want
    assert {g.query_id for g in got} == {0, 1, 2}
    votes = neighbors.knn_classify(qs, rs.limit(2), 5).collect()  # fewer references than asked for
    assert {v.predicted_label for v in votes} == {0}


def test_knn_rows_grow_less_than_the_product(spark, monkeypatch):
    """Four times the rows on both sides: the product grows 16-fold, what is shuffled far less."""
    monkeypatch.setattr(neighbors, "REFERENCE_BLOCK", 100)
    monkeypatch.setattr(neighbors, "CELL_REFERENCES", 50)
    plain, moved = neighbors._compare, []
    monkeypatch.setattr(neighbors, "_compare", lambda q, r, k, *units: (moved.append(q.count() + r.count()), plain(q, r, k, *units))[1])
    rng = np.random.default_rng(8)
    sums = []
    for n in (1000, 4000):
        points = rng.normal(size=(n + n // 4, 2))
        df = spark.createDataFrame([(i, x.tolist(), 0) for i, x in enumerate(points)], "id bigint, vec array<double>, label int")
        moved.clear()
        assert neighbors.knn_classify(df.where(f"id >= {n}"), df.where(f"id < {n}"), 3).count() == n // 4
        assert len(moved) == 2
        sums.append(sum(moved))
    assert sums[1] < 6 * sums[0], sums


def test_confusion_matrix_takes_classes_from_the_data(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "a"), ("c", "a"), (None, "a")], "label string, prediction string")
    m = metrics.confusion_matrix(df)
    assert m.columns == ["label", "a", "b", "c"]
    assert {r["label"]: tuple(r)[1:] for r in m.collect()} == {"a": (1, 1, 0), "b": (0, 0, 0), "c": (1, 0, 0)}
    with pytest.raises(ValueError):
        metrics.confusion_matrix(df, ["a", "b"])


def test_auc_of_huge_counts_and_one_class(spark, monkeypatch):
    df = spark.createDataFrame([(0.1, 0), (0.9, 1)], "score double, label int")
    real = metrics.materialize
    # the histogram of 4e9 rows of either class, half of the positives tied with the negatives
    monkeypatch.setattr(metrics, "materialize", lambda d: real(d).select(
        "_s", (F.col("_pos") * 4_000_000_000).alias("_pos"), (F.col("_neg") * 4_000_000_000).alias("_neg")))
    assert metrics.roc_auc(df).first()["roc_auc"] == 1.0
    monkeypatch.undo()
    assert metrics.roc_auc(df.where("label = 1")).first()["roc_auc"] is None


def test_calendar_reaches_back_as_far_as_the_data(spark):
    from datetime import datetime
    first, last = datetime(2024, 1, 1), datetime(2024, 7, 1)
    a = spark.range(1).select(F.lit(last).cast("timestamp_ntz").alias("anchor_utc"))
    cal = periods.weekend_periods(a, "anchor_utc", 12, periods.weeks_between(first, last)).collect()
    assert len(cal) >= 26 and min(r.start_utc for r in cal) <= datetime(2024, 1, 5)
    assert [r.week_priority for r in sorted(cal, key=lambda r: r.week)][:13] == [*range(12, 0, -1), 1]


@pytest.mark.parametrize("case", ["plain", "far", "outlier", "grid", "copies", "tiny", "nan", "inf", "overflow"])
def test_knn_product_leaves_out_no_near_reference(monkeypatch, case):
    """The same numbers as a full sort of direct differences; differences are taken of few references."""
    rng = np.random.default_rng(5)
    q, r = rng.normal(size=(40, 16)), rng.normal(size=(900, 16))
    if case == "far":
        q, r = q + 1e7, r + 1e7
    elif case == "outlier":
        r[7] = 1e9
    elif case == "grid":  # equal distances all over
        q, r = np.round(q), np.round(r)
    elif case == "copies":
        r[:] = r[0]
    elif case == "tiny":
        q, r = q * 1e-160, r * 1e-160
    elif case in ("nan", "inf", "overflow"):
        r[3, 2] = {"nan": np.nan, "inf": np.inf, "overflow": 1e200}[case]
    with np.errstate(all="ignore"):
        want = neighbors._first(q, r, 7)
        if case in ("plain", "far"):
            monkeypatch.setattr(neighbors, "_distances", None)  # no full table of differences
        assert (neighbors._first_of_few(q, r, 7) == want).all()
