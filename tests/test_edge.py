"""Edge cases: empty and one-row series, equal values, zero previous value, ties, halo exactness."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import categories, prep, quantiles, reports, temporal, traffic

SCHEMA = "series long, ts timestamp_ntz, tpm double, response_time double, is_push_notification int"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def ts(s):
    import datetime
    return datetime.datetime.fromisoformat(s)


def test_empty_series(spark):
    out = traffic.series_features(rows(spark, []))
    assert out.count() == 0 and "tpm_lag_1" in out.columns


def test_one_row_series(spark):
    r = traffic.series_features(rows(spark, [(0, ts("2024-01-01 05:00"), 3.0, 1.0, 0)])).first()
    assert r["tpm_lag_1"] is None and r["tpm_ma_3"] == 3.0 and r["tpm_std_3"] == 0.0
    assert r["tpm_change_rate"] == 0.0 and r["minutes_since_push"] == 0 and r["is_post_push_period"] == 1


def test_zero_previous_value_k3(spark):
    df = rows(spark, [(0, ts("2024-01-01 00:00"), 0.0, 1.0, 0), (0, ts("2024-01-01 01:00"), 2.0, 1.0, 0),
                      (0, ts("2024-01-01 02:00"), 0.0, 1.0, 0), (0, ts("2024-01-01 03:00"), 0.0, 1.0, 0)])
    out = temporal.windowed(df, "series", "ts", lambda w: {
        "par": temporal.relative_change(w, "tpm", parity=True),
        "safe": temporal.relative_change(w, "tpm", parity=False)}, before=1).orderBy("ts").collect()
    assert [r["par"] for r in out] == [0.0, float("inf"), -1.0, 0.0]
    assert [r["safe"] for r in out] == [0.0, 0.0, -1.0, 0.0]


def test_equal_values_duplicate_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in [5, 5, 5, 5]], "tpm double")
    e = categories.edges(df, "tpm", 3).first()
    assert [e[f"edge_{i}"] for i in range(4)] == [5.0] * 4
    cats = {r[0] for r in categories.categorise(df, "tpm", 3).select("tpm_category").collect()}
    assert cats == {"low"}


def test_quantiles_match_numpy(spark):
    import numpy as np
    rnd = random.Random(7)
    vals = [rnd.choice([1.0, 2.0, 2.0, 3.5]) + rnd.random() * (i % 3) for i in range(500)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r["p"]: r["value"] for r in quantiles.quantiles(df, "x", probs).collect()}
    for p in probs:
        assert abs(got[p] - float(np.quantile(vals, p))) < 1e-9


def test_top_n_ties_keep_smaller_key(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 5), (4, 1)], "hour int, n int")
    df = df.withColumn("g", F.lit(0))
    top = reports.top_n_per_group(df, "g", [F.col("n").desc(), F.col("hour")], 2).collect()
    assert sorted(r["hour"] for r in top) == [1, 2]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_halo_windows_equal_plain_windows(spark, seed):
    rnd = random.Random(seed)
    data = []
    for s in range(3):
        for d in range(1, 15):
            for h in sorted(rnd.sample(range(24), rnd.choice([0, 1, 2, 5, 24]))):
                data.append((s, ts(f"2024-01-{d:02d} {h:02d}:00"), rnd.random(), rnd.random(), rnd.choice([0, 1])))
    df = rows(spark, data)

    def build(w):
        return {"l3": F.lag("tpm", 3).over(w), "m12": temporal.rolling_mean(w, "tpm", 12),
                "ld2": F.lead("tpm", 2).over(w),
                **temporal.push_proximity(w, "is_push_notification")}
    a = temporal.windowed(df, "series", "ts", build, before=11, after=2)
    b = temporal.windowed(df, "series", "ts", build, bucket=None)
    cols = ["series", "ts", "l3", "m12", "ld2", "minutes_since_push"]
    ra = sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in a.select(*cols).collect()), key=repr)
    rb = sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in b.select(*cols).collect()), key=repr)
    assert ra == rb


def test_cumulative_and_fill_equal_plain(spark):
    rnd = random.Random(5)
    data = [(s, ts(f"2024-01-{d:02d} {h:02d}:00"), rnd.choice([None, rnd.random()]), 1.0, 0)
            for s in range(2) for d in range(1, 10) for h in sorted(rnd.sample(range(24), rnd.choice([0, 1, 3])))]
    df = rows(spark, data)
    w = Window.partitionBy("series").orderBy("ts")
    bf = temporal.back_fill(df, "series", "ts", ["tpm"]).select("series", "ts", F.col("tpm").alias("a"))
    ref = df.select("series", "ts", F.first("tpm", ignorenulls=True).over(
        w.rowsBetween(0, Window.unboundedFollowing)).alias("a"))
    assert bf.exceptAll(ref).count() == 0 and ref.exceptAll(bf).count() == 0
    ff = temporal.forward_fill(df, "series", "ts", ["tpm"]).select("series", "ts", F.col("tpm").alias("a"))
    ref2 = df.select("series", "ts", F.last("tpm", ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, 0)).alias("a"))
    assert ff.exceptAll(ref2).count() == 0
    cs = temporal.cumulative_sum(df.withColumn("one", F.lit(1)), "series", "ts", "one", "c")
    ref3 = df.select("series", "ts", F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("c"))
    assert cs.select("series", "ts", "c").exceptAll(ref3).count() == 0


def test_w2_short_groups_masked(spark):
    df = rows(spark, [(0, ts("2024-01-01 00:00"), 1.0, 1.0, 0), (0, ts("2024-01-01 01:00"), 2.0, 1.0, 0),
                      (1, ts("2024-01-01 00:00"), 1.0, 1.0, 0), (1, ts("2024-01-01 01:00"), 2.0, 1.0, 0),
                      (1, ts("2024-01-01 02:00"), 3.0, 1.0, 0)])
    f = traffic.series_features(df)
    m = temporal.mask_short_groups(f, "series", {"tpm_lag_2": 2}, {"tpm_ma_3": 3})
    got = {(r["series"], str(r["ts"])[11:16]): (r["tpm_lag_2"], r["tpm_ma_3"]) for r in m.collect()}
    assert got[(0, "01:00")] == (None, None)
    assert got[(1, "02:00")] == (1.0, 2.0)


def test_p4_p5_column_rules(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 3)], "tpm_lag_1 int, tpm double, name string, call_count long")
    assert prep.present_families(df.columns, ["tpm", "tpm_lag_5", "tpm_lag_1"]) == ["tpm", "tpm_lag_1"]
    assert prep.numeric_columns(df, exclude_patterns=["lag"], essentials=["name"]) == ["tpm", "call_count", "name"]


def test_exact_split_sizes(spark):
    df = spark.range(0, 1003).withColumn("k", F.col("id") % 3)
    s = prep.exact_split(df, "id", 0.2, strata=["k"])
    got = {r["k"]: r["n"] for r in s.filter("is_test = 1").groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    import math
    sizes = {r["k"]: r["c"] for r in df.groupBy("k").agg(F.count(F.lit(1)).alias("c")).collect()}
    assert got == {k: math.ceil(v * 0.2) for k, v in sizes.items()}


def test_nan_becomes_null_on_csv_read(spark, tmp_path):
    from tidewater.sources import files
    p = tmp_path / "d.csv"
    p.write_text("Country,Age,Salary\nFrance,44,72000\nSpain,NaN,\nGermany,30,54000\n")
    df = files.read_csv(spark, str(p), "Country string, Age double, Salary double")
    r = df.agg(F.avg("Age").alias("a"), F.count("Age").alias("n"), F.count("Salary").alias("s")).first()
    assert r["a"] == 37.0 and r["n"] == 2 and r["s"] == 2


def test_time_halo_range_frame_equals_plain(spark):
    rnd = random.Random(11)
    data = []
    for s in range(2):
        for d in range(1, 6):
            for m in sorted(rnd.sample(range(24 * 60), rnd.choice([0, 3, 40]))):
                data.append((s, ts(f"2024-01-{d:02d} {m // 60:02d}:{m % 60:02d}"), rnd.random(), 1.0, 0))
    df = rows(spark, data).withColumn("_sec", F.unix_seconds(F.col("ts").cast("timestamp")))

    def build(w):
        return temporal.time_targets(w, "tpm", "_sec", {"t2h": 7200})
    a = temporal.windowed(df, "series", "ts", build, after_seconds=7200).select("series", "ts", "t2h")
    b = temporal.windowed(df, "series", "ts", build, bucket=None).select("series", "ts", "t2h")
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_auc_exact_with_ties_and_crowded_scores(spark):
    from tidewater.operators import metrics
    rnd = random.Random(3)
    data = [(rnd.choice([0, 1]), rnd.choice([0.1, 0.2, 0.2, 0.9]) if i % 2 else 0.5 + rnd.random() * 1e-6)
            for i in range(3000)]
    pos = [s for y, s in data if y == 1]
    neg = [s for y, s in data if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    got = metrics.roc_auc(spark.createDataFrame(data, "label int, score double")).first()["roc_auc"]
    assert abs(got - want) < 1e-12


def test_quantile_zoom_on_crowded_values(spark, monkeypatch):
    import numpy as np
    monkeypatch.setattr(quantiles, "CELL_ROWS", 50)
    rnd = random.Random(9)
    # most values crowded into a range ~1e-9 wide next to two far outliers
    vals = [1.0 + rnd.random() * 1e-9 for _ in range(3000)] + [-1e6, 1e6] + [1.0] * 200
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.0, 0.01, 0.33, 0.5, 0.77, 0.999, 1.0]
    got = quantiles.global_quantiles(df, "x", probs)
    for p, g in zip(probs, got):
        assert g == pytest.approx(float(np.quantile(vals, p)), rel=0, abs=1e-15)


@pytest.mark.parametrize("buckets,cell_rows", [(4096, 100_000), (64, 20)])
def test_quantiles_of_all_columns_and_groups_in_shared_passes(spark, monkeypatch, buckets, cell_rows):
    import numpy as np
    monkeypatch.setattr(quantiles, "BUCKETS", buckets)
    monkeypatch.setattr(quantiles, "CELL_ROWS", cell_rows)
    rnd = random.Random(11)
    rows = []
    for i in range(900):
        g = rnd.choice(["a", "a", "a", "b", None])
        x = rnd.choice([1e300, -1e300]) if i % 150 == 0 else 5.0 + rnd.random() * 1e-7  # an outlier or two a group
        y = rnd.choice([1, 2, 2, 3, None])
        rows.append((g, x, y))
    rows += [("none", None, None), ("nan", float("nan"), 4), ("one", 7.0, 7), ("inf", float("inf"), 1), ("inf", 2.0, 2)]
    df = spark.createDataFrame(rows, "g string, x double, y int")
    probs = [0.0, 0.25, 0.5, 0.999, 1.0]
    for groups in ((), ("g",)):
        got = {(r["g"] if groups else None, r["column"], r["p"]): r["value"]
               for r in quantiles.column_quantiles(df, ["x", "y"], probs, groups).collect()}
        for g in {r[0] for r in rows} if groups else {None}:
            for at, col in ((1, "x"), (2, "y")):
                own = [r[at] for r in rows if (not groups or r[0] == g) and r[at] is not None and r[at] == r[at]]
                for p in probs:
                    if not own:
                        assert got.get((g, col, p)) is None
                    elif g != "inf" and (groups or col == "y"):
                        assert got[g, col, p] == pytest.approx(float(np.quantile(own, p)), rel=1e-15), (g, col, p)
    assert got["inf", "x", 0.0] == 2.0 and got["inf", "x", 1.0] == float("inf")


def test_a_crowded_group_never_reaches_one_window_task(spark, monkeypatch):
    """One outlier a group: the cells whose values are counted hold CELL_ROWS rows at most, or a single value."""
    monkeypatch.setattr(quantiles, "CELL_ROWS", 200)
    seen = []
    plain = quantiles._order_statistics

    def watched(values, cells):
        seen.extend(cells.df.select("_n", "_lo", "_hi").collect())
        return plain(values, cells)

    monkeypatch.setattr(quantiles, "_order_statistics", watched)
    df = spark.range(20_000).select((F.col("id") % 3).alias("g"), F.when(F.col("id") < 3, 1e12).otherwise(
        F.sqrt(F.col("id"))).alias("x"))
    quantiles.quantiles(df, "x", [0.1, 0.5, 0.9], ["g"]).collect()
    assert seen and all(r["_n"] <= 200 or r["_lo"] == r["_hi"] for r in seen)


@pytest.mark.parametrize("bits", [(32, 16), (8, 4)])
def test_exact_split_takes_the_lowest_hashes_then_keys(spark, monkeypatch, bits):
    """Against a sort in plain Python; with 8 bits most hashes are shared, so keys decide. A null stratum is one."""
    import hashlib
    import math
    monkeypatch.setattr(prep, "HASH_BITS", bits[0])
    monkeypatch.setattr(prep, "LOW_BITS", bits[1])
    rows = [(f"k{i}", ("a", "b", None)[i % 7 % 3]) for i in range(700)] + [("alone", "c")]
    df = spark.createDataFrame(rows, "id string, k string")
    for strata in ([], ["k"]):
        got = {r["id"]: r["is_test"] for r in prep.exact_split(df, "id", 0.3, strata).collect()}
        groups = {}
        for i, k in rows:
            groups.setdefault(k if strata else 0, []).append((int(hashlib.md5(i.encode()).hexdigest()[:bits[0] // 4], 16), i))
        want = {i: int(n < math.ceil(len(g) * 0.3)) for g in groups.values() for n, (_, i) in enumerate(sorted(g))}
        assert got == want
    assert {r["is_test"] for r in prep.exact_split(df, "id", 0.0).collect()} == {0}
    assert {r["is_test"] for r in prep.exact_split(df, "id", 1.0, ["k"]).collect()} == {1}
    assert prep.exact_split(df.limit(0), "id", 0.5, ["k"]).collect() == []


def test_kept_tables_are_released(spark):
    import os
    from tidewater import session
    kept = session.materialize(spark.range(5))
    path = session._KEPT[-1].removeprefix("file://")
    assert kept.count() == 5 and os.path.exists(path)
    session.release(spark)
    assert not os.path.exists(path) and not session._KEPT


@pytest.fixture
def no_size_broadcast(spark):
    """A planner that sends a side to every task only when it is told to, as it does when it cannot know the size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _joins(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("BroadcastHashJoin"), plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin")


def test_exact_split_moves_no_stratum_to_one_task(spark, no_size_broadcast, monkeypatch):
    df = spark.range(400).select("id", F.when(F.col("id") % 5 > 0, F.lit("a")).alias("k"))
    few = prep.exact_split(df, "id", 0.3, ["k"])
    assert _joins(few) == (1, 0)
    monkeypatch.setattr(prep, "FEW_GROUPS", 1)  # too many strata to send: same rows
    many = prep.exact_split(df, "id", 0.3, ["k"])
    assert _joins(many) == (0, 1)
    assert sorted(few.collect(), key=str) == sorted(many.collect(), key=str)
    assert sorted((r["k"] or "", r["n"]) for r in few.where("is_test = 1").groupBy("k").agg(F.count("*").alias("n")).collect()) == [("", 24), ("a", 96)]


def test_standardising_by_group_moves_no_group_to_one_task(spark, no_size_broadcast, monkeypatch):
    df = spark.range(100).select("id", F.when(F.col("id") < 97, F.col("id") % 2).alias("g"), (F.col("id") * 1.5).alias("x"))

    def scaled():
        return prep.apply_standardiser(df, prep.fit_standardiser(df, ["x"], ["g"]), ["x"], ["g"])

    few = scaled()
    assert _joins(few) == (1, 0)
    assert few.count() == 97  # rows without a group are in none
    monkeypatch.setattr(prep, "FEW_GROUPS", 1)
    many = scaled()
    assert _joins(many) == (0, 1)
    assert sorted(few.collect()) == sorted(many.collect())
    assert few.agg(F.round(F.avg("z_x"), 9)).first()[0] == 0
