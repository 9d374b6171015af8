"""Stream-equals-batch checks for X1-X4."""

import datetime as dt
import os
import random
import shutil
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidewater.operators import temporal, traffic
from tidewater.sources.tables import table
from tidewater.streaming import traffic_stream as ts


@pytest.fixture(scope="module")
def events_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("events_stream")
    shutil.copy(f"{SF_SMALL}/events.parquet", os.path.join(d, "part-0.parquet"))
    return str(d)


def _run(df, name, tmp):
    q = (df.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", os.path.join(tmp, name)).trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.table(name)


def test_x1_tumbling_equals_batch_for_closed_windows(spark, events_dir, tmp_path):
    schema = table(spark, SF_SMALL, "events").schema
    stream = spark.readStream.schema(schema).parquet(events_dir)
    got = _run(ts.tumbling_tpm(stream), "x1", str(tmp_path))
    batch = traffic.traffic_series(table(spark, SF_SMALL, "events"), with_play_count=False).select(
        "series", "ts", "call_count", "tpm")
    g = got.select("series", "ts", "call_count", "tpm")
    assert g.exceptAll(batch).count() == 0
    missing = batch.exceptAll(g)
    max_ts = table(spark, SF_SMALL, "events").agg(F.max("ts")).first()[0]
    # only windows not yet closed by the watermark (end > max - 10 min) may be missing
    assert missing.filter(F.col("ts") + F.expr("INTERVAL 70 MINUTES") <= F.lit(max_ts)).count() == 0
    assert g.count() >= batch.count() - 4


def test_x2_sliding_equals_batch(spark, events_dir, tmp_path):
    schema = table(spark, SF_SMALL, "events").schema
    got = _run(ts.sliding_mean(spark.readStream.schema(schema).parquet(events_dir)), "x2", str(tmp_path))
    e = table(spark, SF_SMALL, "events").withColumn("event_time", F.col("ts").cast("timestamp"))
    batch = (e.groupBy(F.pmod("user_id", F.lit(4)).alias("series"),
                       F.window("event_time", "30 minutes", "5 minutes").alias("w"))
             .agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value"))
             .select("series", F.col("w.start").cast("timestamp_ntz").alias("window_start"), "n", "mean_value"))
    g = got.select("series", "window_start", "n", "mean_value")
    assert g.exceptAll(batch).count() == 0
    assert g.count() > 0.95 * batch.count()


BASE = dt.datetime(2024, 1, 1)


def _land(spark, rows, path):
    """One file of (series, minutes after BASE, tpm, push); micro-batches follow the files' times."""
    frame = spark.createDataFrame([(k, BASE + dt.timedelta(minutes=m), v, p) for k, m, v, p in rows],
                                  "series long, ts timestamp_ntz, tpm double, is_push_notification int")
    frame.coalesce(1).write.mode("append").parquet(path)  # a few rows of a test
    time.sleep(1.1)
    return frame


def _stream(spark, path, schema):
    return (ts.state_session(spark).readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path))


def _keyed(spark, path, schema, tmp, name, **options):
    df = ts.keyed_lags(_stream(spark, path, schema), **options)
    out, ck = os.path.join(tmp, f"{name}-out"), os.path.join(tmp, f"{name}-ck")
    q = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(out), ck


def _batch(v):
    return temporal.windowed(v, "series", "ts", lambda w: {
        **temporal.lag_columns(w, "tpm", [1, 2, 3]),
        "tpm_ma_6": temporal.rolling_mean(w, "tpm", 6), "tpm_ma_12": temporal.rolling_mean(w, "tpm", 12),
        "minutes_since_push": temporal.push_proximity(w, "is_push_notification")["minutes_since_push"]}, before=11)


def _compare(got, batch):
    cols = ["series", "ts", "tpm_lag_1", "tpm_lag_2", "tpm_lag_3", "minutes_since_push"]
    assert got.count() == batch.count()
    assert got.select(*cols).exceptAll(batch.select(*cols)).count() == 0
    close = got.alias("g").join(batch.alias("b"), ["series", "ts"]).filter(
        (F.abs(F.col("g.tpm_ma_12") - F.col("b.tpm_ma_12")) > 1e-9) | (F.abs(F.col("g.tpm_ma_6") - F.col("b.tpm_ma_6")) > 1e-9))
    assert close.count() == 0


def test_x3_rows_out_of_order_equal_batch_and_late_rows_are_dropped(spark, tmp_path):
    rnd = random.Random(4)
    path = str(tmp_path / "src")
    rows = [(k, m, rnd.random(), int(rnd.random() < 0.15)) for k in (1, 2, 3) for m in range(0, 600, 5)]
    for a, b in ((0, 200), (200, 400), (400, 600)):
        part = [r for r in rows if a <= r[1] < b]
        rnd.shuffle(part)  # any order inside a batch
        frame = _land(spark, part, path)
    late = [(1, 100, 99.0, 1), (2, 250, 99.0, 0)]  # long passed by the watermark
    moved = [(3, m, 5.0, 0) for m in (597, 592)]  # within its delay
    _land(spark, late + moved + [(1, 700, 1.0, 0)], path)
    got, _ = _keyed(spark, path, frame.schema, str(tmp_path), "ordered")
    expected = spark.createDataFrame([(k, BASE + dt.timedelta(minutes=m), v, p) for k, m, v, p in rows + moved], frame.schema)
    assert got.where("tpm = 99.0").count() == 0
    assert got.where(F.col("ts") > BASE + dt.timedelta(minutes=690)).count() == 0  # not passed yet
    _compare(got, _batch(expected))


def test_x3_state_of_a_silent_series_goes(spark, tmp_path):
    path = str(tmp_path / "src")
    frame = _land(spark, [(1, m, 1.0, 0) for m in range(0, 60, 5)] + [(2, m, 2.0, 0) for m in range(0, 60, 5)], path)
    _land(spark, [(2, m, 2.0, 0) for m in range(60, 4000, 100)], path)
    _land(spark, [(2, 4100, 2.0, 0)], path)
    got, ck = _keyed(spark, path, frame.schema, str(tmp_path), "silent", retain_days=1.0)
    assert got.where("series = 1").count() == 12
    held = (spark.read.format("statestore").option("stateVarName", "history").load(ck))
    assert {r["series"] for r in held.select("key.series").distinct().collect()} == {2}
    assert held.count() == ts.KEEP
    # the series returns and starts anew
    _land(spark, [(1, 5000, 7.0, 0), (2, 5100, 2.0, 0)], path)
    got, _ = _keyed(spark, path, frame.schema, str(tmp_path), "silent", retain_days=1.0)
    back = got.where((F.col("series") == 1) & (F.col("tpm") == 7.0)).collect()
    assert len(back) == 1 and back[0]["tpm_lag_1"] is None and back[0]["tpm_ma_12"] == 7.0


def test_x4_score_batches(spark, events_dir, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    v = traffic.traffic_series(table(spark, SF_SMALL, "events"), with_play_count=False)
    model = Pipeline(stages=[VectorAssembler(inputCols=["call_count"], outputCol="features"),
                             LinearRegression(labelCol="tpm")]).fit(v)
    schema = table(spark, SF_SMALL, "events").schema
    stream = ts.tumbling_tpm(spark.readStream.schema(schema).parquet(events_dir))
    out = str(tmp_path / "scored")
    q = ts.score_batches(stream, model, out, str(tmp_path / "ck"))
    q.awaitTermination()
    scored = spark.read.parquet(out)
    assert scored.count() > 0 and "prediction" in scored.columns
