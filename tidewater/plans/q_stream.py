"""Registered streaming queries (X1-X4) and the W2 / F22 parity forms.

Each stream runs to completion with ``trigger(availableNow=True)`` into a
parquet sink under the shared checkpoint folder and the sink is read back, so
the result is what a downstream batch job would see. The oracles model the
watermark: only windows whose end is at or before (latest event - 10 minutes)
have been emitted in append mode.
"""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tidewater.operators import scoring, temporal
from tidewater.plans import common
from tidewater.plans.common import V_CTE
from tidewater.plans.q_models import ADJ, TEST_FLAG_SQL, TRAIN_STATE_SQL, train_test
from tidewater.plans.q_reports import _v_dated
from tidewater.plans.registry import query
from tidewater.session import materialize, scratch_path
from tidewater.sources.tables import table_path
from tidewater.streaming import traffic_stream as ts


STEP_FILES = 2


def _events_stream(spark, sf_dir):
    schema = spark.read.parquet(table_path(sf_dir, "events")).schema
    # a glob keeps the source a file pattern (the folder holds other tables)
    return spark.readStream.schema(schema).parquet(table_path(sf_dir, "events").replace(".parquet", "*.parquet"))


def _run_to_parquet(spark, df, tag):
    run = uuid.uuid4().hex
    out, ck = scratch_path(spark, f"{tag}-{run}/out"), scratch_path(spark, f"{tag}-{run}/ck")
    q = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


@query("X1_stream_tumbling_tpm", """WITH m AS (SELECT max(ts) AS latest FROM events)
       SELECT CAST(user_id % 4 AS BIGINT) AS series, date_trunc('hour', ts) AS ts, count(*) AS call_count,
              count(*) / 60.0 AS tpm, avg(value) AS response_time,
              CAST(CASE WHEN count(*) FILTER (WHERE event_type = 'signup') >= 2 THEN 1 ELSE 0 END AS INTEGER)
                AS is_push_notification
       FROM events GROUP BY 1, 2
       HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT latest FROM m) - INTERVAL 10 MINUTE""",
       doubles="tpm response_time", times="ts")
def x1(spark, sf_dir):
    return _run_to_parquet(spark, ts.tumbling_tpm(_events_stream(spark, sf_dir)), "x1")


@query("X2_stream_sliding_mean", """WITH m AS (SELECT max(ts) AS latest FROM events),
       w AS (SELECT CAST(user_id % 4 AS BIGINT) AS series, value,
                    time_bucket(INTERVAL '5 minutes', ts) - k.range * INTERVAL '5 minutes' AS window_start
             FROM events, range(0, 6) k)
       SELECT series, window_start, window_start + INTERVAL 30 MINUTE AS window_end, count(*) AS n,
              avg(value) AS mean_value FROM w
       WHERE window_start + INTERVAL 30 MINUTE <= (SELECT latest FROM m) - INTERVAL 10 MINUTE
       GROUP BY series, window_start""", doubles="mean_value", times="window_start window_end")
def x2(spark, sf_dir):
    return _run_to_parquet(spark, ts.sliding_mean(_events_stream(spark, sf_dir)), "x2")


@query("X3_stream_keyed_lags", "WITH " + V_CTE + """ SELECT * FROM (SELECT series, ts, tpm,
       lag(tpm, 1) OVER w AS tpm_lag_1, lag(tpm, 2) OVER w AS tpm_lag_2, lag(tpm, 3) OVER w AS tpm_lag_3,
       avg(tpm) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS tpm_ma_6,
       avg(tpm) OVER (w ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS tpm_ma_12,
       CAST(coalesce((row_number() OVER w - max(CASE WHEN is_push_notification = 1 THEN rn END)
            OVER (w ROWS BETWEEN 8 PRECEDING AND CURRENT ROW)) * 5, 0) AS INTEGER) AS minutes_since_push
       FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts) AS rn FROM v) v
       WINDOW w AS (PARTITION BY series ORDER BY ts))
       WHERE ts <= (SELECT max(ts) FROM v) - INTERVAL 10 MINUTE""",
       doubles="tpm tpm_lag_1 tpm_lag_2 tpm_lag_3 tpm_ma_6 tpm_ma_12", times="ts")
def x3(spark, sf_dir):
    """Series rows land in three steps of time, each in several files; one micro-batch a step."""
    v = common.view_v(spark, sf_dir, "series", "ts", "tpm", "is_push_notification")
    src = scratch_path(spark, f"x3-src-{uuid.uuid4().hex}")
    lo, hi = v.agg(F.min("ts"), F.max("ts")).first()
    step = (hi - lo) / 3
    for i in range(3):
        part = v.filter(F.col("ts") >= F.lit(lo + i * step))
        if i < 2:
            part = part.filter(F.col("ts") < F.lit(lo + (i + 1) * step))
        part.repartition(STEP_FILES).write.parquet(f"{src}/b{i}")
    stream = (ts.state_session(spark).readStream.schema(v.schema).option("maxFilesPerTrigger", STEP_FILES)
              .parquet(f"{src}/b*/*.parquet"))
    return _run_to_parquet(spark, ts.keyed_lags(stream), "x3")


@query("X4_stream_score_batches", "WITH " + V_CTE + """, m AS (SELECT max(ts) AS latest FROM events),
       k AS (SELECT regr_slope(response_time, tpm) AS a, regr_intercept(response_time, tpm) AS b FROM v)
       SELECT series, ts, b + a * tpm AS prediction FROM v, k
       WHERE ts + INTERVAL 1 HOUR <= (SELECT latest FROM m) - INTERVAL 10 MINUTE""",
       doubles="prediction", times="ts")
def x4(spark, sf_dir):
    """Response time predicted from traffic: fitted on the batch series, scored on each closed hour of the stream."""
    v = common.view_v(spark, sf_dir, "series", "ts", "tpm", "response_time")
    model = Pipeline(stages=[VectorAssembler(inputCols=["tpm"], outputCol="features"),
                             LinearRegression(labelCol="response_time", solver="normal")]).fit(v)
    run = uuid.uuid4().hex
    out, ck = scratch_path(spark, f"x4-{run}/out"), scratch_path(spark, f"x4-{run}/ck")
    ts.score_batches(ts.tumbling_tpm(_events_stream(spark, sf_dir)), model, out, ck).awaitTermination()
    return spark.read.parquet(out).select("series", "ts", "prediction")


@query("W2_short_group_mask", "WITH " + V_CTE + """, d AS (SELECT *, CAST(ts AS DATE) AS date,
       count(*) OVER (PARTITION BY series, CAST(ts AS DATE)) AS gn FROM v)
       SELECT series, ts,
         CASE WHEN gn > 1 THEN lag(tpm, 1) OVER w END AS tpm_lag_1,
         CASE WHEN gn > 5 THEN lag(tpm, 5) OVER w END AS tpm_lag_5,
         CASE WHEN gn >= 5 THEN avg(tpm) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) END AS tpm_ma_5
       FROM d WINDOW w AS (PARTITION BY series, date ORDER BY ts)""",
       doubles="tpm_lag_1 tpm_lag_5 tpm_ma_5", times="ts")
def w2(spark, sf_dir):
    v = common.view_v(spark, sf_dir, "series", "ts", "tpm").withColumn("date", F.to_date("ts"))
    f = temporal.windowed(v, ["series", "date"], "ts", lambda w: {
        **temporal.lag_columns(w, "tpm", [1, 5]), "tpm_ma_5": temporal.rolling_mean(w, "tpm", 5)}, before=5)
    return temporal.mask_short_groups(f, ["series", "date"], {"tpm_lag_1": 1, "tpm_lag_5": 5},
                                      {"tpm_ma_5": 5}).select("series", "ts", "tpm_lag_1", "tpm_lag_5", "tpm_ma_5")


@query("F22_adjustment_applied", "WITH " + V_CTE + f""",
       rows_ AS (SELECT *, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
                 coalesce(lead(tpm) OVER (PARTITION BY series ORDER BY ts), tpm) AS nxt, {TEST_FLAG_SQL} FROM v),"""
       + TRAIN_STATE_SQL + """,
       fl AS (SELECT cur.*,
         CAST(EXISTS (SELECT 1 FROM peaks p WHERE p.kind = 'hour' AND p.tpm_category = cur.cur
                      AND p.key = cur.hour) AS INTEGER) AS ph,
         CAST(EXISTS (SELECT 1 FROM peaks p WHERE p.kind = 'day' AND p.tpm_category = cur.cur
                      AND p.key = cur.day_of_week) AS INTEGER) AS pd FROM cur),
       a AS (SELECT *, """ + ADJ + """ AS f FROM fl)
       SELECT series, ts, CAST(CASE WHEN tpm * f <> tpm OR nxt * f <> nxt THEN 1 ELSE 0 END AS INTEGER)
              AS adjustment_applied FROM a""", times="ts")
def f22(spark, sf_dir):
    v = temporal.windowed(_v_dated(spark, sf_dir), "series", "ts", lambda w: {
        "pred_60": F.coalesce(F.lead("tpm", 1).over(w), F.col("tpm"))}, after=1)
    rows = materialize(train_test(v.withColumn("pred_0", F.col("tpm"))))
    state = scoring.category_state("tpm", [0, 60]).fit(rows.filter("is_test = 0"))
    return state.transform(rows.filter("is_test = 1")).select("series", "ts", "adjustment_applied")
