"""Registered window queries over the traffic view."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import temporal
from tidewater.plans import common
from tidewater.plans.common import V_CTE, VF_CTE
from tidewater.plans.registry import query


def _vf(spark, sf_dir, parity=True):
    return common.features_v(spark, sf_dir, parity=parity)


@query("W1_lags", "WITH " + VF_CTE + """ SELECT series, ts, tpm_lag_1, tpm_lag_2, tpm_lag_3,
       tpm_lag_5, response_time_lag_1, response_time_lag_2, response_time_lag_3,
       response_time_lag_5 FROM vff""",
       doubles="tpm_lag_1 tpm_lag_2 tpm_lag_3 tpm_lag_5 response_time_lag_1 response_time_lag_2 "
               "response_time_lag_3 response_time_lag_5", times="ts")
def w1(spark, sf_dir):
    return common.window_features(spark, sf_dir, *[f"{v}_lag_{i}" for v in ("tpm", "response_time") for i in (1, 2, 3, 5)])


@query("W3_rolling_mean", "WITH " + VF_CTE + """ SELECT series, ts, tpm_ma_3, tpm_ma_5, tpm_ma_6,
       tpm_ma_12, response_time_ma_3, response_time_ma_5 FROM vff""",
       doubles="tpm_ma_3 tpm_ma_5 tpm_ma_6 tpm_ma_12 response_time_ma_3 response_time_ma_5",
       times="ts")
def w3(spark, sf_dir):
    return common.window_features(spark, sf_dir, "tpm_ma_3", "tpm_ma_5", "tpm_ma_6", "tpm_ma_12", "response_time_ma_3",
                                  "response_time_ma_5")


@query("W4_rolling_std", "WITH " + VF_CTE + " SELECT series, ts, tpm_std_3, tpm_std_5 FROM vff",
       doubles="tpm_std_3 tpm_std_5", times="ts")
def w4(spark, sf_dir):
    return common.window_features(spark, sf_dir, "tpm_std_3", "tpm_std_5")


@query("W5_first_difference", "WITH " + VF_CTE +
       " SELECT series, ts, tpm_change, response_time_change FROM vff",
       doubles="tpm_change response_time_change", times="ts")
def w5(spark, sf_dir):
    return common.window_features(spark, sf_dir, "tpm_change", "response_time_change")


@query("W6_relative_change", "WITH " + VF_CTE + """ SELECT series, ts, tpm_change_rate,
       coalesce(tpm / nullif(lag(tpm) OVER (PARTITION BY series ORDER BY ts), 0) - 1, 0)
         AS tpm_change_rate_safe,
       CASE WHEN lag(play_counted) OVER (PARTITION BY series ORDER BY ts) IS NULL THEN 0
            ELSE play_counted / lag(play_counted) OVER (PARTITION BY series ORDER BY ts) - 1
       END AS play_counted_rate
       FROM vff""",
       doubles="tpm_change_rate tpm_change_rate_safe play_counted_rate", times="ts")
def w6(spark, sf_dir):
    def build(w):
        return {"tpm_change_rate": temporal.relative_change(w, "tpm", parity=True),
                "tpm_change_rate_safe": temporal.relative_change(w, "tpm", parity=False),
                "play_counted_rate": temporal.relative_change(w, "play_counted", parity=True)}
    v = common.view_v(spark, sf_dir, "series", "ts", "tpm", "play_counted")
    return temporal.windowed(v, "series", "ts", build, before=1).select(
        "series", "ts", "tpm_change_rate", "tpm_change_rate_safe", "play_counted_rate")


@query("W7_trend", "WITH " + VF_CTE + " SELECT series, ts, tpm - tpm_lag_1 AS tpm_trend FROM vff",
       doubles="tpm_trend", times="ts")
def w7(spark, sf_dir):
    v = common.view_v(spark, sf_dir, "series", "ts", "tpm")
    return temporal.windowed(v, "series", "ts",
                             lambda w: {"tpm_trend": temporal.first_difference(w, "tpm")},
                             before=1).select("series", "ts", "tpm_trend")


V5_CTE = """
v5 AS (
  SELECT CAST(user_id % 4 AS BIGINT) AS series,
         time_bucket(INTERVAL '5 minutes', ts) AS ts,
         count(*) / CAST(5.0 AS DOUBLE) AS tpm
  FROM events GROUP BY 1, 2
)"""


@query("W8_positional_targets", "WITH " + V5_CTE + """ SELECT series, ts, tpm,
       coalesce(lead(tpm, 1) OVER w, tpm) AS target_5min,
       coalesce(lead(tpm, 2) OVER w, tpm) AS target_10min,
       coalesce(lead(tpm, 4) OVER w, tpm) AS target_20min,
       coalesce(lead(tpm, 6) OVER w, tpm) AS target_30min
       FROM v5 WINDOW w AS (PARTITION BY series ORDER BY ts)""",
       doubles="tpm target_5min target_10min target_20min target_30min", times="ts")
def w8(spark, sf_dir):
    v5 = common.series_5min(spark, sf_dir)
    return temporal.windowed(
        v5, "series", "ts",
        lambda w: temporal.positional_targets(w, "tpm", [5, 10, 20, 30], 5.0), after=6)


@query("W9_time_targets", "WITH " + V_CTE + """ SELECT series, ts, tpm,
       last_value(tpm) OVER (PARTITION BY series ORDER BY ts
            RANGE BETWEEN CURRENT ROW AND INTERVAL 1 HOUR FOLLOWING) AS target_1h,
       last_value(tpm) OVER (PARTITION BY series ORDER BY ts
            RANGE BETWEEN CURRENT ROW AND INTERVAL 2 HOUR FOLLOWING) AS target_2h
       FROM v""", doubles="tpm target_1h target_2h", times="ts")
def w9(spark, sf_dir):
    v = common.view_v(spark, sf_dir, "series", "ts", "tpm")
    v = v.withColumn("_sec", F.unix_seconds(F.col("ts").cast("timestamp")))
    # a 2-hour time halo: exact however many rows a period holds
    out = temporal.windowed(v, "series", "ts",
                            lambda w: temporal.time_targets(w, "tpm", "_sec",
                                                            {"target_1h": 3600, "target_2h": 7200}),
                            after_seconds=7200)
    return out.drop("_sec")


@query("W10_fill_tail_targets", "WITH " + V5_CTE + """ SELECT series, ts,
       lead(tpm, 6) OVER w AS raw_target_30min,
       coalesce(lead(tpm, 6) OVER w, tpm) AS target_30min
       FROM v5 WINDOW w AS (PARTITION BY series ORDER BY ts)""",
       doubles="raw_target_30min target_30min", times="ts")
def w10(spark, sf_dir):
    v5 = common.series_5min(spark, sf_dir)

    def build(w):
        raw = temporal.positional_targets(w, "tpm", [30], 5.0, fill_current=False)["target_30min"]
        return {"raw_target_30min": raw, "target_30min": F.coalesce(raw, F.col("tpm"))}
    return temporal.windowed(v5, "series", "ts", build, after=6).select(
        "series", "ts", "raw_target_30min", "target_30min")


@query("W11_push_proximity", "WITH " + VF_CTE + """ SELECT series, ts, is_push_notification,
       minutes_since_push, is_post_push_period,
       CAST(CASE WHEN max(CASE WHEN is_push_notification = 1 THEN rn END)
                      OVER (PARTITION BY series ORDER BY ts ROWS BETWEEN 8 PRECEDING AND CURRENT ROW) IS NULL
                 THEN 999999 ELSE minutes_since_push END AS INTEGER) AS minutes_since_push_corrected
       FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts) AS rn FROM vff) x""",
       times="ts")
def w11(spark, sf_dir):
    v = common.view_v(spark, sf_dir, "series", "ts", "is_push_notification")

    def build(w):
        par = temporal.push_proximity(w, "is_push_notification", parity=True)
        cor = temporal.push_proximity(w, "is_push_notification", parity=False)
        return {**par, "minutes_since_push_corrected": cor["minutes_since_push"]}
    return temporal.windowed(v, "series", "ts", build, before=8).select(
        "series", "ts", "is_push_notification", "minutes_since_push", "is_post_push_period",
        "minutes_since_push_corrected")


@query("W12_sequence_id", """SELECT event_id, CAST(row_number() OVER (ORDER BY ts, event_id) - 1
       AS BIGINT) AS sequence_id FROM events""")
def w12(spark, sf_dir):
    e = common.events(spark, sf_dir).select("event_id", "ts")
    return temporal.sequence_number(e, ["ts", "event_id"]).select("event_id", "sequence_id")


@query("W13_daily_normalised", "WITH " + V_CTE + """ SELECT series, ts,
       (play_counted - min(play_counted) OVER d) / nullif(CAST(max(play_counted) OVER d
         - min(play_counted) OVER d AS DOUBLE), 0) * max(tpm) OVER d AS play_normalized
       FROM v WINDOW d AS (PARTITION BY series, CAST(ts AS DATE))""",
       doubles="play_normalized", times="ts")
def w13(spark, sf_dir):
    from tidewater.operators import reports
    v = common.view_v(spark, sf_dir, "series", "ts", "tpm", "play_counted").withColumn("date", F.to_date("ts"))
    return reports.daily_normalised(v, date_col=["series", "date"]).select("series", "ts", "play_normalized")


@query("W14_back_fill", "WITH " + V_CTE + """ SELECT series, ts, standard_deviation,
       first_value(standard_deviation IGNORE NULLS) OVER (PARTITION BY series ORDER BY ts
         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS std_bfill
       FROM v""", doubles="standard_deviation std_bfill", times="ts")
def w14(spark, sf_dir):
    v = common.view_v(spark, sf_dir, "series", "ts", "standard_deviation")
    v = v.withColumn("std_bfill", F.col("standard_deviation"))
    return temporal.back_fill(v, "series", "ts", ["std_bfill"])


@query("J4_asof_latest_push", "WITH " + V_CTE + """ SELECT series, ts,
       last_value(CASE WHEN is_push_notification = 1 THEN ts END IGNORE NULLS)
         OVER (PARTITION BY series ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         AS last_push_ts,
       date_diff('minute', last_value(CASE WHEN is_push_notification = 1 THEN ts END IGNORE NULLS)
         OVER (PARTITION BY series ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), ts)
         / CAST(1 AS DOUBLE) AS minutes_since_last_push
       FROM v""", doubles="minutes_since_last_push", times="ts last_push_ts")
def j4(spark, sf_dir):
    from tidewater.functions import timefn
    v = common.view_v(spark, sf_dir, "series", "ts", "is_push_notification")
    v = v.withColumn("last_push_ts", F.when(F.col("is_push_notification") == 1, F.col("ts")))
    v = temporal.forward_fill(v, "series", "ts", ["last_push_ts"])
    return v.select("series", "ts", "last_push_ts",
                    timefn.minutes_between("last_push_ts", "ts").alias("minutes_since_last_push"))
