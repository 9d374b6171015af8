"""Shared inputs for registered queries: the traffic view V and its oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.operators import traffic
from tidewater.session import materialize
from tidewater.sources.tables import table


def adjustment_oracle(cat: str, hour: str, day: str) -> str:
    """DuckDB text of the category adjustment, stated apart from the operator it checks."""
    return f"""CASE {cat}
        WHEN 'high' THEN CASE WHEN {hour} = 0 AND {day} = 0 THEN 0.9 ELSE 1.0 END
        WHEN 'medium' THEN CASE {hour} + {day} WHEN 2 THEN 1.05 WHEN 0 THEN 0.95 ELSE 1.0 END
        WHEN 'low' THEN CASE WHEN {hour} + {day} = 2 THEN 1.15 ELSE 1.0 END
        ELSE 1.0 END"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def view_v(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """View V: hourly traffic per series (A18), computed once (checkpointed).

    Every consumer windows or re-aggregates it from several plan branches;
    the raw events are scanned a single time. Only the columns asked for are computed (all
    of them without any), so the running play count, which has shuffles of its own, is there on demand.
    """
    cols = cols or tuple(V_COLS.split())
    v = traffic.traffic_series(events(spark, sf_dir), with_play_count="play_counted" in cols)
    return materialize(v.select(*cols))


def series_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5-minute traffic per series (tpm only), computed once for the windows that follow."""
    return materialize(traffic.traffic_series(events(spark, sf_dir), period_seconds=300,
                                              with_play_count=False).select("series", "ts", "tpm"))


def features_v(spark: SparkSession, sf_dir: str, parity: bool = True) -> DataFrame:
    v = view_v(spark, sf_dir, *[c for c in V_COLS.split() if c != "play_counted"])
    return traffic.series_features(traffic.calendar_features(v), parity=parity)


def window_features(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """Series, time and the named features of V, from the columns and the halo that they need."""
    needs = ["tpm", *[c for c, of in (("response_time", "response_time"), ("is_push_notification", "push"))
                      if any(of in n for n in names)]]
    v = view_v(spark, sf_dir, "series", "ts", *needs)
    return traffic.series_features(v, want=names).select("series", "ts", *names)


# DuckDB definition of view V (same columns and types as ``view_v``).
V_CTE = """
v_agg AS (
  SELECT CAST(user_id % 4 AS BIGINT) AS series,
         date_trunc('hour', ts) AS ts,
         CAST(count(*) AS BIGINT) AS call_count,
         avg(value) AS response_time,
         min(value) AS min_response_time,
         max(value) AS max_response_time,
         stddev_samp(value) AS standard_deviation,
         count(*) FILTER (WHERE event_type = 'signup') AS push_n
  FROM events GROUP BY 1, 2
), v AS (
  SELECT series, ts, call_count, response_time, min_response_time, max_response_time,
         standard_deviation,
         call_count / CAST(60.0 AS DOUBLE) AS tpm,
         CAST(CASE WHEN push_n >= 2 THEN 1 ELSE 0 END AS INTEGER) AS is_push_notification,
         CAST(sum(call_count) OVER (PARTITION BY series ORDER BY ts
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS play_counted
  FROM v_agg
)"""

V_COLS = ("series ts call_count response_time min_response_time max_response_time "
          "standard_deviation tpm is_push_notification play_counted")

# Features of V (calendar + lags/rolling/change/push), parity forms.
VF_CTE = V_CTE + """,
vf AS (
  SELECT v.*,
    CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute,
    CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
    CAST(CASE WHEN isodow(ts) - 1 >= 5 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
    hour(ts) + minute(ts) / 60.0 AS time_of_day,
    sin(2 * pi() * hour(ts) / 24.0) AS hour_sin, cos(2 * pi() * hour(ts) / 24.0) AS hour_cos,
    sin(2 * pi() * minute(ts) / 60.0) AS minute_sin, cos(2 * pi() * minute(ts) / 60.0) AS minute_cos,
    CAST(CASE WHEN hour(ts) IN (0, 1, 9, 10, 12, 13, 19, 20) THEN 1 ELSE 0 END AS INTEGER) AS is_peak_hour,
    lag(tpm, 1) OVER w AS tpm_lag_1, lag(tpm, 2) OVER w AS tpm_lag_2,
    lag(tpm, 3) OVER w AS tpm_lag_3, lag(tpm, 5) OVER w AS tpm_lag_5,
    lag(response_time, 1) OVER w AS response_time_lag_1,
    lag(response_time, 2) OVER w AS response_time_lag_2,
    lag(response_time, 3) OVER w AS response_time_lag_3,
    lag(response_time, 5) OVER w AS response_time_lag_5,
    avg(tpm) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS tpm_ma_3,
    avg(tpm) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS tpm_ma_5,
    avg(tpm) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS tpm_ma_6,
    avg(tpm) OVER (w ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS tpm_ma_12,
    avg(response_time) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS response_time_ma_3,
    avg(response_time) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS response_time_ma_5,
    coalesce(stddev_samp(tpm) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 0) AS tpm_std_3,
    coalesce(stddev_samp(tpm) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 0) AS tpm_std_5,
    tpm - lag(tpm, 1) OVER w AS tpm_change,
    CASE WHEN lag(tpm, 1) OVER w IS NULL THEN 0
         WHEN lag(tpm, 1) OVER w <> 0 THEN tpm / lag(tpm, 1) OVER w - 1
         WHEN tpm > 0 THEN CAST('inf' AS DOUBLE) WHEN tpm < 0 THEN CAST('-inf' AS DOUBLE)
         ELSE 0 END AS tpm_change_rate,
    response_time - lag(response_time, 1) OVER w AS response_time_change,
    CAST(coalesce((row_number() OVER w - max(CASE WHEN is_push_notification = 1
         THEN row_number_helper END) OVER (w ROWS BETWEEN 8 PRECEDING AND CURRENT ROW)) * 5, 0)
         AS INTEGER) AS minutes_since_push
  FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts) AS row_number_helper FROM v) v
  WINDOW w AS (PARTITION BY series ORDER BY ts)
), vff AS (
  SELECT * EXCLUDE (row_number_helper),
    CAST(CASE WHEN minutes_since_push <= 45 THEN 1 ELSE 0 END AS INTEGER) AS is_post_push_period
  FROM vf
)"""
