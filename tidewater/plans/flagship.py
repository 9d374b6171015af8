"""Flagship question: the five busiest hours of each of the two latest days,
with each hour compared to its series' rolling 6-hour mean.

events -> A18 (hourly series) -> W3 rolling mean -> F3/F4 calendar text ->
T2 latest dates -> J1 semi join -> T3 top 5 per day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.functions import timefn
from tidewater.operators import reports, temporal, traffic
from tidewater.session import materialize
from tidewater.sources.tables import table


def busiest_hours(events: DataFrame, n_days: int = 2, top: int = 5) -> DataFrame:
    # the hourly table is read by the dates, the halo and the own-row branches: compute its three columns once
    base = materialize(traffic.traffic_series(events, with_play_count=False).select("series", "ts", "tpm")
                       .withColumn("date", F.to_date("ts")))
    days = reports.latest_dates(base, n_days)
    first = days.agg(F.min("date")).first()[0]
    # windows run over the latest days and the 5 hours before them of each series, not over all history
    before = Window.partitionBy("series").orderBy(F.col("ts").desc())
    halo = (base.filter(F.col("date") < F.lit(first)).withColumn("_n", F.row_number().over(before))
            .filter(F.col("_n") <= 5).drop("_n"))
    recent = base.filter(F.col("date") >= F.lit(first)).unionByName(halo)
    v = temporal.windowed(recent, "series", "ts",
                          lambda w: {"tpm_ma_6": temporal.rolling_mean(w, "tpm", 6)},
                          before=5)
    picked = reports.keep_dates(v, days)
    top_rows = reports.top_n_per_group(picked, "date",
                                       [F.col("tpm").desc(), F.col("ts"), F.col("series")], top)
    return top_rows.select(
        "date", timefn.day_name("date").alias("day_name"), "rank", "series",
        timefn.hour_minute_text("ts").alias("hour_minute"), "tpm", "tpm_ma_6",
        ((F.col("tpm") - F.col("tpm_ma_6")) / F.col("tpm_ma_6") * 100).alias("vs_rolling_mean_pct"))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return busiest_hours(table(spark, sf_dir, "events"))


FLAGSHIP_SQL = """
WITH v AS (
  SELECT CAST(user_id % 4 AS BIGINT) AS series, date_trunc('hour', ts) AS ts,
         count(*) / CAST(60.0 AS DOUBLE) AS tpm
  FROM events GROUP BY 1, 2
), v2 AS (
  SELECT *, avg(tpm) OVER (PARTITION BY series ORDER BY ts
                           ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS tpm_ma_6,
         CAST(ts AS DATE) AS date
  FROM v
), latest AS (SELECT DISTINCT date FROM v2 ORDER BY date DESC LIMIT 2),
r AS (
  SELECT v2.*, row_number() OVER (PARTITION BY date ORDER BY tpm DESC, ts, series) AS rank
  FROM v2 WHERE date IN (SELECT date FROM latest)
)
SELECT date, dayname(date) AS day_name, CAST(rank AS INTEGER) AS rank, series,
       strftime(ts, '%H:%M') AS hour_minute, tpm, tpm_ma_6,
       (tpm - tpm_ma_6) / tpm_ma_6 * 100 AS vs_rolling_mean_pct
FROM r WHERE rank <= 5
"""
