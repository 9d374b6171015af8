"""Ingest: landed monitoring JSON -> the collected traffic table.

raw documents -> explode metrics x timeslices (S2-S4) -> UTC and GMT+7 times
(F2) -> calendar (F3, F4) -> collection metadata (F10-F13) -> cyclic time
(F6) -> lags / rolling / change per (metric, weekend period) (W1-W6, K14)
-> NULL -> 0 (N2) -> global sequence number (W12).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import scalar, timefn
from tidewater.operators import periods, prep, temporal
from tidewater.sources import files

# Name parts that mark a feature column in the collection summary.
FEATURE_NAME_PARTS = ("tpm", "response_time", "lag", "ma", "change", "sin", "cos")


def collected_table(raw: DataFrame) -> DataFrame:
    flat = files.flatten_metrics(raw)
    t = (flat.withColumn("timestamp", timefn.utc_to_local("timestamp_utc"))
         .withColumn("timestamp_to", timefn.utc_to_local("timestamp_to_utc")))
    for n, c in timefn.calendar_columns("timestamp").items():
        t = t.withColumn(n, c)
    t = t.withColumn("day_name", timefn.day_name("timestamp"))
    t = (t.withColumn("ml_weight", F.coalesce(F.col("ml_weight"), F.lit(1)))
         .withColumn("week_priority", F.coalesce(F.col("week_priority"), F.lit(1)))
         .withColumn("data_age_days", F.coalesce(F.col("data_age_days"), F.lit(0)))
         .withColumn("collection_strategy", F.coalesce(F.col("collection_strategy"), F.lit("unknown")))
         .withColumn("data_quality", scalar.quality_band("ml_weight"))
         .withColumn("is_recent_data", scalar.is_recent("data_age_days")))
    for n, c in scalar.granularity_columns(F.col("requested_period"), F.col("interval_minutes")).items():
        t = t.withColumn(n, c)
    hs, hc = timefn.cyclic(F.col("hour"), 24)
    ms, mc = timefn.cyclic(F.col("minute"), 60)
    t = (t.withColumn("hour_sin", hs).withColumn("hour_cos", hc)
         .withColumn("minute_sin", ms).withColumn("minute_cos", mc)
         .withColumn("_period", periods.period_thursday("timestamp_utc"))
         .drop("requested_period"))

    def build(w: Window):
        cols = {}
        cols.update(temporal.lag_columns(w, "tpm", [1, 2, 3, 5]))
        cols.update(temporal.lag_columns(w, "response_time", [1, 2, 3, 5]))
        for s in (3, 5):
            cols[f"tpm_ma_{s}"] = temporal.rolling_mean(w, "tpm", s)
            cols[f"response_time_ma_{s}"] = temporal.rolling_mean(w, "response_time", s)
            cols[f"tpm_std_{s}"] = temporal.rolling_std(w, "tpm", s, fill=None)
        cols["tpm_change"] = temporal.first_difference(w, "tpm")
        cols["tpm_change_rate"] = temporal.relative_change(w, "tpm", parity=True)
        cols["response_time_change"] = temporal.first_difference(w, "response_time")
        return cols

    t = temporal.windowed(t, ["metric_name", "_period"], ["timestamp_utc"], build, before=5)
    numeric = [f.name for f in t.schema.fields if f.dataType.typeName() in ("double", "integer", "long")]
    t = prep.fill_zero(t, numeric)
    return temporal.sequence_number(t.drop("_period"), ["timestamp_utc", "metric_name"], "sequence_id")


def feature_columns(columns) -> list[str]:
    """summary's feature list (names containing a feature part), sorted."""
    return prep.columns_matching(columns, FEATURE_NAME_PARTS)
