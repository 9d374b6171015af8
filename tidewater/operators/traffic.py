"""Raw events -> per-period traffic series (A18, A19) and the feature table.

``traffic_series`` is the engine's central table: one row per (series, period)
with TPM, call count, response-time statistics, a cumulative play count and a
push flag. It is a plain hash aggregate with map-side partial aggregation, so
its cost is one scan plus one small shuffle whatever the event volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import scalar, timefn
from tidewater.operators import temporal

# Fixed values of the test view: 4 series, push = at least 2 signups in a period.
N_SERIES = 4
PUSH_EVENT = "signup"
PUSH_MIN_EVENTS = 2


def period_start(ts_col, seconds: int):
    """Start of the fixed period holding ``ts`` (epoch-aligned, naive)."""
    if seconds == 3600:
        return F.date_trunc("hour", F.col(ts_col))
    if seconds == 86400:
        return F.date_trunc("day", F.col(ts_col))
    return F.window(F.col(ts_col), f"{seconds} seconds").start


def traffic_series(events: DataFrame, period_seconds: int = 3600, n_series: int = N_SERIES,
                   with_play_count: bool = True) -> DataFrame:
    """A18 / view V: events -> (series, ts, call_count, tpm, response-time stats, push flag)."""
    minutes = period_seconds / 60.0
    agg = (events
           .select(F.pmod(F.col("user_id"), F.lit(n_series)).alias("series"),
                   period_start("ts", period_seconds).alias("ts"),
                   "value", "event_type")
           .groupBy("series", "ts")
           .agg(F.count(F.lit(1)).alias("call_count"),
                F.avg("value").alias("response_time"),
                F.min("value").alias("min_response_time"),
                F.max("value").alias("max_response_time"),
                F.stddev_samp("value").alias("standard_deviation"),
                F.count_if(F.col("event_type") == PUSH_EVENT).alias("_push_n"))
           .withColumn("tpm", F.col("call_count") / F.lit(minutes))
           .withColumn("is_push_notification",
                       F.when(F.col("_push_n") >= PUSH_MIN_EVENTS, 1).otherwise(0))
           .drop("_push_n"))
    if with_play_count:
        agg = temporal.cumulative_sum(agg, "series", "ts", "call_count", "play_counted")
    return agg


def downsample_by_age(events: DataFrame, anchor_col: str | None = None,
                      n_series: int = N_SERIES) -> DataFrame:
    """Recent days at fine periods, older days coarse.

    The period of a row comes from the granularity table (F9) applied to a
    48-hour window whose age is the row's age in days from the latest event.
    Rows are grouped on ``floor(epoch / period)``.
    """
    latest = events.agg(F.max("ts").alias("_latest"))
    e = events.crossJoin(F.broadcast(latest)) if anchor_col is None else events  # one-row side
    anchor = F.col("_latest") if anchor_col is None else F.col(anchor_col)
    age = F.datediff(F.to_date(anchor), F.to_date("ts"))
    strat = scalar.granularity_strategy(F.lit(48.0), age)
    # the historical first rule has no fixed period: 48 h / 10 points
    period = F.coalesce(strat["period_seconds"], F.lit(48 * 3600 // 10))
    epoch = F.unix_seconds(F.col("ts").cast("timestamp"))
    e = e.select(F.pmod("user_id", F.lit(n_series)).alias("series"),
                 period.alias("period_seconds"),
                 (F.floor(epoch / period) * period).alias("_start"), "value")
    return (e.groupBy("series", "period_seconds", "_start")
            .agg(F.count(F.lit(1)).alias("call_count"), F.avg("value").alias("response_time"))
            .withColumn("ts", F.timestamp_seconds("_start").cast("timestamp_ntz"))
            .withColumn("tpm", F.col("call_count") / (F.col("period_seconds") / F.lit(60.0)))
            .drop("_start"))


def calendar_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    """F3-F7 on one pass."""
    cal = timefn.calendar_columns(ts)
    hs, hc = timefn.cyclic(F.hour(ts), 24)
    ms, mc = timefn.cyclic(F.minute(ts), 60)
    return df.select("*",
                     *[c.alias(n) for n, c in cal.items()],
                     timefn.time_of_day(ts).alias("time_of_day"),
                     hs.alias("hour_sin"), hc.alias("hour_cos"),
                     ms.alias("minute_sin"), mc.alias("minute_cos"),
                     timefn.is_peak_hour(F.hour(ts)).alias("is_peak_hour"))


LAGS = (1, 2, 3, 5)
MEANS = {"tpm": (3, 5, 6, 12), "response_time": (3, 5)}
PUSH = ("minutes_since_push", "is_post_push_period")


def feature_depths() -> dict[str, int]:
    """Rows before its own that each series feature looks at."""
    values = ("tpm", "response_time")
    return ({f"{v}_lag_{i}": i for v in values for i in LAGS}
            | {f"{v}_ma_{s}": s - 1 for v in values for s in MEANS[v]} | {f"tpm_std_{s}": s - 1 for s in (3, 5)}
            | {"tpm_change": 1, "tpm_change_rate": 1, "response_time_change": 1} | dict.fromkeys(PUSH, 8))


def series_features(df: DataFrame, keys=("series",), ts: str = "ts",
                    parity: bool = True, bucket: str | None = "day", want: Sequence[str] | None = None) -> DataFrame:
    """The classifier's and forecaster's lag/rolling/change/push features on a series table.

    Lags 1,2,3,5 of tpm and response time; rolling mean 3, 5, 6, 12 of tpm,
    3, 5 of response time; rolling sample std 3, 5; diff and pct change;
    push proximity. ``want`` names those to add (default: all); the halo is as deep as the deepest of them.
    """
    depths = feature_depths()
    names = list(depths) if want is None else list(want)
    keys = list(keys)

    def build(w: Window):
        makers = {}
        for v, means in MEANS.items():
            makers |= {f"{v}_lag_{i}": lambda v=v, i=i: temporal.lag_columns(w, v, [i])[f"{v}_lag_{i}"] for i in LAGS}
            makers |= {f"{v}_ma_{s}": lambda v=v, s=s: temporal.rolling_mean(w, v, s) for s in means}
            makers[f"{v}_change"] = lambda v=v: temporal.first_difference(w, v)
        makers |= {f"tpm_std_{s}": lambda s=s: temporal.rolling_std(w, "tpm", s) for s in (3, 5)}
        makers["tpm_change_rate"] = lambda: temporal.relative_change(w, "tpm", parity=parity)
        makers |= {n: lambda n=n: temporal.push_proximity(w, "is_push_notification", parity=parity)[n] for n in PUSH}
        return {n: makers[n]() for n in names}

    return temporal.windowed(df, keys, [ts], build, before=max(depths[n] for n in names), ts=ts, bucket=bucket)
