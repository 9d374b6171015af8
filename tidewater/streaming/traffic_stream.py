"""Structured Streaming forms of the traffic operators.

* X1 ``tumbling_tpm``: event-time tumbling windows with a watermark, append mode.
* X2 ``sliding_mean``: sliding windows (e.g. 30 minutes every 5 minutes).
* X3 ``keyed_lags``: per-series lags, rolling means and push proximity with typed
  state in RocksDB (the last 12 rows per series and the rows ahead of the
  watermark); event-time timers release rows in order and clear silent series.
* X4 ``score_batches``: ``foreachBatch`` transform-and-append with an
  idempotent per-batch output folder (a retried batch overwrites its own folder).

``events.ts`` is ``timestamp_ntz``; watermarks need ``timestamp``, so the
stream casts it with the session zone set to UTC.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidewater.operators.traffic import N_SERIES, PUSH_EVENT, PUSH_MIN_EVENTS

KEEP = 12  # deepest look-back: the 12-row mean
RETAIN_DAYS = 30.0  # a series silent for longer is forgotten


def with_event_time(events: DataFrame, ts: str = "ts") -> DataFrame:
    return events.withColumn("event_time", F.col(ts).cast("timestamp"))


def tumbling_tpm(events: DataFrame, period: str = "1 hour", minutes: float = 60.0,
                 watermark: str = "10 minutes", n_series: int = N_SERIES) -> DataFrame:
    """Streaming view V (without the running play count)."""
    e = with_event_time(events).withWatermark("event_time", watermark)
    return (e.groupBy(F.pmod(F.col("user_id"), F.lit(n_series)).alias("series"),
                      F.window("event_time", period).alias("w"))
            .agg(F.count(F.lit(1)).alias("call_count"), F.avg("value").alias("response_time"),
                 F.count_if(F.col("event_type") == PUSH_EVENT).alias("_push_n"))
            .select("series", F.col("w.start").cast("timestamp_ntz").alias("ts"), "call_count",
                    (F.col("call_count") / F.lit(minutes)).alias("tpm"), "response_time",
                    F.when(F.col("_push_n") >= PUSH_MIN_EVENTS, 1).otherwise(0).alias("is_push_notification")))


def sliding_mean(events: DataFrame, length: str = "30 minutes", slide: str = "5 minutes",
                 watermark: str = "10 minutes", n_series: int = N_SERIES) -> DataFrame:
    """Per series, mean value and event count over sliding windows."""
    e = with_event_time(events).withWatermark("event_time", watermark)
    return (e.groupBy(F.pmod(F.col("user_id"), F.lit(n_series)).alias("series"),
                      F.window("event_time", length, slide).alias("w"))
            .agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value"))
            .select("series", F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), "n", "mean_value"))


LAG_OUT_SCHEMA = ("series long, ts timestamp_ntz, tpm double, tpm_lag_1 double, tpm_lag_2 double, "
                  "tpm_lag_3 double, tpm_ma_6 double, tpm_ma_12 double, minutes_since_push int")
ROW_STATE = "at long, tpm double, push int"
STATE_CONF = {"spark.sql.streaming.stateStore.providerClass":
              "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def state_session(spark: SparkSession) -> SparkSession:
    """A session like the caller's whose streams keep their state in RocksDB; the caller's settings stay."""
    session = spark.newSession()
    for k in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        session.conf.set(k, spark.conf.get(k))
    for k, v in STATE_CONF.items():
        session.conf.set(k, v)
    return session


class SeriesFeatures(StatefulProcessor):
    """Rows of a series wait until the watermark passes them, then leave in time order with their features.

    ``waiting`` holds rows ahead of the watermark and ``history`` the last KEEP rows that left. An
    event-time timer at the earliest waiting row releases whatever the watermark has passed; one at
    ``retain_ms`` after the last row clears a silent series.
    """

    def __init__(self, retain_ms: int):
        self.retain_ms = retain_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", ROW_STATE)
        self.history = handle.getListState("history", ROW_STATE)
        self.expiry = handle.getValueState("expiry", "at_ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        earliest = None
        for part in rows:
            new = list(zip(part["at"].tolist(), part["tpm"].tolist(), part["push"].tolist(), strict=True))
            if new:
                self.waiting.appendList(new)
                earliest = min(min(r[0] for r in new), earliest if earliest is not None else new[0][0])
        if earliest is not None:
            self.handle.registerTimer(-(-earliest // 1000))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed_ms = timerValues.getCurrentWatermarkInMs()
        waiting = sorted(self.waiting.get()) if self.waiting.exists() else []
        history = list(self.history.get()) if self.history.exists() else []
        released = [r for r in waiting if r[0] <= passed_ms * 1000]
        if released:
            rest = waiting[len(released):]
            self.waiting.clear()
            if rest:
                self.waiting.put(rest)
                self.handle.registerTimer(-(-rest[0][0] // 1000))
            rows = history + released
            self.history.put(rows[-KEEP:])
            self._expire_after(rows[-1][0] // 1000)
            yield _features(key[0], rows, len(history))
        elif not waiting and history and history[-1][0] // 1000 + self.retain_ms <= passed_ms:
            self.history.clear()
            self.expiry.clear()

    def _expire_after(self, last_ms: int) -> None:
        if self.expiry.exists():
            self.handle.deleteTimer(self.expiry.get()[0])
        self.expiry.update((last_ms + self.retain_ms,))
        self.handle.registerTimer(last_ms + self.retain_ms)


def _features(series: int, rows: list[tuple], before: int) -> pd.DataFrame:
    """Features of the rows after the first ``before``, which only serve as their past."""
    at, tpm, push = (pd.Series(list(c)) for c in zip(*rows, strict=True))
    place = pd.Series(range(len(rows)), dtype="float64")
    last_push = place.where(push == 1).ffill(limit=8)  # the latest push within 9 rows
    out = pd.DataFrame({
        "series": series, "ts": pd.to_datetime(at, unit="us"), "tpm": tpm.astype("float64"),
        **{f"tpm_lag_{i}": tpm.astype("float64").shift(i) for i in (1, 2, 3)},
        "tpm_ma_6": tpm.rolling(6, min_periods=1).mean(), "tpm_ma_12": tpm.rolling(12, min_periods=1).mean(),
        "minutes_since_push": ((place - last_push) * 5).fillna(0).astype("int32")})
    return out.iloc[before:]


def keyed_lags(series_rows: DataFrame, watermark: str = "10 minutes",
               retain_days: float = RETAIN_DAYS) -> DataFrame:
    """Streaming lags, rolling means and push proximity per series, in event-time order.

    Input columns: series, ts, tpm, is_push_notification. Rows up to ``watermark`` out of order
    are put in order, later ones are dropped by the watermark, so the result equals the batch
    windows over the rows that were in time. A row leaves when the watermark passes it. A series
    silent for ``retain_days`` of event time is forgotten and starts anew.
    """
    rows = with_event_time(series_rows).withWatermark("event_time", watermark)
    rows = rows.select("series", "event_time", F.unix_micros("event_time").alias("at"), F.col("tpm").cast("double").alias("tpm"),
                       F.coalesce(F.col("is_push_notification"), F.lit(0)).cast("int").alias("push"))
    return rows.groupBy("series").transformWithStateInPandas(
        SeriesFeatures(int(retain_days * 86_400_000)), LAG_OUT_SCHEMA, "Append", "EventTime")


def score_batches(stream: DataFrame, model, out_path: str, checkpoint: str, keep=("series", "ts")):
    """Score each micro-batch with a fitted PipelineModel and write it (availableNow)."""
    def write(batch: DataFrame, batch_id: int):
        scored = model.transform(batch).select(*keep, "prediction")
        scored.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")
    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
