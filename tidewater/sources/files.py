"""CSV and monitoring-JSON sources and sinks.

Reads always take a declared schema (no inference pass over the data), and
writes go to the caller's path -- on a cluster a shared folder, by default the
one named in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Schema of one landed monitoring response (metrics -> timeslices -> values map).
METRICS_JSON_SCHEMA = T.StructType([
    T.StructField("_metadata", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("metric_data", T.StructType([
        T.StructField("metrics", T.ArrayType(T.StructType([
            T.StructField("name", T.StringType(), True),
            T.StructField("timeslices", T.ArrayType(T.StructType([
                T.StructField("from", T.StringType(), True),
                T.StructField("to", T.StringType(), True),
                T.StructField("values", T.MapType(T.StringType(), T.DoubleType()), True),
            ])), True),
        ])), True),
    ]), True),
    T.StructField("_corrupt_record", T.StringType(), True),
])

# Value keys and their fallbacks, as the reference reads them.
VALUE_KEYS = {
    "tpm": ("requests_per_minute", "calls_per_minute"),
    "response_time": ("average_response_time", "average_call_time"),
    "call_count": ("call_count",),
    "min_response_time": ("min_response_time",),
    "max_response_time": ("max_response_time",),
    "standard_deviation": ("standard_deviation",),
    "total_call_time_per_minute": ("total_call_time_per_minute",),
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True) -> DataFrame:
    """CSV with header; pass ``schema`` in production (inference reads the data twice)."""
    from tidewater.operators.prep import nan_to_null
    r = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if schema is not None:
        return nan_to_null(r.schema(schema).csv(path))
    return nan_to_null(r.option("inferSchema", True).csv(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sink with a header row."""
    df.write.mode(mode).option("header", True).csv(path)


def value_with_fallback(values_map, keys, default: float = 0.0):
    """First present key of a map column, else ``default``."""
    return F.coalesce(*[values_map[k] for k in keys], F.lit(default))


def read_metrics_json(spark: SparkSession, path: str) -> DataFrame:
    """Raw landed responses (one JSON document per line), corrupt lines kept in ``_corrupt_record``."""
    return (spark.read.schema(METRICS_JSON_SCHEMA)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
            .json(path))


def flatten_metrics(raw: DataFrame) -> DataFrame:
    """S2 + S3 + S4 + S5: one row per timeslice with values, interval and request metadata.

    ``explode`` drops documents without metrics or timeslices (S3); metadata
    keys come from the document's ``_metadata`` map.
    """
    m = raw.filter(F.col("metric_data").isNotNull()).select(
        "_metadata", F.explode("metric_data.metrics").alias("m"))
    s = m.select("_metadata", F.col("m.name").alias("metric_name"), F.explode("m.timeslices").alias("t"))
    from_utc = F.to_timestamp(F.col("t.from")).cast("timestamp_ntz")
    to_utc = F.to_timestamp(F.col("t.to")).cast("timestamp_ntz")
    cols = {k: value_with_fallback(F.col("t.values"), keys) for k, keys in VALUE_KEYS.items()}
    out = s.select(
        "metric_name",
        from_utc.alias("timestamp_utc"), to_utc.alias("timestamp_to_utc"),
        (F.timestamp_diff("MICROSECOND", from_utc, to_utc) / F.lit(60_000_000.0)).alias("interval_minutes"),
        *[c.alias(k) for k, c in cols.items()],
        F.col("_metadata")["week_priority"].cast("int").alias("week_priority"),
        F.col("_metadata")["ml_weight"].cast("int").alias("ml_weight"),
        F.col("_metadata")["data_age_days"].cast("int").alias("data_age_days"),
        F.col("_metadata")["collection_strategy"].alias("collection_strategy"),
        F.col("_metadata")["requested_period"].cast("double").alias("requested_period"))
    return out


def bad_payloads(raw: DataFrame) -> DataFrame:
    """S3 side table: documents skipped (corrupt, no metric_data, no metrics or no timeslices)."""
    no_slices = F.coalesce(F.aggregate(F.col("metric_data.metrics"), F.lit(0),
                                       lambda acc, x: acc + F.coalesce(F.size(x["timeslices"]), F.lit(0))),
                           F.lit(0)) <= 0
    reason = (F.when(F.col("_corrupt_record").isNotNull(), "corrupt")
              .when(F.col("metric_data").isNull(), "no_metric_data")
              .when(F.coalesce(F.size("metric_data.metrics"), F.lit(0)) <= 0, "no_metrics")
              .when(no_slices, "no_timeslices"))
    return raw.select(reason.alias("reason")).filter(F.col("reason").isNotNull()) \
        .groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def nest_series_as_metrics_json(v: DataFrame, period_minutes: int = 60) -> DataFrame:
    """Inverse of ``flatten_metrics`` for a traffic series: one document per (series, day).

    Used to land test documents from tables; a day of one series is at most
    24 * 60 / period_minutes timeslices, so each collected array is bounded.
    """
    ts = F.col("ts")
    to = ts + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(period_minutes), F.lit(0))
    fmt = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
    slice_ = F.struct(F.date_format(ts, fmt).alias("from"), F.date_format(to, fmt).alias("to"),
                      F.create_map(F.lit("requests_per_minute"), F.col("tpm"),
                                   F.lit("average_response_time"), F.col("response_time"),
                                   F.lit("call_count"), F.col("call_count").cast("double"),
                                   F.lit("min_response_time"), F.col("min_response_time"),
                                   F.lit("max_response_time"), F.col("max_response_time")).alias("values"))
    per = (v.withColumn("_day", F.to_date("ts"))
           .groupBy("series", "_day")
           .agg(F.array_sort(F.collect_list(slice_),
                             lambda a, b: F.when(a["from"] < b["from"], -1)
                             .when(a["from"] > b["from"], 1).otherwise(0)).alias("timeslices")))
    return per.select(
        F.create_map(F.lit("collection_strategy"), F.lit("1hour_granularity"),
                     F.lit("requested_period"), F.lit(str(period_minutes * 60))).alias("_metadata"),
        F.struct(F.array(F.struct(F.concat(F.lit("series_"), F.col("series").cast("string")).alias("name"),
                                  F.col("timeslices").alias("timeslices"))).alias("metrics")).alias("metric_data"))
