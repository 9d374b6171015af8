"""Registered source and sink queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import scalar
from tidewater.operators import periods
from tidewater.plans import common
from tidewater.plans.common import V_CTE
from tidewater.plans.q_functions import CAL_SQL, calendar
from tidewater.plans.registry import query
from tidewater.session import scratch_path
from tidewater.sources import files
from tidewater.sources.report import collection_summary
from tidewater.sources.tables import table

ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("o_orderpriority", T.StringType())])


@query("S1_csv_round_trip", """SELECT o_orderstatus, count(*) AS n, sum(o_totalprice) AS total_price,
       min(o_orderdate) AS first_date, max(o_orderdate) AS last_date FROM orders GROUP BY 1""",
       doubles="total_price", times="first_date last_date")
def s1(spark, sf_dir):
    path = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    files.write_csv(table(spark, sf_dir, "orders"), path)
    back = files.read_csv(spark, path, ORDERS_SCHEMA)
    return back.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total_price"),
        F.min("o_orderdate").alias("first_date"), F.max("o_orderdate").alias("last_date"))


@query("S2_metrics_json_unnest", "WITH " + V_CTE + """ SELECT 'series_' || series AS metric_name,
       ts AS timestamp_utc, ts + INTERVAL 1 HOUR AS timestamp_to_utc, 60.0 AS interval_minutes, tpm,
       response_time, CAST(call_count AS DOUBLE) AS call_count, min_response_time, max_response_time,
       0.0 AS standard_deviation, 0.0 AS total_call_time_per_minute,
       '1hour_granularity' AS collection_strategy, 3600.0 AS requested_period FROM v""",
       doubles="interval_minutes tpm response_time call_count min_response_time max_response_time "
               "standard_deviation total_call_time_per_minute requested_period",
       times="timestamp_utc timestamp_to_utc")
def s2(spark, sf_dir):
    path = scratch_path(spark, f"json-{uuid.uuid4().hex}")
    docs = files.nest_series_as_metrics_json(common.view_v(spark, sf_dir))
    docs.write.mode("overwrite").json(path)
    flat = files.flatten_metrics(files.read_metrics_json(spark, path))
    return flat.drop("week_priority", "ml_weight", "data_age_days")


@query("S4_value_fallback", """SELECT event_id,
       coalesce(TRY_CAST(json_extract_string(props, '$.requests_per_minute') AS DOUBLE),
                TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0) AS tpm,
       CASE WHEN event_id % 4 = 3 THEN 0.0 WHEN event_id % 4 = 2 THEN -value ELSE value END AS response_time
       FROM events""", doubles="tpm response_time")
def s4(spark, sf_dir):
    """Payloads with the first key, with the fallback alone, with both, and with neither."""
    e = table(spark, sf_dir, "events").select("event_id", "value", F.from_json("props", "map<string,double>").alias("m"))
    kind, first, other = F.col("event_id") % 4, F.lit("average_response_time"), F.lit("average_call_time")
    payload = (F.when(kind == 0, F.create_map(first, F.col("value"))).when(kind == 1, F.create_map(other, F.col("value")))
               .when(kind == 2, F.create_map(first, -F.col("value"), other, F.col("value")))
               .otherwise(F.create_map().cast("map<string,double>")))
    return e.select("event_id",
                    files.value_with_fallback(F.col("m"), ["requests_per_minute", "k"]).alias("tpm"),
                    files.value_with_fallback(payload, ["average_response_time", "average_call_time"]).alias("response_time"))


S7_SQL = "WITH " + V_CTE + "," + CAL_SQL + """,
rows AS (SELECT v.ts, c.week_priority, c.data_age_days, 60.0 AS interval_minutes,
         CASE WHEN c.data_age_days <= 8 THEN '30min_granularity' ELSE '10_evenly_spaced_points' END AS collection_strategy,
         CASE WHEN c.data_age_days <= 8 THEN 1800.0 ELSE 60.0 * 60 END AS per,
         greatest(c.week_priority, CASE WHEN c.data_age_days <= 8 THEN 6 ELSE 4 END) AS ml_weight
         FROM v JOIN cal c ON v.ts >= c.start_utc AND v.ts < c.end_utc),
r2 AS (SELECT *, CASE WHEN per <= 60 THEN 'minute' WHEN per <= 600 THEN 'multi_minute'
              WHEN per <= 3600 THEN 'hourly' ELSE 'multi_hour' END AS granularity_category,
              CASE WHEN ml_weight >= 8 THEN 'high' WHEN ml_weight >= 5 THEN 'medium' ELSE 'low' END AS data_quality
       FROM rows),
tot AS (SELECT count(*) AS t FROM r2)
SELECT 'collection_strategy' AS section, collection_strategy AS key, count(*) AS n,
       count(*) * 100.0 / max(t) AS pct, NULL::DOUBLE AS avg_interval FROM r2, tot GROUP BY 2
UNION ALL SELECT 'granularity_category', granularity_category, count(*), count(*) * 100.0 / max(t),
       avg(interval_minutes) FROM r2, tot GROUP BY 2
UNION ALL SELECT 'data_quality', data_quality, count(*), count(*) * 100.0 / max(t), NULL FROM r2, tot GROUP BY 2
UNION ALL SELECT 'ml_weight', CAST(ml_weight AS VARCHAR), count(*), count(*) * 100.0 / max(t), NULL
       FROM r2, tot GROUP BY 2
UNION ALL SELECT 'total', 'records', count(*), 100.0, NULL FROM r2"""


def tagged_traffic(spark, sf_dir):
    """Hourly series rows tagged with their weekend period and its collection metadata."""
    cal = periods.period_metadata(calendar(spark, sf_dir))
    v = common.view_v(spark, sf_dir, *[c for c in common.V_COLS.split() if c != "play_counted"])  # no section counts plays
    t = periods.tag_periods(v, cal.select("thursday", "week", "start_utc", "end_utc", "week_priority",
                                          "data_age_days"), "ts")
    t = t.join(cal.select("week", "requested_period", "collection_strategy", "ml_weight", "data_quality"),
               "week").withColumn("interval_minutes", F.lit(60.0))
    g = scalar.granularity_columns(F.col("requested_period"), F.col("interval_minutes"))
    return t.select("*", *[c.alias(n) for n, c in g.items()])


@query("S7_summary_report", S7_SQL, doubles="pct avg_interval")
def s7(spark, sf_dir):
    return collection_summary(tagged_traffic(spark, sf_dir))
