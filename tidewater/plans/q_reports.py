"""Registered report, aggregation, top-k, join and set queries (A*, T*, J1, J2, U1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions import timefn
from tidewater.operators import categories, quantiles, reports, traffic
from tidewater.plans import common
from tidewater.plans.common import V_CTE
from tidewater.plans.registry import query
from tidewater.sources.tables import table


def _v_dated(spark, sf_dir, *more):
    v = common.view_v(spark, sf_dir, "series", "ts", "tpm", *more)
    return v.withColumn("date", F.to_date("ts")).withColumn("hour", F.hour("ts")) \
            .withColumn("day_of_week", timefn.day_of_week("ts"))


P3 = [0.0, 1 / 3, 2 / 3, 1.0]
P5 = [i / 5 for i in range(6)]

VC3_CTE = V_CTE + f""",
e3 AS (SELECT quantile_cont(tpm, {P3!r}) AS q FROM v),
vc AS (
  SELECT v.*, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
         CASE WHEN tpm >= q[1] AND tpm <= q[2] THEN 'low'
              WHEN tpm > q[2] AND tpm <= q[3] THEN 'medium'
              WHEN tpm > q[3] AND tpm <= q[4] THEN 'high' END AS tpm_category
  FROM v, e3
)"""


def v_categorised(spark, sf_dir, n=3):
    return categories.categorise(_v_dated(spark, sf_dir), "tpm", n)


@query("A1_hourly_summary", "WITH " + V_CTE + """ SELECT CAST(ts AS DATE) AS date,
       CAST(hour(ts) AS INTEGER) AS hour, round_even(avg(call_count), 0) AS tpm_mean,
       round_even(max(call_count), 0) AS tpm_max, round_even(min(call_count), 0) AS tpm_min,
       max(play_counted) AS play_counted_max FROM v GROUP BY 1, 2""",
       doubles="tpm_mean tpm_max tpm_min", dates="date")
def a1(spark, sf_dir):
    """On calls per hour, for calls per minute all round to zero here."""
    v = _v_dated(spark, sf_dir, "play_counted", "call_count")
    return reports.hourly_summary(v.withColumn("tpm", F.col("call_count").cast("double")))


@query("A2_frequency_percent", """SELECT o_orderpriority, count(*) AS n,
       count(*) * 100.0 / sum(count(*)) OVER () AS pct FROM orders GROUP BY 1""", doubles="pct")
def a2(spark, sf_dir):
    return reports.frequency_table(table(spark, sf_dir, "orders"), "o_orderpriority")


@query("A3_frequency_by_day", """SELECT CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
       dayname(ts) AS day_name, count(*) AS n FROM events GROUP BY 1, 2""")
def a3(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(timefn.day_of_week("ts").alias("day_of_week"),
                                              timefn.day_name("ts").alias("day_name"))
    return e.groupBy("day_of_week", "day_name").agg(F.count(F.lit(1)).alias("n")).orderBy("day_of_week")


@query("A4_global_profile", """SELECT min(l_extendedprice) AS min_value,
       max(l_extendedprice) AS max_value, avg(l_extendedprice) AS mean_value,
       count(l_extendedprice) AS n, min(l_shipdate) AS first_ts, max(l_shipdate) AS last_ts,
       date_diff('microsecond', min(l_shipdate), max(l_shipdate)) / 60000000.0 / 60.0 AS range_hours
       FROM lineitem""", doubles="min_value max_value mean_value range_hours",
       times="first_ts last_ts")
def a4(spark, sf_dir):
    return reports.global_profile(table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_shipdate")


@query("A5_daily_summary", "WITH " + V_CTE + """ SELECT CAST(ts AS DATE) AS date,
       count(*) AS records, max(tpm) AS tpm_max, min(tpm) AS tpm_min, avg(tpm) AS tpm_mean,
       min(play_counted) AS play_min, max(play_counted) AS play_max FROM v GROUP BY 1""",
       doubles="tpm_max tpm_min tpm_mean", dates="date")
def a5(spark, sf_dir):
    return reports.daily_summary(_v_dated(spark, sf_dir, "play_counted"))


@query("A6_category_interval", """SELECT l_returnflag, count(*) AS n,
       avg(date_diff('microsecond', o_orderdate, l_shipdate) / 60000000.0) AS avg_interval
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""", doubles="avg_interval")
def a6(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_shipdate")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    j = li.join(o, "l_orderkey").withColumn(
        "interval_minutes", timefn.minutes_between("o_orderdate", "l_shipdate"))
    return reports.category_interval_stats(j, "l_returnflag", "interval_minutes")


@query("A7_exact_quantile", """SELECT quantile_cont(l_extendedprice, 0.75) AS threshold,
       quantile_cont(l_quantity, 0.75) AS threshold_qty FROM lineitem""",
       doubles="threshold threshold_qty")
def a7(spark, sf_dir):
    return quantiles.quantile_columns(table(spark, sf_dir, "lineitem"),
                                      {"threshold": ("l_extendedprice", 0.75), "threshold_qty": ("l_quantity", 0.75)})


@query("A8_quantile_edges", f"""SELECT q[1] AS edge_0, q[2] AS edge_1, q[3] AS edge_2, q[4] AS edge_3,
       q[5] AS edge_4, q[6] AS edge_5
       FROM (SELECT quantile_cont(l_extendedprice, {P5!r}) AS q FROM lineitem)""",
       doubles="edge_0 edge_1 edge_2 edge_3 edge_4 edge_5")
def a8(spark, sf_dir):
    return categories.edges(table(spark, sf_dir, "lineitem"), "l_extendedprice", 5)


@query("A8_grouped_quantiles", """SELECT l_returnflag, quantile_cont(l_quantity, 0.5) AS median_qty,
       quantile_cont(l_extendedprice, 0.9) AS p90_price FROM lineitem GROUP BY 1""",
       doubles="median_qty p90_price")
def a8g(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return quantiles.quantile_columns(li, {"median_qty": ("l_quantity", 0.5), "p90_price": ("l_extendedprice", 0.9)},
                                      ["l_returnflag"])


@query("A9_high_label", "WITH " + V_CTE + """, t AS (SELECT quantile_cont(tpm, 0.75) AS threshold FROM v)
       SELECT series, ts, tpm, threshold,
              CAST(CASE WHEN tpm >= threshold THEN 1 ELSE 0 END AS INTEGER) AS is_high_tpm,
              avg(CASE WHEN tpm >= threshold THEN 1.0 ELSE 0.0 END) OVER () * 100 AS high_pct
       FROM v, t""", doubles="tpm threshold high_pct", times="ts")
def a9(spark, sf_dir):
    lab = categories.high_label(common.view_v(spark, sf_dir, "series", "ts", "tpm"))
    share = lab.agg((F.avg("is_high_tpm") * 100).alias("high_pct"))
    return lab.crossJoin(F.broadcast(share)).select(  # one-row side
       "series", "ts", "tpm", "threshold",
                                                    "is_high_tpm", "high_pct")


@query("A10_categories_n3", "WITH " + VC3_CTE + " SELECT series, ts, tpm, tpm_category FROM vc",
       doubles="tpm", times="ts")
def a10_3(spark, sf_dir):
    return v_categorised(spark, sf_dir, 3).select("series", "ts", "tpm", "tpm_category")


@query("A10_categories_n5", "WITH " + V_CTE + f""",
       e AS (SELECT quantile_cont(tpm, {P5!r}) AS q FROM v)
       SELECT series, ts, tpm,
         CASE WHEN tpm >= q[1] AND tpm <= q[2] THEN 'category_1'
              WHEN tpm > q[2] AND tpm <= q[3] THEN 'category_2'
              WHEN tpm > q[3] AND tpm <= q[4] THEN 'category_3'
              WHEN tpm > q[4] AND tpm <= q[5] THEN 'category_4'
              WHEN tpm > q[5] AND tpm <= q[6] THEN 'category_5' END AS tpm_category
       FROM v, e""", doubles="tpm", times="ts")
def a10_5(spark, sf_dir):
    return v_categorised(spark, sf_dir, 5).select("series", "ts", "tpm", "tpm_category")


@query("A11_category_stats", "WITH " + VC3_CTE + """ SELECT tpm_category, count(*) AS count,
       avg(tpm) AS mean_tpm, min(tpm) AS min_tpm, max(tpm) AS max_tpm,
       count(*) * 100.0 / sum(count(*)) OVER () AS percentage FROM vc GROUP BY 1""",
       doubles="mean_tpm min_tpm max_tpm percentage")
def a11(spark, sf_dir):
    return categories.category_stats(v_categorised(spark, sf_dir, 3))


@query("A12_pivot_hour", "WITH " + VC3_CTE + """ SELECT hour,
       count(*) FILTER (WHERE tpm_category = 'low') AS low,
       count(*) FILTER (WHERE tpm_category = 'medium') AS medium,
       count(*) FILTER (WHERE tpm_category = 'high') AS high FROM vc GROUP BY 1""")
def a12h(spark, sf_dir):
    return categories.category_pivot(v_categorised(spark, sf_dir, 3), "hour")


@query("A12_pivot_day", "WITH " + VC3_CTE + """ SELECT day_of_week,
       count(*) FILTER (WHERE tpm_category = 'low') AS low,
       count(*) FILTER (WHERE tpm_category = 'medium') AS medium,
       count(*) FILTER (WHERE tpm_category = 'high') AS high FROM vc GROUP BY 1""")
def a12d(spark, sf_dir):
    return categories.category_pivot(v_categorised(spark, sf_dir, 3), "day_of_week")


@query("A13_category_heatmap", "WITH " + VC3_CTE + """ SELECT tpm_category, hour, day_of_week,
       count(*) AS n, count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY tpm_category) AS pct
       FROM vc GROUP BY 1, 2, 3""", doubles="pct")
def a13(spark, sf_dir):
    return categories.category_heatmap(v_categorised(spark, sf_dir, 3))


@query("A14_distinct_dates", """SELECT DISTINCT CAST(ts AS DATE) AS date, dayname(ts) AS day_name
       FROM events""", dates="date")
def a14(spark, sf_dir):
    return reports.distinct_dates(table(spark, sf_dir, "events"))


@query("A15_count_distinct_filtered", """SELECT
       count(DISTINCT CASE WHEN event_type = 'purchase' THEN CAST(ts AS DATE) END) AS purchase_days,
       count(DISTINCT CASE WHEN isodow(ts) >= 6 THEN CAST(ts AS DATE) END) AS weekend_days
       FROM events""")
def a15(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.agg(
        F.count_distinct(F.when(F.col("event_type") == "purchase", F.to_date("ts"))).alias("purchase_days"),
        F.count_distinct(F.when(timefn.day_of_week("ts") >= 5, F.to_date("ts"))).alias("weekend_days"))


@query("A16_numeric_profile", """SELECT 'c_acctbal' AS "column", count(c_acctbal) AS count,
       avg(c_acctbal) AS mean, stddev_samp(c_acctbal) AS std, min(c_acctbal) AS min,
       quantile_cont(c_acctbal, 0.25) AS p25, quantile_cont(c_acctbal, 0.5) AS p50,
       quantile_cont(c_acctbal, 0.75) AS p75, max(c_acctbal) AS max FROM customer
       UNION ALL
       SELECT 'c_nationkey', count(c_nationkey), avg(c_nationkey), stddev_samp(c_nationkey),
       CAST(min(c_nationkey) AS DOUBLE), quantile_cont(c_nationkey, 0.25),
       quantile_cont(c_nationkey, 0.5), quantile_cont(c_nationkey, 0.75),
       CAST(max(c_nationkey) AS DOUBLE) FROM customer""",
       doubles="mean std min p25 p50 p75 max")
def a16(spark, sf_dir):
    return reports.numeric_profile(table(spark, sf_dir, "customer"), ["c_acctbal", "c_nationkey"])


@query("A17_null_counts", """SELECT count(*) AS n_rows, u.column, u.null_count FROM (
       SELECT 'doc_id' AS column, count(*) FILTER (WHERE d.doc_id IS NULL) AS null_count,
              0 AS k FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
       UNION ALL SELECT 'lang', count(*) FILTER (WHERE d.lang IS NULL), 1
              FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
       UNION ALL SELECT 'quality', count(*) FILTER (WHERE l.quality IS NULL), 2
              FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
       UNION ALL SELECT 'toxic', count(*) FILTER (WHERE l.toxic IS NULL), 3
              FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) u,
       documents d GROUP BY u.column, u.null_count""")
def a17(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return reports.null_counts(d.join(lab, "doc_id", "left"))


@query("A18_view_v_5min", """SELECT CAST(user_id % 4 AS BIGINT) AS series,
       time_bucket(INTERVAL '5 minutes', ts) AS ts, count(*) AS call_count,
       count(*) / CAST(5.0 AS DOUBLE) AS tpm, avg(value) AS response_time FROM events GROUP BY 1, 2""",
       doubles="tpm response_time", times="ts")
def a18_5(spark, sf_dir):
    return traffic.traffic_series(common.events(spark, sf_dir), 300, with_play_count=False).select(
        "series", "ts", "call_count", "tpm", "response_time")


@query("A19_age_downsample", """WITH m AS (SELECT max(ts) AS latest FROM events),
       e AS (SELECT CAST(user_id % 4 AS BIGINT) AS series, value,
             CASE WHEN date_diff('day', CAST(ts AS DATE), CAST(latest AS DATE)) <= 8
                  THEN 1800 ELSE 17280 END AS period_seconds, epoch(ts) AS sec FROM events, m)
       SELECT series, CAST(period_seconds AS INTEGER) AS period_seconds, count(*) AS call_count,
              avg(value) AS response_time,
              make_timestamp(CAST(floor(sec / period_seconds) * period_seconds AS BIGINT) * 1000000) AS ts,
              count(*) / (period_seconds / 60.0) AS tpm
       FROM e GROUP BY series, period_seconds, floor(sec / period_seconds)""",
       doubles="response_time tpm", times="ts")
def a19(spark, sf_dir):
    return traffic.downsample_by_age(common.events(spark, sf_dir))


@query("A20_count_if", """SELECT count(*) FILTER (WHERE event_type = 'signup') AS n_signup,
       count(*) FILTER (WHERE value > 25.0) AS n_high_value,
       count(*) FILTER (WHERE isodow(ts) >= 6) AS n_weekend FROM events""")
def a20(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.agg(F.count_if(F.col("event_type") == "signup").alias("n_signup"),
                 F.count_if(F.col("value") > 25.0).alias("n_high_value"),
                 F.count_if(timefn.day_of_week("ts") >= 5).alias("n_weekend"))


@query("T1_sort_by_time", "SELECT event_id, ts, user_id FROM events ORDER BY ts, event_id",
       times="ts")
def t1(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id").orderBy("ts", "event_id")


@query("T2_latest_dates", """SELECT DISTINCT CAST(ts AS DATE) AS date FROM events
       ORDER BY date DESC LIMIT 2""", dates="date")
def t2(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.to_date("ts").alias("date"))
    return reports.latest_dates(e, 2)


@query("T3_top5_per_day", "WITH " + V_CTE + """ SELECT * FROM (SELECT CAST(ts AS DATE) AS date,
       series, ts, tpm, CAST(row_number() OVER (PARTITION BY CAST(ts AS DATE)
       ORDER BY tpm DESC, ts, series) AS INTEGER) AS rank FROM v) WHERE rank <= 5""",
       doubles="tpm", times="ts", dates="date")
def t3(spark, sf_dir):
    v = _v_dated(spark, sf_dir)
    return reports.top_n_per_group(v, "date", [F.col("tpm").desc(), F.col("ts"), F.col("series")], 5) \
        .select("date", "series", "ts", "tpm", "rank")


PEAKS_SQL = """
ph AS (SELECT tpm_category, 'hour' AS kind, hour AS key, count(*) AS count,
       CAST(row_number() OVER (PARTITION BY tpm_category ORDER BY count(*) DESC, hour) AS INTEGER) AS rank
       FROM vc GROUP BY tpm_category, hour QUALIFY rank <= 3),
pdd AS (SELECT tpm_category, 'day' AS kind, day_of_week AS key, count(*) AS count,
       CAST(row_number() OVER (PARTITION BY tpm_category ORDER BY count(*) DESC, day_of_week) AS INTEGER) AS rank
       FROM vc GROUP BY tpm_category, day_of_week QUALIFY rank <= 2),
peaks AS (SELECT * FROM ph UNION ALL SELECT * FROM pdd)"""


@query("T4_peak_times", "WITH " + VC3_CTE + "," + PEAKS_SQL + " SELECT * FROM peaks")
def t4(spark, sf_dir):
    return categories.peak_times(v_categorised(spark, sf_dir, 3))


@query("J1_semi_join_latest", """SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) IN
       (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events ORDER BY d DESC LIMIT 2)""", times="ts")
def j1(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "ts", F.to_date("ts").alias("date"))
    return reports.keep_dates(e, reports.latest_dates(e, 2)).select("event_id", "ts")


@query("J2_peak_flags", "WITH " + VC3_CTE + "," + PEAKS_SQL + """
       SELECT series, ts, tpm_category,
         CAST(EXISTS (SELECT 1 FROM peaks p WHERE p.kind = 'hour' AND p.tpm_category = vc.tpm_category
                      AND p.key = vc.hour) AS INTEGER) AS is_peak_hour,
         CAST(EXISTS (SELECT 1 FROM peaks p WHERE p.kind = 'day' AND p.tpm_category = vc.tpm_category
                      AND p.key = vc.day_of_week) AS INTEGER) AS is_peak_day
       FROM vc""", times="ts")
def j2(spark, sf_dir):
    vc = v_categorised(spark, sf_dir, 3)
    return categories.peak_flags(vc, categories.peak_times(vc)).select(
        "series", "ts", "tpm_category", "is_peak_hour", "is_peak_day")


@query("U1_union_by_name", """SELECT s_suppkey, s_name, s_nationkey, s_acctbal,
       NULL::BIGINT AS c_custkey, NULL::VARCHAR AS c_name, NULL::INTEGER AS c_nationkey,
       NULL::DOUBLE AS c_acctbal, NULL::VARCHAR AS c_mktsegment FROM supplier
       UNION ALL SELECT NULL, NULL, NULL, NULL, c_custkey, c_name, c_nationkey, c_acctbal,
       c_mktsegment FROM customer""",
       doubles="s_acctbal c_acctbal s_suppkey s_nationkey c_custkey c_nationkey",
       note="integer keys compared as doubles: they are NULL on the other side's rows")
def u1(spark, sf_dir):
    u = table(spark, sf_dir, "supplier").unionByName(table(spark, sf_dir, "customer"),
                                                     allowMissingColumns=True)
    return u.select(*[F.col(c).cast("double").alias(c) if c.endswith("key") else F.col(c)
                      for c in u.columns])
