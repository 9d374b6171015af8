"""Registered scalar-function queries (F1-F22, G1-G5) and the period calendar."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions import scalar, timefn
from tidewater.operators import categories, periods, temporal
from tidewater.plans import common
from tidewater.plans.common import V_CTE
from tidewater.plans.registry import query
from tidewater.sources.tables import table


def _ev(spark, sf_dir):
    return table(spark, sf_dir, "events")


@query("F1_parse_timestamp", """WITH t AS (SELECT o_orderkey,
         CASE WHEN o_orderkey % 97 = 0 THEN 'unknown'
              WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
              ELSE strftime(o_orderdate, '%d/%m/%Y %H:%M') END AS date_text FROM orders)
       SELECT o_orderkey, date_text, coalesce(try_strptime(date_text, '%Y-%m-%d %H:%M:%S'),
              try_strptime(date_text, '%d/%m/%Y %H:%M')) AS parsed FROM t""", times="parsed")
def f1(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    text = (F.when(F.pmod("o_orderkey", F.lit(97)) == 0, F.lit("unknown"))
            .when(F.pmod("o_orderkey", F.lit(2)) == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
            .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy HH:mm")))
    return o.select("o_orderkey", text.alias("date_text")).withColumn(
        "parsed", timefn.parse_timestamp("date_text"))


@query("F2_utc_to_local", """SELECT event_id, ts + INTERVAL 7 HOUR AS local_ts FROM events""",
       times="local_ts")
def f2(spark, sf_dir):
    return _ev(spark, sf_dir).select("event_id", timefn.utc_to_local("ts").alias("local_ts"))


@query("F3_calendar", """SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour,
       CAST(minute(ts) AS INTEGER) AS minute, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
       CAST(CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend FROM events""")
def f3(spark, sf_dir):
    return _ev(spark, sf_dir).select("event_id", *[c.alias(n) for n, c in timefn.calendar_columns("ts").items()])


@query("F4_date_text", """SELECT event_id, CAST(ts AS DATE) AS date, dayname(ts) AS day_name,
       strftime(ts, '%H:%M') AS hour_minute FROM events""", dates="date")
def f4(spark, sf_dir):
    return _ev(spark, sf_dir).select("event_id", F.to_date("ts").alias("date"),
                                     timefn.day_name("ts").alias("day_name"),
                                     timefn.hour_minute_text("ts").alias("hour_minute"))


@query("F5_time_of_day", "SELECT event_id, hour(ts) + minute(ts) / 60.0 AS time_of_day FROM events",
       doubles="time_of_day")
def f5(spark, sf_dir):
    return _ev(spark, sf_dir).select("event_id", timefn.time_of_day("ts").alias("time_of_day"))


@query("F6_cyclic", """SELECT event_id, sin(2 * pi() * hour(ts) / 24) AS hour_sin,
       cos(2 * pi() * hour(ts) / 24) AS hour_cos, sin(2 * pi() * minute(ts) / 60) AS minute_sin,
       cos(2 * pi() * minute(ts) / 60) AS minute_cos FROM events""",
       doubles="hour_sin hour_cos minute_sin minute_cos")
def f6(spark, sf_dir):
    hs, hc = timefn.cyclic(F.hour("ts"), 24)
    ms, mc = timefn.cyclic(F.minute("ts"), 60)
    return _ev(spark, sf_dir).select("event_id", hs.alias("hour_sin"), hc.alias("hour_cos"),
                                     ms.alias("minute_sin"), mc.alias("minute_cos"))


@query("F7_peak_hour", """SELECT event_id, CAST(CASE WHEN hour(ts) IN (0, 1, 9, 10, 12, 13, 19, 20)
       THEN 1 ELSE 0 END AS INTEGER) AS is_peak_hour FROM events""")
def f7(spark, sf_dir):
    return _ev(spark, sf_dir).select("event_id", timefn.is_peak_hour(F.hour("ts")).alias("is_peak_hour"))


@query("F8_interval_minutes", """SELECT l_orderkey, l_linenumber,
       date_diff('microsecond', o_orderdate, l_shipdate) / 60000000.0 AS interval_minutes
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""", doubles="interval_minutes")
def f8(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return li.join(o, "l_orderkey").select(
        "l_orderkey", "l_linenumber",
        timefn.minutes_between("o_orderdate", "l_shipdate").alias("interval_minutes"))


def order_spans(spark, sf_dir):
    """A collection span for every order: hours from its price, on three scales, and an age from its date.

    Together they meet all twelve branches of the decision table, both flags and every band.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    latest = o.agg(F.max("o_orderdate").alias("_latest"))
    price = F.col("o_totalprice")
    hours = (F.when(F.col("o_orderkey") % 3 == 0, price % 8.0).when(F.col("o_orderkey") % 3 == 1, price % 120.0)
             .otherwise(price % 2000.0))
    age = F.datediff(F.to_date("_latest"), F.to_date("o_orderdate")) % 91
    return o.crossJoin(F.broadcast(latest)).select(  # one-row side
        "o_orderkey", hours.alias("time_range_hours"), age.alias("data_age_days"),
        (F.lit(12) - F.floor(age / 7)).cast("int").alias("week_priority"))


SPANS_SQL = """
s AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN o_totalprice % 8.0::DOUBLE WHEN 1 THEN o_totalprice % 120.0::DOUBLE
             ELSE o_totalprice % 2000.0::DOUBLE END AS time_range_hours,
        CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST((SELECT max(o_orderdate) FROM orders) AS DATE)) % 91 AS INTEGER)
          AS data_age_days FROM orders),
g AS (SELECT *, CAST(12 - floor(data_age_days / 7) AS INTEGER) AS week_priority,
  CASE WHEN data_age_days <= 8 THEN
    CASE WHEN time_range_hours <= 3 THEN {'p': 60, 'n': CAST(trunc(time_range_hours * 60) AS INTEGER), 'w': 10, 's': '1min_granularity'}
         WHEN time_range_hours <= 6 THEN {'p': 120, 'n': CAST(trunc(time_range_hours * 30) AS INTEGER), 'w': 9, 's': '2min_granularity'}
         WHEN time_range_hours <= 14 THEN {'p': 300, 'n': CAST(trunc(time_range_hours * 12) AS INTEGER), 'w': 8, 's': '5min_granularity'}
         WHEN time_range_hours <= 24 THEN {'p': 600, 'n': CAST(trunc(time_range_hours * 6) AS INTEGER), 'w': 7, 's': '10min_granularity'}
         WHEN time_range_hours <= 96 THEN {'p': 1800, 'n': CAST(trunc(time_range_hours * 2) AS INTEGER), 'w': 6, 's': '30min_granularity'}
         ELSE {'p': 3600, 'n': CAST(trunc(time_range_hours) AS INTEGER), 'w': 5, 's': '1hour_granularity'} END
  ELSE
    CASE WHEN time_range_hours <= 96 THEN {'p': NULL, 'n': 10, 'w': 4, 's': '10_evenly_spaced_points'}
         WHEN time_range_hours <= 168 THEN {'p': 3600, 'n': CAST(trunc(time_range_hours) AS INTEGER), 'w': 3, 's': '1hour_intervals'}
         WHEN time_range_hours <= 504 THEN {'p': 10800, 'n': CAST(trunc(time_range_hours / 3) AS INTEGER), 'w': 2, 's': '3hour_intervals'}
         WHEN time_range_hours <= 1008 THEN {'p': 21600, 'n': CAST(trunc(time_range_hours / 6) AS INTEGER), 'w': 2, 's': '6hour_intervals'}
         WHEN time_range_hours <= 1512 THEN {'p': 43200, 'n': CAST(trunc(time_range_hours / 12) AS INTEGER), 'w': 1, 's': '12hour_intervals'}
         ELSE {'p': 259200, 'n': CAST(trunc(time_range_hours / 72) AS INTEGER), 'w': 1, 's': '3day_intervals'} END
  END AS st FROM s)"""


def _strategy(spark, sf_dir):
    s = order_spans(spark, sf_dir)
    st = scalar.granularity_strategy("time_range_hours", "data_age_days")
    return s.withColumn("_s", st)


@query("F9_granularity_strategy", "WITH " + SPANS_SQL + """ SELECT o_orderkey, time_range_hours,
       data_age_days, CAST(st.p AS INTEGER) AS period_seconds, CAST(st.n AS INTEGER) AS expected_points,
       CAST(st.w AS INTEGER) AS ml_weight, st.s AS collection_strategy FROM g""",
       doubles="time_range_hours period_seconds")
def f9(spark, sf_dir):
    out = _strategy(spark, sf_dir).select("o_orderkey", "time_range_hours", "data_age_days", "_s.*")
    return out.withColumn("period_seconds", F.col("period_seconds").cast("double"))


@query("F10_effective_weight", "WITH " + SPANS_SQL + """ SELECT o_orderkey,
       CAST(greatest(week_priority, st.w) AS INTEGER) AS effective_weight FROM g""")
def f10(spark, sf_dir):
    return _strategy(spark, sf_dir).select(
        "o_orderkey", scalar.effective_weight("week_priority", F.col("_s.ml_weight")).alias("effective_weight"))


@query("F11_quality_band", "WITH " + SPANS_SQL + """ SELECT o_orderkey,
       CASE WHEN greatest(week_priority, st.w) >= 8 THEN 'high'
            WHEN greatest(week_priority, st.w) >= 5 THEN 'medium' ELSE 'low' END AS data_quality FROM g""")
def f11(spark, sf_dir):
    return _strategy(spark, sf_dir).select(
        "o_orderkey", scalar.quality_band(scalar.effective_weight("week_priority", F.col("_s.ml_weight")))
        .alias("data_quality"))


@query("F12_recent_flag", "WITH " + SPANS_SQL + """ SELECT o_orderkey,
       CAST(CASE WHEN data_age_days <= 8 THEN 1 ELSE 0 END AS INTEGER) AS is_recent_data FROM g""")
def f12(spark, sf_dir):
    return _strategy(spark, sf_dir).select("o_orderkey", scalar.is_recent("data_age_days").alias("is_recent_data"))


@query("F13_granularity_columns", "WITH " + SPANS_SQL + """, h AS (SELECT o_orderkey,
       coalesce(CAST(st.p AS DOUBLE), time_range_hours * 60 / st.n * 60) AS per FROM g)
       SELECT o_orderkey, per / 60.0 AS granularity_minutes,
       CAST(CASE WHEN per <= 300 THEN 1 ELSE 0 END AS INTEGER) AS is_high_granularity,
       CAST(CASE WHEN per <= 120 THEN 1 ELSE 0 END AS INTEGER) AS is_fine_granularity,
       CASE WHEN per <= 60 THEN 'minute' WHEN per <= 600 THEN 'multi_minute'
            WHEN per <= 3600 THEN 'hourly' ELSE 'multi_hour' END AS granularity_category FROM h""",
       doubles="granularity_minutes")
def f13(spark, sf_dir):
    s = _strategy(spark, sf_dir)
    # observed interval between the service's points: span / points
    interval = F.try_divide(F.col("time_range_hours") * 60, F.col("_s.expected_points"))
    cols = scalar.granularity_columns(F.col("_s.period_seconds"), interval)
    return s.select("o_orderkey", *[c.alias(n) for n, c in cols.items()])


@query("F14_non_negative", "SELECT c_custkey, greatest(0.0, c_acctbal) AS acctbal_clamped FROM customer",
       doubles="acctbal_clamped")
def f14(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", scalar.non_negative("c_acctbal").alias("acctbal_clamped"))


@query("F15_label_from_probability", """SELECT l_orderkey, l_linenumber, l_discount * 10 AS probability,
       CASE WHEN l_discount * 10 > 0.7 THEN 'High' ELSE 'Normal' END AS label FROM lineitem""",
       doubles="probability")
def f15(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber",
                                                 (F.col("l_discount") * 10).alias("probability"))
    return li.withColumn("label", scalar.label_from_probability("probability"))


@query("F16_percent_difference", """WITH u AS (SELECT l_partkey, avg(l_extendedprice / l_quantity)
       AS avg_unit_price FROM lineitem GROUP BY 1)
       SELECT p_partkey, p_retailprice, avg_unit_price,
       CASE WHEN p_retailprice <> 0 THEN (avg_unit_price - p_retailprice) / p_retailprice * 100.0 END
         AS pct_difference FROM part JOIN u ON p_partkey = l_partkey""",
       doubles="p_retailprice avg_unit_price pct_difference")
def f16(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    unit = li.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("avg_unit_price"))
    p = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return p.join(unit, "p_partkey").withColumn(
        "pct_difference", scalar.percent_difference("p_retailprice", "avg_unit_price"))


@query("F17_half_even", """SELECT l_orderkey, l_linenumber, round_even(l_quantity / 2, 0) AS half_qty,
       round_even(l_extendedprice, -2) AS price_hundreds FROM lineitem""",
       doubles="half_qty price_hundreds")
def f17(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     scalar.round_half_even(F.col("l_quantity") / 2, 0).alias("half_qty"),
                     scalar.round_half_even("l_extendedprice", -2).alias("price_hundreds"))


LISTS_SQL = V_CTE + """,
lst AS (SELECT series, ts, tpm, list_reverse(list(tpm) OVER (PARTITION BY series ORDER BY ts
        ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)) AS prev FROM v)"""


def _prev_lists(spark, sf_dir):
    v = common.view_v(spark, sf_dir, "series", "ts", "tpm")
    return temporal.windowed(v, "series", "ts", lambda w: {
        "prev": F.reverse(F.collect_list("tpm").over(w.rowsBetween(-5, -1)))}, before=5)


@query("F18_lags_from_list", "WITH " + LISTS_SQL + """ SELECT series, ts,
       coalesce(prev[1], tpm) AS tpm_lag_1, coalesce(prev[2], tpm) AS tpm_lag_2,
       coalesce(prev[3], tpm) AS tpm_lag_3, coalesce(prev[4], tpm) AS tpm_lag_4,
       coalesce(prev[5], tpm) AS tpm_lag_5 FROM lst""",
       doubles="tpm_lag_1 tpm_lag_2 tpm_lag_3 tpm_lag_4 tpm_lag_5", times="ts")
def f18(spark, sf_dir):
    p = _prev_lists(spark, sf_dir)
    return p.select("series", "ts", *[c.alias(n) for n, c in scalar.lags_from_list("prev", "tpm").items()])


@query("F19_mean_of_first", "WITH " + LISTS_SQL + """ SELECT series, ts,
       list_avg(list_slice(prev, 1, 3)) AS recent_mean_3 FROM lst""", doubles="recent_mean_3", times="ts")
def f19(spark, sf_dir):
    return _prev_lists(spark, sf_dir).select("series", "ts", scalar.mean_of_first("prev", 3).alias("recent_mean_3"))


@query("F20_post_push_flag", "WITH " + V_CTE + """, x AS (SELECT series, ts,
       date_diff('minute', last_value(CASE WHEN is_push_notification = 1 THEN ts END IGNORE NULLS)
         OVER (PARTITION BY series ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), ts) AS m
       FROM v)
       SELECT series, ts, CAST(CASE WHEN m <= 45 THEN 1 ELSE 0 END AS INTEGER) AS is_post_push FROM x""",
       times="ts")
def f20(spark, sf_dir):
    v = common.view_v(spark, sf_dir, "series", "ts", "is_push_notification")
    v = v.withColumn("_lp", F.when(F.col("is_push_notification") == 1, F.col("ts")))
    v = temporal.forward_fill(v, "series", "ts", ["_lp"])
    return v.select("series", "ts", scalar.post_push_flag(timefn.minutes_between("_lp", "ts")).alias("is_post_push"))


F21_SQL = """, fl AS (SELECT series, ts, tpm_category,
         CAST(EXISTS (SELECT 1 FROM peaks p WHERE p.kind = 'hour' AND p.tpm_category = vc.tpm_category
                      AND p.key = vc.hour) AS INTEGER) AS is_peak_hour,
         CAST(EXISTS (SELECT 1 FROM peaks p WHERE p.kind = 'day' AND p.tpm_category = vc.tpm_category
                      AND p.key = vc.day_of_week) AS INTEGER) AS is_peak_day, tpm
       FROM vc)"""
ADJ_SQL = common.adjustment_oracle("tpm_category", "is_peak_hour", "is_peak_day")


def _f21_sql():
    from tidewater.plans.q_reports import PEAKS_SQL, VC3_CTE
    return ("WITH " + VC3_CTE + "," + PEAKS_SQL + F21_SQL + " SELECT series, ts, tpm_category, is_peak_hour, "
            "is_peak_day, " + ADJ_SQL + " AS adjustment_factor FROM fl")


@query("F21_category_adjustment", _f21_sql(), doubles="adjustment_factor", times="ts")
def f21(spark, sf_dir):
    from tidewater.plans.q_reports import v_categorised
    vc = v_categorised(spark, sf_dir, 3)
    flagged = categories.peak_flags(vc, categories.peak_times(vc))
    return flagged.select("series", "ts", "tpm_category", "is_peak_hour", "is_peak_day",
                          scalar.category_adjustment("tpm_category", "is_peak_hour", "is_peak_day")
                          .alias("adjustment_factor"))


@query("G1_weekly_window", """SELECT event_id, CAST(CASE WHEN (isodow(ts) - 1) * 24 + hour(ts) >= 2 * 24 + 23
       AND (isodow(ts) - 1) * 24 + hour(ts) < 6 * 24 + 1 THEN 1 ELSE 0 END AS INTEGER) AS in_window
       FROM events""")
def g1(spark, sf_dir):
    return _ev(spark, sf_dir).select(
        "event_id", F.when(timefn.in_weekly_window("ts"), 1).otherwise(0).alias("in_window"))


@query("G2_week_and_age", """SELECT event_id, CAST(weekofyear(ts) AS INTEGER) AS week_of_year,
       CAST(date_diff('day', CAST(ts AS DATE), CAST((SELECT max(ts) FROM events) AS DATE)) AS INTEGER)
         AS age_days FROM events""")
def g2(spark, sf_dir):
    e = _ev(spark, sf_dir)
    latest = e.agg(F.to_date(F.max("ts")).alias("_latest"))
    return e.crossJoin(F.broadcast(latest)).select(  # one-row side
        "event_id", timefn.week_of_year("ts").alias("week_of_year"),
        F.datediff("_latest", F.to_date("ts")).alias("age_days"))


@query("G3_rolling_mean_10", "WITH " + V_CTE + """ SELECT series, ts, avg(tpm) OVER (PARTITION BY series
       ORDER BY ts ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS tpm_ma_10 FROM v""",
       doubles="tpm_ma_10", times="ts")
def g3(spark, sf_dir):
    v = common.view_v(spark, sf_dir, "series", "ts", "tpm")
    return temporal.windowed(v, "series", "ts", lambda w: {"tpm_ma_10": temporal.rolling_mean(w, "tpm", 10)},
                             before=9).select("series", "ts", "tpm_ma_10")


@query("G4_minutes_since_daily_push", """SELECT event_id,
       date_diff('microsecond', date_trunc('day', ts) + INTERVAL 11 HOUR, ts) / 1000000.0 AS seconds_since_push,
       CAST(CASE WHEN ts >= date_trunc('day', ts) + INTERVAL 11 HOUR
                 AND ts < date_trunc('day', ts) + INTERVAL 11 HOUR + INTERVAL 10 MINUTE THEN 1 ELSE 0 END
            AS INTEGER) AS in_push_window FROM events""", doubles="seconds_since_push",
       note="reported in seconds: minutes carry a 7th decimal that rounds differently by engine")
def g4(spark, sf_dir):
    m = timefn.minutes_since_daily_time("ts", 11, 0)
    return _ev(spark, sf_dir).select("event_id", (m * 60.0).alias("seconds_since_push"),
                                     F.when((m >= 0) & (m < 10), 1).otherwise(0).alias("in_push_window"))


@query("G5_push_boost", "WITH " + V_CTE + """ SELECT series, ts,
       tpm * CASE WHEN is_push_notification = 1 THEN 1.2 ELSE 1.0 END AS boosted_5min,
       tpm * CASE WHEN is_push_notification = 1 THEN 1.4 ELSE 1.0 END AS boosted_10min,
       tpm * CASE WHEN is_push_notification = 1 THEN 1.5 ELSE 1.0 END AS boosted_15min,
       tpm * CASE WHEN is_push_notification = 1 THEN 1.3 ELSE 1.0 END AS boosted_30min FROM v""",
       doubles="boosted_5min boosted_10min boosted_15min boosted_30min", times="ts")
def g5(spark, sf_dir):
    v = common.view_v(spark, sf_dir)
    out = v.select("series", "ts", "tpm", "is_push_notification")
    for h in (5, 10, 15, 30):
        out = out.withColumn(f"boosted_{h}min", F.col("tpm") * F.when(
            F.col("is_push_notification") == 1, scalar.push_boost(F.lit(h))).otherwise(1.0))
    return out.drop("tpm", "is_push_notification")


CAL_SQL = """
a AS (SELECT max(ts) AS anchor_utc FROM events),
wk AS (SELECT a.anchor_utc, w.range AS week,
        CAST(a.anchor_utc + INTERVAL 7 HOUR AS DATE) - CAST(7 * w.range AS INTEGER) AS target
       FROM a, range(0, 12) w),
th AS (SELECT *, target - CAST(((isodow(target) - 1 - 3) % 7 + 7) % 7 AS INTEGER) AS thursday FROM wk),
cal AS (SELECT week, thursday,
        CAST(thursday AS TIMESTAMP) + INTERVAL 23 HOUR + INTERVAL 50 MINUTE - INTERVAL 7 HOUR AS start_utc,
        CAST(thursday + 3 AS TIMESTAMP) - INTERVAL 7 HOUR AS end_utc,
        CAST(12 - week AS INTEGER) AS week_priority,
        CAST(floor(date_diff('second', CAST(thursday AS TIMESTAMP) + INTERVAL 23 HOUR + INTERVAL 50 MINUTE
             - INTERVAL 7 HOUR, anchor_utc) / 86400) AS INTEGER) AS data_age_days
       FROM th WHERE CAST(thursday AS TIMESTAMP) + INTERVAL 23 HOUR + INTERVAL 50 MINUTE - INTERVAL 7 HOUR
                     <= anchor_utc)"""


def calendar(spark, sf_dir):
    """Weekend periods back from the latest event (the anchor is a scalar barrier).

    12, as the reference has them, or as many more as the table's earliest event needs.
    """
    anchor, earliest = _ev(spark, sf_dir).agg(F.max("ts"), F.min("ts")).first()
    anchors = spark.range(1).select(F.lit(anchor).cast("timestamp_ntz").alias("anchor_utc"))
    return periods.weekend_periods(anchors, "anchor_utc", 12, periods.weeks_between(earliest, anchor))


@query("R7_weekend_calendar", "WITH " + CAL_SQL + """ SELECT CAST(week AS INTEGER) AS week, thursday,
       start_utc, end_utc, week_priority, data_age_days FROM cal""",
       times="start_utc end_utc", dates="thursday")
def r7(spark, sf_dir):
    return calendar(spark, sf_dir).where("week < 12").select(
        "week", "thursday", "start_utc", "end_utc", "week_priority", "data_age_days")


@query("J3_range_join_periods", "WITH " + CAL_SQL + """ SELECT CAST(c.week AS INTEGER) AS week,
       count(*) AS n_events, avg(e.value) AS mean_value FROM events e JOIN cal c
       ON e.ts >= c.start_utc AND e.ts < c.end_utc GROUP BY c.week""", doubles="mean_value")
def j3(spark, sf_dir):
    tagged = periods.tag_periods(_ev(spark, sf_dir), calendar(spark, sf_dir), "ts")
    return tagged.groupBy("week").agg(F.count(F.lit(1)).alias("n_events"), F.avg("value").alias("mean_value"))


@query("S5_period_metadata", "WITH " + CAL_SQL + """, md AS (SELECT *,
         date_diff('microsecond', start_utc, end_utc) / 3600000000.0 AS hours FROM cal),
       st AS (SELECT *, CASE WHEN data_age_days <= 8 THEN 6 ELSE 4 END AS w0,
              CASE WHEN data_age_days <= 8 THEN '30min_granularity' ELSE '10_evenly_spaced_points' END AS strat
              FROM md)
       SELECT CAST(week AS INTEGER) AS week, strat AS collection_strategy,
         CAST(greatest(week_priority, w0) AS INTEGER) AS ml_weight,
         CASE WHEN greatest(week_priority, w0) >= 8 THEN 'high' WHEN greatest(week_priority, w0) >= 5
              THEN 'medium' ELSE 'low' END AS data_quality,
         CAST(CASE WHEN data_age_days <= 8 THEN 1 ELSE 0 END AS INTEGER) AS is_recent_data,
         count(e.event_id) AS n_events
       FROM st LEFT JOIN events e ON e.ts >= st.start_utc AND e.ts < st.end_utc
       GROUP BY ALL""")
def s5(spark, sf_dir):
    cal = periods.period_metadata(calendar(spark, sf_dir))
    tagged = periods.tag_periods(_ev(spark, sf_dir).select("event_id", "ts"), cal.select("thursday", "week", "start_utc", "end_utc", "week_priority", "data_age_days"), "ts")
    counts = tagged.groupBy("week").agg(F.count(F.lit(1)).alias("n_events"))
    return (cal.join(counts, "week", "left").fillna(0, subset=["n_events"])
            .select("week", "collection_strategy", "ml_weight", "data_quality", "is_recent_data", "n_events"))
