"""Registered projection, missing-value, encoding, scaling and split queries (P*, N*, E*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import prep
from tidewater.plans import common
from tidewater.plans.common import V_CTE, VF_CTE
from tidewater.plans.registry import query
from tidewater.sources.tables import table

HASH_SQL = "CAST(('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8)) AS UBIGINT) / 4294967296.0"
# lineitem has no single-column key: (orderkey, linenumber) repeats in the test data
LID_SQL = "concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


def lineitem_id():
    return F.concat_ws("|", *[F.col(c).cast("string") for c in
                              ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query("P1_select_by_position", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def p1(spark, sf_dir):
    return prep.select_by_position(table(spark, sf_dir, "supplier"), stop=-1)


@query("P2_drop_columns", "WITH " + V_CTE + """ SELECT * EXCLUDE (call_count, play_counted,
       is_push_notification) FROM v""",
       doubles="response_time min_response_time max_response_time standard_deviation tpm", times="ts")
def p2(spark, sf_dir):
    v = common.view_v(spark, sf_dir)
    return prep.drop_columns(v, ["call_count", "play_counted", "is_push_notification"])


ALIASES = {"key": ["id", "o_orderkey"], "tpm": ["tpm", "requests_per_minute", "o_totalprice"],
           "timestamp": ["timestamp", "ts", "o_orderdate"], "response_time": ["response_time", "avg_ms"],
           "priority": ["o_orderpriority"]}


@query("P3_alias_resolver", """SELECT o_orderkey AS key, o_totalprice AS tpm, o_orderdate AS timestamp,
       o_orderpriority AS priority FROM orders""", doubles="tpm", times="timestamp")
def p3(spark, sf_dir):
    return prep.resolve_aliases(table(spark, sf_dir, "orders"), ALIASES)


TRAIN_ORDER = ["hour", "day_of_week", "tpm_lag_1", "tpm_lag_2", "push_notification_active", "response_time"]


@query("P6_align_features", "WITH " + VF_CTE + """ SELECT series, ts, CAST(hour AS DOUBLE) AS hour,
       CAST(day_of_week AS DOUBLE) AS day_of_week, coalesce(tpm_lag_1, 0.0) AS tpm_lag_1,
       coalesce(tpm_lag_2, 0.0) AS tpm_lag_2, 0.0 AS push_notification_active,
       coalesce(response_time, 0.0) AS response_time FROM vff""",
       doubles="hour day_of_week tpm_lag_1 tpm_lag_2 push_notification_active response_time", times="ts")
def p6(spark, sf_dir):
    return prep.align_features(common.features_v(spark, sf_dir), TRAIN_ORDER, keep=["series", "ts"])


@query("P7_add_if_absent", "WITH " + V_CTE + """ SELECT series, ts, is_push_notification,
       0 AS push_notification_active, 999999 AS minutes_since_push FROM v""", times="ts")
def p7(spark, sf_dir):
    v = common.view_v(spark, sf_dir, "series", "ts", "is_push_notification")
    return prep.add_if_absent(v, {"push_notification_active": 0, "minutes_since_push": 999999,
                                  "is_push_notification": -1})


@query("P8_equality_filter", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'",
       doubles="value")
def p8(spark, sf_dir):
    return table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase").select(
        "event_id", "user_id", "value")


@query("P9_threshold_filter", "WITH " + V_CTE + " SELECT series, ts, tpm FROM v WHERE tpm > 0.1",
       doubles="tpm", times="ts")
def p9(spark, sf_dir):
    return common.view_v(spark, sf_dir, "series", "ts", "tpm").filter(F.col("tpm") > 0.1)


@query("P10_share_passing", """SELECT avg(CASE WHEN l_discount > 0.05 THEN 1.0 ELSE 0.0 END) * 100
       AS pct_passing, count(*) AS n_rows FROM lineitem""", doubles="pct_passing")
def p10(spark, sf_dir):
    return prep.share_passing(table(spark, sf_dir, "lineitem"), F.col("l_discount") > 0.05)


@query("P12_preview", "SELECT * FROM customer ORDER BY c_custkey LIMIT 5", doubles="c_acctbal")
def p12(spark, sf_dir):
    return prep.preview(table(spark, sf_dir, "customer"), "c_custkey", 5)


@query("N1_mean_imputer", """WITH h AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS v
       FROM events) SELECT event_id, coalesce(v, avg(v) OVER ()) AS value_imputed FROM h""",
       doubles="value_imputed")
def n1(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("v"))
    return prep.mean_impute(e, ["v"], suffix="_imp").select("event_id", F.col("v_imp").alias("value_imputed"))


LAGS = ["tpm_lag_1", "tpm_lag_2", "tpm_lag_3", "response_time_lag_1"]


@query("N2_fill_zero", "WITH " + VF_CTE + """ SELECT series, ts, coalesce(tpm_lag_1, 0) AS tpm_lag_1,
       coalesce(tpm_lag_2, 0) AS tpm_lag_2, coalesce(tpm_lag_3, 0) AS tpm_lag_3,
       coalesce(response_time_lag_1, 0) AS response_time_lag_1 FROM vff""",
       doubles=" ".join(LAGS), times="ts")
def n2(spark, sf_dir):
    return prep.fill_zero(common.window_features(spark, sf_dir, *LAGS), LAGS)


@query("N3_fill_mean", "WITH " + VF_CTE + """ SELECT series, ts,
       coalesce(tpm_lag_1, avg(tpm_lag_1) OVER ()) AS tpm_lag_1,
       coalesce(tpm_lag_2, avg(tpm_lag_2) OVER ()) AS tpm_lag_2,
       coalesce(tpm_lag_3, avg(tpm_lag_3) OVER ()) AS tpm_lag_3,
       coalesce(response_time_lag_1, avg(response_time_lag_1) OVER ()) AS response_time_lag_1 FROM vff""",
       doubles=" ".join(LAGS), times="ts")
def n3(spark, sf_dir):
    return prep.mean_impute(common.window_features(spark, sf_dir, *LAGS), LAGS)


@query("N4_fill_from_column", "WITH " + V_CTE + """ SELECT series, ts,
       coalesce(standard_deviation, response_time) AS standard_deviation FROM v""",
       doubles="standard_deviation", times="ts")
def n4(spark, sf_dir):
    v = common.view_v(spark, sf_dir, "series", "ts", "standard_deviation", "response_time")
    return prep.fill_from(v, "standard_deviation", "response_time").drop("response_time")


@query("E1_label_encode", """SELECT c_custkey, c_mktsegment,
       CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS DOUBLE) AS c_mktsegment_code FROM customer""",
       doubles="c_mktsegment_code")
def e1(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return prep.label_encode(c, "c_mktsegment")


def _onehot_sql(drop_first: bool) -> str:
    segs = SEGMENTS[1:] if drop_first else SEGMENTS
    cols = ", ".join(f"CASE WHEN c_mktsegment = '{s}' THEN 1.0 ELSE 0.0 END AS c_mktsegment_{s}" for s in segs)
    return f"SELECT {cols}, c_custkey, c_acctbal FROM customer"


def _onehot_doubles(drop_first: bool) -> str:
    segs = SEGMENTS[1:] if drop_first else SEGMENTS
    return " ".join(f"c_mktsegment_{s}" for s in segs) + " c_acctbal"


@query("E2_one_hot", _onehot_sql(False), doubles=_onehot_doubles(False))
def e2(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return prep.one_hot(c, "c_mktsegment")


@query("E3_drop_first_dummy", _onehot_sql(True), doubles=_onehot_doubles(True))
def e3(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return prep.one_hot(c, "c_mktsegment", drop_first=True)


def _li_split(spark, sf_dir, f=0.2):
    li = table(spark, sf_dir, "lineitem").select(
        lineitem_id().alias("rid"), "l_returnflag",
        "l_quantity", "l_extendedprice")
    return prep.hash_split(li, "rid", f)


LI_SPLIT_SQL = f"""li AS (SELECT {LID_SQL} AS rid, l_returnflag, l_quantity, l_extendedprice,
       CAST(CASE WHEN {HASH_SQL.format(k=LID_SQL)} < 0.2 THEN 1 ELSE 0 END AS INTEGER)
       AS is_test FROM lineitem)"""


@query("E4_standardise_train_stats", "WITH " + LI_SPLIT_SQL + """, s AS (SELECT avg(l_quantity) AS mq,
       stddev_pop(l_quantity) AS sq, avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp
       FROM li WHERE is_test = 0)
       SELECT rid, is_test, (l_quantity - mq) / CASE WHEN sq = 0 THEN 1 ELSE sq END AS z_l_quantity,
       (l_extendedprice - mp) / CASE WHEN sp = 0 THEN 1 ELSE sp END AS z_l_extendedprice FROM li, s""",
       doubles="z_l_quantity z_l_extendedprice")
def e4(spark, sf_dir):
    li = _li_split(spark, sf_dir)
    cols = ["l_quantity", "l_extendedprice"]
    stats = prep.fit_standardiser(li.filter(F.col("is_test") == 0), cols)
    return prep.apply_standardiser(li, stats, cols).select("rid", "is_test", "z_l_quantity", "z_l_extendedprice")


@query("E5_standardise_own_stats", "WITH " + LI_SPLIT_SQL + """, s AS (SELECT is_test, avg(l_quantity) AS mq,
       stddev_pop(l_quantity) AS sq, avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp
       FROM li GROUP BY is_test)
       SELECT rid, li.is_test, (l_quantity - mq) / CASE WHEN sq = 0 THEN 1 ELSE sq END AS z_l_quantity,
       (l_extendedprice - mp) / CASE WHEN sp = 0 THEN 1 ELSE sp END AS z_l_extendedprice
       FROM li JOIN s ON li.is_test = s.is_test""", doubles="z_l_quantity z_l_extendedprice")
def e5(spark, sf_dir):
    li = _li_split(spark, sf_dir)
    cols = ["l_quantity", "l_extendedprice"]
    stats = prep.fit_standardiser(li, cols, groups=["is_test"])
    return prep.apply_standardiser(li, stats, cols, groups=["is_test"]).select(
        "rid", "is_test", "z_l_quantity", "z_l_extendedprice")


@query("E6_hash_split", f"""SELECT o_orderkey, CAST(CASE WHEN {HASH_SQL.format(k='o_orderkey')} < 0.25
       THEN 1 ELSE 0 END AS INTEGER) AS is_test FROM orders""")
def e6(spark, sf_dir):
    return prep.hash_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 0.25)


@query("E6_exact_size_split", f"""SELECT o_orderkey, CAST(CASE WHEN row_number() OVER (ORDER BY
       {HASH_SQL.format(k='o_orderkey')}, o_orderkey) <= ceil(count(*) OVER () * 0.2) THEN 1 ELSE 0 END
       AS INTEGER) AS is_test FROM orders""")
def e6x(spark, sf_dir):
    return prep.exact_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 0.2)


@query("E7_stratified_split", f"""WITH li AS (SELECT {LID_SQL} AS rid, l_returnflag
       FROM lineitem)
       SELECT rid, l_returnflag, CAST(CASE WHEN row_number() OVER (PARTITION BY l_returnflag ORDER BY
       {HASH_SQL.format(k='rid')}, rid) <= ceil(count(*) OVER (PARTITION BY l_returnflag) * 0.25)
       THEN 1 ELSE 0 END AS INTEGER) AS is_test FROM li""")
def e7(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        lineitem_id().alias("rid"), "l_returnflag")
    return prep.exact_split(li, "rid", 0.25, strata=["l_returnflag"])
