"""Goldens from the reference's recorded collection summary and hand-derived values."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidewater.operators import periods
from tidewater.plans import ingest
from tidewater.sources import files
from tidewater.sources.report import collection_summary
from tidewater.functions import scalar

# The recorded run (local GMT+7 clock) and its 25 feature names.
ANCHOR_UTC = "2025-08-05 08:59:26"  # 15:59:26 at GMT+7
FEATURES_25 = sorted("""hour_cos hour_sin max_response_time min_response_time minute_cos minute_sin
response_time response_time_change response_time_lag_1 response_time_lag_2 response_time_lag_3
response_time_lag_5 response_time_ma_3 response_time_ma_5 tpm tpm_change tpm_change_rate tpm_lag_1
tpm_lag_2 tpm_lag_3 tpm_lag_5 tpm_ma_3 tpm_ma_5 tpm_std_3 tpm_std_5""".split())


@pytest.fixture(scope="module")
def hourly_rows(spark):
    anchors = spark.createDataFrame([(ANCHOR_UTC,)], "a string").select(
        F.to_timestamp_ntz("a").alias("anchor_utc"))
    cal = periods.period_metadata(periods.weekend_periods(anchors, "anchor_utc", 12))
    # hourly timeslices inside each period, on local hour boundaries
    first = F.date_trunc("hour", F.col("start_utc") + F.expr("INTERVAL 59 MINUTES"))
    slices = cal.select("*", F.explode(F.sequence(first, F.col("end_utc") - F.expr("INTERVAL 1 HOUR"),
                                                  F.expr("INTERVAL 1 HOUR"))).alias("ts"))
    g = scalar.granularity_columns(F.col("requested_period"), F.lit(60.0))
    return slices.withColumn("interval_minutes", F.lit(60.0)).select("*", *[c.alias(n) for n, c in g.items()])


def test_r7_periods_and_rows(hourly_rows):
    assert hourly_rows.select("week").distinct().count() == 12
    assert hourly_rows.count() == 576
    r = hourly_rows.agg(F.min(F.col("ts") + F.expr("INTERVAL 7 HOURS")).alias("a"),
                        F.max(F.col("ts") + F.expr("INTERVAL 7 HOURS")).alias("b")).first()
    assert str(r["a"]) == "2025-05-16 00:00:00" and str(r["b"]) == "2025-08-02 23:00:00"


def test_s7_summary_matches_recorded_distribution(hourly_rows):
    rows = {(r["section"], r["key"]): r for r in collection_summary(hourly_rows).collect()}
    assert rows[("collection_strategy", "10_evenly_spaced_points")]["n"] == 528
    assert rows[("collection_strategy", "30min_granularity")]["n"] == 48
    assert rows[("granularity_category", "hourly")]["n"] == 576
    assert rows[("granularity_category", "hourly")]["avg_interval"] == 60.0
    assert rows[("data_quality", "high")]["n"] == 240
    assert rows[("data_quality", "medium")]["n"] == 144
    assert rows[("data_quality", "low")]["n"] == 192
    assert rows[("ml_weight", "4")]["n"] == 192
    for w in range(5, 13):
        assert rows[("ml_weight", str(w))]["n"] == 48
    assert round(rows[("collection_strategy", "10_evenly_spaced_points")]["pct"], 1) == 91.7


def test_p13_feature_names_of_collected_table(spark, tmp_path):
    from tidewater.plans import common
    path = str(tmp_path / "landed")
    files.nest_series_as_metrics_json(common.view_v(spark, SF_SMALL)).write.json(path)
    t = ingest.collected_table(files.read_metrics_json(spark, path))
    assert ingest.feature_columns(t.columns) == FEATURES_25
    n = t.count()
    seq = t.agg(F.min("sequence_id"), F.max("sequence_id"), F.countDistinct("sequence_id")).first()
    assert (seq[0], seq[1], seq[2]) == (0, n - 1, n)


def test_s3_bad_payloads_counted(spark, tmp_path):
    p = tmp_path / "docs.json"
    p.write_text("\n".join([
        '{"metric_data": {"metrics": [{"name": "a", "timeslices": [{"from": "2024-01-01T00:00:00+00:00",'
        ' "to": "2024-01-01T01:00:00+00:00", "values": {"calls_per_minute": 2.0}}]}]}}',
        '{"other": 1}',
        '{"metric_data": {"metrics": []}}',
        '{"metric_data": {"metrics": [{"name": "b", "timeslices": []}]}}',
        'not json']))
    raw = files.read_metrics_json(spark, str(p))
    flat = files.flatten_metrics(raw).collect()
    assert len(flat) == 1 and flat[0]["tpm"] == 2.0 and flat[0]["response_time"] == 0.0
    assert flat[0]["interval_minutes"] == 60.0
    bad = {r["reason"]: r["n"] for r in files.bad_payloads(raw).collect()}
    assert bad == {"no_metric_data": 1, "no_metrics": 1, "no_timeslices": 1, "corrupt": 1}


def test_s6_csv_round_trip(spark, tmp_path):
    from tidewater.sources.tables import table
    c = table(spark, SF_SMALL, "customer")
    path = str(tmp_path / "c.csv")
    files.write_csv(c, path)
    back = files.read_csv(spark, path, c.schema)
    assert back.exceptAll(c).count() == 0 and c.exceptAll(back).count() == 0


def test_f9_branches():
    import itertools
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    grid = [(float(h), a) for h, a in itertools.product([2, 5, 10, 20, 50, 100, 150, 400, 900, 1400, 2000], [3, 30])]
    df = spark.createDataFrame(grid, "h double, a int").select(
        "h", "a", scalar.granularity_strategy("h", "a").alias("s"))
    got = {(r["h"], r["a"]): (r["s"]["period_seconds"], r["s"]["expected_points"], r["s"]["ml_weight"],
                              r["s"]["collection_strategy"]) for r in df.collect()}
    assert got[(2, 3)] == (60, 120, 10, "1min_granularity")
    assert got[(50, 3)] == (1800, 100, 6, "30min_granularity")
    assert got[(100, 3)] == (3600, 100, 5, "1hour_granularity")
    assert got[(50, 30)] == (None, 10, 4, "10_evenly_spaced_points")
    assert got[(400, 30)] == (10800, 133, 2, "3hour_intervals")
    assert got[(2000, 30)] == (259200, 27, 1, "3day_intervals")


# Hours studied and scores of 25 students; country, age, salary of 10 customers.
STUDENTS = [(2.5, 21), (5.1, 47), (3.2, 27), (8.5, 75), (3.5, 30), (1.5, 20), (9.2, 88), (5.5, 60), (8.3, 81), (2.7, 25),
            (7.7, 85), (5.9, 62), (4.5, 41), (3.3, 42), (1.1, 17), (8.9, 95), (2.5, 30), (1.9, 24), (6.1, 67), (7.4, 69),
            (2.7, 30), (4.8, 54), (3.8, 35), (6.9, 76), (7.8, 86)]
CUSTOMERS = [("France", 44, 72000), ("Spain", 27, 48000), ("Germany", 30, 54000), ("Spain", 38, 61000), ("Germany", 40, None),
             ("France", 35, 58000), ("Spain", None, 52000), ("France", 48, 79000), ("Germany", 50, 83000), ("France", 37, 67000)]


def test_m1_m2_golden_line(spark):
    from tidewater.operators import models
    df = spark.createDataFrame([(h, float(s)) for h, s in STUDENTS], "hours double, score double")
    line = models.simple_linear_fit(df, "hours", "score").first()
    assert round(line["slope"], 5) == 9.77580 and round(line["intercept"], 5) == 2.48367
    terms = {r["term"]: round(r["coefficient"], 5) for r in models.normal_equations(df, ["hours"], "score").collect()}
    assert terms == {"hours": 9.77580, "intercept": 2.48367}


def test_n1_e1_golden_imputation_and_codes(spark):
    from pyspark.ml import Pipeline
    from tidewater.stages import LabelCodes, MeanImputer
    df = spark.createDataFrame(CUSTOMERS, "country string, age int, salary int")
    out = Pipeline(stages=[MeanImputer(inputCols=["age", "salary"], outputCols=["age_filled", "salary_filled"]),
                           LabelCodes(inputCol="country", outputCol="code")]).fit(df).transform(df).collect()
    assert {round(r["age_filled"], 3) for r in out if r["age"] is None} == {38.778}
    assert {round(r["salary_filled"], 2) for r in out if r["salary"] is None} == {63777.78}
    assert {r["country"]: r["code"] for r in out} == {"France": 0.0, "Germany": 1.0, "Spain": 2.0}
