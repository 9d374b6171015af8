"""Forecaster and high-traffic classifier, composed from the operators.

Forecaster (reference: features -> one forest per horizon -> category-aware
scoring): 5-minute traffic per series, calendar/lag/rolling/change/push
features, positional targets 5/10/20/30 minutes ahead, weights from the
collection calendar, one ``RandomForestRegressor`` pipeline per horizon.

Classifier: hourly traffic, label = tpm >= exact 75th percentile, stratified
exact split, standardised features, several classifiers compared by AUC.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators import categories, metrics, models, periods, prep, temporal, traffic
from tidewater.session import checkpoint_dir, materialize

HORIZONS = (5, 10, 20, 30)

# Feature list of the forecaster (first existing alias wins, P3/P4).
FORECAST_FEATURES = [
    "tpm", "response_time", "hour", "minute", "day_of_week", "is_weekend",
    "hour_sin", "hour_cos", "minute_sin", "minute_cos",
    "tpm_lag_1", "tpm_lag_2", "tpm_lag_3", "tpm_lag_5",
    "tpm_ma_3", "tpm_ma_5", "tpm_std_3", "tpm_std_5",
    "tpm_change", "tpm_change_rate", "push_notification_active", "minutes_since_push",
]
# Order of the rows a forest is grown on: the features of few values from which most others follow.
FOREST_ORDER = ["tpm", "tpm_lag_1", "tpm_lag_2", "tpm_lag_3", "tpm_lag_5", "minutes_since_push",
                "hour", "minute", "day_of_week"]
# Classifier features (tpm_trend left out: with tpm_lag_1 it sums to the labelled value).
CLASSIFIER_FEATURES = [
    "hour", "minute", "day_of_week", "is_weekend", "time_of_day", "hour_sin", "hour_cos",
    "is_peak_hour", "tpm_lag_1", "tpm_lag_2", "tpm_lag_3", "tpm_ma_6", "tpm_ma_12",
    "play_counted_rate", "minutes_since_push", "is_post_push_period",
]


def forecast_table(events: DataFrame, period_seconds: int = 300, weeks_back: int = 12) -> DataFrame:
    """Training rows: features, target_{h}min and ml_weight (calendar weight, 1 outside periods)."""
    # several window branches read the series: aggregate the events once
    v = materialize(traffic.traffic_series(events, period_seconds, with_play_count=False))
    v = traffic.calendar_features(v)
    v = traffic.series_features(v, parity=False)
    gran = period_seconds / 60.0
    v = temporal.windowed(v, "series", "ts", lambda w: temporal.positional_targets(w, "tpm", HORIZONS, gran),
                          after=max(int(h / gran) for h in HORIZONS))
    v = (v.withColumn("push_notification_active", F.col("is_push_notification"))
         .withColumn("tpm_change", F.coalesce("tpm_change", F.lit(0.0))))
    earliest, latest = events.agg(F.min("ts"), F.max("ts")).first()
    anchors = events.sparkSession.range(1).select(F.lit(latest).cast("timestamp_ntz").alias("anchor_utc"))
    cal = periods.period_metadata(periods.weekend_periods(anchors, "anchor_utc", weeks_back,
                                                          periods.weeks_between(earliest, latest)))
    tagged = periods.tag_periods(v.select("series", "ts"), cal.select(
        "thursday", "week", "start_utc", "end_utc", "week_priority", "data_age_days"), "ts")
    w = tagged.join(cal.select("week", "ml_weight"), "week").select("series", "ts", "ml_weight")
    out = v.join(w, ["series", "ts"], "left").withColumn(
        "ml_weight", F.coalesce(F.col("ml_weight"), F.lit(1)).cast("double"))
    return prep.fill_zero(out, [c for c in FORECAST_FEATURES if c not in ("tpm", "response_time")])


def train_forecaster(table: DataFrame, features=FORECAST_FEATURES, horizons=HORIZONS,
                     n_trees: int = 200, use_weights: bool = True, test_fraction: float = 0.2):
    """M11 + M12: one forest per horizon on a hash split; returns (models, metric table)."""
    data = prep.hash_split(table.withColumn("_rid", F.concat_ws("|", "series", "ts")), "_rid", test_fraction)
    checkpoint_dir(table.sparkSession)
    # every horizon re-reads the table: cut the window lineage once (reliable checkpoint)
    data = models.forest_layout(data, "_rid", FOREST_ORDER).checkpoint(eager=True)
    memory_mb = models.tree_memory_mb(data)
    train, test = data.filter("is_test = 0"), data.filter("is_test = 1")

    def grown(h: int):
        est = models.forest_regressor(n_trees=n_trees, label=f"target_{h}min",
                                      weight="ml_weight" if use_weights else None, memory_mb=memory_mb)
        return models.fit_pipeline(train, features, est)

    fits = models.side_by_side(table.sparkSession, [partial(grown, h) for h in horizons], models.fits_at_once(data))
    fitted = dict(zip(horizons, fits, strict=True))

    def judged(h: int):  # a forest is made ready to be sent to the tasks here, on the driver
        return metrics.regression_metrics(fitted[h].transform(test), f"target_{h}min", "prediction") \
            .withColumn("horizon_minutes", F.lit(h))

    evals = models.side_by_side(table.sparkSession, [partial(judged, h) for h in horizons])
    return fitted, reduce(DataFrame.unionByName, evals)


def classifier_table(events: DataFrame) -> DataFrame:
    """Hourly traffic with the classifier features and the high-traffic label."""
    v = materialize(traffic.traffic_series(events))
    v = traffic.calendar_features(v)
    v = traffic.series_features(v, parity=True)
    v = temporal.windowed(v, "series", "ts", lambda w: {
        "play_counted_rate": temporal.relative_change(w, "play_counted", parity=False)}, before=1)
    lab = categories.high_label(v, "tpm", 75.0, "label")
    return prep.fill_zero(lab, CLASSIFIER_FEATURES).withColumn("label", F.col("label").cast("double"))


def train_classifiers(table: DataFrame, n_trees: int = 200, rounds: int = 150):
    """Stratified exact split, scaling fitted on train, LR / forest / boosting compared.

    Returns (metric table, {name: pipeline}, best name); the pipelines score raw rows.
    """
    t = prep.exact_split(table.withColumn("_rid", F.concat_ws("|", "series", "ts")), "_rid", 0.2,
                         strata=["label"])
    checkpoint_dir(table.sparkSession)
    t = t.checkpoint(eager=True)
    train, test = t.filter("is_test = 0"), t.filter("is_test = 1")
    n = train.count()
    est = {"logistic_regression": models.logistic_regression(n, C=1.0, max_iter=2000),
           "random_forest": models.random_forest(n_trees=n_trees, max_depth=12, min_instances=5),
           "gradient_boosting": models.gradient_boosting(max_iter=rounds)}
    return models.compare_classifiers(train, test, CLASSIFIER_FEATURES, est, scale=True)
