"""Registered model, scoring and persistence queries (P-rows: rows-only checks).

Model results are not SQL-expressible (and MLlib trees are not expected to
equal scikit-learn's), so these entries carry no oracle; pytest holds their
property checks. Hyperparameters are the reference's.
"""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tidewater.operators import metrics, models, prep, scoring, temporal
from tidewater.plans import common, forecast, ingest
from tidewater.plans.q_prep import HASH_SQL, LID_SQL, lineitem_id
from tidewater.plans.registry import query
from tidewater.session import materialize, scratch_path
from tidewater.sources import files, model_store
from tidewater.sources.tables import table, table_path
from tidewater.stages import CategoryThresholds, DecisionLabel, HighLabel, LabelCodes, MeanImputer, TrainScaler


def labelled_documents(spark, sf_dir):
    """Small labelled table (like the walkthroughs' 400-row dataset): text size -> quality."""
    d = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.log1p("n_chars").alias("log_chars"),
        F.log1p(F.size(F.split(F.col("text"), r"\s+"))).alias("log_words"))
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    t = d.join(lab, "doc_id")
    cols = ["log_chars", "log_words"]
    t = prep.hash_split(t, "doc_id", 0.25)
    stats = prep.fit_standardiser(t.filter("is_test = 0"), cols)
    return materialize(prep.apply_standardiser(t, stats, cols)), ["z_log_chars", "z_log_words"]


def _fit_eval(spark, sf_dir, est, name):
    t, cols = labelled_documents(spark, sf_dir)
    pm = models.fit_pipeline(t.filter("is_test = 0"), cols, est)
    pred = pm.transform(t.filter("is_test = 1"))
    acc = metrics.accuracy(pred, "label", "prediction")
    return acc.withColumn("model", F.lit(name))


@query("M3_logistic_default")
def m3(spark, sf_dir):
    t, _ = labelled_documents(spark, sf_dir)
    return _fit_eval(spark, sf_dir, models.logistic_regression(t.filter("is_test = 0").count(), C=1.0), "logistic")


@query("M4_logistic_2000_iterations")
def m4(spark, sf_dir):
    t, _ = labelled_documents(spark, sf_dir)
    n = t.filter("is_test = 0").count()
    return _fit_eval(spark, sf_dir, models.logistic_regression(n, C=1.0, max_iter=2000), "logistic_2000")


@query("M6_linear_svm")
def m6(spark, sf_dir):
    t, _ = labelled_documents(spark, sf_dir)
    return _fit_eval(spark, sf_dir, models.linear_svm(t.filter("is_test = 0").count()), "linear_svm")


@query("M7_decision_tree_entropy")
def m7(spark, sf_dir):
    return _fit_eval(spark, sf_dir, models.decision_tree(), "decision_tree")


@query("M8_random_forest_10")
def m8(spark, sf_dir):
    return _fit_eval(spark, sf_dir, models.random_forest(n_trees=10), "random_forest_10")


@query("G8_naive_bayes")
def g8(spark, sf_dir):
    # gaussian NB takes any real features
    return _fit_eval(spark, sf_dir, models.naive_bayes_gaussian(), "naive_bayes")


BAYES_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _bayes_sql():
    """Gaussian likelihoods from the train rows' moments, each class's written out."""
    moments = ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in BAYES_FEATURES)
    largest = ", ".join(f"var_pop({c})" for c in BAYES_FEATURES)
    logs = " + ".join(f"-0.5 * (ln(2 * pi() * (v_{c} + eps)) + (li.{c} - m_{c}) ^ 2 / (v_{c} + eps))" for c in BAYES_FEATURES)
    return f"""WITH li AS (SELECT {LID_SQL} AS rid, l_returnflag, {', '.join(BAYES_FEATURES)},
           {HASH_SQL.format(k=LID_SQL)} < 0.2 AS test FROM lineitem),
      e AS (SELECT 1e-9 * greatest({largest}) AS eps FROM li WHERE NOT test),
      k AS (SELECT l_returnflag AS class, count(*) AS n, {moments} FROM li WHERE NOT test GROUP BY 1),
      s AS (SELECT rid, l_returnflag, class, ln(n / (SELECT sum(n) FROM k)) + {logs} AS score FROM li, k, e WHERE test),
      p AS (SELECT rid, l_returnflag, arg_max(class, score) AS predicted FROM s GROUP BY rid, l_returnflag)
      SELECT l_returnflag, predicted, count(*) AS n FROM p GROUP BY 1, 2"""


@query("G8_gaussian_moments", _bayes_sql())
def g8_moments(spark, sf_dir):
    """Naive Bayes in closed form: moments of each class from train rows, test rows by the largest likelihood.

    Rows that share their identifier and class are one, judged by the likeliest of them.
    """
    li = table(spark, sf_dir, "lineitem").select(lineitem_id().alias("rid"), "l_returnflag", *BAYES_FEATURES)
    li = materialize(prep.hash_split(li, "rid", 0.2))
    state = models.gaussian_moments(li.filter("is_test = 0"), "l_returnflag", BAYES_FEATURES)
    judged = li.filter("is_test = 1").select("rid", "l_returnflag", models.gaussian_class(state, BAYES_FEATURES).alias("class"),
                                             models.gaussian_score(state, BAYES_FEATURES).alias("score"))
    judged = judged.groupBy("rid", "l_returnflag").agg(F.max_by("class", "score").alias("predicted"))
    return judged.groupBy("l_returnflag", "predicted").agg(F.count(F.lit(1)).alias("n"))


@query("G10_kernel_svm_rff")
def g10(spark, sf_dir):
    t, cols = labelled_documents(spark, sf_dir)
    r = models.random_fourier_features(t, cols, 64, gamma=1.0)
    rcols = [f"rff_{i}" for i in range(64)]
    n = r.filter("is_test = 0").count()
    pm = models.fit_pipeline(r.filter("is_test = 0"), rcols, models.linear_svm(n))
    return metrics.accuracy(pm.transform(r.filter("is_test = 1")), "label", "prediction")


@query("G12_neural_classifier")
def g12(spark, sf_dir):
    return _fit_eval(spark, sf_dir, models.mlp([2, 8, 2]), "mlp")


@query("G11_cross_validation")
def g11(spark, sf_dir):
    t, cols = labelled_documents(spark, sf_dir)
    train = t.filter("is_test = 0")
    cv = models.cross_validate(train, cols, models.logistic_regression(train.count()),
                               {"regParam": [0.001, 0.01, 0.1]}, BinaryClassificationEvaluator(), folds=3)
    return spark.createDataFrame([(float(r), float(m)) for r, m in zip([0.001, 0.01, 0.1], cv.avgMetrics)],
                                 "reg_param double, mean_auc double")


# With a dummy for each segment the slope is that of deviations from the segment's means, and
# each segment has an intercept of its own; a dummy's coefficient is its distance from the first one's.
SEGMENT_FIT_SQL = """WITH g AS (SELECT c_mktsegment AS s, avg(c_nationkey) AS mx, avg(c_acctbal) AS my FROM customer GROUP BY 1),
  b AS (SELECT sum((c_nationkey - mx) * (c_acctbal - my)) / sum((c_nationkey - mx) ^ 2) AS slope
        FROM customer JOIN g ON s = c_mktsegment),
  i AS (SELECT s, my - slope * mx AS level FROM g, b),
  f AS (SELECT level AS base FROM i ORDER BY s LIMIT 1)
  SELECT 'c_mktsegment_' || s AS term, level - base AS coefficient FROM i, f WHERE s > (SELECT min(s) FROM i)
  UNION ALL SELECT 'c_nationkey', slope FROM b UNION ALL SELECT 'intercept', base FROM f"""


def _account_features(spark, sf_dir):
    c = materialize(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal"))
    oh = prep.one_hot(c, "c_mktsegment", drop_first=True)
    return oh, [x for x in oh.columns if x.startswith("c_mktsegment_")] + ["c_nationkey"]


@query("M2_multiple_linear_regression", SEGMENT_FIT_SQL, doubles="coefficient")
def m2(spark, sf_dir):
    oh, feats = _account_features(spark, sf_dir)
    pm = models.fit_pipeline(oh, feats, models.linear_regression(label="c_acctbal"))
    lr = pm.stages[-1]
    rows = [(n, float(v)) for n, v in zip(feats, lr.coefficients.toArray())] + [("intercept", float(lr.intercept))]
    return spark.createDataFrame(rows, "term string, coefficient double")


@query("M2_normal_equations", SEGMENT_FIT_SQL, doubles="coefficient")
def m2_normal(spark, sf_dir):
    oh, feats = _account_features(spark, sf_dir)
    return models.normal_equations(oh, feats, "c_acctbal")


@query("E8_assemble_features", "WITH " + common.VF_CTE + """ SELECT series, ts, unnest([0, 1, 2, 3, 4, 5]) AS pos,
  unnest([tpm, coalesce(tpm_lag_1, 0), coalesce(tpm_lag_2, 0), coalesce(tpm_lag_3, 0), hour_sin, hour_cos]) AS value
  FROM vff""", doubles="value", times="ts")
def e8(spark, sf_dir):
    f = prep.fill_zero(common.features_v(spark, sf_dir), ["tpm_lag_1", "tpm_lag_2", "tpm_lag_3"])
    a = prep.assemble(f, ["tpm", "tpm_lag_1", "tpm_lag_2", "tpm_lag_3", "hour_sin", "hour_cos"])
    return a.select("series", "ts", F.posexplode(vector_to_array("features")).alias("pos", "value"))


@query("G7_kmeans_embeddings")
def g7(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", array_to_vector("embedding").alias("features"))
    return models.kmeans(8).fit(e).transform(e).groupBy("prediction").agg(F.count(F.lit(1)).alias("n"))


@query("G9_hierarchical_embeddings")
def g9(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", array_to_vector("embedding").alias("features"))
    return models.hierarchical(8).fit(e).transform(e).groupBy("prediction").agg(F.count(F.lit(1)).alias("n"))


N_TREES, ROUNDS = 200, 150


def _classifier(spark, sf_dir):
    """Compared classifiers, trained once per input (fit-or-load).

    Beside the metrics, the feature list and the label's threshold are kept with the pipelines.
    """
    def train():
        tab = forecast.classifier_table(table(spark, sf_dir, "events"))
        metric_table, fitted, _ = forecast.train_classifiers(tab, N_TREES, ROUNDS)
        best = metric_table.orderBy(F.col("roc_auc").desc(), F.col("model")).first()["model"]
        # one object: threshold of "high", feature list, scaler, model and decision
        high = HighLabel(inputCol="tpm", outputCol="is_high_tpm").fit(tab)
        bundle = PipelineModel(stages=[high, *fitted[best].stages, DecisionLabel(threshold=0.7)])
        return fitted | {"bundle": bundle}, {"metrics": metric_table}
    fitted, tables = model_store.fit_or_load(
        spark, "classifiers", [table_path(sf_dir, "events")],
        f"stages=2 trees={N_TREES} rounds={ROUNDS} features={','.join(forecast.CLASSIFIER_FEATURES)}", train)
    mt = tables["metrics"]
    best = mt.orderBy(F.col("roc_auc").desc(), F.col("model")).first()["model"]
    return mt, fitted, best


@query("M13_compare_classifiers")
def m13(spark, sf_dir):
    metric_table, _, _ = _classifier(spark, sf_dir)
    return metric_table


@query("T6_best_model")
def t6(spark, sf_dir):
    metric_table, _, _ = _classifier(spark, sf_dir)
    return metric_table.orderBy(F.col("roc_auc").desc(), F.col("model")).limit(1)


@query("M9_random_forest_200")
def m9(spark, sf_dir):
    tab = forecast.classifier_table(table(spark, sf_dir, "events"))
    t = materialize(prep.hash_split(tab.withColumn("_rid", F.concat_ws("|", "series", "ts")), "_rid", 0.2))
    pm = models.fit_pipeline(t.filter("is_test = 0"), forecast.CLASSIFIER_FEATURES,
                             models.random_forest(n_trees=200, max_depth=12, min_instances=5))
    return metrics.accuracy(pm.transform(t.filter("is_test = 1")), "label", "prediction")


@query("M10_gradient_boosting")
def m10(spark, sf_dir):
    tab = forecast.classifier_table(table(spark, sf_dir, "events"))
    t = materialize(prep.hash_split(tab.withColumn("_rid", F.concat_ws("|", "series", "ts")), "_rid", 0.2))
    pm = models.fit_pipeline(t.filter("is_test = 0"), forecast.CLASSIFIER_FEATURES, models.gradient_boosting())
    return metrics.accuracy(pm.transform(t.filter("is_test = 1")), "label", "prediction")


def _forecaster(spark, sf_dir, use_weights=True):
    """One forest per horizon, trained once per input (fit-or-load, S8)."""
    ft = materialize(forecast.forecast_table(table(spark, sf_dir, "events")))

    def train():
        fitted, evals = forecast.train_forecaster(ft, use_weights=use_weights)
        return {f"h{h}": m for h, m in fitted.items()}, {"metrics": evals}
    fitted, tables = model_store.fit_or_load(spark, "forecaster", [table_path(sf_dir, "events")],
                                             f"weights={use_weights} horizons={forecast.HORIZONS} "
                                             f"features={','.join(forecast.FORECAST_FEATURES)}", train)
    return ft, {int(k[1:]): m for k, m in fitted.items()}, tables["metrics"]


@query("M11_forecaster_per_horizon")
def m11(spark, sf_dir):
    return _forecaster(spark, sf_dir)[2]


@query("M12_sample_weights")
def m12(spark, sf_dir):
    ft, w, _ = _forecaster(spark, sf_dir, use_weights=True)
    _, u, _ = _forecaster(spark, sf_dir, use_weights=False)
    weighted = w[5].transform(ft).withColumnRenamed("prediction", "weighted").drop("features")
    return u[5].transform(weighted).select("series", "ts", "weighted", F.col("prediction").alias("unweighted"))


@query("M14_feature_importances")
def m14(spark, sf_dir):
    _, fitted, _ = _forecaster(spark, sf_dir)
    return models.feature_importances(fitted[5], forecast.FORECAST_FEATURES, spark)


@query("T5_top10_features")
def t5(spark, sf_dir):
    _, fitted, _ = _forecaster(spark, sf_dir)
    return models.feature_importances(fitted[5], forecast.FORECAST_FEATURES, spark).limit(10)


@query("G6_best_regressor_per_horizon")
def g6(spark, sf_dir):
    ft = materialize(forecast.forecast_table(table(spark, sf_dir, "events")))
    data = prep.hash_split(ft.withColumn("_rid", F.concat_ws("|", "series", "ts")), "_rid", 0.2)
    data = models.forest_layout(data, "_rid", forecast.FOREST_ORDER).checkpoint(eager=True)
    tab, _ = models.best_regressor_per_horizon(data.filter("is_test = 0"), data.filter("is_test = 1"),
                                               forecast.FORECAST_FEATURES, forecast.HORIZONS)
    return tab


def scenario_table(spark, sf_dir):
    """R2 input from data: each series' latest hour as the current situation, with and without a push."""
    f = temporal.windowed(common.features_v(spark, sf_dir), "series", "ts",
                          lambda w: {"tpm_lag_4": F.lag("tpm", 4).over(w)}, before=4)
    latest = f.groupBy("series").agg(F.max("ts").alias("ts"))
    cur = f.join(latest, ["series", "ts"]).select(
        "series", F.col("tpm").alias("current_tpm"), "hour", "day_of_week", "response_time",
        F.array(*[F.coalesce(F.col(f"tpm_lag_{i}"), F.col("tpm")) for i in range(1, 6)]).alias("previous_tpm_values"))
    push = F.explode(F.array(F.struct(F.lit("no_push").alias("scenario"), F.lit(0).alias("push_notification_active"),
                                      F.lit(999999).alias("minutes_since_push")),
                             F.struct(F.lit("push").alias("scenario"), F.lit(1).alias("push_notification_active"),
                                      F.lit(5).alias("minutes_since_push"))))
    return cur.select("*", push.alias("_s")).select("*", "_s.*").drop("_s")


def _scored_scenarios(spark, sf_dir, sweep=False):
    _, fitted, _ = _forecaster(spark, sf_dir)
    scen = scenario_table(spark, sf_dir)
    if sweep:
        scen = scoring.hour_sweep(scen)
    return scoring.forecast(fitted, scoring.scenario_features(scen, forecast.FORECAST_FEATURES))


@query("R2_score_scenarios")
def r2(spark, sf_dir):
    return _scored_scenarios(spark, sf_dir).select("series", "scenario", "pred_5", "pred_10", "pred_20", "pred_30")


@query("R5_hour_sweep")
def r5(spark, sf_dir):
    return _scored_scenarios(spark, sf_dir, sweep=True).select("series", "scenario", "hour", "pred_5", "pred_10",
                                                               "pred_20", "pred_30")


@query("R6_scenario_uplift")
def r6(spark, sf_dir):
    return scoring.scenario_uplift(_scored_scenarios(spark, sf_dir), "scenario", "no_push", "push", ["series"])


@query("R1_score_saved_model")
def r1(spark, sf_dir):
    _, fitted, _ = _classifier(spark, sf_dir)
    tab = forecast.classifier_table(table(spark, sf_dir, "events"))
    out = _reloaded(spark, fitted["bundle"]).transform(tab)  # S8: scales by the statistics it was trained with
    out = out.select("ts", "label", "prediction", "probability_high")  # P11: timestamp, prediction, probability, actual
    return out.filter(F.col("probability_high") > 0.7)        # P9


def _reloaded(spark, model):
    """The model as another session finds it."""
    path = scratch_path(spark, f"model-{uuid.uuid4().hex}")
    model.write().overwrite().save(path)
    return PipelineModel.read().session(spark.newSession()).load(path)


def situation_table(spark, sf_dir):
    """Classifier situations from data: each series' latest hour and the hours before it, without and with a push."""
    return scenario_table(spark, sf_dir).select(
        "series", "scenario", "current_tpm", "hour", F.lit(0).alias("minute"), "day_of_week", "previous_tpm_values",
        F.col("push_notification_active").alias("is_push_notification"))


@query("R2_classify_situations")
def r2_classify(spark, sf_dir):
    """Situations scored by the saved classifier: its threshold, the class, the probability, High or Normal."""
    _, fitted, _ = _classifier(spark, sf_dir)
    scored = _reloaded(spark, fitted["bundle"]).transform(scoring.situation_features(situation_table(spark, sf_dir)))
    return scored.select("series", "scenario", "hour", "current_tpm", "predicted_high", "probability_high", "tpm_threshold",
                         "recommendation")


# The train rows' mean, codes, statistics and quantiles, worked out on every row.
@query("S8_fitted_stages", f"""WITH t AS (SELECT event_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS v,
         {HASH_SQL.format(k='event_id')} < 0.2 AS test FROM events),
  m AS (SELECT avg(v) AS m FROM t WHERE NOT test), i AS (SELECT event_id, event_type, coalesce(v, m) AS x, test FROM t, m),
  s AS (SELECT avg(x) AS mu, stddev_pop(x) AS sd, quantile_cont(x, [0.25, 0.5, 0.75]) AS q FROM i WHERE NOT test),
  c AS (SELECT event_type, CAST(row_number() OVER (ORDER BY event_type) - 1 AS DOUBLE) AS code
        FROM (SELECT DISTINCT event_type FROM i WHERE NOT test))
  SELECT i.event_id, x AS value_imputed, code AS type_code, (x - mu) / CASE WHEN sd = 0 THEN 1 ELSE sd END AS value_scaled,
         CASE WHEN x <= q[1] THEN 'category_1' WHEN x <= q[2] THEN 'category_2' WHEN x <= q[3] THEN 'category_3'
              ELSE 'category_4' END AS value_category
  FROM i LEFT JOIN c ON c.event_type = i.event_type, s""", doubles="value_imputed type_code value_scaled")
def s8_stages(spark, sf_dir):
    """Imputer, label codes, scaler and thresholds fitted to train rows, saved as one pipeline and loaded in a new session."""
    raw = materialize(table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.when(F.col("event_type") != "error", F.col("value")).alias("value")))
    pipeline = Pipeline(stages=[
        MeanImputer(inputCols=["value"], outputCols=["value_imputed"]),
        LabelCodes(inputCol="event_type", outputCol="type_code"),
        TrainScaler(inputCols=["value_imputed"], outputCols=["value_scaled"]),
        CategoryThresholds(inputCol="value_imputed", outputCol="value_category", bins=4)])
    fitted = pipeline.fit(prep.hash_split(raw, "event_id", 0.2).filter("is_test = 0"))
    return _reloaded(spark, fitted).transform(raw).select(
        "event_id", "value_imputed", "type_code", "value_scaled", "value_category")


@query("S8_model_round_trip", """SELECT CAST(d.doc_id AS BIGINT) AS doc_id, 1 AS same
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id""")
def s8(spark, sf_dir):
    """A pipeline with its scaler scores raw rows alike before and after it was saved."""
    t, _ = labelled_documents(spark, sf_dir)
    cols = ["log_chars", "log_words"]
    t = t.select("doc_id", "label", "is_test", *cols)
    pm = models.fit_pipeline(t.filter("is_test = 0"), cols, models.logistic_regression(t.count()), scale=True)
    path = scratch_path(spark, f"model-{uuid.uuid4().hex}")
    pm.write().overwrite().save(path)
    raw = t.select("doc_id", *cols)
    before = pm.transform(raw).select("doc_id", *cols, F.col("prediction").alias("before"))
    after = PipelineModel.load(path).transform(before.select("doc_id", *cols, "before"))
    return after.select("doc_id", (F.col("before") == F.col("prediction")).cast("int").alias("same"))


def _landed(spark, sf_dir):
    path = scratch_path(spark, f"landed-{uuid.uuid4().hex}")
    files.nest_series_as_metrics_json(common.view_v(spark, sf_dir)).write.json(path)
    return files.read_metrics_json(spark, path)


# One broken document of each kind; customer c lands kind c modulo 4.
BAD_DOCUMENTS = ('{"metric_data": {"metrics": [', '{"other": 1}', '{"metric_data": {"metrics": []}}',
                 '{"metric_data": {"metrics": [{"name": "x", "timeslices": []}]}}')


@query("S3_bad_payloads", "WITH " + common.V_CTE + """
  SELECT 'timeslices_read' AS reason, count(*) AS n FROM v
  UNION ALL SELECT ['corrupt', 'no_metric_data', 'no_metrics', 'no_timeslices'][1 + c_custkey % 4], count(*)
  FROM customer GROUP BY 1""")
def s3(spark, sf_dir):
    """Series documents landed together with broken ones; what is read, and what is skipped and why."""
    path = scratch_path(spark, f"landed-{uuid.uuid4().hex}")
    files.nest_series_as_metrics_json(common.view_v(spark, sf_dir)).write.json(path)
    kinds = F.array(*[F.lit(d) for d in BAD_DOCUMENTS])
    table(spark, sf_dir, "customer").select(
        F.get(kinds, (F.col("c_custkey") % 4).cast("int")).alias("value")).write.mode("append").text(path)
    raw = materialize(files.read_metrics_json(spark, path))
    ok = files.flatten_metrics(raw).agg(F.lit("timeslices_read").alias("reason"), F.count(F.lit(1)).alias("n"))
    return ok.unionByName(files.bad_payloads(raw))


@query("S6_csv_sink", "WITH " + common.V_CTE + " SELECT * FROM v", times="ts",
       doubles="response_time min_response_time max_response_time standard_deviation tpm")
def s6(spark, sf_dir):
    path = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    v = common.view_v(spark, sf_dir)
    files.write_csv(v, path)
    return files.read_csv(spark, path, v.schema)


def _profiles(df, names):
    """One row for each chosen column: values that are not null, and their mean. One pass over the data."""
    sums = df.agg(*[x for i, c in enumerate(names) for x in (
        F.count(c).alias(f"n{i}"), F.avg(F.col(c).cast("double")).alias(f"m{i}"))])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("n"), F.col(f"m{i}").alias("mean"))
                               for i, c in enumerate(names)]))
    return sums.select(rows.alias("_p")).select("_p.*")


def _profiles_sql(names, source):
    rows = " UNION ALL ".join(f"SELECT '{c}' AS feature, count({c}) AS n, avg(CAST({c} AS DOUBLE)) AS mean FROM {source}"
                              for c in names.split())
    return "WITH " + common.VF_CTE + " " + rows


@query("S2_collected_table", "WITH " + common.V_CTE + """,
  p AS (SELECT *, d - CAST(((isodow(d) - 4) % 7 + 7) % 7 AS INTEGER) AS period
        FROM (SELECT *, CAST(ts + INTERVAL 7 HOUR - INTERVAL 1430 MINUTE AS DATE) AS d FROM v)),
  w AS (SELECT 'series_' || series AS metric_name, ts, ts + INTERVAL 7 HOUR AS "timestamp", tpm, response_time,
    lag(tpm, 1) OVER w AS tpm_lag_1, lag(tpm, 2) OVER w AS tpm_lag_2, lag(tpm, 3) OVER w AS tpm_lag_3,
    lag(tpm, 5) OVER w AS tpm_lag_5, lag(response_time, 1) OVER w AS response_time_lag_1,
    lag(response_time, 5) OVER w AS response_time_lag_5,
    avg(tpm) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS tpm_ma_3,
    avg(response_time) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS response_time_ma_5,
    stddev_samp(tpm) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS tpm_std_5,
    tpm - lag(tpm, 1) OVER w AS tpm_change
    FROM p WINDOW w AS (PARTITION BY series, period ORDER BY ts))
  SELECT metric_name, "timestamp", tpm, response_time, coalesce(tpm_lag_1, 0) AS tpm_lag_1,
    coalesce(tpm_lag_2, 0) AS tpm_lag_2, coalesce(tpm_lag_3, 0) AS tpm_lag_3, coalesce(tpm_lag_5, 0) AS tpm_lag_5,
    coalesce(response_time_lag_1, 0) AS response_time_lag_1, coalesce(response_time_lag_5, 0) AS response_time_lag_5,
    tpm_ma_3, response_time_ma_5, coalesce(tpm_std_5, 0) AS tpm_std_5, coalesce(tpm_change, 0) AS tpm_change,
    CAST(row_number() OVER (ORDER BY ts, metric_name) - 1 AS BIGINT) AS sequence_id FROM w""", times="timestamp",
    doubles="tpm response_time tpm_lag_1 tpm_lag_2 tpm_lag_3 tpm_lag_5 response_time_lag_1 response_time_lag_5 "
            "tpm_ma_3 response_time_ma_5 tpm_std_5 tpm_change")
def s2_collected(spark, sf_dir):
    """The collected table: landed documents flattened, with lags and rolling values inside each weekly period."""
    return ingest.collected_table(_landed(spark, sf_dir)).select(
        "metric_name", "timestamp", "tpm", "response_time", "tpm_lag_1", "tpm_lag_2", "tpm_lag_3", "tpm_lag_5",
        "response_time_lag_1", "response_time_lag_5", "tpm_ma_3", "response_time_ma_5", "tpm_std_5", "tpm_change",
        "sequence_id")


@query("P13_feature_columns")
def p13(spark, sf_dir):
    t = materialize(ingest.collected_table(_landed(spark, sf_dir)))
    return _profiles(t, ingest.feature_columns([c for c, kind in t.dtypes if kind in ("double", "int", "bigint")]))


# The forecaster's features that view V has, and its numeric columns without series.
@query("P4_feature_families", _profiles_sql(
    "tpm response_time hour minute day_of_week is_weekend hour_sin hour_cos minute_sin minute_cos tpm_lag_1 "
    "tpm_lag_2 tpm_lag_3 tpm_lag_5 tpm_ma_3 tpm_ma_5 tpm_std_3 tpm_std_5 tpm_change tpm_change_rate "
    "minutes_since_push", "vff"), doubles="mean")
def p4(spark, sf_dir):
    f = materialize(common.features_v(spark, sf_dir))
    return _profiles(f, prep.present_families(f.columns, forecast.FORECAST_FEATURES))


@query("P5_numeric_fallback", _profiles_sql(
    "call_count response_time min_response_time max_response_time standard_deviation tpm is_push_notification "
    "play_counted", "v"), doubles="mean")
def p5(spark, sf_dir):
    v = common.view_v(spark, sf_dir)
    return _profiles(v, prep.numeric_columns(v, exclude_patterns=["target_", "series"], essentials=["tpm"]))


@query("P11_result_projection")
def p11(spark, sf_dir):
    _, fitted, best = _classifier(spark, sf_dir)
    tab = forecast.classifier_table(table(spark, sf_dir, "events"))
    return scoring.score_table(fitted[best], tab, keep=["ts", "label"]).withColumnRenamed("label", "actual")
