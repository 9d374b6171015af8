"""Property checks for models, scoring and persistence."""

import os

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tests.conftest import SF_CHECK, SF_SMALL
from tidewater.operators import categories, models, prep, scoring
from tidewater.plans import forecast
from tidewater.sources.tables import table


@pytest.fixture(scope="module")
def ftable(spark):
    from tidewater.session import checkpoint_dir
    checkpoint_dir(spark)
    return forecast.forecast_table(table(spark, SF_SMALL, "events")).checkpoint(eager=True)


@pytest.fixture(scope="module")
def fmodels(ftable):
    return forecast.train_forecaster(ftable, n_trees=8)


@pytest.fixture(scope="module")
def lineitem_z(spark):
    li = table(spark, SF_SMALL, "lineitem").select(
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"))
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    z = prep.apply_standardiser(li, prep.fit_standardiser(li, cols), cols)
    return prep.assemble(z, [f"z_{c}" for c in cols]).persist()


def test_m2_residuals_orthogonal_to_features(spark, lineitem_z):
    data = prep.assemble(lineitem_z.drop("features"), ["z_l_quantity", "z_l_discount", "z_l_tax"])
    pm = models.linear_regression(label="l_extendedprice").fit(data)
    res = pm.transform(data).withColumn("r", F.col("l_extendedprice") - F.col("prediction"))
    arr = res.select(vector_to_array("features").alias("x"), "r").toPandas()
    x = np.stack(arr["x"].to_numpy())
    dots = x.T @ arr["r"].to_numpy()
    scale = np.abs(x).sum(axis=0) * np.abs(arr["r"]).mean()
    assert np.all(np.abs(dots) < 1e-6 * scale)
    assert abs(arr["r"].mean()) < 1e-6 * arr["r"].abs().mean()


@pytest.mark.parametrize("kind", ["logistic", "svm", "tree", "forest", "gbt"])
def test_m3_m10_classifiers_fit_and_predict(spark, lineitem_z, kind):
    n = lineitem_z.count()
    est = {"logistic": models.logistic_regression(n, C=1.0, max_iter=2000),
           "svm": models.linear_svm(n),
           "tree": models.decision_tree(max_depth=10),
           "forest": models.random_forest(n_trees=10),
           "gbt": models.gradient_boosting(max_iter=5)}[kind]
    pred = est.fit(lineitem_z).transform(lineitem_z)
    acc = pred.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    base = lineitem_z.agg(F.avg("label")).first()[0]
    assert acc >= max(base, 1 - base) - 0.05


def test_m7_larger_depth_is_refused():
    assert models.decision_tree().getMaxDepth() == 30
    with pytest.raises(ValueError):
        models.decision_tree(max_depth=31)


def test_m11_m12_forecaster_per_horizon_and_weights(spark, ftable, fmodels):
    fitted, evals = fmodels
    assert sorted(fitted) == [5, 10, 20, 30]
    rows = evals.collect()
    assert len(rows) == 4 and all(r["mse"] >= 0 for r in rows)
    unweighted, _ = forecast.train_forecaster(ftable, horizons=[5], n_trees=8, use_weights=False)
    a = fitted[5].transform(ftable).agg(F.sum("prediction")).first()[0]
    b = unweighted[5].transform(ftable).agg(F.sum("prediction")).first()[0]
    assert ftable.select("ml_weight").distinct().count() > 1
    assert a != b


def test_m13_t6_compare_and_best(spark):
    tab = forecast.classifier_table(table(spark, SF_CHECK, "events"))
    metric_table, fitted, best = forecast.train_classifiers(tab, n_trees=10, rounds=3)
    rows = {r["model"]: r for r in metric_table.collect()}
    assert set(rows) == {"logistic_regression", "random_forest", "gradient_boosting"}
    assert best == max(rows, key=lambda k: rows[k]["roc_auc"])
    assert all(0 <= r["roc_auc"] <= 1 for r in rows.values())
    # scoring keeps the training statistics, also on a file with shifted values
    shifted = tab.withColumn("tpm_lag_1", F.col("tpm_lag_1") + 1000)
    pm = fitted["logistic_regression"]
    part = shifted.limit(50).checkpoint(eager=True)
    whole = pm.transform(shifted).select("series", "ts", F.col("prediction").alias("whole"))
    alone = pm.transform(part).select("series", "ts", "prediction").join(whole, ["series", "ts"])
    assert alone.count() == 50 and alone.filter("prediction <> whole").count() == 0


def test_m14_t5_importances_sum_to_one(spark, fmodels):
    fitted, _ = fmodels
    imp = models.feature_importances(fitted[5], forecast.FORECAST_FEATURES, spark)
    total = imp.agg(F.sum("importance")).first()[0]
    assert abs(total - 1.0) < 1e-9
    top = imp.limit(10).collect()
    assert [r["importance"] for r in top] == sorted([r["importance"] for r in top], reverse=True)


def test_m15_grid_scores(spark, lineitem_z):
    b = spark.range(1).select(F.lit(0.0).alias("x_min"), F.lit(0.5).alias("x_max"),
                              F.lit(0.0).alias("y_min"), F.lit(0.2).alias("y_max"))
    g = models.decision_grid(b, step=0.1, margin=0.0)
    assert g.count() == 5 * 2


def test_s8_save_load_same_scores(spark, fmodels, ftable, tmp_path):
    fitted, _ = fmodels
    path = os.path.join(str(tmp_path), "h5")
    fitted[5].write().overwrite().save(path)
    back = PipelineModel.load(path)
    a = fitted[5].transform(ftable).select("series", "ts", "prediction")
    b = back.transform(ftable).select("series", "ts", F.col("prediction").alias("p2"))
    assert a.join(b, ["series", "ts"]).filter(F.col("prediction") != F.col("p2")).count() == 0


def test_r1_score_table(spark, lineitem_z):
    pm = models.fit_pipeline(lineitem_z.drop("features"), ["z_l_quantity", "z_l_discount"],
                             models.logistic_regression(100))
    out = scoring.score_table(pm, lineitem_z.drop("features"), keep=["label"])
    assert out.columns == ["label", "prediction", "probability_high"]
    assert out.filter((F.col("probability_high") < 0) | (F.col("probability_high") > 1)).count() == 0


def _scenarios(spark):
    return spark.createDataFrame(
        [("no_push", 1, 500.0, 14, 5, 250.0, [480.0, 470.0, 460.0], 0, 999999),
         ("push", 1, 500.0, 14, 5, 250.0, [480.0, 470.0, 460.0], 1, 5),
         ("no_push", 2, 80.0, 3, 1, 120.0, [], 0, 999999),
         ("push", 2, 80.0, 3, 1, 120.0, [], 1, 0)],
        "scenario string, sid int, current_tpm double, hour int, day_of_week int, response_time double, "
        "previous_tpm_values array<double>, push_notification_active int, minutes_since_push int")


def test_r2_r5_r6_scenarios_sweep_uplift(spark, fmodels):
    fitted, _ = fmodels
    scen = _scenarios(spark)
    feats = scoring.scenario_features(scen, forecast.FORECAST_FEATURES)
    pred = scoring.forecast(fitted, feats)
    assert pred.filter(F.least(*[F.col(f"pred_{h}") for h in (5, 10, 20, 30)]) < 0).count() == 0
    sweep = scoring.forecast(fitted, scoring.scenario_features(scoring.hour_sweep(scen.limit(1)),
                                                               forecast.FORECAST_FEATURES))
    assert sweep.count() == 24 and len([c for c in sweep.columns if c.startswith("pred_")]) == 4
    up = scoring.scenario_uplift(pred, "scenario", "no_push", "push", ["sid"]).collect()
    assert len(up) == 2 and all(r["uplift_pct_5"] is not None for r in up)


def test_r4_category_awareness_uses_thresholds(spark):
    from tidewater.plans.q_reports import _v_dated
    v = _v_dated(spark, SF_SMALL)
    peaks = categories.peak_times(categories.categorise(v, "tpm", 3))
    cur = v.withColumn("pred_5", F.col("tpm"))
    out = scoring.category_aware(cur, categories.edges(v, "tpm", 3), peaks, [5], value="tpm")
    r = out.filter(F.col("adjustment_applied") == 1).select("adjustment_factor").distinct().collect()
    assert {x[0] for x in r} <= {0.9, 1.15, 1.05, 0.95}


def test_g6_best_regressor_per_horizon(spark, ftable):
    data = prep.hash_split(ftable.withColumn("_rid", F.concat_ws("|", "series", "ts")), "_rid", 0.2)
    tab, best = models.best_regressor_per_horizon(data.filter("is_test = 0"), data.filter("is_test = 1"),
                                                  forecast.FORECAST_FEATURES, [5], n_trees=10, rounds=3)
    rows = tab.collect()
    assert len(rows) == 3
    assert best[5][0] == min(rows, key=lambda r: r["mse"])["model"]


def test_g7_g9_clustering_embeddings(spark):
    from pyspark.ml.functions import array_to_vector
    e = table(spark, SF_SMALL, "embeddings").select(array_to_vector("embedding").alias("features"))
    for est in (models.kmeans(4), models.hierarchical(4)):
        pred = est.fit(e).transform(e)
        assert pred.select("prediction").distinct().count() <= 4


def test_g8_g10_g12_other_classifiers(spark, lineitem_z):
    nb = models.naive_bayes_gaussian().fit(lineitem_z).transform(lineitem_z)
    assert nb.count() == lineitem_z.count()
    rff = models.random_fourier_features(lineitem_z.drop("features"), ["z_l_quantity", "z_l_discount"], 16)
    rff = prep.assemble(rff, [f"rff_{i}" for i in range(16)])
    svm = models.linear_svm(rff.count()).fit(rff).transform(rff)
    assert svm.select("prediction").distinct().count() >= 1
    mlp = models.mlp([4, 5, 2]).fit(lineitem_z).transform(lineitem_z)
    assert mlp.count() == lineitem_z.count()


def test_g11_cross_validation(spark, lineitem_z):
    cols = ["z_l_quantity", "z_l_discount", "z_l_tax"]
    est = models.logistic_regression(1000)
    cv = models.cross_validate(lineitem_z.drop("features"), cols, est, {"regParam": [0.001, 0.1]},
                               BinaryClassificationEvaluator(), folds=2)
    assert len(cv.avgMetrics) == 2


def test_e8_assemble_rejects_null(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(Exception):
        prep.assemble(df, ["a", "b"]).collect()


def test_m2_normal_equations_of_dependent_features(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=200) + 1e4, rng.normal(size=200)
    y = 3 * a - 2 * b + 5
    df = spark.createDataFrame([(float(p), float(q), float(p + q), float(t)) for p, q, t in zip(a, b, y)] + [(None, 1.0, 1.0, 1.0)],
                               "a double, b double, s double, y double")
    two = {r["term"]: r["coefficient"] for r in models.normal_equations(df, ["a", "b"], "y").collect()}
    assert two["a"] == pytest.approx(3, rel=1e-9) and two["b"] == pytest.approx(-2, rel=1e-9)
    assert two["intercept"] == pytest.approx(5, abs=1e-4)
    three = {r["term"]: r["coefficient"] for r in models.normal_equations(df, ["a", "b", "s"], "y").collect()}
    fitted = three["a"] * a + three["b"] * b + three["s"] * (a + b) + three["intercept"]
    assert np.allclose(fitted, y, rtol=1e-9)


def test_g8_closed_form_agrees_with_mllib(spark, lineitem_z):
    names = ["z_l_quantity", "z_l_extendedprice", "z_l_discount", "z_l_tax"]
    state = models.gaussian_moments(lineitem_z, "label", names)
    both = models.naive_bayes_gaussian().fit(lineitem_z).transform(lineitem_z).withColumn(
        "closed", models.gaussian_class(state, names))
    assert both.where("prediction <> closed").count() == 0


def test_fits_run_side_by_side_in_order(spark):
    import threading
    met = threading.Barrier(2)

    def fit(name):
        met.wait(timeout=60)  # one alone never gets past it
        return name, spark.range(10).count()

    assert list(models.side_by_side(spark, [lambda n=n: fit(n) for n in "abcd"])) == [(n, 10) for n in "abcd"]

    def broken():
        raise ValueError("no fit")
    with pytest.raises(ValueError, match="no fit"):
        list(models.side_by_side(spark, [broken, lambda: 1]))


def test_forest_rows_do_not_depend_on_the_files(spark, monkeypatch):
    """Few tasks, each with the same rows in the same order however the rows came; a small table is left as it lies."""
    rows = spark.range(5000).select(F.concat_ws("|", F.col("id") % 4, "id").alias("_rid"))
    assert models.forest_layout(rows.repartition(7), "_rid").rdd.getNumPartitions() == 7
    monkeypatch.setattr(models, "FEW_ROWS", 100)

    def parts(df):
        return [[r["_rid"] for r in part] for part in models.forest_layout(df, "_rid").rdd.glom().collect()]

    a, b = parts(rows.repartition(7)), parts(rows.repartition(3).orderBy(F.desc("_rid")))
    assert a == b and sum(map(len, a)) == 5000
    assert len(a) == -(-spark.sparkContext.defaultParallelism // models.FITS_AT_ONCE)
    monkeypatch.setattr(models, "FOREST_TASK_ROWS", 1000)
    assert len(parts(rows)) == 5


def test_as_many_fits_as_the_cores_hold_tasks_of(spark, monkeypatch):
    """Few rows are laid out so that all four horizons grow at a time; many rows in many tasks leave it at two."""
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(models, "FEW_ROWS", 100)
    rows = spark.range(5000).select(F.col("id").cast("string").alias("_rid"))
    laid = models.forest_layout(rows, "_rid")
    assert laid.rdd.getNumPartitions() == -(-cores // 4)
    assert models.fits_at_once(laid) == max(2, min(4, cores // laid.rdd.getNumPartitions()))
    assert models.fits_at_once(rows.repartition(1)) == max(2, min(4, cores))
    assert models.fits_at_once(rows.repartition(4 * cores)) == 2


def test_rows_alike_lie_together_in_a_forests_tasks(spark, monkeypatch):
    """Each task keeps the rows it had, sorted by the named features and then by the key; a small table is left as it lies."""
    rows = spark.range(3000).select(F.concat_ws("|", F.col("id") % 4, "id").alias("_rid"), (F.col("id") * 7 % 5).alias("a"),
                                    F.when(F.col("id") % 3 > 0, F.col("id") % 2).alias("b")).repartition(6)

    def parts(df):
        return [[(r["a"], r["b"] is not None, r["b"], r["_rid"]) for r in part] for part in df.rdd.glom().collect()]

    assert parts(models.forest_layout(rows, "_rid", ["a", "b"])) == parts(rows)
    monkeypatch.setattr(models, "FEW_ROWS", 100)
    plain, sorted_ = parts(models.forest_layout(rows, "_rid")), parts(models.forest_layout(rows, "_rid", ["a", "b"]))
    assert [sorted(p, key=lambda r: (r[0], r[1], r[2] or 0, r[3])) for p in plain] == sorted_
    assert parts(models.forest_layout(rows.repartition(3), "_rid", ["a", "b"])) == sorted_


def test_forests_on_many_rows_hold_less_in_a_task(spark, ftable, monkeypatch):
    """The statistics of a pass are bounded on many rows; the forecaster is as whole, its fits have all their trees."""
    assert models.tree_memory_mb(ftable) == models.TREE_MEMORY_MB
    monkeypatch.setattr(models, "FEW_ROWS", 10)
    assert models.tree_memory_mb(ftable) == models.MANY_ROWS_TREE_MEMORY_MB < models.TREE_MEMORY_MB
    grown = []
    monkeypatch.setattr(models, "fit_pipeline", lambda df, features, est, fit=models.fit_pipeline: grown.append(
        (est.getMaxMemoryInMB(), est.getCacheNodeIds())) or fit(df, features, est))
    fitted, evals = forecast.train_forecaster(ftable, n_trees=3)
    assert grown == 4 * [(models.MANY_ROWS_TREE_MEMORY_MB, True)]
    assert [fitted[h].stages[-1].getNumTrees for h in (5, 10, 20, 30)] == [3, 3, 3, 3] and evals.count() == 4
