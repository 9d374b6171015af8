"""Models (M1-M15, G6-G12) as MLlib estimators and aggregate fits.

Parameter mapping from the reference's scikit-learn settings:

* logistic / linear SVM: ``regParam = 1 / (C * n)``, no feature standardisation
  inside the estimator (features are scaled by ``prep`` with population std);
* trees: entropy impurity, ``maxDepth`` 30 for "unlimited" (MLlib's limit; a larger
  depth is refused), splits on binned candidates (``maxBins``);
* forests and boosting: the tree counts, depths and rates of the reference;
  ``minInstancesPerNode`` stands in for min samples per split/leaf;
* sample weights (``ml_weight``) go to ``weightCol``.

Tree results are not expected to equal scikit-learn's: split candidates and
randomness differ.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC,
                                       LogisticRegression, MultilayerPerceptronClassifier,
                                       NaiveBayes, RandomForestClassifier)
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.forest import FEW_ROWS, ForestRegressor

MAX_TREE_DEPTH = 30
# Execution settings for deep ensembles (they change how trees are grown, not
# which trees): keep each row's node id cached instead of re-walking the tree
# per level, and let one pass aggregate statistics for more nodes.
TREE_MEMORY_MB = 1024
# The same for many rows: every running task holds such statistics, beside the rows and node ids kept by its executor.
MANY_ROWS_TREE_MEMORY_MB = 256
# Fits that run at a time, at most and at least: one's driver work and short jobs leave the cores to the others.
FITS_AT_ONCE = 4
FEWEST_AT_ONCE = 2
# Rows of a forest's task at most (FEW_ROWS are left as they lie).
FOREST_TASK_ROWS = 500_000


# ------------------------------------------------------------ closed form (M1)

def simple_linear_fit(df: DataFrame, x: str, y: str, groups: Sequence[str] = ()) -> DataFrame:
    """M1: least-squares slope, intercept and R^2 as aggregates (groupable per series)."""
    aggs = [F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
            F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n")]
    return df.groupBy(*groups).agg(*aggs) if groups else df.agg(*aggs)


def normal_equations(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """M2 in closed form: (term, coefficient) from one aggregate of means and covariances.

    The k x k system is solved on the driver. Of features that depend on each other the solution of least norm is taken.
    """
    names = [*features, label]
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names)) if i < len(features)]
    row = df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in names)).agg(
        *[F.avg(f"`{c}`").alias(f"m_{i}") for i, c in enumerate(names)],
        *[F.covar_pop(f"`{names[i]}`", f"`{names[j]}`").alias(f"c_{i}_{j}") for i, j in pairs]).first()
    k = len(features)
    if row["m_0"] is None:
        return df.sparkSession.createDataFrame([], "term string, coefficient double")
    system = np.array([[row[f"c_{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])
    slopes = np.linalg.lstsq(system, np.array([row[f"c_{i}_{k}"] for i in range(k)]), rcond=None)[0]
    intercept = row[f"m_{k}"] - sum(b * row[f"m_{i}"] for i, b in enumerate(slopes))
    return df.sparkSession.createDataFrame([(c, float(b)) for c, b in zip(features, slopes, strict=True)]
                                           + [("intercept", float(intercept))], "term string, coefficient double")


MAX_CLASSES = 1000
VARIANCE_FLOOR = 1e-9


def gaussian_moments(df: DataFrame, label: str, features: Sequence[str]) -> list[tuple]:
    """(class, log prior, [(mean, variance) of each feature]) from one grouped aggregate.

    Every variance is raised by a billionth of the largest feature variance, as a constant feature has none.
    """
    sums = [x for i, c in enumerate(features) for x in (F.avg(c).alias(f"m_{i}"), F.var_pop(c).alias(f"v_{i}"))]
    rows = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"), *sums).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    whole = df.where(F.col(label).isNotNull()).agg(*[F.var_pop(c).alias(f"v_{i}") for i, c in enumerate(features)]).first()
    floor = VARIANCE_FLOOR * max((whole[f"v_{i}"] or 0.0) for i in range(len(features)))
    total = sum(r["n"] for r in rows)
    return sorted(((r[label], math.log(r["n"] / total), [(r[f"m_{i}"], r[f"v_{i}"] + floor) for i in range(len(features))])
                   for r in rows), key=lambda s: s[0])


def _gaussian_scores(state: Sequence[tuple], features: Sequence[str]) -> list[Column]:
    scores = []
    for cls, prior, moments in state:
        score = F.lit(prior)
        for c, (mean, variance) in zip(features, moments, strict=True):
            score = score - 0.5 * (math.log(2 * math.pi * variance) + (F.col(c) - mean) * (F.col(c) - mean) / variance)
        scores.append(score)
    return scores


def gaussian_score(state: Sequence[tuple], features: Sequence[str]) -> Column:
    """The largest of the classes' log likelihoods."""
    return F.array_max(F.array(*_gaussian_scores(state, features)))


def gaussian_class(state: Sequence[tuple], features: Sequence[str]) -> Column:
    """The class of the largest likelihood (ties: the smaller class), as one expression without a join."""
    best = gaussian_score(state, features)
    out = F.lit(None)
    for score, (cls, _, _) in reversed(list(zip(_gaussian_scores(state, features), state, strict=True))):
        out = F.when(score == best, F.lit(cls)).otherwise(out)
    return out


# ---------------------------------------------------------------- estimators

def linear_regression(features: str = "features", label: str = "label", weight: str | None = None):
    """M2: ordinary least squares (normal equations, no regularisation)."""
    lr = LinearRegression(featuresCol=features, labelCol=label, regParam=0.0, solver="normal",
                          standardization=False)
    if weight:
        lr.setWeightCol(weight)
    return lr


def logistic_regression(n_rows: int, C: float = 1.0, max_iter: int = 100,
                        features: str = "features", label: str = "label"):
    """M3 / M4: L2 logistic regression with scikit-learn's C mapped to regParam."""
    return LogisticRegression(featuresCol=features, labelCol=label, regParam=1.0 / (C * max(n_rows, 1)),
                              elasticNetParam=0.0, standardization=False, maxIter=max_iter)


def linear_svm(n_rows: int, C: float = 1.0, features: str = "features", label: str = "label"):
    """M6."""
    return LinearSVC(featuresCol=features, labelCol=label, regParam=1.0 / (C * max(n_rows, 1)),
                     standardization=False, maxIter=100)


def _depth(depth: int) -> int:
    if depth > MAX_TREE_DEPTH:
        raise ValueError(f"MLlib grows trees to depth {MAX_TREE_DEPTH} at most, {depth} was asked for")
    return depth


def decision_tree(max_depth: int = MAX_TREE_DEPTH, max_bins: int = 256, seed: int = 0,
                  features: str = "features", label: str = "label"):
    """M7: entropy tree."""
    return DecisionTreeClassifier(featuresCol=features, labelCol=label, impurity="entropy",
                                  maxDepth=_depth(max_depth), maxBins=max_bins, seed=seed)


def random_forest(n_trees: int = 10, max_depth: int = MAX_TREE_DEPTH, min_instances: int = 1,
                  impurity: str = "entropy", seed: int = 0, features: str = "features",
                  label: str = "label", weight: str | None = None):
    """M8 (10 trees, entropy) / M9 (200 trees, depth 12, min split 5)."""
    rf = RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=n_trees,
                                maxDepth=_depth(max_depth), impurity=impurity,
                                minInstancesPerNode=min_instances, featureSubsetStrategy="sqrt",
                                seed=seed, cacheNodeIds=True, maxMemoryInMB=TREE_MEMORY_MB)
    if weight:
        rf.setWeightCol(weight)
    return rf


def gradient_boosting(max_iter: int = 150, max_depth: int = 6, step: float = 0.1,
                      subsample: float = 0.8, seed: int = 0, features: str = "features",
                      label: str = "label"):
    """M10."""
    return GBTClassifier(featuresCol=features, labelCol=label, maxIter=max_iter, maxDepth=max_depth,
                         stepSize=step, subsamplingRate=subsample, seed=seed)


def forest_regressor(n_trees: int = 200, max_depth: int = 15, min_leaf: int = 4, seed: int = 42,
                     features: str = "features", label: str = "label", weight: str | None = None,
                     memory_mb: int = TREE_MEMORY_MB):
    """The forecaster's forest (200 trees, depth 15, leaf 4, sqrt features)."""
    rf = ForestRegressor(featuresCol=features, labelCol=label, numTrees=n_trees,
                         maxDepth=_depth(max_depth), minInstancesPerNode=min_leaf,
                         featureSubsetStrategy="sqrt", seed=seed, cacheNodeIds=True,
                         maxMemoryInMB=memory_mb)
    if weight:
        rf.setWeightCol(weight)
    return rf


def naive_bayes_gaussian(features: str = "features", label: str = "label"):
    """G8."""
    return NaiveBayes(featuresCol=features, labelCol=label, modelType="gaussian")


def mlp(layers: Sequence[int], seed: int = 0, features: str = "features", label: str = "label"):
    """Feed-forward classifier."""
    return MultilayerPerceptronClassifier(featuresCol=features, labelCol=label, layers=list(layers),
                                          seed=seed, maxIter=200)


def kmeans(k: int, seed: int = 0, features: str = "features"):
    """G7."""
    return KMeans(featuresCol=features, k=k, seed=seed)


def hierarchical(k: int, seed: int = 0, features: str = "features"):
    """Divisive hierarchical clustering."""
    return BisectingKMeans(featuresCol=features, k=k, seed=seed)


# ----------------------------------------------------------- pipelines, tables

def fit_pipeline(df: DataFrame, feature_cols: Sequence[str], estimator, features: str = "features", scale: bool = False):
    """(Alignment + scaling +) assembly + estimator as one ``PipelineModel``, which is what is saved and reloaded.

    The feature list and the train rows' statistics are stages, so a saved pipeline scores raw rows as it was trained.
    """
    from tidewater.stages import AlignFeatures, TrainScaler
    inputs = [f"z_{c}" for c in feature_cols] if scale else list(feature_cols)
    first = [AlignFeatures(features=list(feature_cols)),
             TrainScaler(inputCols=list(feature_cols), outputCols=inputs)] if scale else []
    asm = VectorAssembler(inputCols=inputs, outputCol=features, handleInvalid="error")
    return Pipeline(stages=[*first, asm, estimator]).fit(df)


def side_by_side(spark: SparkSession, fits: Sequence[Callable], at_once: int = FEWEST_AT_ONCE) -> Iterator:
    """Results of independent fits in their order, ``at_once`` running at a time.

    Each is the fit that it is alone; Spark shares the cores between their jobs. One that fails stops those not begun.
    """
    with ThreadPoolExecutor(at_once) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(fit)) for fit in fits]
        try:
            while begun:
                yield begun.pop(0).result()
        finally:
            for other in begun:
                other.cancel()


def forest_layout(df: DataFrame, key: str, alike: Sequence[str] = ()) -> DataFrame:
    """Rows in as few tasks as keep the cores busy while forests are grown side by side.

    In a pass each task of a forest fills a table with the statistics of every node grown in it, however
    few of its rows reach the node, so at depth the work is that of tasks times nodes. Rows are dealt by
    the hash of ``key`` and sorted, so a row's draws do not depend on the files; ``FEW_ROWS`` stay as they lie.
    Sorted by the features ``alike`` first, neighbours reach the same nodes of most trees, whose statistics are then at hand.
    """
    n = df.count()
    if n <= FEW_ROWS:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(math.ceil(cores / FITS_AT_ONCE), math.ceil(n / FOREST_TASK_ROWS))
    return df.repartition(tasks, key).sortWithinPartitions(*alike, key)


def tree_memory_mb(df: DataFrame) -> int:
    """Statistics that one pass of a forest on ``df`` holds in each task; ``FEW_ROWS`` keep the larger share."""
    return TREE_MEMORY_MB if df.count() <= FEW_ROWS else MANY_ROWS_TREE_MEMORY_MB


def fits_at_once(df: DataFrame) -> int:
    """Fits on ``df`` whose tasks the cores hold at a time; each keeps its rows and their nodes, so no more run on many rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return min(FITS_AT_ONCE, max(FEWEST_AT_ONCE, cores // max(1, df.rdd.getNumPartitions())))


def feature_importances(model, feature_cols: Sequence[str], spark=None) -> DataFrame:
    """(feature, importance) rows, most important first."""
    m = model.stages[-1] if isinstance(model, PipelineModel) else model
    imp = m.featureImportances.toArray().tolist()
    spark = spark or SparkSession.getActiveSession()
    rows = [(str(n), float(v)) for n, v in zip(feature_cols, imp)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), F.col("feature"))


def compare_classifiers(train: DataFrame, test: DataFrame, feature_cols: Sequence[str],
                        estimators: dict, label: str = "label", scale: bool = False):
    """M13 + T6: fit each, score the test set, metric table, best by AUC (ties: first name).

    Returns (metric DataFrame, {name: PipelineModel}, best name).
    """
    train = train.persist()
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction",
                                       metricName="areaUnderROC", numBins=0)

    def judged(name: str):
        pm = fit_pipeline(train, feature_cols, estimators[name], scale=scale)
        pred = pm.transform(test)
        auc = ev.evaluate(pred)
        acc = pred.agg(F.avg(F.when(F.col("prediction") == F.col(label), 1.0).otherwise(0.0))).first()[0]
        return (name, float(auc), float(acc)), pm

    found = list(side_by_side(train.sparkSession, [partial(judged, name) for name in estimators]))
    rows, models = [row for row, _ in found], {row[0]: pm for row, pm in found}
    train.unpersist()
    spark = test.sparkSession
    table = spark.createDataFrame(rows, "model string, roc_auc double, accuracy double")
    best = min(rows, key=lambda r: (-r[1], r[0]))[0]
    return table, models, best


def best_regressor_per_horizon(train: DataFrame, test: DataFrame, feature_cols: Sequence[str],
                               horizons: Sequence[int], n_trees: int = 200, rounds: int = 100):
    """Forest vs boosting vs linear for each horizon, kept by lowest test MSE."""
    def judged(h: int, name: str, est):
        pm = fit_pipeline(train, feature_cols, est)
        ev = RegressionEvaluator(metricName="mse", predictionCol="prediction", labelCol=f"target_{h}min")
        return h, name, ev.evaluate(pm.transform(test)), pm

    fits, memory_mb = [], tree_memory_mb(train)
    for h in horizons:
        label = f"target_{h}min"
        cands = {"forest": forest_regressor(n_trees=n_trees, label=label, memory_mb=memory_mb),
                 # scikit-learn's boosting defaults: 100 stages of depth 3, rate 0.1
                 "boosting": GBTRegressor(labelCol=label, maxIter=rounds, maxDepth=3,
                                          stepSize=0.1, seed=0),
                 "linear": linear_regression(label=label)}
        fits += [partial(judged, h, name, est) for name, est in cands.items()]
    out, models = [], {}
    for h, name, mse, pm in side_by_side(train.sparkSession, fits, fits_at_once(train)):
        out.append((h, name, float(mse)))
        if h not in models or mse < models[h][1]:
            models[h] = (name, mse, pm)
    table = test.sparkSession.createDataFrame(out, "horizon_minutes int, model string, mse double")
    return table, {h: (b[0], b[2]) for h, b in models.items()}


def cross_validate(df: DataFrame, feature_cols: Sequence[str], estimator, grid: dict,
                   evaluator, folds: int = 3, seed: int = 0):
    """K-fold CV over a parameter grid; returns the fitted CrossValidatorModel."""
    pg = ParamGridBuilder()
    for param, values in grid.items():
        pg = pg.addGrid(getattr(estimator, param), values)
    asm = VectorAssembler(inputCols=list(feature_cols), outputCol="features")
    cv = CrossValidator(estimator=Pipeline(stages=[asm, estimator]), estimatorParamMaps=pg.build(),
                        evaluator=evaluator, numFolds=folds, seed=seed)
    return cv.fit(df)


def random_fourier_features(df: DataFrame, cols: Sequence[str], n_features: int = 64,
                            gamma: float = 1.0, seed: int = 0, out_prefix: str = "rff_") -> DataFrame:
    """RBF-kernel approximation (Rahimi & Recht 2007) as plain column expressions.

    z_j(x) = sqrt(2/D) cos(w_j . x + b_j), w ~ N(0, 2 gamma I), b ~ U(0, 2 pi);
    a linear SVM on z approximates the kernel SVM.
    """
    import numpy as np
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2 * gamma), size=(n_features, len(cols)))
    b = rng.uniform(0, 2 * math.pi, size=n_features)
    scale = math.sqrt(2.0 / n_features)
    exprs = []
    for j in range(n_features):
        dot = F.lit(float(b[j]))
        for i, c in enumerate(cols):
            dot = dot + F.col(c) * F.lit(float(w[j, i]))
        exprs.append((F.lit(scale) * F.cos(dot)).alias(f"{out_prefix}{j}"))
    return df.select("*", *exprs)


def decision_grid(bounds: DataFrame, step: float = 0.01, margin: float = 1.0) -> DataFrame:
    """The 2-D grid behind decision-boundary plots, from data bounds.

    ``bounds`` has x_min, x_max, y_min, y_max (one row). Axis values follow
    ``arange(min - margin, max + margin, step)``; points are numbered by ``range``, so the
    grid is made by as many tasks as it needs.
    """
    b = bounds.first()
    x0, y0 = b["x_min"] - margin, b["y_min"] - margin
    nx, ny = math.ceil((b["x_max"] + margin - x0) / step), math.ceil((b["y_max"] + margin - y0) / step)
    g = bounds.sparkSession.range(nx * ny)
    i, j = F.floor(F.col("id") / ny), F.col("id") % ny
    return g.select((F.lit(x0) + i * step).alias("x"), (F.lit(y0) + j * step).alias("y"))


def linear_rule(df: DataFrame, x: str, y: str, label: str) -> tuple[float, float]:
    """Weights of the least-squares direction of a 0/1 label on two centred features, from one row of sums."""
    r = df.agg(F.covar_pop(x, x).alias("xx"), F.covar_pop(y, y).alias("yy"), F.covar_pop(x, y).alias("xy"),
               F.covar_pop(x, label).alias("xl"), F.covar_pop(y, label).alias("yl")).first()
    det = r["xx"] * r["yy"] - r["xy"] ** 2
    return (r["yy"] * r["xl"] - r["xy"] * r["yl"]) / det, (r["xx"] * r["yl"] - r["xy"] * r["xl"]) / det
