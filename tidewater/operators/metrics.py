"""Model evaluation as aggregates (V1-V7).

Every metric is one or two grouped aggregates over (label, prediction) or
(actual, predicted) columns; nothing is collected. ROC AUC is the exact
rank-sum form with tied scores averaged, computed on the histogram of
distinct scores with a range-bucketed running sum, so no task sorts the whole
score column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import materialize


def accuracy(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """V1."""
    return df.agg(F.avg(F.when(F.col(label) == F.col(pred), 1.0).otherwise(0.0)).alias("accuracy"),
                  F.count(F.lit(1)).alias("n"))


MAX_CLASSES = 1000


def confusion_matrix(df: DataFrame, labels: Sequence | None = None, label: str = "label",
                     pred: str = "prediction") -> DataFrame:
    """V2: rows = true label, one column per predicted label, sorted, zeros kept.

    The classes are those of either column. A given list has to hold them all.
    """
    found = df.select(F.explode(F.array(label, pred)).alias("c")).where("c IS NOT NULL").distinct() \
        .limit(MAX_CLASSES + 1).collect()
    if len(found) > MAX_CLASSES:
        raise ValueError(f"a confusion matrix has at most {MAX_CLASSES} classes")
    found = sorted(r["c"] for r in found)
    if labels is not None and set(found) - set(labels):
        raise ValueError(f"classes outside the given list: {sorted(set(found) - set(labels))}")
    labels = found if labels is None else labels
    counts = df.groupBy(label).pivot(pred, list(labels)).count()
    names = [str(x) for x in labels]
    spark = df.sparkSession
    # the label list is the model's class list: bounded and tiny
    all_rows = spark.createDataFrame([(x,) for x in labels],
                                     f"`{label}` {df.schema[label].dataType.simpleString()}")
    return all_rows.join(counts, label, "left").na.fill(0, subset=names)


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """V3: precision, recall, f1, support per class, plus accuracy, macro and weighted averages."""
    # classes x classes rows, read by six branches: aggregate the input once
    pairs = materialize(df.groupBy(F.col(label).alias("_t"), F.col(pred).alias("_p"))
                        .agg(F.count(F.lit(1)).alias("_n")))
    tp = pairs.filter(F.col("_t") == F.col("_p")).select(F.col("_t").alias("cls"), F.col("_n").alias("tp"))
    sup = pairs.groupBy(F.col("_t").alias("cls")).agg(F.sum("_n").alias("support"))
    npred = pairs.groupBy(F.col("_p").alias("cls")).agg(F.sum("_n").alias("n_pred"))
    per = (sup.join(npred, "cls", "full").join(tp, "cls", "left")
           .na.fill(0, subset=["support", "n_pred", "tp"]))
    per = (per.withColumn("precision", F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(0.0))
           .withColumn("recall", F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0))
           .withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                    2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                       .otherwise(0.0)))
    classes = per.select(F.col("cls").cast("string").alias("class"), "precision", "recall", "f1",
                         F.col("support").cast("long").alias("support"))
    tot = per.agg(F.sum("support").alias("_s"), F.sum("tp").alias("_tp"))
    macro = per.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                    F.sum("support").cast("long").alias("support"))
    weighted = per.agg(F.lit("weighted avg").alias("class"),
                       (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
                       (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
                       (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"),
                       F.sum("support").cast("long").alias("support"))
    acc = tot.select(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), (F.col("_tp") / F.col("_s")).alias("f1"),
                     F.col("_s").cast("long").alias("support"))
    return classes.unionByName(macro).unionByName(weighted).unionByName(acc)


def running_sum_by_value(df: DataFrame, order: str, value: str, out: str, buckets: int = 1024) -> DataFrame:
    """Exclusive running sum of ``value`` in ascending ``order`` over the whole table.

    Rows are cut into equal-frequency buckets (``approxQuantile`` splits, at
    most ``buckets`` floats to the driver, applied by the JVM ``Bucketizer``),
    so a crowded value range cannot put most rows in one task. Bucket totals
    get offsets on the small bucket table; the within-bucket sum runs per bucket.
    """
    from pyspark.ml.feature import Bucketizer
    qs = df.approxQuantile(order, [i / buckets for i in range(1, buckets)], 1.0 / (4 * buckets))
    splits = [float("-inf")] + sorted(set(q for q in qs if q is not None)) + [float("inf")]
    b = Bucketizer(splits=splits, inputCol=order, outputCol="_bf", handleInvalid="keep").transform(df) \
        .withColumn("_b", F.col("_bf").cast("int")).drop("_bf")
    tot = b.groupBy("_b").agg(F.sum(value).alias("_t"))
    # one row per bucket (<= ``buckets``): an ordered pass over a tiny table
    offs = tot.withColumn("_off", F.coalesce(F.sum("_t").over(
        Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_t")
    w = Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (b.join(F.broadcast(offs), "_b")
            .withColumn(out, F.col("_off") + F.coalesce(F.sum(value).over(w), F.lit(0)))
            .drop("_b", "_off"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """V4: exact ROC AUC with ties (Mann-Whitney), on the distinct-score histogram; null for one class."""
    hist = materialize(df.groupBy(F.col(score).cast("double").alias("_s")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg")))
    cum = running_sum_by_value(hist, "_s", "_neg", "_neg_below")
    return cum.agg(
        F.try_divide(F.sum(F.col("_pos").cast("double") * (F.col("_neg_below") + 0.5 * F.col("_neg"))),
                     F.sum("_pos").cast("double") * F.sum("_neg").cast("double")).alias("roc_auc"),
        F.sum("_pos").alias("n_pos"), F.sum("_neg").alias("n_neg"))


def regression_metrics(df: DataFrame, actual: str = "actual", pred: str = "prediction",
                       groups: Sequence[str] = ()) -> DataFrame:
    """V5: MSE, RMSE, MAE, R2, MAPE (rows with actual 0 are left out of MAPE)."""
    err = F.col(actual) - F.col(pred)
    aggs = [F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae"),
            F.sum(err * err).alias("_sse"), F.var_pop(actual).alias("_var"), F.count(F.lit(1)).alias("n"),
            (F.avg(F.when(F.col(actual) != 0, F.abs(err / F.col(actual)))) * 100).alias("mape")]
    g = df.groupBy(*groups).agg(*aggs) if groups else df.agg(*aggs)
    return (g.withColumn("rmse", F.sqrt("mse"))
            .withColumn("r2", F.when(F.col("_var") > 0, 1 - F.col("_sse") / (F.col("_var") * F.col("n"))))
            .drop("_sse", "_var"))


def residuals(df: DataFrame, actual: str = "actual", pred: str = "prediction") -> DataFrame:
    """V6: residual and absolute difference per row."""
    return (df.withColumn("residual", F.col(actual) - F.col(pred))
            .withColumn("abs_error", F.abs(F.col(actual) - F.col(pred))))


def category_aware_evaluation(df: DataFrame, horizons: Sequence[int]) -> DataFrame:
    """V7: per horizon, MAE of standard vs category-aware predictions and the improvement %.

    ``df`` holds target_{h}min, pred_{h}, adjusted_{h} columns (from R4). One
    aggregate computes every horizon; ``stack`` turns it into rows.
    """
    aggs = []
    for h in horizons:
        t = F.col(f"target_{h}min")
        aggs += [F.avg(F.abs(t - F.col(f"pred_{h}"))).alias(f"s_{h}"),
                 F.avg(F.abs(t - F.col(f"adjusted_{h}"))).alias(f"c_{h}")]
    wide = df.agg(*aggs)
    body = ", ".join(f"{h}, s_{h}, c_{h}" for h in horizons)
    out = wide.selectExpr(f"stack({len(horizons)}, {body}) AS (horizon_minutes, standard_mae, category_mae)")
    return out.withColumn("horizon_minutes", F.col("horizon_minutes").cast("int")).withColumn(
        "improvement_pct", F.when(F.col("standard_mae") != 0,
                                  (F.col("standard_mae") - F.col("category_mae")) / F.col("standard_mae") * 100))
