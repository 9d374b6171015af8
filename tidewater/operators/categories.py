"""Thresholds, traffic categories and peak times.

Thresholds are exact quantiles (``quantiles``); they stay one-row DataFrames
that are broadcast into the labelling step, so no Python value round-trips.
Bins are right-closed with the lowest edge included, as the reference's
``cut(..., include_lowest=True)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import scalar
from tidewater.operators.quantiles import quantile_row

# Category names for three bins and the day names, Monday first.
THREE_LABELS = ("low", "medium", "high")
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def labels_for(n: int) -> list[str]:
    return list(THREE_LABELS) if n == 3 else [f"category_{i + 1}" for i in range(n)]


def threshold(df: DataFrame, col: str = "tpm", percentile: float = 75.0) -> DataFrame:
    """One-row DataFrame with the exact quantile ``threshold``."""
    return quantile_row(df, col, [percentile / 100.0], ["threshold"])


def edges(df: DataFrame, col: str = "tpm", n: int = 3) -> DataFrame:
    """One row with edge_0 .. edge_n at probabilities linspace(0, 1, n + 1)."""
    probs = [i / n for i in range(n + 1)]
    return quantile_row(df, col, probs, [f"edge_{i}" for i in range(n + 1)])


def high_label(df: DataFrame, col: str = "tpm", percentile: float = 75.0,
               out: str = "is_high_tpm") -> DataFrame:
    """Flag rows >= the exact percentile; keeps the threshold as a column."""
    t = threshold(df, col, percentile)
    return (df.crossJoin(F.broadcast(t))  # one-row threshold table
            .withColumn(out, F.when(F.col(col) >= F.col("threshold"), 1).otherwise(0)))


def category_expr(col: str, n: int, labels) -> Column:
    """Right-closed bins (edge_{i-1}, edge_i], first bin includes edge_0."""
    x = F.col(col)
    expr = None
    for i in range(n, 0, -1):
        cond = (x >= F.col("edge_0")) & (x <= F.col(f"edge_{i}")) if i == 1 else \
            (x > F.col(f"edge_{i - 1}")) & (x <= F.col(f"edge_{i}"))
        expr = F.when(cond, labels[i - 1]) if expr is None else F.when(cond, labels[i - 1]).otherwise(expr)
    return expr


def categorise(df: DataFrame, col: str = "tpm", n: int = 3, out: str = "tpm_category",
               thresholds: DataFrame | None = None) -> DataFrame:
    """A10: n-way quantile categories; ``thresholds`` from a training set if given."""
    e = thresholds if thresholds is not None else edges(df, col, n)
    labels = labels_for(n)
    return (df.crossJoin(F.broadcast(e))  # one-row edge table
            .withColumn(out, category_expr(col, n, labels))
            .drop(*[f"edge_{i}" for i in range(n + 1)]))


def category_stats(df: DataFrame, col: str = "tpm", cat: str = "tpm_category") -> DataFrame:
    """Count, percent, mean, min, max per category (one grouped pass)."""
    per = df.groupBy(cat).agg(F.count(F.lit(1)).alias("count"), F.avg(col).alias("mean_tpm"),
                              F.min(col).alias("min_tpm"), F.max(col).alias("max_tpm"))
    total = per.agg(F.sum("count").alias("_total"))
    return (per.crossJoin(F.broadcast(total))  # one-row total
            .withColumn("percentage", F.col("count") * F.lit(100.0) / F.col("_total")).drop("_total"))


def category_pivot(df: DataFrame, by: str, n: int = 3, cat: str = "tpm_category") -> DataFrame:
    """Counts of ``by`` x category, one column per category, 0-filled (values given)."""
    labels = labels_for(n)
    return df.groupBy(by).pivot(cat, labels).count().na.fill(0, subset=labels)


def category_heatmap(df: DataFrame, hour: str = "hour", day: str = "day_of_week",
                     cat: str = "tpm_category") -> DataFrame:
    """Percent of the category's rows in each (hour, day), long form."""
    counts = df.groupBy(cat, hour, day).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(cat)  # one row per (cat, hour, day): at most 168 rows per category
    return counts.withColumn("pct", F.col("n") * F.lit(100.0) / F.sum("n").over(w))


def peak_times(df: DataFrame, hour: str = "hour", day: str = "day_of_week",
               cat: str = "tpm_category", top_hours: int = 3, top_days: int = 2) -> DataFrame:
    """T4: top hours and top days per category by count; ties keep the smaller key.

    Long form: (tpm_category, kind 'hour'|'day', key, count, rank). One pass
    counts (category, hour, day) -- at most 168 rows per category -- and both
    rankings are taken from that small table.
    """
    cells = df.groupBy(cat, hour, day).agg(F.count(F.lit(1)).alias("_n"))

    def top(key: str, k: int, kind: str) -> DataFrame:
        c = cells.groupBy(cat, key).agg(F.sum("_n").alias("count"))
        w = Window.partitionBy(cat).orderBy(F.col("count").desc(), F.col(key))
        return (c.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
                .select(cat, F.lit(kind).alias("kind"), F.col(key).alias("key"), "count", "rank"))
    return top(hour, top_hours, "hour").unionByName(top(day, top_days, "day"))


def assign_category(df: DataFrame, thresholds: DataFrame, col: str = "current_tpm",
                    out: str = "tpm_category", n: int = 3) -> DataFrame:
    """Category of a value from saved thresholds (<= low_to_medium -> low, ..., else the last one).

    The outer categories are open: a value outside the fitted range has one too. A null has none.
    """
    inner = [f"edge_{i}" for i in range(1, n)]
    labels = labels_for(n)
    x = F.col(col)
    label = F.when(x.isNull(), F.lit(None).cast("string"))
    for edge, name in zip(inner, labels, strict=False):
        label = label.when(x <= F.col(edge), name)
    return (df.crossJoin(F.broadcast(thresholds.select(*inner)))  # one-row threshold table
            .withColumn(out, label.otherwise(labels[-1])).drop(*inner))


def peak_flags(df: DataFrame, peaks: DataFrame, cat: str = "tpm_category",
               hour: str = "hour", day: str = "day_of_week") -> DataFrame:
    """Is (category, hour) / (category, day) among the category's peaks -> 0/1 flags.

    ``peaks`` is the T4 table: at most (3 + 2) rows per category, broadcast.
    """
    ph = peaks.filter(F.col("kind") == "hour").select(F.col(cat).alias("_c"), F.col("key").alias("_h"),
                                                      F.lit(1).alias("is_peak_hour"))
    pd_ = peaks.filter(F.col("kind") == "day").select(F.col(cat).alias("_c2"), F.col("key").alias("_d"),
                                                      F.lit(1).alias("is_peak_day"))
    out = (df.join(F.broadcast(ph), (F.col(cat) == F.col("_c")) & (F.col(hour) == F.col("_h")), "left")
           .join(F.broadcast(pd_), (F.col(cat) == F.col("_c2")) & (F.col(day) == F.col("_d")), "left"))
    return (out.withColumn("is_peak_hour", F.coalesce("is_peak_hour", F.lit(0)))
            .withColumn("is_peak_day", F.coalesce("is_peak_day", F.lit(0)))
            .drop("_c", "_h", "_c2", "_d"))


def adjust_predictions(df: DataFrame, horizons, cat: str = "tpm_category") -> DataFrame:
    """F21 + F22: category-aware adjusted prediction per horizon and the 'applied' flag."""
    f = scalar.category_adjustment(cat, "is_peak_hour", "is_peak_day")
    df = df.withColumn("adjustment_factor", f)
    for h in horizons:
        df = df.withColumn(f"adjusted_{h}", F.col(f"pred_{h}") * F.col("adjustment_factor"))
    return df.withColumn("adjustment_applied",
                         scalar.any_changed([(f"pred_{h}", f"adjusted_{h}") for h in horizons]))
