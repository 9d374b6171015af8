"""Descriptive reports over traffic tables.

Every report is a grouped aggregate or a window partitioned by a data key; the
only driver-side values are scalars (a global count, the latest dates), and
they reach the plan as broadcast one-row joins, not as collected Python values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import timefn


def hourly_summary(df: DataFrame, date_col: str = "date", hour_col: str = "hour",
                   value: str = "tpm", count_col: str = "play_counted") -> DataFrame:
    """A1: mean/max/min of the value and max of the count per (date, hour), half-even rounded."""
    return (df.groupBy(date_col, hour_col)
            .agg(F.bround(F.avg(value), 0).alias("tpm_mean"),
                 F.bround(F.max(value), 0).alias("tpm_max"),
                 F.bround(F.min(value), 0).alias("tpm_min"),
                 F.max(count_col).alias("play_counted_max")))


def frequency_table(df: DataFrame, key: str, pct_name: str = "pct") -> DataFrame:
    """A2: count and percent of total per key, most frequent first (ties by key)."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))
    return (counts.crossJoin(F.broadcast(total))  # one-row total
            .withColumn(pct_name, F.col("n") * F.lit(100.0) / F.col("_total"))
            .drop("_total").orderBy(F.col("n").desc(), F.col(key)))


def ordered_frequency(df: DataFrame, key: str) -> DataFrame:
    """A3: count per key in key order."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(key)


def global_profile(df: DataFrame, value: str, ts: str | None = None) -> DataFrame:
    """A4: min, max, mean, count (and time range) of one column in a single pass."""
    aggs = [F.min(value).alias("min_value"), F.max(value).alias("max_value"),
            F.avg(value).alias("mean_value"), F.count(value).alias("n")]
    if ts:
        aggs += [F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
                 (timefn.minutes_between(F.min(ts), F.max(ts)) / 60.0).alias("range_hours")]
    return df.agg(*aggs)


def daily_summary(df: DataFrame, date_col: str = "date", value: str = "tpm",
                  count_col: str = "play_counted") -> DataFrame:
    """A5: per day: records, max/min/mean value, play-count range."""
    return (df.groupBy(date_col)
            .agg(F.count(F.lit(1)).alias("records"),
                 F.max(value).alias("tpm_max"), F.min(value).alias("tpm_min"),
                 F.avg(value).alias("tpm_mean"),
                 F.min(count_col).alias("play_min"), F.max(count_col).alias("play_max")))


def category_interval_stats(df: DataFrame, key: str, interval: str) -> DataFrame:
    """Count and mean interval per category (one grouped pass, not a loop)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"),
                               F.avg(interval).alias("avg_interval"))


def distinct_dates(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Distinct dates with day names."""
    return (df.select(F.to_date(ts).alias("date")).distinct()
            .withColumn("day_name", timefn.day_name("date")).orderBy("date"))


def latest_dates(df: DataFrame, n: int = 2, date_col: str = "date") -> DataFrame:
    """The n latest distinct dates (TakeOrderedAndProject on distinct keys)."""
    return df.select(date_col).distinct().orderBy(F.col(date_col).desc()).limit(n)


def keep_dates(df: DataFrame, dates: DataFrame, date_col: str = "date") -> DataFrame:
    """Left semi join on a short date list (n rows, broadcast)."""
    return df.join(F.broadcast(dates), date_col, "left_semi")


def top_n_per_group(df: DataFrame, group, order: Sequence[Column], n: int,
                    rank_col: str = "rank") -> DataFrame:
    """First n rows per group in ``order`` (row_number, planned as WindowGroupLimit)."""
    group = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def numeric_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, std, min, quartiles, max per column, long form.

    Quartiles are exact, not ``summary()``'s approximate text; the columns share every pass.
    """
    from tidewater.operators.quantiles import column_quantiles
    values = [[F.count(c), F.avg(c), F.stddev_samp(c), F.min(c).cast("double"), F.max(c).cast("double")] for c in cols]
    names = ("count", "mean", "std", "min", "max")
    sums = df.agg(*[v.alias(f"{n}_{i}") for i, of in enumerate(values) for n, v in zip(names, of, strict=True)])
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"{n}_{i}").alias(n) for n in names])
                               for i, c in enumerate(cols)]))
    found = column_quantiles(df, cols, [0.25, 0.5, 0.75])  # a literal table of three rows a column
    quartiles = found.groupBy("column").agg(*[F.max(F.when(F.col("q_index") == i, F.col("value"))).alias(n)
                                              for i, n in enumerate(("p25", "p50", "p75"))])
    return (sums.select(each.alias("_e")).select("_e.*").join(F.broadcast(quartiles), "column")
            .select("column", "count", "mean", "std", "min", "max", "p25", "p50", "p75"))


def null_counts(df: DataFrame) -> DataFrame:
    """Null count per column (one pass), long form with the row count."""
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n_{i}")
                   for i, c in enumerate(df.columns)])
    stack = ", ".join(f"'{c}', n_{i}" for i, c in enumerate(df.columns))
    return agg.selectExpr("_rows AS n_rows",
                          f"stack({len(df.columns)}, {stack}) AS (column, null_count)")


def daily_normalised(df: DataFrame, value: str = "tpm", count_col: str = "play_counted",
                     date_col="date") -> DataFrame:
    """Min-max normalise the count per day, scaled by the day's max value."""
    w = Window.partitionBy(*([date_col] if isinstance(date_col, str) else date_col))
    lo, hi = F.min(count_col).over(w), F.max(count_col).over(w)
    return df.withColumn("play_normalized",
                         F.try_divide((F.col(count_col) - lo).cast("double"), (hi - lo).cast("double"))
                         * F.max(value).over(w))
