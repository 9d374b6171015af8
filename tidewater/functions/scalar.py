"""Scalar decision and arithmetic functions.

Each returns a Column; decision tables are nested ``when`` chains, so they run
inside whole-stage codegen with no Python on the row path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Collection-strategy decision table of the reference.
# (max hours, period seconds, points per hour, ml weight, strategy name)
RECENT_RULES = [
    (3, 60, 60, 10, "1min_granularity"),
    (6, 120, 30, 9, "2min_granularity"),
    (14, 300, 12, 8, "5min_granularity"),
    (24, 600, 6, 7, "10min_granularity"),
    (96, 1800, 2, 6, "30min_granularity"),
    (None, 3600, 1, 5, "1hour_granularity"),
]
# (max hours, period seconds, hours per point, ml weight, strategy name);
# the first row has no period (the service picks 10 points).
HISTORICAL_RULES = [
    (96, None, None, 4, "10_evenly_spaced_points"),
    (168, 3600, 1, 3, "1hour_intervals"),
    (504, 10800, 3, 2, "3hour_intervals"),
    (1008, 21600, 6, 2, "6hour_intervals"),
    (1512, 43200, 12, 1, "12hour_intervals"),
    (None, 259200, 72, 1, "3day_intervals"),
]
RECENT_AGE_DAYS = 8


def _chain(hours: Column, rules, recent: bool) -> Column:
    out = None
    for max_h, period, factor, weight, name in reversed(rules):
        if recent:
            points = (hours * F.lit(float(factor))).cast("int")
        elif factor is None:
            points = F.lit(10)
        else:
            points = (hours / F.lit(float(factor))).cast("int")
        val = F.struct(F.lit(period).cast("int").alias("period_seconds"),
                       points.alias("expected_points"),
                       F.lit(weight).alias("ml_weight"),
                       F.lit(name).alias("collection_strategy"))
        out = val if out is None else F.when(hours <= F.lit(float(max_h)), val).otherwise(out)
    return out


def granularity_strategy(time_range_hours, data_age_days) -> Column:
    """struct(period_seconds, expected_points, ml_weight, collection_strategy)."""
    h = _c(time_range_hours).cast("double")
    age = _c(data_age_days)
    return F.when(age <= RECENT_AGE_DAYS, _chain(h, RECENT_RULES, True)) \
        .otherwise(_chain(h, HISTORICAL_RULES, False))


def effective_weight(week_priority, ml_weight) -> Column:
    """F10."""
    return F.greatest(_c(week_priority), _c(ml_weight))


def quality_band(weight) -> Column:
    """>=8 high, >=5 medium, else low."""
    w = _c(weight)
    return F.when(w >= 8, "high").when(w >= 5, "medium").otherwise("low")


def is_recent(age_days, limit: int = RECENT_AGE_DAYS) -> Column:
    """F12."""
    return F.when(_c(age_days) <= limit, 1).otherwise(0)


def granularity_columns(requested_period_seconds, interval_minutes) -> dict[str, Column]:
    """granularity in minutes (falls back to the observed interval), flags, category."""
    period = F.coalesce(_c(requested_period_seconds).cast("double"),
                        _c(interval_minutes) * F.lit(60.0))
    return {
        "granularity_minutes": period / F.lit(60.0),
        "is_high_granularity": F.when(period <= 300, 1).otherwise(0),
        "is_fine_granularity": F.when(period <= 120, 1).otherwise(0),
        "granularity_category": F.when(period <= 60, "minute")
        .when(period <= 600, "multi_minute")
        .when(period <= 3600, "hourly")
        .otherwise("multi_hour"),
    }


def non_negative(c) -> Column:
    """F14."""
    return F.greatest(F.lit(0.0), _c(c).cast("double"))


def label_from_probability(p, threshold: float = 0.7) -> Column:
    """'High' when probability > threshold, else 'Normal'."""
    return F.when(_c(p) > threshold, "High").otherwise("Normal")


def percent_difference(base, other) -> Column:
    """F16: (other - base) / base * 100; NULL when base is 0 or NULL."""
    b, o = _c(base), _c(other)
    return F.when(b != 0, (o - b) / b * F.lit(100.0))


def round_half_even(c, scale: int = 0) -> Column:
    """F17."""
    return F.bround(_c(c), scale)


def lags_from_list(values, current, n: int = 5) -> dict[str, Column]:
    """previous-values array (newest first) -> lag columns, current value past the end."""
    arr = _c(values)
    return {f"tpm_lag_{i + 1}": F.coalesce(F.get(arr, i), _c(current)).cast("double")
            for i in range(n)}


def mean_of_first(values, n: int) -> Column:
    """mean of the first n entries (the n newest); NULL for an empty list."""
    head = F.slice(_c(values), 1, n)
    total = F.aggregate(head, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return F.when(F.size(head) > 0, total / F.size(head))


def post_push_flag(minutes_since_push, limit: int = 45) -> Column:
    """F20."""
    return F.when(_c(minutes_since_push) <= limit, 1).otherwise(0)


# Category-aware adjustment factors.
HIGH_OFF_PEAK = 0.9      # high category, neither peak hour nor peak day
LOW_AT_PEAK = 1.15       # low category, peak hour and peak day
MEDIUM_AT_PEAK = 1.05    # medium category, peak hour and peak day
MEDIUM_OFF_PEAK = 0.95   # medium category, neither


def category_adjustment(category, is_peak_hour, is_peak_day) -> Column:
    """multiplier from the (category, peak hour, peak day) rule."""
    cat, ph, pd_ = _c(category), _c(is_peak_hour) == 1, _c(is_peak_day) == 1
    return (F.when((cat == "high") & ~(ph | pd_), HIGH_OFF_PEAK)
            .when((cat == "low") & (ph & pd_), LOW_AT_PEAK)
            .when((cat == "medium") & (ph & pd_), MEDIUM_AT_PEAK)
            .when((cat == "medium") & ~(ph | pd_), MEDIUM_OFF_PEAK)
            .otherwise(1.0))


def any_changed(pairs) -> Column:
    """1 when any (standard, adjusted) pair differs."""
    cond = None
    for a, b in pairs:
        c = _c(a) != _c(b)
        cond = c if cond is None else (cond | c)
    return F.when(cond, 1).otherwise(0)


# Documented push boost per horizon in minutes (20 to 30 share one factor).
PUSH_BOOST = {5: 1.2, 10: 1.4, 15: 1.5}
PUSH_BOOST_20_TO_30 = 1.3


def push_boost(horizon_minutes) -> Column:
    """Boost factor for a forecast horizon while a push is active."""
    h = _c(horizon_minutes)
    out = F.when((h >= 20) & (h <= 30), PUSH_BOOST_20_TO_30).otherwise(1.0)
    for minutes, factor in sorted(PUSH_BOOST.items(), reverse=True):
        out = F.when(h == minutes, factor).otherwise(out)
    return out
