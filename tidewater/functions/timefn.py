"""Time functions.

All work on naive ``timestamp_ntz`` values; UTC instants are converted with
``convert_timezone`` so the result stays naive local time.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reference's alternative text layout and peak hours.
DAY_FIRST_FORMAT = "dd/MM/yyyy HH:mm"
PEAK_HOURS = (0, 1, 9, 10, 12, 13, 19, 20)
LOCAL_ZONE = "Asia/Bangkok"  # GMT+7, no daylight saving


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c, alt_format: str = DAY_FIRST_FORMAT) -> Column:
    """ISO 8601 first, then the day-first layout; NULL when neither parses."""
    c = _c(c).cast("string")
    parsed = F.coalesce(F.try_to_timestamp(c), F.try_to_timestamp(c, F.lit(alt_format)))
    return parsed.cast("timestamp_ntz")


def utc_to_local(c, zone: str = LOCAL_ZONE) -> Column:
    """naive UTC wall time -> naive local wall time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _c(c))


def day_of_week(c) -> Column:
    """Monday=0 .. Sunday=6 (not ``dayofweek``, which is Sunday=1)."""
    return F.weekday(_c(c))


def is_weekend(c) -> Column:
    return F.when(day_of_week(c) >= 5, 1).otherwise(0)


def calendar_columns(c) -> dict[str, Column]:
    """hour, minute, day_of_week, is_weekend."""
    return {"hour": F.hour(_c(c)), "minute": F.minute(_c(c)),
            "day_of_week": day_of_week(c), "is_weekend": is_weekend(c)}


def day_name(c) -> Column:
    """English day name."""
    return F.date_format(_c(c), "EEEE")


def hour_minute_text(c) -> Column:
    """``HH:mm``."""
    return F.date_format(_c(c), "HH:mm")


def time_of_day(c) -> Column:
    """fractional hour."""
    return F.hour(_c(c)) + F.minute(_c(c)) / F.lit(60.0)


def cyclic(value, period: float) -> tuple[Column, Column]:
    """(sin, cos) of 2*pi*value/period."""
    angle = F.lit(2 * math.pi) * _c(value) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def is_peak_hour(hour_col) -> Column:
    """1 inside the fixed peak hours, else 0."""
    return F.when(_c(hour_col).isin(*PEAK_HOURS), 1).otherwise(0)


def minutes_between(start, end) -> Column:
    """F8: (end - start) in minutes as double."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(60_000_000.0)


def in_weekly_window(c, start_dow: int = 2, start_hour: int = 23,
                     end_dow: int = 6, end_hour: int = 1) -> Column:
    """G1: weekly hour window, default Wednesday 23:00 to Sunday 01:00 (end excluded).

    Position in the week is measured in hours from Monday 00:00.
    """
    pos = day_of_week(c) * 24 + F.hour(_c(c))
    return (pos >= start_dow * 24 + start_hour) & (pos < end_dow * 24 + end_hour)


def week_of_year(c) -> Column:
    """ISO week number."""
    return F.weekofyear(_c(c))


def minutes_since_daily_time(c, hour: int = 11, minute: int = 0) -> Column:
    """Minutes since today's push time (negative before it)."""
    day_start = F.date_trunc("day", _c(c))
    push = day_start + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0),
                                       F.lit(hour), F.lit(minute), F.lit(0))
    return minutes_between(push, _c(c))
