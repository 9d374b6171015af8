"""Query registry: each entry pairs a Spark query with its DuckDB oracle SQL.

Outputs are normalised the same way on both sides so that results can be
compared by value: timestamps become ``yyyy-MM-dd HH:mm:ss`` text, dates
``yyyy-MM-dd`` text, and doubles are rounded to 6 places.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROUND = 6


@dataclass
class Entry:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doubles: tuple[str, ...] = ()
    times: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    note: str = ""
    tags: tuple[str, ...] = field(default_factory=tuple)


REGISTRY: dict[str, Entry] = {}


def normalise(df: DataFrame) -> DataFrame:
    """Spark side of the comparison format."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), ROUND)
        out.append(c.alias(f.name))
    return df.select(*out)


def wrap_sql(sql: str, doubles=(), times=(), dates=()) -> str:
    """DuckDB side of the comparison format."""
    rep = [f"round(CAST({c} AS DOUBLE), {ROUND}) AS {c}" for c in doubles]
    rep += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in times]
    rep += [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates]
    if not rep:
        return sql.strip()
    return f"SELECT * REPLACE ({', '.join(rep)}) FROM (\n{sql.strip()}\n) AS _q"


def _split(s) -> tuple[str, ...]:
    if not s:
        return ()
    return tuple(s.split()) if isinstance(s, str) else tuple(s)


def query(name: str, sql: str | None = None, doubles="", times="", dates="", note=""):
    """Decorator registering ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn):
        REGISTRY[name] = Entry(name, fn, sql, _split(doubles), _split(times), _split(dates), note)
        return fn
    return deco


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from tidewater.session import configure

    def mk(e: Entry):
        def run(spark, sf_dir):
            configure(spark)  # UTC session zone: timestamps are naive UTC wall times
            return normalise(e.fn(spark, sf_dir))
        return run
    return {n: mk(e) for n, e in REGISTRY.items()}


def oracle_queries() -> dict[str, str]:
    return {n: wrap_sql(e.sql, e.doubles, e.times, e.dates)
            for n, e in REGISTRY.items() if e.sql}
