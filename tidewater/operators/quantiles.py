"""Exact linear-interpolated quantiles of many columns, groups and probabilities at once.

``percentile`` keeps a value -> count map of a whole group in one aggregate
buffer, which does not survive a column of 10^12 rows. Here every needed order
statistic is closed in on by *cells*: ranges of values of one (group, column)
that hold a needed rank. One pass over the data finds n, minimum and maximum of
every (group, column), its first cell. While a cell holds more than
``CELL_ROWS`` rows of different values, a pass counts its rows in ``BUCKETS``
sub-ranges and keeps those that hold a rank, with their own least and greatest
value. These are always in different sub-ranges, so a cell gets smaller with
every pass wherever its values crowd: an outlier costs one pass, not one task.
A last pass counts the distinct values of the cells that are left, each of at
most ``CELL_ROWS`` rows, and reads the ranks off them. All columns, groups and
probabilities share each pass.

Numpy / DuckDB ``quantile_cont`` semantics: rank h = p * (n - 1),
value = x[floor h] + (h - floor h) * (x[ceil h] - x[floor h]). NULL and NaN are
no values; a null group is a group; a group without values has null quantiles.

Without groups there are at most two cells a column and probability, so they
are written into the expressions and the result is a literal table; with groups
cells are a table, checkpointed and joined, and the result is lazy.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import materialize

#: Sub-ranges of a cell in one pass.
BUCKETS = 4096
#: Rows that a cell may hold when its distinct values are counted, and so that a window task may get of it.
CELL_ROWS = 100_000


def _is_crowded() -> Column:
    return (F.col("_n") > CELL_ROWS) & (F.col("_lo") < F.col("_hi"))


class _Table:
    """Cells of any number of groups: a table, joined to the rows."""

    def __init__(self, df: DataFrame):
        self.df = materialize(df)

    def crowded(self) -> _Table | None:
        found = _Table(self.df.where(_is_crowded()))
        return None if found.df.isEmpty() else found

    def settled_and(self, narrowed: DataFrame) -> _Table:
        return _Table(self.df.where(~_is_crowded()).unionByName(narrowed))

    def one_value(self) -> DataFrame:
        return self.df.where("_lo = _hi")

    def mixed(self) -> _Table:
        return _Table(self.df.where("_lo < _hi"))

    def inside(self, values: DataFrame) -> DataFrame:
        of_key = self.df.select(F.col("_k").alias("_ck"), "_lo", "_hi")
        held = (F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi"))
        return values.join(of_key, F.col("_k").eqNullSafe(F.col("_ck")) & held).select("_k", "_x", "_lo", "_hi")

    def with_parents(self, counted: DataFrame) -> DataFrame:
        parents = self.df.select(F.col("_k").alias("_ck"), F.col("_lo").alias("_clo"), F.col("_before").alias("_base"), "_need")
        return counted.join(parents, F.col("_k").eqNullSafe(F.col("_ck")) & (F.col("_plo") == F.col("_clo"))).drop("_ck", "_clo")


class _Literals:
    """Cells of columns without groups: at most two a column and probability, written into the expressions."""

    def __init__(self, df: DataFrame, rows: list | None = None):
        self.df, self.schema = df, df.schema
        self.rows = df.collect() if rows is None else rows

    def _of(self, rows: list) -> _Literals:
        return _Literals(self.df, rows)

    def crowded(self) -> _Literals | None:
        found = [r for r in self.rows if r["_n"] > CELL_ROWS and r["_lo"] < r["_hi"]]
        return self._of(found) if found else None

    def settled_and(self, narrowed: DataFrame) -> _Literals:
        return self._of([r for r in self.rows if not (r["_n"] > CELL_ROWS and r["_lo"] < r["_hi"])] + narrowed.collect())

    def one_value(self) -> DataFrame:
        return self.df.sparkSession.createDataFrame([r for r in self.rows if r["_lo"] == r["_hi"]], self.schema)

    def mixed(self) -> _Literals:
        return self._of([r for r in self.rows if r["_lo"] < r["_hi"]])

    def _case(self, meets, value) -> Column:
        out = F.when(F.lit(False), value(self.rows[0])) if self.rows else F.lit(None)
        for r in self.rows:
            out = out.when((F.col("_k._c") == r["_k"]["_c"]) & meets(r), value(r))
        return out

    def inside(self, values: DataFrame) -> DataFrame:
        if not self.rows:
            return values.select("_k", "_x", F.col("_x").alias("_lo"), F.col("_x").alias("_hi")).limit(0)
        number = {id(r): i for i, r in enumerate(self.rows)}
        own = values.withColumn("_i", self._case(lambda r: F.col("_x").between(r["_lo"], r["_hi"]), lambda r: F.lit(number[id(r)])))
        bound = [F.get(F.array(*[F.lit(r[c]) for r in self.rows]), F.col("_i")).alias(c) for c in ("_lo", "_hi")]
        return own.where("_i IS NOT NULL").select("_k", "_x", *bound)

    def with_parents(self, counted: DataFrame) -> DataFrame:
        if not self.rows:
            return counted.withColumns({"_base": F.lit(0).cast("long"), "_need": F.array().cast("array<bigint>")})
        own = self._case(lambda r: F.col("_plo") == r["_lo"], lambda r: F.struct(
            F.lit(r["_before"]).cast("long").alias("_base"), F.array(*[F.lit(n).cast("long") for n in r["_need"]]).alias("_need")))
        return counted.withColumn("_own", own).select("*", "_own.*").drop("_own")


def _long(df: DataFrame, cols: Sequence[str], groups: Sequence[str]) -> DataFrame:
    """(_k: group columns and column number, _x) of every value."""
    if len(cols) == 1:
        one = df.select(F.struct(*groups, F.lit(0).alias("_c")).alias("_k"), F.col(cols[0]).cast("double").alias("_x"))
    else:
        each = F.array(*[F.struct(F.lit(i).alias("_c"), F.col(c).cast("double").alias("_x")) for i, c in enumerate(cols)])
        one = (df.select(*groups, F.explode(each).alias("_e"))
               .select(F.struct(*groups, "_e._c").alias("_k"), F.col("_e._x").alias("_x")))
    return one.where(F.col("_x").isNotNull() & ~F.isnan("_x"))


def _sub_range(x: Column, lo: Column, hi: Column) -> Column:
    """Number of x's sub-range; lo and hi are always in the first and the last one, whatever the width."""
    width = hi / 2 - lo / 2  # halves, for the difference of two doubles can pass the largest
    share = (x / 2 - lo / 2) / width
    inner = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1))
    finite = (F.abs(lo) < float("inf")) & (F.abs(hi) < float("inf")) & (width > 0)
    return F.when(x == lo, 0).when(x == hi, BUCKETS - 1).when(finite, inner).otherwise(BUCKETS // 2).cast("int")


def _with_ranks(counted: DataFrame, cells: _Table | _Literals, order: str) -> DataFrame:
    """Counted parts of cells that hold needed ranks: ``_before`` (rows below them), ``_need`` (the ranks)."""
    below = Window.partitionBy("_k", "_plo").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.with_parents(counted.withColumn("_below", F.coalesce(F.sum("_n").over(below), F.lit(0))))
    placed = placed.withColumn("_before", F.col("_base") + F.col("_below"))
    held = F.filter("_need", lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_n")))
    return placed.withColumn("_need", held).where(F.size("_need") > 0)


def _narrowed(values: DataFrame, cells: _Table | _Literals) -> DataFrame:
    """The cells that one pass makes of crowded ones."""
    counted = (cells.inside(values)
               .groupBy("_k", F.col("_lo").alias("_plo"), _sub_range(F.col("_x"), F.col("_lo"), F.col("_hi")).alias("_b"))
               .agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")))
    return _with_ranks(counted, cells, "_b").select("_k", "_lo", "_hi", "_n", "_before", "_need")


def _order_statistics(values: DataFrame, cells: _Table | _Literals) -> DataFrame:
    """(_k, _rank, _value) of every needed rank; no cell is crowded any more."""
    single = cells.one_value().select("_k", F.explode("_need").alias("_rank"), F.col("_lo").alias("_value"))
    mixed = cells.mixed()
    counted = (mixed.inside(values).groupBy("_k", F.col("_lo").alias("_plo"), "_x").agg(F.count(F.lit(1)).alias("_n")))
    found = _with_ranks(counted, mixed, "_x").select("_k", F.explode("_need").alias("_rank"), F.col("_x").alias("_value"))
    return single.unionByName(found)


def _first_cells(values: DataFrame, probs: Sequence[float]) -> DataFrame:
    last = F.col("_n") - 1
    heights = F.array(*[F.lit(p) * last for p in probs])
    need = F.array_distinct(F.concat(F.transform(heights, lambda h: F.floor(h)), F.transform(heights, lambda h: F.ceil(h))))
    stats = values.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    return stats.select("_k", "_lo", "_hi", "_n", F.lit(0).cast("long").alias("_before"), need.alias("_need"))


def _between(low: float, high: float, share: float) -> float:
    return low if low == high else low + share * (high - low)


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                     groups: Sequence[str] = ()) -> DataFrame:
    """Rows (``*groups``, column, q_index, p, value): exact quantiles of every column of every group."""
    cols, groups, probs = list(cols), list(groups), [float(p) for p in probs]
    values = _long(df, cols, groups)
    first = (_Table if groups else _Literals)(_first_cells(values, probs))
    cells = first
    while (crowded := cells.crowded()) is not None:
        cells = cells.settled_and(_narrowed(values, crowded))
    at = _order_statistics(values, cells)
    if not groups:
        return _literal_table(df, cols, probs, first, at)
    by_key = at.groupBy(F.col("_k").alias("_ck")).agg(
        F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_at"))
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("q_index"), F.lit(p).alias("p")) for i, p in enumerate(probs)]))
    asked = (first.df.join(by_key, F.col("_k").eqNullSafe(F.col("_ck"))).select("_k", "_n", "_at", each.alias("_q"))
             .withColumn("_h", F.col("_q.p") * (F.col("_n") - 1)))
    low, high = F.try_element_at("_at", F.floor("_h")), F.try_element_at("_at", F.ceil("_h"))
    value = F.when(low == high, low).otherwise(low + (F.col("_h") - F.floor("_h")) * (high - low))
    return asked.select(*[F.col(f"_k.{g}").alias(g) for g in groups],
                        F.get(F.array(*[F.lit(c) for c in cols]), F.col("_k._c")).alias("column"), "_q.q_index", "_q.p",
                        value.alias("value"))


def _literal_table(df: DataFrame, cols: list[str], probs: list[float], first: _Literals, at: DataFrame) -> DataFrame:
    sizes = {r["_k"]["_c"]: r["_n"] for r in first.rows}
    found = {(r["_k"]["_c"], r["_rank"]): r["_value"] for r in at.collect()}
    rows = []
    for c, name in enumerate(cols):
        for i, p in enumerate(probs):
            h = p * (sizes.get(c, 0) - 1)
            value = _between(found[c, math.floor(h)], found[c, math.ceil(h)], h - math.floor(h)) if c in sizes else None
            rows.append((name, i, p, value))
    return df.sparkSession.createDataFrame(rows, "column string, q_index int, p double, value double")


def global_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> list[float | None]:
    """Exact quantiles of a whole column as Python floats."""
    return [r["value"] for r in column_quantiles(df, [col], probs).orderBy("q_index").collect()]


def quantiles(df: DataFrame, col: str, probs: Sequence[float], groups: Sequence[str] = ()) -> DataFrame:
    """Rows (``*groups``, q_index, p, value) with exact quantiles of ``col``."""
    return column_quantiles(df, [col], probs, groups).drop("column")


def quantile_row(df: DataFrame, col: str, probs: Sequence[float], names: Sequence[str],
                 groups: Sequence[str] = ()) -> DataFrame:
    """Wide form: one row per group, one column per probability."""
    return quantile_columns(df, {n: (col, p) for n, p in zip(names, probs, strict=True)}, groups)


def quantile_columns(df: DataFrame, wanted: dict[str, tuple[str, float]], groups: Sequence[str] = ()) -> DataFrame:
    """One row (per group) with a column for each ``name: (column, probability)``, from shared passes."""
    cols = list(dict.fromkeys(c for c, _ in wanted.values()))
    probs = list(dict.fromkeys(p for _, p in wanted.values()))
    found = column_quantiles(df, cols, probs, groups)
    picked = [F.max(F.when((F.col("column") == c) & (F.col("q_index") == probs.index(p)), F.col("value"))).alias(n)
              for n, (c, p) in wanted.items()]
    return found.groupBy(*groups).agg(*picked) if groups else found.agg(*picked)
