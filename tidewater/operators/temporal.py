"""Ordered-series window operators (W1-W14, J4) that scale past one task per series.

A plain ``Window.partitionBy(series).orderBy(ts)`` puts a whole series into one
task. Here every window is evaluated per (series, bucket) -- a bucket is a day
by default -- and each bucket is given a *halo*: copies of the K rows just
before it (and L rows just after it, for leads). Because every bucket keeps its
own last K rows in a small "tails" table, the K rows before any bucket always
sit inside the tails of earlier buckets, so the halo is exact even when
buckets are short or empty. Halo rows take part in the frame and are dropped
afterwards.

Cumulative operators (running sums, global sequence numbers, back-fill) use
the same idea with per-bucket totals: a small table of bucket aggregates gives
each bucket its offset, which is joined back.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLK, HALO = "_blk", "_halo"


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def add_bucket(df: DataFrame, ts: str, unit: str = "day") -> DataFrame:
    """Default bucket: the truncated timestamp (day)."""
    return df.withColumn(BLK, F.date_trunc(unit, F.col(ts)))


def _edge_rows(df: DataFrame, keys, order, n: int, tail: bool) -> DataFrame:
    spec = [F.col(c).desc() for c in order] if tail else [F.col(c).asc() for c in order]
    w = Window.partitionBy(*keys, BLK).orderBy(*spec)
    # row_number <= n is planned as WindowGroupLimit: rows are pruned before the shuffle
    return df.withColumn("_e", F.row_number().over(w)).filter(F.col("_e") <= n).drop("_e")


def halo_frame(df: DataFrame, keys, order, before: int, after: int = 0) -> DataFrame:
    """Own rows (``_halo=0``) plus halo copies (``_halo=1``) keyed by ``_blk``.

    ``df`` must already carry the ``_blk`` bucket column.
    """
    keys, order = _cols(keys), _cols(order)
    cols = [c for c in df.columns if c != BLK]
    parts = [df.withColumn(HALO, F.lit(0))]
    wk = Window.partitionBy(*keys).orderBy(BLK, *order)
    for n, tail in ((before, True), (after, False)):
        if n <= 0:
            continue
        edge = _edge_rows(df, keys, order, n, tail).withColumn("_row", F.struct(*cols))
        frame = wk.rowsBetween(-n, -1) if tail else wk.rowsBetween(1, n)
        edge = edge.withColumn("_nb", F.collect_list("_row").over(frame))
        # the first (tail) / last (head) edge row of each bucket carries the halo
        pick_spec = [F.col(c).asc() for c in order] if tail else [F.col(c).desc() for c in order]
        pick = Window.partitionBy(*keys, BLK).orderBy(*pick_spec)
        halo = (edge.withColumn("_p", F.row_number().over(pick)).filter(F.col("_p") == 1)
                .select(F.col(BLK), F.explode("_nb").alias("_r"))
                .select(F.col(BLK), "_r.*").withColumn(HALO, F.lit(1)))
        parts.append(halo.select(*df.columns, HALO))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


BUCKET_SECONDS = {"hour": 3600, "day": 86400, "week": 7 * 86400}


def time_halo(df: DataFrame, ts: str, bucket: str, seconds: int) -> DataFrame:
    """Rows within ``seconds`` after a bucket start, copied into the previous bucket.

    Exact look-ahead by time (RANGE frames up to ``seconds`` ahead) for any
    number of rows per period, as long as ``seconds`` <= the bucket length.
    """
    if seconds > BUCKET_SECONDS.get(bucket, 0):
        raise ValueError(f"time halo of {seconds}s exceeds one {bucket}")
    start = F.date_trunc(bucket, F.col(ts))
    ahead = F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))
    prev = (F.date_trunc(bucket, start - F.expr("INTERVAL 1 SECOND")))
    return (df.filter(F.col(ts) <= start + ahead)
            .withColumn(BLK, prev).withColumn(HALO, F.lit(1)))


def windowed(df: DataFrame, keys, order, build: Callable[[Window], dict[str, Column]],
             before: int = 0, after: int = 0, ts: str | None = None,
             bucket: str | None = "day", after_seconds: int = 0) -> DataFrame:
    """Add the columns returned by ``build(w)``, w = window over keys ordered by ``order``.

    ``before``/``after`` bound how many rows any frame looks back/ahead;
    ``after_seconds`` bounds a RANGE frame's look-ahead by time. With
    ``bucket=None`` the plain per-key window is used (fine for short series).
    """
    keys, order = _cols(keys), _cols(order)
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        for name, col in build(w).items():
            df = df.withColumn(name, col)
        return df
    ts = ts or order[0]
    base = add_bucket(df, ts, bucket)
    framed = halo_frame(base, keys, order, before, after)
    if after_seconds:
        framed = framed.unionByName(time_halo(base, ts, bucket, after_seconds).select(*framed.columns))
    w = Window.partitionBy(*keys, BLK).orderBy(*order)
    for name, col in build(w).items():
        framed = framed.withColumn(name, col)
    return framed.filter(F.col(HALO) == 0).drop(BLK, HALO)


# ---------------------------------------------------------------- window columns

def lag_columns(w: Window, col: str, lags: Sequence[int], prefix: str | None = None):
    prefix = prefix or col
    return {f"{prefix}_lag_{i}": F.lag(col, i).over(w) for i in lags}


def lead_columns(w: Window, col: str, steps: dict[str, int]):
    return {name: F.lead(col, k).over(w) for name, k in steps.items()}


def rolling_mean(w: Window, col: str, size: int) -> Column:
    """Mean over the last ``size`` rows, partial at the start (min_periods=1)."""
    return F.avg(col).over(w.rowsBetween(-(size - 1), 0))


def rolling_std(w: Window, col: str, size: int, fill: float | None = 0.0) -> Column:
    """Sample std over the last ``size`` rows; NULL on one row, then ``fill``."""
    s = F.stddev_samp(col).over(w.rowsBetween(-(size - 1), 0))
    return F.coalesce(s, F.lit(fill)) if fill is not None else s


def first_difference(w: Window, col: str) -> Column:
    """W5 / W7."""
    return F.col(col) - F.lag(col, 1).over(w)


def relative_change(w: Window, col: str, parity: bool = False) -> Column:
    """X / prev - 1.

    ``parity=True`` reproduces the reference: prev 0 gives +-inf (x != 0) or
    0 (x == 0 is NaN, filled with 0), first row 0. The default returns 0 for
    every undefined case, since an infinite feature breaks model fits.
    """
    prev = F.lag(col, 1).over(w)
    x = F.col(col)
    if parity:
        return (F.when(prev.isNull(), 0.0)
                .when(prev != 0, x / prev - 1)
                .when(x > 0, F.lit(float("inf")))
                .when(x < 0, F.lit(float("-inf")))
                .otherwise(0.0))
    return F.coalesce(F.try_divide(x, prev) - 1, F.lit(0.0))


def push_proximity(w: Window, flag: str, reach: int = 9, step_minutes: int = 5,
                   parity: bool = True, none_value: int = 999999) -> dict[str, Column]:
    """Minutes since the latest push within the last ``reach`` rows.

    Parity: ``step * rows_since`` for a push within ``reach-1`` rows, else 0,
    and the post-push flag (<= 45) -- always 1 in the reference. Corrected:
    ``none_value`` when no push is in reach.
    """
    rn = F.row_number().over(w)
    last = F.max(F.when(F.col(flag) == 1, rn)).over(w.rowsBetween(-(reach - 1), 0))
    since = (rn - last) * step_minutes
    msp = F.coalesce(since, F.lit(0 if parity else none_value))
    return {"minutes_since_push": msp.cast("int"),
            "is_post_push_period": F.when(msp <= 45, 1).otherwise(0)}


# ------------------------------------------------------------ cumulative operators

def cumulative_sum(df: DataFrame, keys, order, value: str, out: str,
                   ts: str | None = None, bucket: str = "day") -> DataFrame:
    """Running sum of ``value`` per key in ``order`` (exact, no single-task window).

    Bucket totals (small: keys x buckets) get a running offset; within each
    bucket the sum runs over (key, bucket) only.
    """
    keys, order = _cols(keys), _cols(order)
    ts = ts or order[0]
    b = add_bucket(df, ts, bucket)
    totals = b.groupBy(*keys, BLK).agg(F.sum(value).alias("_tot"))
    wt = Window.partitionBy(*keys).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_off", F.coalesce(F.sum("_tot").over(wt), F.lit(0))).drop("_tot")
    wb = Window.partitionBy(*keys, BLK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (b.join(offsets, [*keys, BLK], "left")
            .withColumn(out, F.col("_off") + F.sum(value).over(wb))
            .drop("_off", BLK))


def sequence_number(df: DataFrame, order, out: str = "sequence_id", start: int = 0) -> DataFrame:
    """Global 0-based position in ``order`` that holds up under skew.

    ``orderBy`` range-partitions on the full key (sampling splits a hot
    timestamp by the next key), ``monotonically_increasing_id`` then carries
    (partition, position) of each row in sorted order. The marked table is
    checkpointed so a retried task cannot renumber rows; per-partition counts
    (one row per partition) give each partition its offset.
    """
    from tidewater.session import materialize
    order = _cols(order)
    marked = materialize(df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()))
    pid = F.shiftright(F.col("_mid"), 33)
    counts = marked.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per sorted partition: an ordered pass over a partition-count-sized table
    wt = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(wt), F.lit(0))).drop("_n")
    local = F.col("_mid") - F.shiftleft(F.col("_pid"), 33)
    return (marked.join(F.broadcast(offsets), pid == F.col("_pid"), "inner")
            .withColumn(out, (F.col("_off") + local + start).cast("long"))
            .drop("_mid", "_pid", "_off"))


def back_fill(df: DataFrame, keys, order, cols: Sequence[str], ts: str | None = None,
              bucket: str = "day") -> DataFrame:
    """Replace NULLs by the next non-NULL value in order (per key).

    Within a bucket: first non-NULL over current..unbounded following; the
    remainder comes from the first non-NULL value of any later bucket, found on
    the small per-bucket table.
    """
    keys, order, cols = _cols(keys), _cols(order), list(cols)
    ts = ts or order[0]
    b = add_bucket(df, ts, bucket)
    firsts = b.groupBy(*keys, BLK).agg(*[
        F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*order))).alias(f"_f_{c}")
        for c in cols])
    wn = Window.partitionBy(*keys).orderBy(BLK).rowsBetween(1, Window.unboundedFollowing)
    nxt = firsts.select(*keys, BLK, *[F.first(f"_f_{c}", ignorenulls=True).over(wn).alias(f"_n_{c}")
                                      for c in cols])
    wb = Window.partitionBy(*keys, BLK).orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    out = b.join(nxt, [*keys, BLK], "left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.first(c, ignorenulls=True).over(wb), F.col(f"_n_{c}")))
    return out.drop(BLK, *[f"_n_{c}" for c in cols])


def forward_fill(df: DataFrame, keys, order, cols: Sequence[str], ts: str | None = None,
                 bucket: str = "day") -> DataFrame:
    """Replace NULLs by the latest earlier non-NULL value in order (per key).

    Mirror of ``back_fill``: last non-NULL up to the current row inside the
    bucket, else the last non-NULL value of any earlier bucket.
    """
    keys, order, cols = _cols(keys), _cols(order), list(cols)
    ts = ts or order[0]
    b = add_bucket(df, ts, bucket)
    lasts = b.groupBy(*keys, BLK).agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*order))).alias(f"_l_{c}")
        for c in cols])
    wp = Window.partitionBy(*keys).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    prv = lasts.select(*keys, BLK, *[F.last(f"_l_{c}", ignorenulls=True).over(wp).alias(f"_p_{c}")
                                     for c in cols])
    wb = Window.partitionBy(*keys, BLK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = b.join(prv, [*keys, BLK], "left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.last(c, ignorenulls=True).over(wb), F.col(f"_p_{c}")))
    return out.drop(BLK, *[f"_p_{c}" for c in cols])


def positional_targets(w: Window, col: str, horizons: Sequence[int], granularity_minutes: float,
                       fill_current: bool = True) -> dict[str, Column]:
    """W8 + W10: value ``int(h / granularity)`` rows ahead; tail filled with the current value."""
    out = {}
    for h in horizons:
        k = int(h / granularity_minutes)
        ahead = F.col(col) if k == 0 else F.lead(col, k).over(w)
        out[f"target_{h}min"] = F.coalesce(ahead, F.col(col)) if fill_current else ahead
    return out


def time_targets(w: Window, col: str, order_seconds: str, horizons_seconds: dict[str, int]):
    """Latest value at or before ts + h (RANGE frame on epoch seconds)."""
    return {name: F.last(col).over(w.orderBy(order_seconds).rangeBetween(0, s))
            for name, s in horizons_seconds.items()}


def mask_short_groups(df: DataFrame, keys, lags: dict[str, int], windows: dict[str, int]) -> DataFrame:
    """W2 parity: NULL a lag column when its group has <= i rows, a rolling column when < w rows.

    The reference only creates such columns for long enough periods; after
    concatenation they are NULL for short ones. Group sizes come from one
    grouped count joined back (no window over the whole group).
    """
    keys = _cols(keys)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_gn"))
    out = df.join(sizes, keys, "left")
    for c, i in lags.items():
        out = out.withColumn(c, F.when(F.col("_gn") > i, F.col(c)))
    for c, w in windows.items():
        out = out.withColumn(c, F.when(F.col("_gn") >= w, F.col(c)))
    return out.drop("_gn")
