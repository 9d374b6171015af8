"""Feature selection, missing values, encoding, scaling and splitting (P*, N*, E*).

Statistics (means, standard deviations, category lists) are computed by one
aggregate and applied through a broadcast one-row join, or via MLlib
estimators whose fitted state is equally small. Splits are keyed hashes, so a
row's side never depends on partitioning or on a random seed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import materialize

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


# ------------------------------------------------------------------ projections

def select_by_position(df: DataFrame, start: int | None = None, stop: int | None = None,
                       positions: Sequence[int] | None = None) -> DataFrame:
    """Columns by position (slice or explicit list), like ``iloc[:, ...]``."""
    cols = df.columns
    chosen = [cols[i] for i in positions] if positions is not None else cols[start:stop]
    return df.select(*[F.col(f"`{c}`") for c in chosen])


def drop_columns(df: DataFrame, exclude: Sequence[str]) -> DataFrame:
    """P2."""
    return df.drop(*exclude)


def resolve_aliases(df: DataFrame, candidates: dict[str, Sequence[str]]) -> DataFrame:
    """For each logical name, the first existing candidate column, renamed."""
    cols = set(df.columns)
    out = []
    for name, alts in candidates.items():
        hit = next((a for a in alts if a in cols), None)
        if hit is not None:
            out.append(F.col(f"`{hit}`").alias(name))
    return df.select(*out)


def present_families(columns: Sequence[str], families: Sequence[str]) -> list[str]:
    """The ordered intersection of wanted feature names with the columns present."""
    have = set(columns)
    return [c for c in families if c in have]


def numeric_columns(df: DataFrame, exclude_patterns: Sequence[str] = (),
                    essentials: Sequence[str] = ()) -> list[str]:
    """P5: numeric columns minus name patterns, plus essentials that exist."""
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)
           and not any(p in f.name for p in exclude_patterns)]
    return num + [e for e in essentials if e in df.columns and e not in num]


def align_features(df: DataFrame, order: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Columns in training order; missing columns and NULLs become 0 (opt-in)."""
    have = set(df.columns)
    cols = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) if c in have
            else F.lit(0.0).alias(c) for c in order]
    return df.select(*keep, *cols)


def add_if_absent(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Constant column when it is not there yet."""
    for name, value in defaults.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(value))
    return df


def share_passing(df: DataFrame, predicate: Column, name: str = "pct_passing") -> DataFrame:
    """P10: percent of rows passing a predicate (one aggregate)."""
    return df.agg((F.avg(F.when(predicate, 1.0).otherwise(0.0)) * 100).alias(name),
                  F.count(F.lit(1)).alias("n_rows"))


def preview(df: DataFrame, key, n: int = 5) -> DataFrame:
    """First n rows in an explicit order."""
    return df.orderBy(key).limit(n)


def columns_matching(columns: Sequence[str], patterns: Sequence[str]) -> list[str]:
    """Column names containing any pattern, sorted."""
    return sorted(c for c in columns if any(p in c for p in patterns))


# --------------------------------------------------------------- missing values

def mean_impute(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None,
                suffix: str = "") -> DataFrame:
    """MLlib mean Imputer on double copies (an int column would truncate the mean).

    ``fit_on`` selects the rows the means are learnt from (default: ``df``).
    """
    tmp = [f"_imp_in_{i}" for i in range(len(cols))]
    outs = [f"{c}{suffix}" for c in cols]
    src = df.select("*", *[F.col(c).cast("double").alias(t) for c, t in zip(cols, tmp)])
    fit_src = src if fit_on is None else fit_on.select(
        *[F.col(c).cast("double").alias(t) for c, t in zip(cols, tmp)])
    model = Imputer(strategy="mean", inputCols=tmp, outputCols=[f"_imp_out_{i}" for i in range(len(cols))]).fit(fit_src)
    res = model.transform(src)
    for i, o in enumerate(outs):
        res = res.withColumn(o, F.col(f"_imp_out_{i}"))
    return res.drop(*tmp, *[f"_imp_out_{i}" for i in range(len(cols))])


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN -> NULL in floating columns (``avg`` over a NaN is NaN; NULL is skipped)."""
    return df.select(*[F.when(~F.isnan(F.col(f"`{f.name}`")), F.col(f"`{f.name}`")).alias(f.name)
                       if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def fill_zero(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULL (and NaN) -> 0."""
    return df.na.fill(0, subset=list(cols) if cols else None)


def fill_from(df: DataFrame, col: str, base: str) -> DataFrame:
    """NULL -> value of another column."""
    return df.withColumn(col, F.coalesce(F.col(col), F.col(base)))


# -------------------------------------------------------------------- encoding

def label_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Alphabetical codes from 0; a null label has a null code.

    The distinct labels are numbered where they lie and joined back, so their number is not bounded.
    """
    from tidewater.operators.temporal import sequence_number
    out = out or f"{col}_code"
    codes = sequence_number(df.select(col).where(F.col(col).isNotNull()).distinct(), [col], out)
    return df.join(codes.withColumn(out, F.col(out).cast("double")), col, "left").select(*df.columns, out)


MAX_DUMMIES = 10_000


def one_hot(df: DataFrame, col: str, prefix: str | None = None, drop_first: bool = False) -> DataFrame:
    """One-hot columns (alphabetical categories) placed before the other columns.

    ``drop_first`` removes the first category's column (dummy-trap rule). A null has 0 in each column.
    The categories become columns, so there can be ``MAX_DUMMIES`` at most; more are refused.
    """
    prefix = prefix or col
    found = df.select(col).where(F.col(col).isNotNull()).distinct().limit(MAX_DUMMIES + 1).collect()
    if len(found) > MAX_DUMMIES:
        raise ValueError(f"{col} has more than {MAX_DUMMIES} categories")
    labels = sorted(r[0] for r in found)[1 if drop_first else 0:]
    dummies = [F.when(F.col(col) == F.lit(x), 1.0).otherwise(0.0).alias(f"{prefix}_{x}") for x in labels]
    return df.select(*dummies, *[F.col(f"`{c}`") for c in df.columns if c != col])


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """E8."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid).transform(df)


# --------------------------------------------------------------------- scaling

def fit_standardiser(df: DataFrame, cols: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """Population mean and std per column (std 0 -> 1), one row per group."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"_mu_{c}"), F.stddev_pop(c).alias(f"_sd_{c}")]
    stats = df.groupBy(*groups).agg(*aggs) if groups else df.agg(*aggs)
    for c in cols:
        stats = stats.withColumn(f"_sd_{c}", F.when(F.col(f"_sd_{c}") == 0, 1.0).otherwise(F.col(f"_sd_{c}")))
    return stats


#: Rows that a table of one row a group (or stratum) has at most to be sent to every task.
FEW_GROUPS = 10_000


def small_side(per_group: DataFrame) -> DataFrame:
    """One row a group, computed once; sent to every task if there are few groups.

    Left to a join by shuffle, the rows of a large group would all go to one task, and the planner
    learns that there are few groups only when the rows are on their way.
    """
    kept = materialize(per_group)
    return F.broadcast(kept) if kept.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS else kept


def apply_standardiser(df: DataFrame, stats: DataFrame, cols: Sequence[str], groups: Sequence[str] = (),
                       prefix: str = "z_") -> DataFrame:
    """(x - mean) / std with broadcast statistics (one row, or one per group)."""
    j = df.join(small_side(stats), list(groups), "inner") if groups else df.crossJoin(F.broadcast(stats))
    for c in cols:
        j = j.withColumn(f"{prefix}{c}", (F.col(c) - F.col(f"_mu_{c}")) / F.col(f"_sd_{c}"))
    return j.drop(*[f"_mu_{c}" for c in cols], *[f"_sd_{c}" for c in cols])


# ------------------------------------------------------------------- splitting

HASH_BITS = 32
LOW_BITS = 16


def hash_bits(key) -> Column:
    """The first 32 bits of md5(key as text), as a long; same value in DuckDB."""
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(k.cast("string")), 1, HASH_BITS // 4), 16, 10).cast("long")


def hash_unit(key) -> Column:
    """Uniform [0, 1) from ``hash_bits``."""
    return hash_bits(key).cast("double") / F.lit(float(2 ** HASH_BITS))


def hash_split(df: DataFrame, key, test_fraction: float = 0.2, out: str = "is_test") -> DataFrame:
    """Keyed hash split; deterministic and partitioning-independent."""
    return df.withColumn(out, F.when(hash_unit(key) < test_fraction, 1).otherwise(0))


def _cut(counted: DataFrame, by: Sequence[str], order: str, take: str) -> DataFrame:
    """Per stratum the value of ``order`` at which the running count reaches ``take``, and what is left to take of it."""
    upto = F.sum("_c").over(Window.partitionBy(*by).orderBy(order))
    return (counted.withColumn("_upto", upto)
            .where((F.col("_upto") >= F.col(take)) & (F.col("_upto") - F.col("_c") < F.col(take)))
            .withColumn("_left", F.col(take) - (F.col("_upto") - F.col("_c"))).drop("_upto", "_c", take))


def exact_split(df: DataFrame, key: str, test_fraction: float, strata: Sequence[str] = (),
                out: str = "is_test") -> DataFrame:
    """E6 / E7 exact size: ceil(n * f) test rows per stratum, lowest (hash, key) first.

    The rows are hashed and kept once. A histogram of the hash's upper half (65,536 buckets a
    stratum) finds the bucket with the last test row; of that bucket, a 65,536th of the stratum,
    one of the lower half finds the hash itself, and the keys of that one hash the key. Every
    row's side is then one comparison with its stratum's (hash, key): nothing is ranked. ``key``
    names a row; rows that share one stay on one side, so they can make the test side larger.
    """
    strata = list(strata)
    names = [f"_s{i}" for i in range(len(strata))] or ["_s0"]  # a null stratum is a stratum
    own = [F.struct(F.col(f"`{s}`")).alias(n) for s, n in zip(strata, names, strict=True)] if strata else [F.lit(0).alias("_s0")]
    rows = materialize(df.select("*", *own, hash_bits(key).alias("_h")))
    high, low = F.shiftright("_h", LOW_BITS).alias("_b"), F.col("_h").bitwiseAND(F.lit((1 << LOW_BITS) - 1)).alias("_b")
    counted = rows.groupBy(*names, high).agg(F.count(F.lit(1)).alias("_c"))
    size = F.sum("_c").over(Window.partitionBy(*names))  # 65,536 rows a stratum at most
    wanted = counted.withColumn("_take", F.ceil(size * F.lit(float(test_fraction))).cast("long"))
    bucket = small_side(_cut(wanted, names, "_b", "_take").withColumnsRenamed({"_left": "_take"}))
    inside = materialize(rows.select(*names, F.col(f"`{key}`").alias("_key"), "_h", high).join(bucket, [*names, "_b"])
                         .groupBy(*names, "_h", "_key", "_take").agg(F.count(F.lit(1)).alias("_c")))
    hashes = inside.groupBy(*names, "_take", low).agg(F.sum("_c").alias("_c"), F.max("_h").alias("_last"))
    hashes = _cut(hashes, names, "_b", "_take").select(*names, "_last", F.col("_left").alias("_want"))
    tied = inside.join(hashes, names).where("_h = _last").select(*names, "_last", "_key", "_want", "_c")
    cuts = _cut(tied, names, "_key", "_want").select(*names, "_last", F.col("_key").alias("_last_key"))
    side = F.when((F.col("_h") < F.col("_last")) | ((F.col("_h") == F.col("_last")) & (F.col(f"`{key}`") <= F.col("_last_key"))),
                  1).otherwise(0)
    return (rows.join(small_side(cuts), names, "left").withColumn(out, side)
            .drop(*names, "_h", "_last", "_last_key"))
