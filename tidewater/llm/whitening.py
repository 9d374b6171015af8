"""Whitening of embeddings by shifted CholeskyQR.

Vectors become integers, ``floor(256 * c)``. The model is fitted to the list of
distinct integer vectors: their number n and sums S are exact, rows are centred
before they are multiplied, as (n*x - S) / n. Each pass over the list solves the
centred rows through the triangular factors found so far and adds up their Gram
matrix, partition by partition; its Cholesky factor joins the others. The first
Gram matrix is shifted, so that it factors however near the vectors are to a
plane; the later passes orthogonalise what the shift left. The composed factor
R has the singular values and right vectors of the centred list, so its SVD
gives the components and, by sigma^2 / n, their variances.

Only d x d matrices (d: length of a vector) reach the driver, already added up.

Defined results: a row whose vector is null, or holds a null, a value that is
not finite or one that does not fit a 64-bit integer, is left out; so is a
vector whose length is not the one that most distinct vectors have (ties: the
longer; empty vectors do not count). Repeated vectors count once in the fit and
each of their rows gets its result; a null identifier is kept. Components of no
variance (a singular value below ``RANK_TOLERANCE`` times the largest) cannot be
whitened and are not returned: a table of one distinct vector, or none, gives an
empty result. ``deviation`` is null where it does not fit a long. Further
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import keep_table, map_batches

SCALE = 256
COMPONENTS = 4
#: Gram passes: the shifted one and two more.
PASSES = 3
RANK_TOLERANCE = 1e-10
LONG = 2.0 ** 63
RESULT = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
          "identity_error double")


def integers(vector: Column) -> Column:
    """``floor(256 * c)`` of every entry, or null for a vector that is left out."""
    scaled = F.transform(vector, lambda c: c.cast("double") * SCALE)
    usable = F.forall(scaled, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LONG))
    return F.when(usable, F.transform(scaled, lambda c: F.floor(c)))


# ---- arithmetic on one batch -----------------------------------------------------------------

def matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def exceeds(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n*x - S, exact: 64-bit integers where they suffice, else Python's."""
    largest = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    if n * largest + max(map(abs, sums), default=0) < 2 ** 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def squares(over: np.ndarray) -> list[int | None]:
    """Exact sums of squares by row; null beyond 64 bits."""
    largest = max((abs(int(v)) for v in (over.min(), over.max())), default=0) if over.size else 0
    if over.dtype == np.int64 and over.shape[1] * largest ** 2 < 2 ** 62:
        return (over * over).sum(axis=1).tolist()
    exact = over.astype(object)
    return [s if s < 2 ** 63 else None for s in ((exact * exact).sum(axis=1)).tolist()]


def solve_through(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """rows times the inverse of an upper triangular factor, by substitution column by column."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def factor_of(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper Cholesky factor of the Gram matrix; a singular one is shifted, by as little as it takes."""
    step = max(shift, np.finfo(float).eps * np.trace(gram) * len(gram))
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift, step = shift + step, step * 10


# ---- passes over the list --------------------------------------------------------------------

def _add_up(rows: DataFrame, part_of: Callable[[np.ndarray], np.ndarray], length: int) -> np.ndarray:
    """The sum over all batches of the matrices that ``part_of`` makes of them.

    A task adds up its own; the matrices' rows are then dealt by number, in the order of their
    partitions, and added up again, so the driver gets one matrix and a rerun the same one.
    """

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = part_of(matrix(batch.column(0), length))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()),
                 pa.array([TaskContext.get().partitionId()] * len(total), pa.int32()),
                 pa.array([r.astype("<f8").tobytes() for r in total], pa.binary())], ["i", "part", "v"])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                totals[i] = totals.get(i, 0.0) + np.frombuffer(v, "<f8")
        if totals:
            yield pa.RecordBatch.from_arrays([pa.array(totals, pa.int32()),
                                              pa.array([t.tobytes() for t in totals.values()], pa.binary())], ["i", "v"])

    parts = map_batches(rows.select("x"), own, "i int, part int, v binary")
    dealt = parts.repartition("i").sortWithinPartitions("i", "part")
    found = {r.i: r.v for r in map_batches(dealt, together, "i int, v binary").collect()}
    return np.array([np.frombuffer(found[i], "<f8") for i in range(len(found))])


def _sums(rows: DataFrame, length: int) -> list[int]:
    """Exact sums by dimension."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [0] * length
        for batch in batches:
            x = matrix(batch.column(0), length)
            if not x.size:
                continue
            largest = max(abs(int(x.min())), abs(int(x.max())))
            wide = x if largest * len(x) < 2 ** 62 else x.astype(object)
            totals = [t + int(s) for t, s in zip(totals, wide.sum(axis=0), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(length), pa.int32()), pa.array(map(Decimal, totals), pa.decimal128(38, 0))], ["i", "s"])

    parts = map_batches(rows.select("x"), own, "i int, s decimal(38,0)")
    by_dimension = {r.i: int(r.s) for r in parts.groupBy("i").agg(F.sum("s").alias("s")).collect()}
    return [by_dimension.get(i, 0) for i in range(length)]


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: list[int]
    components: np.ndarray   # one a row, unit length
    variances: np.ndarray    # falling
    trace: float
    identity_error: float

    @property
    def length(self) -> int:
        return len(self.sums)

    def transform(self, rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
        """``RESULT`` for every row that is not left out and every component."""
        if not len(self.components):
            return rows.sparkSession.createDataFrame([], RESULT)
        n, sums, length, components = self.n, self.sums, self.length, self.components
        scales, explained = np.sqrt(self.variances), (self.variances / self.trace).tolist()
        error, k = self.identity_error, len(components)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = matrix(batch.column(1), length)
                over = exceeds(x, n, sums)
                whitened = (over.astype(float) / n) @ components.T / scales
                m = len(x)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array([n] * (m * k), pa.int64()),
                     pa.array(squares(over), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                     pa.array(whitened.ravel()), pa.array(explained * m), pa.array([error] * (m * k))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

        scaled = rows.select(F.col(key).cast("long").alias("key"), integers(F.col(vector)).alias("x"))
        return map_batches(scaled.where(F.size("x") == length), run, RESULT)


def fit(rows: DataFrame, vector: str = "embedding", n_components: int = COMPONENTS) -> Whitening:
    scaled = rows.select(integers(F.col(vector)).alias("x")).where(F.size("x") > 0)
    distinct = keep_table(scaled.distinct(), "distinct-vectors")
    common = (distinct.groupBy(F.size("x").alias("length")).count()
              .orderBy(F.desc("count"), F.desc("length")).first())
    if common is None:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)
    length, n = common["length"], common["count"]
    listed = distinct.where(F.size("x") == length)
    sums = _sums(listed, length)

    def centred(x: np.ndarray) -> np.ndarray:
        return exceeds(x, n, sums).astype(float) / n

    factors: list[np.ndarray] = []
    composed, squared = np.eye(length), 0.0
    for number in range(PASSES):

        def gram(x: np.ndarray, factors=tuple(factors)) -> np.ndarray:
            q = centred(x)
            for factor in factors:
                q = solve_through(q, factor)
            return q.T @ q

        found = _add_up(listed, gram, length)
        if number == 0:
            squared = float(np.trace(found))
            if squared == 0:
                return Whitening(n, sums, np.zeros((0, length)), np.zeros(0), 0.0, 0.0)
        unit = np.finfo(float).eps / 2
        shift = 11 * (n * length + length * (length + 1)) * unit * squared if number == 0 else 0.0
        factors.append(factor_of(found, shift))
        composed = factors[-1] @ composed

    _, singular, right = np.linalg.svd(composed)
    kept = min(n_components, int((singular > RANK_TOLERANCE * singular[0]).sum()))
    components, variances = right[:kept], singular[:kept] ** 2 / n
    largest = np.abs(components).argmax(axis=1)
    components = components * np.sign(components[np.arange(kept), largest])[:, None]
    scales = np.sqrt(variances)

    def moments(x: np.ndarray) -> np.ndarray:
        z = centred(x) @ components.T / scales
        return np.vstack([z.sum(axis=0), z.T @ z])

    found = _add_up(listed, moments, length) / n
    covariance = found[1:] - np.outer(found[0], found[0])
    return Whitening(n, sums, components, variances, squared / n, float(np.abs(covariance - np.eye(kept)).max()))


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding",
           n_components: int = COMPONENTS) -> DataFrame:
    return fit(rows, vector, n_components).transform(rows, key, vector)
