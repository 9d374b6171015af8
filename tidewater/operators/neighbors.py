"""Exact k-nearest-neighbour classification (M5) by pivots.

References are dealt to the nearest of a few pivots, which are references themselves;
a pivot's cell has a radius. A query is first compared with the references of its own
cell. The k-th distance found there bounds what is left: by the triangle inequality a
reference of another cell is at least the query's distance to that pivot, less the
cell's radius, away, and at least half the difference of the squared distances to both
pivots over the pivots' distance. Only the cells that may hold a nearer (or equally
near) reference are visited, so both sides are shuffled by what lies near each other
and not by the product of their sizes. The result is exact.

A unit of work is a block of queries with a block of one cell's references; a crowded
cell has several of both, so no unit holds more than one block of either side. Up to
``REFERENCE_BLOCK`` references make one cell, which is then all there is. In a unit a matrix
product rules out the references that its rounding error cannot make near enough. Distances of
the others are taken from direct differences, so they do not depend on how far the vectors lie
from the origin. Ties go to the smaller id, and votes to the smaller label. Rows without a
vector are left out. Nothing but the pivots and row counts reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.session import materialize

QUERY_BLOCK = 2048
REFERENCE_BLOCK = 20_000
#: References for each pivot, and the most pivots there are.
CELL_REFERENCES = 4096
MAX_PIVOTS = 1024
SLAB = 256  # queries compared at once
CANDIDATES = "query_id bigint, ref_id bigint, distance double, ref_label bigint"
#: Bounds are lowered by this share, for they are rounded.
SLACK = 1e-9
#: Rounding errors of a squared distance by a product, in units of (dimensions + 8) * eps * norms; about 2 are possible.
PRODUCT_ERROR = 16


def _vectors(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = pc.min_max(pc.list_value_length(rows)).as_py()
    if rows.null_count or lengths["min"] != lengths["max"]:
        return np.array(rows.to_pylist(), np.float64)
    return rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), lengths["max"] or 0)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        squares += (a[:, i, None] - b[None, :, i]) ** 2
    return np.sqrt(squares)


def _first(q: np.ndarray, r: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the n nearest references of each query in order, ties by the smaller number."""
    return np.argsort(_distances(q, r), axis=1, kind="stable")[:, :n]


def _first_of_few(q: np.ndarray, r: np.ndarray, n: int) -> np.ndarray:
    """``_first``, with direct differences only for the references that may be among the n nearest.

    One matrix product gives every squared distance up to a rounding error that is bounded by the
    norms about the references' centre; a reference whose least is over the n-th smallest greatest is left out.
    """
    centre = r.mean(axis=0)
    qc, rc = q - centre, r - centre
    qn, rn = (qc ** 2).sum(axis=1), (rc ** 2).sum(axis=1)
    error = PRODUCT_ERROR * (q.shape[1] + 8) * np.finfo(np.float64).eps
    most = qc @ (-2 * rc.T)
    most += ((1 + error) * qn)[:, None]
    most += ((1 + error) * rn)[None, :]
    if not np.isfinite(most).all():
        return _first(q, r, n)
    bound = np.partition(most, n - 1, axis=1)[:, n - 1] + 2 * error * qn + np.finfo(np.float64).tiny * q.shape[1]
    most -= (2 * error * rn)[None, :]
    row, at = np.nonzero(most <= bound[:, None])
    squares = np.zeros(len(row))
    for i in range(q.shape[1]):
        squares += (q[row, i] - r[at, i]) ** 2
    order = np.lexsort((at, np.sqrt(squares), row))
    start = np.searchsorted(row, np.arange(len(q)))  # rows come in order, so each keeps its place
    return at[order][start[:, None] + np.arange(n)]


def _nearest(k: int):
    """The k nearest references of each query of one unit, ties by the smaller id."""
    schema = pa.schema([("query_id", pa.int64()), ("ref_id", pa.int64()), ("distance", pa.float64()),
                        ("ref_label", pa.int64())])

    def unit(_, queries: pa.Table, refs: pa.Table) -> pa.Table:
        if not queries.num_rows or not refs.num_rows:
            return schema.empty_table()
        q_ids, q = queries["_id"].to_numpy(), _vectors(queries["_v"])
        r_ids, r, labels = refs["_id"].to_numpy(), _vectors(refs["_v"]), refs["_y"].to_numpy()
        by_id = np.argsort(r_ids, kind="stable")
        r_ids, r, labels = r_ids[by_id], r[by_id], labels[by_id]
        n = min(k, len(r_ids))
        at = np.concatenate([_first_of_few(q[a:a + SLAB], r, n) for a in range(0, len(q), SLAB)])
        distance = np.sqrt(((q[:, None, :] - r[at]) ** 2).sum(axis=2))
        return pa.table([np.repeat(q_ids, n), r_ids[at].ravel(), distance.ravel(), labels[at].ravel()], schema=schema)

    return unit


def _unit_counts(queries: DataFrame, refs: DataFrame) -> DataFrame:
    """Blocks of either side of every cell that has both: a row a cell, ``MAX_PIVOTS`` at most."""
    sizes = refs.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / REFERENCE_BLOCK).alias("_nr"))
    visits = queries.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).alias("_nq"))
    return F.broadcast(sizes.join(visits, "_cell"))


def _compare(queries: DataFrame, refs: DataFrame, k: int, units: DataFrame | None = None) -> DataFrame:
    """Candidates of every query among the references of its cell; both sides have ``_cell``."""
    units = _unit_counts(queries, refs) if units is None else units

    def block(n: str, salt: int) -> Column:
        return F.pmod(F.xxhash64("_id", F.lit(salt)), F.col(n))

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    q = queries.join(units, "_cell").select("_cell", "_id", "_v", block("_nq", 1).alias("_q"), every("_nr").alias("_r"))
    r = refs.join(units, "_cell").select("_cell", "_id", "_v", "_y", block("_nr", 2).alias("_r"), every("_nq").alias("_q"))
    unit = ["_cell", "_q", "_r"]
    return q.groupBy(*unit).cogroup(r.groupBy(*unit)).applyInArrow(_nearest(k), CANDIDATES)


def _best(candidates: DataFrame, k: int) -> DataFrame:
    """(query_id, nearest): the k best candidates in order. A query has k for each block it met."""
    found = F.sort_array(F.collect_list(F.struct("distance", "ref_id", "ref_label")))
    return candidates.groupBy("query_id").agg(F.slice(found, 1, k).alias("nearest"))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few enough rows to be held against every pivot."""
    for batch in batches:
        for a in range(0, batch.num_rows, QUERY_BLOCK):
            yield batch.slice(a, QUERY_BLOCK)


def _own_cell(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Rows with ``_cell``, the number of the nearest pivot, and ``_d``, its distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            far = _distances(_vectors(part.column("_v")), pivots)
            cell = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(cell.astype("int32")), pa.array(far[np.arange(len(cell)), cell])],
                [*part.schema.names, "_cell", "_d"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", _cell int, _d double"
    return rows.mapInArrow(run, schema)


def _other_cells(queries: DataFrame, pivots: np.ndarray, radius: dict[int, float]) -> DataFrame:
    """Queries once for each further cell that may hold a reference within ``_bound``."""
    cells = np.array(sorted(radius))
    at, radii = pivots[cells], np.array([radius[c] for c in cells])
    between = _distances(pivots, at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            own, bound = batch.column("_cell").to_numpy(), batch.column("_bound").to_numpy()
            far, near = _distances(_vectors(batch.column("_v")), at), batch.column("_d").to_numpy()[:, None]
            apart = between[own]
            plane = (far ** 2 * (1 - SLACK) - near ** 2 * (1 + SLACK)) / np.where(apart > 0, 2 * apart, np.inf)
            least = np.maximum(far - radii, plane) - SLACK * (far + near)
            row, to = np.nonzero((least <= bound[:, None]) & (cells[None, :] != own[:, None]))
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column("_id").take(rows), batch.column("_v").take(rows),
                                              pa.array(cells[to].astype("int32"))], ["_id", "_v", "_cell"])

    vector = queries.schema["_v"].dataType.simpleString()
    return queries.select("_id", "_v", "_cell", "_d", "_bound").mapInArrow(run, f"_id bigint, _v {vector}, _cell int")


def nearest_lists(queries: DataFrame, refs: DataFrame, k: int = 5, id_col: str = "id", vec_col: str = "vec",
                  label_col: str = "label") -> DataFrame:
    """(query_id, nearest): each query's k nearest references as an array of (distance, ref_id, ref_label)."""
    q = queries.select(F.col(id_col).cast("long").alias("_id"), F.col(vec_col).alias("_v")).where("_v IS NOT NULL")
    r = refs.select(F.col(id_col).cast("long").alias("_id"), F.col(vec_col).alias("_v"),
                    F.col(label_col).cast("long").alias("_y")).where("_v IS NOT NULL")
    n = r.count()
    if n <= REFERENCE_BLOCK:
        one = F.broadcast(q.sparkSession.createDataFrame([(0, 1, max(1, math.ceil(q.count() / QUERY_BLOCK)))],
                                                         "_cell int, _nr long, _nq long"))
        return _best(_compare(q.withColumn("_cell", F.lit(0)), r.withColumn("_cell", F.lit(0)), k, one), k)
    chosen = r.orderBy(F.xxhash64("_id", F.lit(3)), "_id").limit(min(MAX_PIVOTS, math.ceil(n / CELL_REFERENCES)))
    pivots = np.array([row["_v"] for row in chosen.select("_v").collect()], np.float64)
    r = materialize(_own_cell(r, pivots))
    q = materialize(_own_cell(q, pivots))
    first = materialize(_compare(q, r, k))
    bounds = _best(first, k).select(F.col("query_id").alias("_id"), F.when(
        F.size("nearest") >= k, F.element_at("nearest", -1)["distance"]).otherwise(float("inf")).alias("_bound"))
    radius = {row["_cell"]: row["_far"] for row in r.groupBy("_cell").agg(F.max("_d").alias("_far")).collect()}
    bounded = q.join(bounds, "_id", "left").withColumn("_bound", F.coalesce("_bound", F.lit(float("inf"))))
    visits = materialize(_other_cells(bounded, pivots, radius))
    return _best(first.unionByName(_compare(visits, r, k)), k)


def knn_candidates(queries: DataFrame, refs: DataFrame, k: int = 5, id_col: str = "id", vec_col: str = "vec",
                   label_col: str = "label") -> DataFrame:
    """(query_id, ref_id, distance, ref_label, rank) for the k nearest references per query."""
    each = nearest_lists(queries, refs, k, id_col, vec_col, label_col).select("query_id", F.posexplode("nearest").alias("_p", "_n"))
    return each.select("query_id", "_n.ref_id", "_n.distance", "_n.ref_label", (F.col("_p") + 1).alias("rank"))


def knn_classify(queries: DataFrame, refs: DataFrame, k: int = 5, id_col: str = "id", vec_col: str = "vec",
                 label_col: str = "label") -> DataFrame:
    """M5: majority label of the k nearest references; ties go to the smaller label."""
    found = nearest_lists(queries, refs, k, id_col, vec_col, label_col)
    labels = F.col("_labels")
    votes = F.transform(F.array_distinct(labels), lambda y: F.struct(
        F.size(F.filter(labels, lambda other: other == y)).alias("n"), (-y).alias("y")))
    return (found.withColumn("_labels", F.col("nearest.ref_label"))
            .select(F.col("query_id").alias(id_col), (-F.array_max(votes)["y"]).cast("int").alias("predicted_label")))
