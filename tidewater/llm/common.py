"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import gc
import posixpath
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_path

BATCH_BYTES = 16 << 20
#: A side of a join is broadcast up to this size, by its counted rows; larger ones are shuffled.
BROADCAST_BYTES = 64 << 20


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Arrow batches are cut by size as well as by rows, for very long texts make large batches."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str) -> DataFrame:
    bounded_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def texts_of(column: pa.Array) -> list[str]:
    """Texts of an Arrow column; null is the empty text."""
    return [t or "" for t in column.to_pylist()]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared checkpoint folder."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def keep_table(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: lineage ends there."""
    path = new_folder(df.sparkSession, name)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_shuffles(spark: SparkSession) -> None:
    """Files of shuffles go when the driver collects its garbage, on a small driver long after their table is written: ask for it."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def keep_bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """As ``keep_table``, bucketed by ``key``, so that joins and groups by it need not shuffle the table again."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("path", new_folder(spark, name)).saveAsTable(table)
    return spark.table(table)


def broadcast_if_small(table: DataFrame, row_bytes: int) -> DataFrame:
    """A kept table, marked for broadcast where its rows, counted from the files, are few enough."""
    return F.broadcast(table) if table.count() * row_bytes <= BROADCAST_BYTES else table


def open_store(path: str):
    """(file system, path) of a folder or file in the shared store, local or remote."""
    from pyarrow import fs
    if "://" not in path and path.startswith("file:"):
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def write_atomically(folder: str, name: str, data) -> None:
    """A file appears whole or not at all; a task that runs again writes the same bytes again."""
    store, base = open_store(folder)
    store.create_dir(base, recursive=True)
    temporary = posixpath.join(base, f"_{uuid.uuid4().hex}")
    with store.open_output_stream(temporary) as out:
        for part in data:
            out.write(part)
    store.move(temporary, posixpath.join(base, name))
