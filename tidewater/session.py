"""Session helpers.

The engine expects UTC as session zone (all timestamp arithmetic is done on
naive ``timestamp_ntz`` values or on UTC instants), ANSI mode on, and AQE on so
that small sides are broadcast and tiny post-shuffle partitions are coalesced
at run time.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tidewater", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's expected settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the operators rely on to an existing session."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.coalescePartitions.enabled"):
        spark.conf.set(k, DEFAULT_CONF[k])
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared folder there).
    Only when it is unset and the master is local -- tests -- a scratch folder is created and set.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)


_KEPT: list[str] = []


def kept_path(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared checkpoint folder, until ``release``."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    _KEPT.append(path)
    return path


def materialize(df):
    """Compute ``df`` once into a Parquet table in the shared folder; lineage ends there.

    Used for tables that several branches of a plan read: without it each
    branch re-scans and re-aggregates the raw rows, because differently pruned
    branches cannot share an exchange. Later reads take the columns they need.
    The table survives executor loss; it is never a machine-local copy.
    ``release`` removes what was kept.
    """
    path = kept_path(df.sparkSession, "kept")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Remove all kept tables, once the results that read them are written."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _KEPT:
        path = jvm.org.apache.hadoop.fs.Path(_KEPT.pop())
        path.getFileSystem(conf).delete(path, True)
