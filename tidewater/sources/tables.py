"""Parquet table access for the test and production layouts.

Tables are read lazily; Catalyst prunes columns and pushes filters into the
parquet scan, so callers select what they need after ``table()``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table of the star schema (or the ``events`` stream table)."""
    return spark.read.parquet(table_path(sf_dir, name))


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Register each table as a temp view so it can be queried with ``spark.sql``."""
    for n in names:
        p = table_path(sf_dir, n)
        if os.path.exists(p) or "://" in p:
            table(spark, sf_dir, n).createOrReplaceTempView(n)
