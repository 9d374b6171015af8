"""Connected components of a graph of links, by alternating star contraction.

Each round links a node's larger neighbours to its smallest neighbour, then its
smaller neighbours to it (Kiveris et al., 2014). Chains shorten at least
by half, so the rounds grow with the logarithm of the longest path; every round is
written to the shared folder, which ends its lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import keep_table


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """(u, v) joined with the smallest of u and its neighbours; minima are taken before the shuffle."""
    least = edges.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("u", "least"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    return (_least_neighbour(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
            .where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = _least_neighbour(down)
    return (joined.select(F.col("v").alias("u"), F.col("least").alias("v"))
            .union(joined.select("u", F.col("least").alias("v"))).where("u <> v").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; the root is the component's smallest node.

    ``edges`` has two columns of one ordered type. Null ends are ignored.
    """
    a, b = edges.columns
    now = keep_table(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "links")
    state = None
    while True:
        now = keep_table(_small_star(_large_star(now)), "links")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == state:
            break
        state = mark
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select("v", "v")).distinct()
