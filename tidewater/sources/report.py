"""Collection summary report (S7) as one long DataFrame.

All sections come from a single ``GROUPING SETS`` aggregate over the tagged
traffic rows (one scan), giving (section, key, n, pct, avg_interval).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SECTIONS = ("collection_strategy", "granularity_category", "data_quality", "ml_weight")


def collection_summary(rows: DataFrame) -> DataFrame:
    """Strategy, granularity, quality and weight distributions plus the record count."""
    base = rows.select(*[F.col(c).cast("string").alias(c) for c in SECTIONS], "interval_minutes")
    sets = ", ".join(f"({c})" for c in SECTIONS) + ", ()"
    base.createOrReplaceTempView("_summary_rows")
    g = base.sparkSession.sql(f"""
        SELECT {", ".join(SECTIONS)}, grouping_id() AS gid, count(1) AS n,
               avg(interval_minutes) AS avg_interval
        FROM _summary_rows GROUP BY GROUPING SETS ({sets})""")
    full = (1 << len(SECTIONS)) - 1
    section = F.lit("total")
    key = F.lit("records")
    for i, c in enumerate(SECTIONS):
        gid = full ^ (1 << (len(SECTIONS) - 1 - i))
        section = F.when(F.col("gid") == gid, F.lit(c)).otherwise(section)
        key = F.when(F.col("gid") == gid, F.col(c)).otherwise(key)
    total = F.max(F.when(F.col("gid") == full, F.col("n"))).over(Window.partitionBy())  # a few dozen rows
    return g.select(section.alias("section"), key.alias("key"), "n",
                    (F.col("n") * F.lit(100.0) / total).alias("pct"),
                    F.when(F.col("gid") == full ^ (1 << (len(SECTIONS) - 2)), F.col("avg_interval"))
                    .alias("avg_interval"))
