"""The corpus pipeline: quality rules, near-duplicate join, decontamination, secrets, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's documents. Every stage but the last returns the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bpe, decontamination, quality, secret_scan, setjoin
from tidewater.llm.common import keep_table
from tidewater.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or whose host does, go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8, one of each group stays."""
    return setjoin.one_of_each(docs, percent=80, words=5)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, within its edit budget, go."""
    return decontamination.drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked; no document goes."""
    masked = secret_scan.mask(docs, secret_scan.learn_formats(docs))
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, decoded again: counts and digests of both."""
    return bpe.round_trip(docs, bpe.rank_file())


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("byte-level BPE encoding and decoding", byte_level_bpe),
]

#: Edit distances and inferred automata are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
