"""Token counts by an exact histogram of encoded lengths.

Documents are encoded once; what is kept is the number of documents of each
length, for the corpus (``scope`` is ``corpus``, the group null) and for each group (``scope`` is
``group``). Totals, quantiles and the tokens left after cutting every
document at a context limit all follow from sums over that histogram:
cut at L, documents of at most L tokens keep theirs and each longer one keeps L.

Defined results: null and empty texts have length 0; a null group is a group of
its own; repeated rows count each; an empty table gives an empty histogram.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.bpe import encode
from tidewater.llm.common import map_batches, texts_of


def encoded_lengths(docs: DataFrame, path: str, by: str = "lang", text: str = "text") -> DataFrame:
    """(group, length) of every row."""

    def run(batches):
        for batch in batches:
            n = [len(encode(t, path)) for t in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["group", "length"])

    return map_batches(docs.select(F.col(by).cast("string").alias("group"), text), run, "group string, length bigint")


def histogram(lengths: DataFrame) -> DataFrame:
    """(scope, group, length, n_docs); counts are partially summed before the shuffle.

    The corpus is summed from the groups' rows, of which there are few.
    """
    by_group = lengths.groupBy("group", "length").agg(F.count("*").alias("n_docs"))
    whole = by_group.groupBy("length").agg(F.sum("n_docs").alias("n_docs"))
    return by_group.select(F.lit("group").alias("scope"), "group", "length", "n_docs").unionByName(
        whole.select(F.lit("corpus").alias("scope"), F.lit(None).cast("string").alias("group"), "length", "n_docs"))


def cumulative(hist: DataFrame) -> DataFrame:
    """The histogram with its sums from either end, for each scope and group.

    Columns: n_docs, n_tokens (of documents of this length), docs_up_to and
    tokens_up_to (length at most this), docs_from and tokens_from (suffix sums),
    truncated_tokens (total when every document is cut at this length) and
    quantile (share of documents of at most this length). The window runs over
    distinct lengths, not documents.
    """
    h = hist.withColumn("n_tokens", F.col("n_docs") * F.col("length"))
    up = Window.partitionBy("scope", "group").orderBy("length")
    down = Window.partitionBy("scope", "group").orderBy(F.col("length").desc())
    h = h.select("*", F.sum("n_docs").over(up).alias("docs_up_to"), F.sum("n_tokens").over(up).alias("tokens_up_to"),
                 F.sum("n_docs").over(down).alias("docs_from"), F.sum("n_tokens").over(down).alias("tokens_from"))
    longer = F.col("docs_from") - F.col("n_docs")
    return h.withColumn("truncated_tokens", F.col("tokens_up_to") + longer * F.col("length")) \
        .withColumn("quantile", F.col("docs_up_to") / (F.col("docs_up_to") + longer))


def truncated_totals(sums: DataFrame, limits: DataFrame) -> DataFrame:
    """(scope, group, limit, truncated_tokens) for any limits, also such that no document has.

    ``limits`` has one column ``limit``. For each, the largest length not above it
    decides: its prefix sum, and the limit times the documents beyond.
    """
    whole = sums.groupBy("scope", "group").agg(F.sum("n_docs").alias("all_docs"))
    asked = whole.crossJoin(F.broadcast(limits.select("limit").distinct()))
    at = sums.select(F.col("scope").alias("s"), F.col("group").alias("g"), "length", "docs_up_to", "tokens_up_to")
    same = (asked["scope"] == at["s"]) & asked["group"].eqNullSafe(at["g"])
    joined = asked.join(at, same & (at["length"] <= asked["limit"]), "left")
    best = joined.groupBy("scope", "group", "limit", "all_docs").agg(
        F.coalesce(F.max_by("docs_up_to", "length"), F.lit(0)).alias("docs"),
        F.coalesce(F.max_by("tokens_up_to", "length"), F.lit(0)).alias("tokens"))
    return best.select("scope", "group", "limit",
                       (F.col("tokens") + (F.col("all_docs") - F.col("docs")) * F.col("limit")).alias("truncated_tokens"))


def quantiles(sums: DataFrame, levels: tuple[float, ...]) -> DataFrame:
    """(scope, group, level, length): the smallest length that at least that share of documents does not pass."""
    wanted = F.explode(F.array(*[F.lit(float(x)) for x in levels])).alias("level")
    return (sums.select("scope", "group", "length", "quantile", wanted).where(F.col("quantile") >= F.col("level"))
            .groupBy("scope", "group", "level").agg(F.min("length").alias("length")))
