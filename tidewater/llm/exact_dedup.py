"""Exact dedup by a stateful stream, in DataFrame functions only.

Arrivals are a file stream. Its keyed state, on disk (RocksDB) and without
expiry, holds for every digest of a normalised text the stable identifier and
the content locator (file and row in it) of the first document by identifier,
and how many arrived. The state lives in the checkpoint, so later files meet
everything seen before, and it is read as a table with ``statestore``.

Every hit is then checked by its full bytes against the text at the locator.
Texts travel only where their digest may have come more than once: a bitmap of
at most ``MAX_BITMAPS`` x 4 KB, broadcast, tells the others, which travel
without text. A group of more than a ten-thousandth of all rows (at most
10,000 groups can be so large) is cut into parts, and its first text goes to
each part. Texts that share a digest and differ are grouped anew by their
whole bytes, so no digest, however weak, changes the result.

Defined results: a null text is the empty text; a null identifier comes after
all others; of rows that share identifier and text the one that comes first by
file and row stays; an empty table gives an empty result; further columns are
not read, whatever their names. Arrow, pandas and user functions are not used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import keep_table, new_folder

SPACES = r"[\x20\x09-\x0D]+"
BATCH_BYTES = 64 << 30
#: Groups above this share of all rows are cut into parts; there are at most as many such groups.
LARGE_SHARE = 10_000
LEAST_PART = 100
#: A bitmap chunk has 32,768 bits; 16 bits for each repeated digest, up to 16 MB in all.
MAX_BITMAPS = 4096
BITMAP_BITS = 32_768
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # many small stores: no room taken ahead
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}
RESULT = "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string"


def whole_digest(sha256: Column) -> Column:
    return F.unhex(sha256)


def arrivals(docs: DataFrame, digest: Callable[[Column], Column] = whole_digest) -> DataFrame:
    """(at, sha256, digest, body) of a file-backed table, batch or stream; ``at`` orders by identifier, then place."""
    body = F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), SPACES, " ")
    place = docs.metadataColumn("_metadata")
    at = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").cast("long").alias("doc_id"),
                  place["file_path"].alias("file"), place["row_index"].alias("row"))
    read = docs.select(at.alias("at"), body.alias("body"))
    return (read.withColumn("sha256", F.sha2(F.col("body").cast("binary"), 256))
            .withColumn("digest", digest(F.col("sha256"))))


def remember(spark: SparkSession, path: str, state: str,
             digest: Callable[[Column], Column] = whole_digest) -> None:
    """Stream the files under ``path`` that ``state`` has not seen into it."""
    session = spark.newSession()  # the caller's settings stay
    for k, v in STATE_CONF.items():
        session.conf.set(k, v)
    for k in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        session.conf.set(k, spark.conf.get(k))
    schema = spark.read.parquet(path).select("doc_id", "text").schema
    stream = session.readStream.schema(schema).option("maxBytesPerTrigger", str(BATCH_BYTES)).parquet(path)
    held = arrivals(stream, digest).groupBy("digest").agg(F.min("at"), F.count(F.lit(1)))
    query = (held.writeStream.format("noop").outputMode("update").option("checkpointLocation", state)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def index(spark: SparkSession, state: str) -> DataFrame:
    """The state as a table: digest, ``first`` (identifier and locator), ``n``."""
    held = spark.read.format("statestore").load(state)
    return held.select("key.digest", F.col("value.min").alias("first"), F.col("value.count").alias("n"))


def _bit(digest: Column, chunks: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(chunks * BITMAP_BITS))


def _with_repeat_flag(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """``body`` only where the digest may be repeated, by a bitmap of the digests that are."""
    chunks = min(MAX_BITMAPS, max(1, repeated.count() * 16 // BITMAP_BITS + 1))
    bit = _bit(F.col("digest"), chunks)
    bitmaps = (repeated.select(F.bitmap_bucket_number(bit).alias("chunk"), F.bitmap_bit_position(bit).alias("bit"))
               .groupBy("chunk").agg(F.bitmap_construct_agg("bit").alias("bits")))
    position = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring("bits", (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))), 16, 10)
    may_repeat = F.getbit(byte.cast("int"), position.bitwiseAND(F.lit(7)).cast("int")) == 1
    return (rows.withColumn("chunk", F.bitmap_bucket_number(bit)).join(F.broadcast(bitmaps), "chunk", "left")
            .withColumn("body", F.when(may_repeat, F.col("body"))).drop("chunk", "bits"))


def judge(docs: DataFrame, held: DataFrame, digest: Callable[[Column], Column] = whole_digest) -> DataFrame:
    """One row per document of ``docs``, whose digests are all in ``held``; hits are checked by full bytes."""
    total = held.agg(F.sum("n")).first()[0]
    part_rows = max(total // LARGE_SHARE, LEAST_PART)
    parts = F.greatest(F.ceil(F.col("n") / part_rows), F.lit(1)).cast("int")
    large = held.where(F.col("n") > part_rows).select("digest", parts.alias("parts"), F.col("first").alias("large_first"))
    rows = _with_repeat_flag(arrivals(docs, digest), held.where("n > 1").select("digest"))
    own = F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("at.file", "at.row"), F.col("parts"))).otherwise(0).cast("int")
    everywhere = F.sequence(F.lit(0), F.col("parts") - 1)
    rows = (rows.join(F.broadcast(large), "digest", "left").withColumn("own", own)
            .withColumn("part", F.explode(F.when(F.col("at") == F.col("large_first"), everywhere)
                                          .otherwise(F.array("own")))).drop("parts", "large_first"))
    asked = held.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    together = Window.partitionBy("digest", "part")
    is_first = F.col("at") == F.col("first")
    met = (rows.join(asked, ["digest", "part"])
           .withColumn("first_body", F.max(F.when(is_first, F.col("body"))).over(together))
           .where(F.col("part") == F.col("own"))
           .withColumn("same", (F.col("n") == 1) | is_first | (F.col("body") == F.col("first_body"))))
    verdicts = keep_table(met.select("at", "sha256", "digest", "first", "n", "same",
                                     F.when(~F.col("same"), F.col("body")).alias("body")), "verdicts")
    strays = verdicts.where(~F.col("same"))
    if not strays.isEmpty():  # texts that differ and share a digest
        lost = strays.groupBy("digest").agg(F.count(F.lit(1)).alias("lost"))
        true = (verdicts.where("same").join(lost, "digest", "left")
                .withColumn("n", F.col("n") - F.coalesce("lost", F.lit(0))))
        groups = strays.groupBy("digest", "body").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
        apart = strays.drop("first", "n").join(groups, ["digest", "body"])
        verdicts = true.select("at", "sha256", "first", "n").union(apart.select("at", "sha256", "first", "n"))
    return verdicts.select(F.col("at.doc_id").alias("doc_id"), F.col("first.doc_id").alias("keep_id"),
                           F.col("n").alias("group_size"), (F.col("at") == F.col("first")).alias("kept"),
                           F.col("sha256").alias("text_sha256"))


def deduplicate(spark: SparkSession, path: str, state: str | None = None,
                digest: Callable[[Column], Column] = whole_digest) -> DataFrame:
    """Stream every file under ``path`` (a folder, or a pattern) into the state and judge all its rows."""
    docs = spark.read.parquet(path)
    if docs.isEmpty():
        return spark.createDataFrame([], RESULT)
    state = state or new_folder(spark, "seen")
    remember(spark, path, state, digest)
    return judge(docs, keep_table(index(spark, state), "seen-index"), digest)
