"""Token ids in files of fixed-width bit packing.

Each id takes the fewest bits that hold the vocabulary. A shard file has

    magic, bits, ids in a block, documents, ids       five unsigned 64-bit integers
    document keys                                     int64 each (with a validity byte each)
    offsets of documents, in ids                      int64, one more than documents
    offsets of blocks, in bytes of the payload        int64, one more than blocks
    payload                                           blocks, each padded to whole bytes

so that any document or range of ids is unpacked by numpy from the blocks that
hold it. Documents are never split over shards and stand in ascending order of
their keys, within and across shards.

Defined results: a null or empty text is its end id alone; the name of an added
token inside a text, such as ``<|endoftext|>``, is that token, as the library reads it; a null key comes
before all others; rows of one key are ordered by their texts, repeated rows
stay; an empty table gives no shard and an empty result; other columns of the
input are not read.
"""

from __future__ import annotations

import json
import posixpath
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import map_batches, new_folder, open_store, texts_of, write_atomically

MAGIC = 0x31_4B_50_42
BLOCK_IDS = 4096
SHARD_IDS = 16 << 20
CACHE_ENTRIES = 400_000  # of each of two generations; about 150 bytes each
ENCODE_CHARS = 2 << 20


# ---- encoding -------------------------------------------------------------------------------

class CachedTokenizer:
    """The tokenizers library with a memory of pieces it has encoded.

    A byte-level tokenizer merges inside the matches of its pattern, so ids of a
    text are those of parts cut where the pattern always ends a match: before
    white space after another character, before a full stop or comma after a
    letter or digit, and before the last character of a run of white space. Parts
    come again and again; each is given to the library once while it is
    remembered. Texts with rarer white space or with the name of an added token,
    which the library reads as that token, and tokenizers of other kinds, go to
    the library whole.
    """

    _PART = re.compile(r" ?[^\W_]+(?=[.,\s])| ?\S+|\s+(?!\S)|\s+")
    _RARE_SPACE = re.compile("[" + "".join(map(chr, (
        *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + "]")

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self._added = re.compile("|".join(map(re.escape, added))) if added else None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.cuts = (pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
                     and not spec.get("normalizer") and not spec["model"].get("dropout")
                     and not any(c.isspace() for t in added for c in t))
        self.bytes_of = np.ones(1, np.int64)
        if self.cuts:  # a byte-level token has one character for each byte
            self.bytes_of = np.zeros(self.vocabulary, np.int64)
            for token, i in self.library.get_vocab(with_added_tokens=True).items():
                self.bytes_of[i] = len(token)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @property
    def vocabulary(self) -> int:
        return self.library.get_vocab_size(with_added_tokens=True)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _parts(self, parts: list[str]) -> list[bytes]:
        """Ids of parts: those like words are given to the library side by side and told apart by their bytes."""
        words = [p for p in parts if p[0] == " " and not p[-1].isspace()]
        out = dict.fromkeys(parts, b"")
        for i in range(0, len(words), 512):
            some = words[i:i + 512]
            ids = np.array(self.library.encode("".join(some), add_special_tokens=False).ids, "<u4")
            ends = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum([len(w.encode()) for w in some])) + 1
            raw, at = ids.tobytes(), 0
            for w, end in zip(some, (4 * ends).tolist(), strict=True):
                out[w] = raw[at:end]
                at = end
        rest = [p for p in parts if p[0] != " " or p[-1].isspace()]
        out.update(zip(rest, self._whole(rest), strict=True))
        return [out[p] for p in parts]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        parts = [self._PART.findall(t) if self.cuts and not self._RARE_SPACE.search(t)
                 and not (self._added and self._added.search(t)) else None for t in texts]
        if len(self.known) > CACHE_ENTRIES:  # two generations: what is still in use is taken over
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        found = [None if row is None else list(map(known.get, row)) for row in parts]
        holes = [_nones(ids) if ids else [] for ids in found]
        missing = {row[i] for row, at in zip(parts, holes, strict=True) for i in at}
        known.update((p, older[p]) for p in missing if p in older)
        new = list(missing.difference(older))
        known.update(zip(new, self._parts(new), strict=True))
        for row, ids, at in zip(parts, found, holes, strict=True):
            for i in at:
                ids[i] = known[row[i]]
        whole = iter(self._whole([t for t, row in zip(texts, parts, strict=True) if row is None]))
        return [next(whole) if ids is None else b"".join(ids) for ids in found]


def _nones(values: list) -> list[int]:
    """Positions of None."""
    out, at = [], -1
    try:
        while True:
            at = values.index(None, at + 1)
            out.append(at)
    except ValueError:
        return out


@lru_cache(maxsize=2)
def tokenizer(path: str) -> CachedTokenizer:
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return CachedTokenizer(path)


# ---- the format ------------------------------------------------------------------------------

def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids one after another, lowest bit first, padded to whole bytes."""
    if bits in (8, 16, 32):  # the same bytes without a detour
        return ids.astype(f"<u{bits // 8}").tobytes()
    rows = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(rows[:, :bits], bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    full = np.zeros((n, 32), np.uint8)
    full[:, :bits] = flat
    return np.packbits(full, axis=1, bitorder="little").view("<u4").reshape(n).astype(np.uint32)


def shard_parts(keys: list[int | None], ids: list[np.ndarray], bits: int, block: int = BLOCK_IDS):
    """The byte parts of one shard file."""
    offsets = np.zeros(len(ids) + 1, "<i8")
    np.cumsum([len(x) for x in ids], out=offsets[1:])
    stream = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    payload = [pack(stream[i:i + block], bits) for i in range(0, len(stream), block)]
    blocks = np.zeros(len(payload) + 1, "<i8")
    np.cumsum([len(x) for x in payload], out=blocks[1:])
    yield np.array([MAGIC, bits, block, len(keys), len(stream)], "<u8").tobytes()
    yield np.array([0 if k is None else k for k in keys], "<i8").tobytes()
    yield np.array([k is not None for k in keys], np.uint8).tobytes()
    yield offsets.tobytes()
    yield blocks.tobytes()
    yield from payload


class Shard:
    """One shard file, read by ranges: the index at once, ids block by block on demand."""

    def __init__(self, path: str):
        store, at = open_store(path)
        self._file = store.open_input_file(at)
        magic, self.bits, self.block, n, self.n_ids = (int(x) for x in np.frombuffer(self._read(0, 40), "<u8"))
        if magic != MAGIC:
            raise ValueError(f"{path} is not a shard of token ids")
        n_blocks = -(-self.n_ids // self.block)
        size = 8 * n + n + 8 * (n + 1) + 8 * (n_blocks + 1)
        index = self._read(40, size)
        valid = np.frombuffer(index, np.uint8, n, 8 * n)
        self.keys = [int(k) if v else None for k, v in zip(np.frombuffer(index, "<i8", n), valid, strict=True)]
        self.offsets = np.frombuffer(index, "<i8", n + 1, 9 * n)
        self.blocks = np.frombuffer(index, "<i8", n_blocks + 1, 9 * n + 8 * (n + 1))
        self._payload = 40 + size

    def _read(self, at: int, size: int) -> bytes:
        self._file.seek(at)
        return self._file.read(size)

    def range(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` (exclusive) of the shard; only their blocks are read."""
        if end <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block
        data = self._read(self._payload + int(self.blocks[first]), int(self.blocks[last + 1] - self.blocks[first]))
        base, out = int(self.blocks[first]), []
        for b in range(first, last + 1):
            n = min(self.block, self.n_ids - b * self.block)
            out.append(unpack(data[int(self.blocks[b]) - base:int(self.blocks[b + 1]) - base], n, self.bits))
        return np.concatenate(out)[start - first * self.block:end - first * self.block]

    def document(self, i: int) -> np.ndarray:
        return self.range(int(self.offsets[i]), int(self.offsets[i + 1]))

    def documents(self, ids_at_once: int = 1 << 20):
        """(key, first id, ids) of every document, read in long ranges."""
        i, n = 0, len(self.keys)
        while i < n:
            j = max(i + 1, int(np.searchsorted(self.offsets, self.offsets[i] + ids_at_once, "right")) - 1)
            a = int(self.offsets[i])
            ids = self.range(a, int(self.offsets[j]))
            for k in range(i, j):
                yield self.keys[k], int(self.offsets[k]), ids[int(self.offsets[k]) - a:int(self.offsets[k + 1]) - a]
            i = j


# ---- Spark ---------------------------------------------------------------------------------------

def write_shards(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, key: str = "doc_id",
                 text: str = "text", shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode every text, write the shards, and return their manifest (shard, n_docs, n_ids).

    Documents are dealt out by ranges of the key and sorted within each, so shard
    names sort as their documents do. A task writes a shard whenever it holds
    ``shard_ids`` ids, so its memory does not depend on the partition's size.
    The manifest is a table beside the shards and written once; a task that runs
    again writes the same files.
    """
    spark = docs.sparkSession
    ordered = (docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("body"))
               .repartitionByRange(F.col("key").asc_nulls_first(), F.xxhash64("body"))
               .sortWithinPartitions(F.col("key").asc_nulls_first(), F.xxhash64("body"), "body"))

    def run(batches):
        tok = tokenizer(tokenizer_path)
        bits = bits_for(tok.vocabulary)
        part, number = TaskContext.get().partitionId(), 0
        keys: list[int | None] = []
        ids: list[np.ndarray] = []
        held = 0

        def flush():
            nonlocal keys, ids, held, number
            name = f"ids-{part:06d}-{number:05d}.bin"
            write_atomically(folder, name, shard_parts(keys, ids, bits))
            row = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(keys)], pa.int64()),
                                              pa.array([held], pa.int64())], ["shard", "n_docs", "n_ids"])
            keys, ids, held, number = [], [], 0, number + 1
            return row

        for batch in batches:
            texts, of = texts_of(batch.column(1)), batch.column(0).to_pylist()
            for a, b in _by_chars(texts):
                for k, raw in zip(of[a:b], tok.encode(texts[a:b]), strict=True):
                    one = np.append(np.frombuffer(raw, "<u4"), np.uint32(end_id))
                    keys.append(k)
                    ids.append(one.astype(np.uint16) if bits <= 16 else one)
                    held += len(one)
                    if held >= shard_ids:
                        yield flush()
        if keys:
            yield flush()

    manifest = map_batches(ordered, run, "shard string, n_docs bigint, n_ids bigint")
    path = posixpath.join(folder, "manifest")
    manifest.write.parquet(path)
    return spark.read.schema(manifest.schema).parquet(path)


def _by_chars(texts: list[str]):
    """Ranges of texts of about ENCODE_CHARS characters together."""
    a = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= ENCODE_CHARS:
            yield a, i + 1
            a, size = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


def shard_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``base``: ids in all shards before. One row a shard, so one task is enough."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))


def read_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""

    def run(batches):
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys, starts, sizes, sums = [], [], [], []
                for key, first, ids in Shard(posixpath.join(folder, name)).documents():
                    keys.append(key)
                    starts.append(base + first)
                    sizes.append(len(ids))
                    sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (keys, starts, sizes, sums)],
                                                 ["doc_id", "start", "n_tokens", "ids_crc32"])

    shards = shard_starts(manifest).select("shard", "base")
    return map_batches(shards.repartition(max(1, manifest.count())), run,
                       "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def packed(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    folder = new_folder(spark, "token-ids")
    return read_shards(write_shards(docs, folder, tokenizer_path, end_id), folder)
