"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts and benchmark items are lower-cased, with single spaces. An item of m characters
that occurs with at most k edits shares at least ``m - q + 1 - k * q`` of its q-grams with
the place, all within k + 1 neighbouring diagonals (position in the text
minus position in the item). Hits of item q-grams in a text are therefore
counted per item in overlapping bands of 2 * (k + 1) diagonals; a band with fewer hits
cannot hold the item. Regions that reach the bound are verified by a
semi-global alignment inside their band, which gives the exact number of edits.

The benchmark is the stated query set: it is cut by item into blocks of at most
``BLOCK_GRAMS`` q-grams, and each block is matched against all whole texts.

Defined results: a null or empty text holds no item; null items and items shorter
than q characters are not searched for (their number is in ``Index.skipped``); rows of one doc_id
are documents of their own; several occurrences of an item in a text give one
row, with the fewest edits; equal items each give a row; empty tables give
an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import map_batches, texts_of

Q = 8
#: Edits allowed for each character of an item.
EDIT_RATE = 0.1
BLOCK_GRAMS = 1_000_000
FILTER_BITS = 22
SLAB_CHARS = 1 << 20

_FACTOR = np.uint32(0x9E3779B1)


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A 32-bit hash of the q-gram at each position; by doubling for powers of 2."""
    h, width, factor = codes, 1, int(_FACTOR)
    while 2 * width <= q:
        h = h[:-width] * np.uint32(factor) + h[width:]
        factor = factor * factor % 2**32
        width *= 2
    for i in range(width, q):
        h = h[:-1] * _FACTOR + codes[i:i + len(h) - 1]
    return h ^ (h >> np.uint32(15))


def edit_budget(m: int, q: int, rate: float) -> int:
    """Edits allowed for an item of m characters: the rate, as far as the lemma leaves a bound of 1 or more."""
    return max(0, min(int(m * rate), (m - q) // q))


class Index:
    """The q-grams of some items, with what each item needs."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, rate: float = EDIT_RATE):
        self.q = q
        kept = [(i, t) for i, raw in items if len(t := normal(raw or "")) >= q]
        self.skipped = len(items) - len(kept)
        self.ids, self.texts = [i for i, _ in kept], [t for _, t in kept]
        sizes = np.array([len(t) for t in self.texts], np.int64)
        self.budget = np.array([edit_budget(m, q, rate) for m in sizes], np.int64)
        self.bound = sizes - q + 1 - self.budget * q
        grams = [gram_hashes(_codes(t), q) for t in self.texts]
        h = np.concatenate([np.zeros(0, np.uint32), *grams])
        item = np.repeat(np.arange(len(kept)), [len(g) for g in grams])
        place = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(g)) for g in grams]])
        order = np.argsort(h, kind="stable")
        self.item, self.place = item[order].astype(np.int64), place[order].astype(np.int64)
        self.grams, self.begin, self.count = np.unique(h[order], return_index=True, return_counts=True)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self._slot(self.grams)] = True
        self.longest = int(sizes.max()) if len(sizes) else 0

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h * _FACTOR) >> np.uint32(32 - FILTER_BITS)

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, diagonal) of every pair of equal q-grams."""
        none = np.zeros(0, np.int64)
        if len(codes) < self.q or not len(self.grams):
            return none, none
        h = gram_hashes(codes, self.q)
        at = np.flatnonzero(self.filter[self._slot(h)])
        slot = np.searchsorted(self.grams, h[at])
        ok = (slot < len(self.grams)) & (self.grams[np.minimum(slot, len(self.grams) - 1)] == h[at])
        at, slot = at[ok], slot[ok]
        n = self.count[slot]
        entry = np.repeat(self.begin[slot] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.item[entry], np.repeat(at, n) - self.place[entry]

    def regions(self, codes: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, first diagonal, last diagonal) of the bands that reach their item's bound."""
        item, diagonal = self.hits(codes)
        total = np.bincount(item, minlength=len(self.ids))
        some = total[item] >= self.bound[item]
        item, diagonal = item[some], diagonal[some]
        if not len(item):
            return []
        step = self.budget[item] + 1
        half = (diagonal + self.longest) // step  # diagonals may be below 0
        cells, counts = np.unique((item << 40) | half, return_counts=True)
        out = []
        following = np.zeros(len(cells), np.int64)
        if len(cells) > 1:
            near = np.diff(cells) == 1
            following[:-1][near] = counts[1:][near]
        preceding = np.zeros(len(cells), np.int64)
        preceding[1:] = np.where(np.diff(cells) == 1, 1, 0)
        of = cells >> 40
        first = cells & ((1 << 40) - 1)
        for c in np.flatnonzero(counts + following >= self.bound[of]):
            step = int(self.budget[of[c]]) + 1
            low = int(first[c]) * step - self.longest
            out.append((int(of[c]), low, low + 2 * step - 1))
        return out

    def edits(self, text: str, item: int, low: int, high: int) -> int | None:
        """Fewest edits of the item within the band of the text, or None beyond its budget."""
        want, k = self.texts[item], int(self.budget[item])
        region = text[max(0, low - k):max(0, high + k + len(want))]
        if want in region:
            return 0
        return banded(_codes(want), _codes(text), low - k, high + k, k)


def banded(want: np.ndarray, text: np.ndarray, low: int, high: int, k: int) -> int | None:
    """Semi-global edit distance of ``want`` to any part of ``text`` on diagonals low to high, if at most k."""
    width = high - low + 1
    far = np.int32(k + 1)
    offset = np.arange(width, dtype=np.int32)
    n = len(text)
    position = low + offset  # in the text, before the next character
    row = np.where((position >= 0) & (position <= n), 0, far).astype(np.int32)  # the start is free
    for symbol in want:
        ok = (position >= 0) & (position < n)
        differs = np.ones(width, np.int32)
        differs[ok] = text[position[ok]] != symbol
        new = np.where(ok, row + differs, far)
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)  # a character of the item is missing
        position = position + 1
        new[(position < 0) | (position > n)] = far
        row = np.minimum.accumulate(new - offset) + offset  # characters too many
        row = np.minimum(row, far)
        if row.min() > k:
            return None
    best = int(row.min())
    return best if best <= k else None


def found_in(texts: list[str], index: Index) -> list[list[tuple[int, int]]]:
    """(item number, edits) for each text; texts are searched side by side, apart by more than any item."""
    out: list[dict[int, int]] = [{} for _ in texts]
    clean = [normal(t) for t in texts]
    gap = "\0" * (2 * index.longest + 2)
    a = 0
    while a < len(clean):
        b, size = a, 0
        while b < len(clean) and (b == a or size < SLAB_CHARS):
            size += len(clean[b])
            b += 1
        slab = gap.join(clean[a:b])
        starts = np.cumsum([0] + [len(t) + len(gap) for t in clean[a:b]])
        for item, low, high in index.regions(_codes(slab)):
            middle = (low + high) // 2 + len(index.texts[item]) // 2
            i = int(np.clip(np.searchsorted(starts, middle, "right") - 1, 0, b - a - 1))
            for j in {max(i - 1, 0), i, min(i + 1, b - a - 1)}:  # the region may begin or end in a gap
                at, text = int(starts[j]), clean[a + j]
                if high - at < -len(index.texts[item]) or low - at > len(text):
                    continue
                if out[a + j].get(item) == 0:
                    continue
                edits = index.edits(text, item, low - at, high - at)
                if edits is not None:
                    out[a + j][item] = min(edits, out[a + j].get(item, edits))
        a = b
    return [sorted(x.items()) for x in out]


# ---- Spark -----------------------------------------------------------------------------------------

def blocks(benchmark: DataFrame, key: str = "item_id", text: str = "text", most: int = BLOCK_GRAMS) -> list[Index]:
    """Indexes over the benchmark, each of at most about ``most`` q-grams (or one item)."""
    spark_rows = benchmark.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    chars = spark_rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-chars // most)
    part = F.pmod(F.xxhash64("key", "text"), F.lit(max(1, n)).cast("long"))
    return [Index([tuple(r) for r in spark_rows.where(part == b).orderBy("key", "text").collect()]) for b in range(n)]


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, edits) of every benchmark item found in a document."""
    schema = "doc_id bigint, item_id bigint, edits bigint"
    parts = [_block_leaks(docs, index, key, text) for index in blocks(benchmark)]
    return reduce(DataFrame.unionAll, parts) if parts else docs.sparkSession.createDataFrame([], schema)


def _block_leaks(docs: DataFrame, index: Index, key: str, text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)  # at most BLOCK_GRAMS q-grams

    def run(batches):
        own = shared.value
        for batch in batches:
            keys = batch.column(0).to_pylist()
            rows = [(k, own.ids[item], edits) for k, found in zip(keys, found_in(texts_of(batch.column(1)), own),
                                                                  strict=True) for item, edits in found]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)],
                                             ["doc_id", "item_id", "edits"])

    return map_batches(docs.select(F.col(key).cast("long").alias("key"), text), run,
                       "doc_id bigint, item_id bigint, edits bigint")


def drop_leaked(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their own columns."""
    at = docs.columns.index(text)
    for index in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            own = shared.value
            for batch in batches:
                yield batch.filter(pa.array([not x for x in found_in(texts_of(batch.column(at)), own)], pa.bool_()))

        docs = map_batches(docs, run, docs.schema)
    return docs
