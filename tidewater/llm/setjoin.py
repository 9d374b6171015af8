"""N-gram Jaccard join, exact, by a size-aware light and heavy split.

A document's set holds its distinct word shingles, of ``WORDS`` words unless asked otherwise. Documents with equal sets are
one node. Two nodes link when ``100 * |A and B| >= percent * |A or B|``; the result is
each document's component under such links.

Light sets (few shingles) enumerate the subsets that a partner has to share: a set
of size a links with one of size b over a common subset of o shingles exactly when
a + b <= o * (100 + percent) / percent, so every subset group is joined as a
star around its smallest set and nothing is compared. Heavy sets scan inverted
lists, kept only for a prefix of each set under one order of all shingles:
shingles in few documents first, by hash, then the frequent ones. Two linked sets share
a shingle of their prefixes. The boundary is the size up to which subsets cost
less than scanning the lists.

Lists with the same members are scanned once. Scanning first links each
list's members to its smallest member, which joins groups of near copies with
as many tests as members. What is left are pairs in different components; their
bitmaps of shingle parities bound the symmetric difference from below, which
rejects nearly all in the task that holds the list, and long lists are cut in
blocks, dealt pair by pair of blocks. Pairs that the bound lets through are verified
on the whole sets, unless links already found join their components, so no component
is torn and none is made up, and what a task returns does not exceed what it reads.

Defined results: null and empty texts have no shingles and are their own
component; with fewer words than a shingle the whole sequence is one; rows of one
doc_id are handled as documents of their own; a null doc_id takes part and never
names a component unless nothing else can; an empty table gives an empty result.
Shingles are 64-bit hashes, sets 128-bit digests.
"""

from __future__ import annotations

import posixpath
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.columns import get, put, steps
from tidewater.llm.common import (broadcast_if_small, keep_bucketed, keep_table, map_batches, new_folder, open_store, texts_of,
                                  write_atomically)
from tidewater.llm.components import components

WORDS = 4
PERCENT = 85
#: Shingles counted together before they are dealt out, and owned by one bucket.
CHUNK_SHINGLES = 1_000_000
#: Counting names shingles by this many bits; a clash only makes one look more frequent.
COUNT_BITS = 44
#: A shingle in more sets than this is frequent; doubled until at most so many are. Below it,
#: shingles in at least so many sets are marked in bitmaps of 2 ** MARK_BITS bits by their names' top bits.
FREQUENT = 64
MOST_FREQUENT = 2_000_000
MARKED = (2, 8)
MARK_BITS = 27
LIGHT_SIZES = 24  # sizes for which subsets can pay at all
BITMAP_WORDS = 16
BLOCK = 1024
PAIRS_AT_ONCE = 1 << 16

_MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h = h * _MULTIPLIERS[1]
    return h ^ (h >> np.uint64(32))


class WordHashes(dict):
    """Hash of each word, remembered up to a bound."""

    MOST = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str, hashes: WordHashes, n: int = WORDS) -> np.ndarray:
    """Ascending hashes of the distinct shingles."""
    words = np.array([hashes[w] for w in text.encode().lower().split()], np.uint64)
    if not len(words):
        return words
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(words.tobytes(), seed=len(words))], np.uint64)
    h = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        h = h * _MULTIPLIERS[3] + words[i:len(words) - n + 1 + i] * _MULTIPLIERS[i % 4] + np.uint64(i + 1)
    return np.unique(_mix(h))


def least_overlap(size: int, percent: int) -> int:
    """Shingles that a set of this size shares with any set it links with."""
    return -(-percent * size // 100)


# ---- frequencies -----------------------------------------------------------------------------

def _mark_ranges(buckets: int) -> np.ndarray:
    """First mark of each bucket, in whole bytes, and the end of the last."""
    return (np.arange(buckets + 1, dtype=np.uint64) * np.uint64(2**MARK_BITS // 8) // np.uint64(buckets)) * np.uint64(8)


def count_shingles(docs: DataFrame, text: str, buckets: int, words: int = WORDS) -> DataFrame:
    """Per bucket: frequent shingles, document frequencies by powers of 2, and sizes of small sets."""

    def chunks(batches):
        hashes = WordHashes()
        held: list[np.ndarray] = []
        n = 0
        sizes = np.zeros(LIGHT_SIZES + 1, np.int64)

        def flush():
            nonlocal held, n, sizes
            names, counts = np.unique(np.concatenate(held), return_counts=True)
            # buckets are ranges of the marks, so each owns a part of the bitmaps
            ends = np.searchsorted(names >> np.uint64(COUNT_BITS - MARK_BITS), _mark_ranges(buckets))
            rows = [{"bucket": b, "sizes": None, "payload": put(steps(names[a:z]), counts[a:z].astype(np.uint32))}
                    for b, (a, z) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if z > a]
            rows.append({"bucket": 0, "sizes": sizes.tolist(), "payload": None})
            held, n, sizes = [], 0, np.zeros(LIGHT_SIZES + 1, np.int64)
            return pa.RecordBatch.from_pylist(rows, schema=schema)

        schema = pa.schema([("bucket", pa.int64()), ("sizes", pa.list_(pa.int64())), ("payload", pa.binary())])
        for batch in batches:
            for t in texts_of(batch.column(0)):
                s = shingles(t, hashes, words)
                if len(s) <= LIGHT_SIZES:
                    sizes[len(s)] += 1
                held.append(np.unique(s >> np.uint64(64 - COUNT_BITS)))
                n += len(s)
                if n >= CHUNK_SHINGLES:
                    yield flush()
        if held:
            yield flush()

    def merge(key, table):
        sizes = np.zeros(LIGHT_SIZES + 1, np.int64)
        names, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for row in table.to_pylist():
            if row["payload"] is None:
                sizes += np.array(row["sizes"])
            else:
                n, c = get(row["payload"])
                names.append(np.cumsum(n, dtype=np.uint64))
                counts.append(c.astype(np.int64))
        known, inverse = np.unique(np.concatenate(names), return_inverse=True)
        total = np.bincount(inverse, np.concatenate(counts), len(known)).astype(np.int64)
        often = total > FREQUENT
        level = np.log2(np.maximum(total, 1)).astype(np.int64)
        first, end = (int(x) for x in _mark_ranges(buckets)[key[0].as_py():][:2])
        marks = []
        for least in MARKED:
            bits = np.zeros(end - first, np.uint8)
            bits[(known[total >= least] >> np.uint64(COUNT_BITS - MARK_BITS)).astype(np.int64) - first] = 1
            marks.append(np.packbits(bits))
        return pa.table({
            "first": pa.array([first], pa.int64()), "marks": pa.array([put(*marks)], pa.binary()),
            "sizes": pa.array([sizes.tolist()], pa.list_(pa.int64())),
            "levels": pa.array([np.bincount(level[often], minlength=64).tolist()], pa.list_(pa.int64())),
            "entries": pa.array([int(total[~often].sum())], pa.int64()),
            "scans": pa.array([float((total[~often].astype(float) ** 2).sum())], pa.float64()),
            "names": pa.array([put(known[often], level[often].astype(np.uint8))], pa.binary())})

    counted = map_batches(docs.select(text), chunks, "bucket bigint, sizes array<bigint>, payload binary")
    return counted.groupBy("bucket").applyInArrow(
        merge, "first bigint, marks binary, sizes array<bigint>, levels array<bigint>, entries bigint, scans double, names binary")


class ShingleOrder:
    """The order of all shingles: by level of frequency, then by hash.

    Its size is fixed: two bitmaps, and at most MOST_FREQUENT names. The level is the number
    of bitmaps that mark the shingle or, for the frequent ones, comes with their names.
    Any order is right; a mark by mistake only makes a rare shingle come later.
    """

    def __init__(self, names: np.ndarray, levels: np.ndarray, marks: list[np.ndarray]):
        order = np.argsort(names)
        self.names, self.levels, self.marks = names[order], levels[order], marks

    def __getstate__(self):
        return put(steps(self.names), self.levels, *self.marks)

    def __setstate__(self, packed: bytes):
        names, self.levels, *self.marks = get(packed)
        self.names = np.cumsum(names, dtype=np.uint64)

    def prefix(self, s: np.ndarray, percent: int) -> np.ndarray:
        n = len(s) - least_overlap(len(s), percent) + 1
        short = s >> np.uint64(64 - COUNT_BITS)
        mark = (short >> np.uint64(COUNT_BITS - MARK_BITS)).astype(np.int64)
        level = np.zeros(len(s), np.uint8)
        for bits in self.marks:
            level += bits[mark >> 3] >> (7 - (mark & 7)).astype(np.uint8) & 1
        if len(self.names):
            at = np.minimum(np.searchsorted(self.names, short), len(self.names) - 1)
            level = np.where(self.names[at] == short, self.levels[at] + len(self.marks), level)
        return s[np.lexsort((s, level))[:n]]


def keep_order(spark, order: ShingleOrder) -> str:
    """The order as a file in the shared folder; tasks read it there, so no closure or broadcast carries it."""
    folder = new_folder(spark, "shingle-order")
    write_atomically(folder, "order", [order.__getstate__()])
    return posixpath.join(folder, "order")


@lru_cache(maxsize=1)
def order_at(path: str) -> ShingleOrder:
    store, at = open_store(path)
    order = ShingleOrder.__new__(ShingleOrder)
    with store.open_input_file(at) as f:
        order.__setstate__(f.read())
    return order


def subsets_of(size: int, percent: int) -> int:
    return sum(comb(size, o) for o in range(least_overlap(size, percent), size + 1))


def boundary(sizes: np.ndarray, scan: float, percent: int) -> int:
    """The largest size of light sets: up to it, subsets cost no more rows than prefixes and list scans.

    ``scan`` is the mean length of a list met by an entry.
    """
    light = 0
    for size in range(1, LIGHT_SIZES + 1):
        entries = size - least_overlap(size, percent) + 1
        if subsets_of(size, percent) > entries * (1 + scan):
            break
        light = size
    return light


def subset_keys(s: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """(o, key) of every subset that a link of this set can rest on."""
    whole = int(_mix(s).sum(dtype=np.uint64))
    mixed = [int(x) for x in _mix(s)]
    out = []
    for o in range(least_overlap(len(s), percent), len(s) + 1):
        for gone in combinations(mixed, len(s) - o):
            out.append((o, _signed((whole - sum(gone) + o * 0x9E3779B97F4A7C15) % 2**64)))
    return out


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


# ---- sets ----------------------------------------------------------------------------------------

def bitmap(s: np.ndarray) -> bytes:
    """Parity of the shingles that fall on each bit: sets differ in at least as many shingles as bits."""
    n = 64 * BITMAP_WORDS
    bits = np.bincount((s % np.uint64(n)).astype(np.int64), minlength=n) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def document_sets(docs: DataFrame, key: str, text: str, order_path: str, light: int, percent: int,
                  words: int = WORDS) -> DataFrame:
    """(doc_id, text_hash, digest, size, prefix, subset_sizes, subset_keys, bitmap) of every document.

    Light sets have subsets; sets that can link with a heavy one have a prefix.
    """
    heavy_from = least_overlap(light + 1, percent)

    def run(batches):
        hashes, order = WordHashes(), order_at(order_path)
        for batch in batches:
            cols: list[list] = [[], [], [], [], [], []]
            for t in texts_of(batch.column(2)):
                s = shingles(t, hashes, words)
                n = len(s)
                prefix = order.prefix(s, percent).view(np.int64) if n >= max(1, heavy_from) else None
                subsets = subset_keys(s, percent) if 0 < n <= light else []
                row = (digest(s), n, prefix, [x[0] for x in subsets], [x[1] for x in subsets], bitmap(s))
                for c, x in zip(cols, row, strict=True):
                    c.append(x)
            longs = pa.list_(pa.int64())
            kinds = (pa.binary(), pa.int64(), longs, longs, longs, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                ["doc_id", "text_hash", "digest", "size", "prefix", "subset_sizes", "subset_keys", "bitmap"])

    return map_batches(docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text),
                       run, "doc_id bigint, text_hash bigint, digest binary, size bigint, prefix array<bigint>, "
                            "subset_sizes array<bigint>, subset_keys array<bigint>, bitmap binary")


def whole_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, words: int = WORDS) -> DataFrame:
    """(node, shingles) of the wanted nodes, from the texts of their representatives.

    ``wanted`` has node, doc_id and digest; rows of that doc_id with another set fall away.
    """
    found = (docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("body"))
             .join(broadcast_if_small(wanted, 40), F.col("key").eqNullSafe(F.col("doc_id"))).select("node", "digest", "body"))

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(t, hashes, words) for t in texts_of(batch.column(2))]
            own = [digest(s) == d for s, d in zip(sets, batch.column(1).to_pylist(), strict=True)]
            nodes = [n for n, ok in zip(batch.column(0).to_pylist(), own, strict=True) if ok]
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()),
                 pa.array([put(steps(s)) for s, ok in zip(sets, own, strict=True) if ok], pa.binary())],
                ["node", "shingles"])

    return map_batches(found, run, "node bigint, shingles binary").dropDuplicates(["node"])


# ---- links ---------------------------------------------------------------------------------------

def light_links(nodes: DataFrame, percent: int) -> DataFrame:
    """Links between light sets: in each group of equal subsets, a star around its smallest set.

    If x and y link over a subset, each also fits with the group's smallest set, so
    the stars join what links join, and every edge of a star is a link.
    """
    entries = nodes.select("node", "size", F.explode(F.arrays_zip("subset_sizes", "subset_keys")).alias("s")) \
        .select("node", "size", F.col("s.subset_sizes").alias("o"), F.col("s.subset_keys").alias("key"))
    least = entries.groupBy("o", "key").agg(F.min(F.struct("size", "node")).alias("least"), F.count("*").alias("n")) \
        .where("n > 1")
    return (entries.join(least, ["o", "key"]).where(F.col("node") != F.col("least.node"))
            .where((F.col("size") + F.col("least.size")) * percent <= F.col("o") * (100 + percent))
            .select(F.col("least.node").alias("a"), F.col("node").alias("b")).distinct())


def inverted_lists(nodes: DataFrame) -> DataFrame:
    """(list, node, size, centre, centre_size): lists of two nodes or more, one for each set of members.

    A list is named by the sum of its members' hashes, so lists with the same members fall together.
    """
    entries = nodes.select("node", F.explode("prefix").alias("shingle"))
    of = Window.partitionBy("shingle")
    named = entries.select("node", F.count("*").over(of).alias("n"),
                           F.sum(F.xxhash64("node").cast("decimal(20,0)")).over(of).alias("list"))
    listed = (named.where("n > 1")
              .select(F.concat_ws(":", F.col("list").cast("string"), F.col("n").cast("string")).alias("list"), "node")
              .distinct().join(nodes.select("node", "size"), "node"))
    centres = listed.groupBy("list").agg(F.min(F.struct("size", "node")).alias("centre"))
    return listed.join(centres, "list").select(
        "list", "node", "size", F.col("centre.node").alias("centre"), F.col("centre.size").alias("centre_size"))


def most_difference(a, b, percent: int):
    """The largest symmetric difference of linked sets of sizes a and b."""
    return a + b - 2 * (-(-percent * (a + b) // (100 + percent)))


def _close(maps: np.ndarray, sizes: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs may link, by sizes and bitmaps."""
    a, b = sizes[i], sizes[j]
    ok = percent * np.maximum(a, b) <= 100 * np.minimum(a, b)
    at = np.flatnonzero(ok)
    for k in range(0, len(at), PAIRS_AT_ONCE):
        some = at[k:k + PAIRS_AT_ONCE]
        bits = np.bitwise_count(maps[i[some]] ^ maps[j[some]]).sum(axis=1, dtype=np.int64)
        ok[some] = bits <= most_difference(a[some], b[some], percent)
    return ok


def _maps(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, BITMAP_WORDS)


def bounded_pairs(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and bitmaps allow."""
    of = nodes.select("node", "size", "bitmap")
    both = (pairs.join(of.toDF("a", "size_a", "bitmap_a"), "a").join(of.toDF("b", "size_b", "bitmap_b"), "b"))

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            maps = np.concatenate([_maps(batch.column(3)), _maps(batch.column(5))])
            sizes = np.concatenate([batch.column(2).to_numpy(), batch.column(4).to_numpy()])
            ok = pa.array(_close(maps, sizes, np.arange(n), np.arange(n) + n, percent))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], ["a", "b"])

    return map_batches(both.select("a", "b", "size_a", "bitmap_a", "size_b", "bitmap_b"), run, "a bigint, b bigint")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets; pairs are compared one by one."""
    both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")

    def run(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = (np.cumsum(get(s)[0], dtype=np.uint64) for s in (x, y))
                ok.append(_linked(x, y, percent))
            ok = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], ["a", "b"])

    return map_batches(both.select("a", "b", "set_a", "set_b"), run, "a bigint, b bigint")


def _whole_units(batches):
    """Tables that hold whole units of the sorted input, and where each unit begins in them (with the end)."""
    rest = None
    for batch in batches:
        rest = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables(
            [rest, pa.Table.from_batches([batch])])
        unit = np.array(rest.column("unit").to_pylist(), object)
        begins = np.flatnonzero(np.append(True, unit[1:] != unit[:-1])) if len(unit) else []
        if len(begins) > 1:  # the last unit may go on in the next batch
            yield rest.slice(0, begins[-1]), begins
            rest = rest.slice(begins[-1])
    if rest is not None and rest.num_rows:
        yield rest, np.array([0, rest.num_rows])


def _candidates(table: pa.Table, percent: int):
    """(first, end, i, j) of each unit: pairs of different components that sizes and bitmaps allow."""
    sizes, roots, mine = (table.column(c).to_numpy() for c in ("size", "root", "mine"))
    apart = np.array(table.column("apart").to_pylist(), bool)
    maps = _maps(table.column("bitmap"))

    def of(first, end):
        n = end - first
        step = max(1, PAIRS_AT_ONCE // n)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for row in range(first, end, step):  # some rows of the triangle at a time
            mine_rows = np.arange(row, min(row + step, end))
            i, j = np.repeat(mine_rows, n), np.tile(np.arange(first, end), len(mine_rows))
            ok = (j > i) & (roots[i] != roots[j]) & (~apart[i] | (mine[i] != mine[j]))
            i, j = i[ok], j[ok]
            ok = _close(maps, sizes, i, j, percent)
            found.append((i[ok], j[ok]))
        return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])

    return of


def _units(now: DataFrame) -> DataFrame:
    """(unit, apart, mine, node, size, root) of the members (list, node, size, root) of lists with several roots.

    A list longer than BLOCK is cut by hash; each pair of its blocks is a unit of work,
    so a long list is compared by many tasks, each with two blocks at a time. In a unit of two blocks
    (``apart``) only pairs across them count, for pairs within a block have their own unit.
    """
    mixed = (now.groupBy("list").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("n"))
             .where("r0 <> r1").select("list", F.ceil(F.col("n") / BLOCK).cast("long").alias("blocks")))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks"))
    cut = now.join(mixed, "list").withColumn("mine", mine).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    unit = F.concat_ws("/", "list", F.least("mine", "other").cast("string"), F.greatest("mine", "other").cast("string"))
    two = F.split("unit", "/")
    return cut.select(unit.alias("unit"), "mine", "node", "size", "root").withColumn("apart", two[1] != two[2])


def scanned_members(lists: DataFrame, roots: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The members of lists that have a possible partner in another component, by unit."""
    now = (lists.join(roots, "node", "left")
           .select("list", "node", "size", F.coalesce("root", "node").alias("root")))
    dealt = (_units(now).join(nodes.select("node", "bitmap"), "node")
             .select("unit", "apart", "mine", "node", "size", "root", "bitmap")
             .repartition("unit").sortWithinPartitions("unit"))

    def run(batches):
        for table, begins in _whole_units(batches):
            of = _candidates(table, percent)
            kept = np.zeros(table.num_rows, bool)
            for first, end in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
                i, j = of(first, end)
                kept[i] = True
                kept[j] = True
            yield from table.filter(pa.array(kept)).to_batches()

    return map_batches(dealt, run, dealt.schema)


def scanned_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that join components, at most one fewer in a unit than it has members.

    What the scan left are few nodes, each in many lists. Nodes that met in a list are
    gathered, so that each whole set is dealt once for its gathering (or for each pair of
    blocks of a long one). Possible pairs are verified on the whole sets unless links found before
    in the unit join them already.
    """
    least = members.groupBy("unit").agg(F.min("node").alias("a"))
    met = members.join(least, "unit").select("a", F.col("node").alias("b")).where("a <> b")
    gathered = keep_table(components(met), "gatherings")
    one = members.select("node", "size", "root", "bitmap").dropDuplicates(["node"])
    now = one.join(gathered.toDF("node", "list"), "node").withColumn("list", F.col("list").cast("string"))
    dealt = (_units(now.select("list", "node", "size", "root"))
             .join(one.select("node", "bitmap"), "node").join(sets, "node")
             .select("unit", "apart", "mine", "node", "size", "root", "bitmap", "shingles")
             .repartition("unit").sortWithinPartitions("unit"))

    def run(batches):
        for table, begins in _whole_units(batches):
            of = _candidates(table, percent)
            nodes, roots = table.column("node").to_pylist(), table.column("root").to_pylist()
            packed = table.column("shingles")
            a, b = [], []
            for first, end in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
                parent = {r: r for r in roots[first:end]}
                held: dict[int, np.ndarray] = {}

                def find(x, parent=parent):
                    while parent[x] != x:
                        parent[x] = parent[parent[x]]
                        x = parent[x]
                    return x

                def whole(i, held=held):
                    if i not in held:
                        held[i] = np.cumsum(get(packed[i].as_py())[0], dtype=np.uint64)
                    return held[i]

                for i, j in zip(*(x.tolist() for x in of(first, end)), strict=True):
                    x, y = find(roots[i]), find(roots[j])
                    if x != y and _linked(whole(i), whole(j), percent):
                        parent[max(x, y)] = min(x, y)
                        a.append(min(nodes[i], nodes[j]))
                        b.append(max(nodes[i], nodes[j]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return map_batches(dealt, run, "a bigint, b bigint").distinct()


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def join(docs: DataFrame, percent: int = PERCENT, key: str = "doc_id", text: str = "text",
         words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, text_hash, root) of every document.

    ``root`` names the component also where doc_ids are null or repeated; it is null without shingles.
    """
    spark = docs.sparkSession
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = keep_table(count_shingles(docs, text, shuffles, words), "shingles")
    order, light = _order_of(counted, percent)

    sets = keep_table(document_sets(docs, key, text, keep_order(spark, order), light, percent, words)
                      .withColumn("row", F.monotonically_increasing_id()), "sets")
    # one node for each set: the row that stands for it, and the smallest doc_id
    classes = keep_table(sets.where("size > 0").groupBy("digest").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("least_id"), F.count("*").alias("copies")), "classes")
    copied = keep_table(classes.where("copies > 1").select("digest", "node"), "copied")
    nodes = (sets.where("size > 0").join(broadcast_if_small(copied, 40), "digest", "left")
             .where("node IS NULL OR node = row").drop("node").withColumnRenamed("row", "node"))

    lists = keep_table(inverted_lists(nodes), "lists")
    listed = lists.select("node").distinct()
    held = keep_table(sets.withColumnRenamed("row", "node").join(listed, "node", "left_semi")
                      .select("node", "doc_id", "digest", "size", "bitmap"), "listed")
    whole = keep_bucketed(whole_sets(docs, held.select("node", "doc_id", "digest"), key, text, words), "whole_sets", "node")

    stars = (lists.where("node <> centre").where(F.col("centre_size") * 100 >= F.col("size") * percent)
             .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct())
    links = keep_table(verified(bounded_pairs(stars, held, percent), whole, percent)
                       .union(light_links(nodes, percent)), "star-links")
    roots = keep_table(components(links), "roots")
    members = keep_table(scanned_members(lists, roots, held, percent), "members")
    across = scanned_links(members, whole, percent)
    # what the stars joined stands for its root, so the second graph is small
    root_of = lambda c: F.coalesce(F.col(f"{c}_root"), F.col(c))
    joined = (across.join(roots.toDF("a", "a_root"), "a", "left").join(roots.toDF("b", "b_root"), "b", "left")
              .select(root_of("a").alias("a"), root_of("b").alias("b")))
    final = components(joined.union(roots.where("node <> root").select("root", "node")))

    named = (classes.join(final, "node", "left").withColumn("root", F.coalesce("root", "node")))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_set = named.join(least, "root").select("digest", "component_id", "root")
    return (sets.select("doc_id", "text_hash", "digest", "size").join(by_set, "digest", "left")
            .select("doc_id", F.col("size").alias("n_shingles"),
                    F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    "text_hash", "root"))


def one_of_each(docs: DataFrame, percent: int = PERCENT, key: str = "doc_id", text: str = "text",
                words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` without those that link to another one that stays, with their own columns.

    Of each component the document with the smallest (key, text hash) stays, once; documents
    without shingles stay, once each. Rows are told apart by key and text hash, so neither null nor
    repeated keys lose a text.
    """
    found = keep_table(join(docs, percent, key, text, words).select("doc_id", "text_hash", "root"), "components")
    rows = found.groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("times"))
    first = rows.where("root IS NOT NULL").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")).alias("first"))
    marked = rows.join(first, "root", "left").select(
        F.col("doc_id").alias("of"), "text_hash", "times",
        (F.col("root").isNull() | (F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
                                   & (F.col("text_hash") == F.col("first.text_hash")))).alias("stays"))
    marked = keep_table(marked.where("NOT stays OR times > 1"), "copies")

    def listed(which):
        """Condition that a row is one of the listed ones, and the list."""
        these = broadcast_if_small(keep_table(marked.where(which).select("of", "text_hash"), "listed-copies"), 40)
        return these, F.col(key).cast("long").eqNullSafe(these["of"]) & (F.xxhash64(docs[text]) == these["text_hash"])

    gone, is_gone = listed("NOT stays")
    many, is_many = listed("stays AND times > 1")
    left = docs.join(gone, is_gone, "left_anti")
    again = left.join(many, is_many, "left_semi")
    return left.join(many, is_many, "left_anti").unionByName(again.dropDuplicates([key, text]))


def _order_of(counted: DataFrame, percent: int) -> tuple[ShingleOrder, int]:
    """The shingle order and the boundary, from sums, bitmaps of fixed size and at most MOST_FREQUENT names."""
    sizes, levels = np.zeros(LIGHT_SIZES + 1, np.int64), np.zeros(64, np.int64)
    sums = counted.select(F.posexplode("levels")).groupBy("pos").agg(F.sum("col").alias("n")).collect()
    for pos, n in sums:
        levels[pos] = n
    for pos, n in counted.select(F.posexplode("sizes")).groupBy("pos").agg(F.sum("col").alias("n")).collect():
        sizes[pos] = n
    entries, scans = counted.agg(F.sum("entries"), F.sum("scans")).first()
    least = 0
    while levels[least:].sum() > MOST_FREQUENT:
        least += 1
    names, of_names = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)]
    marks = [np.zeros(2**MARK_BITS // 8, np.uint8) for _ in MARKED]
    for first, some, payload in counted.select("first", "marks", "names").toLocalIterator():
        for whole, part in zip(marks, get(some), strict=True):
            whole[first // 8:first // 8 + len(part)] = part
        n, level = get(payload)
        names.append(n[level >= least])
        of_names.append(level[level >= least])
    scan = scans / entries if entries else 1.0
    return ShingleOrder(np.concatenate(names), np.concatenate(of_names), marks), boundary(sizes, scan, percent)
