"""Substring dedup by content-defined chunking with a gear rolling hash.

A text is lower-cased and its white space made single spaces. A gear hash rolls
over its bytes, and the text is cut at the ends of words where the hash of the last
``GEAR_BYTES`` bytes has its top ``CUT_BITS`` bits clear: on average every 2**CUT_BITS words. Cuts
depend on nearby bytes only, so after an insertion the same chunks come back.
Each chunk is known by its digest. Neighbouring chunks whose digests occur more
than once in the corpus form a run, and a run of ``MIN_WORDS`` words or more is a
repeated passage. (A repeated passage loses less than a chunk, and the bytes
of the gear hash, at either end, which is why the bound is below the 50 words that
passages worth removing have.)

Digests are counted as in a join without its rows: documents are held in groups,
each group asks the owner of a digest once for each distinct digest, and is told whether it
comes again and whether the group holds its first occurrence. Order of
occurrences is that of groups, then of documents in them; exactly one
occurrence of each digest is the first.

``exact_passages`` is the operator of the query and takes repeated chunks as seeds only. A seed is the digest of the
``SEED_WORDS`` words after a cut, and every word end of a stretch without a cut of more than ``MOST_GAP`` words
is a cut there. Two copies of ``PASSAGE_WORDS`` words share a cut in their first half, whatever stands around
them, so no copy is missed: cuts depend on ``GEAR_BYTES`` bytes, which 9 words fill, and of the 18 word ends that follow
one is a cut. Each window of ``PASSAGE_WORDS`` words that holds a repeated seed is then counted by its own
digest; a passage is a run of neighbouring windows that occur more than once, exact to the word. Which copy
stays is settled window by window.

Defined results: null and empty texts have no chunks; a text with no place to cut
is cut after ``MOST_WORDS`` words; rows of one doc_id are documents of their own; a
null doc_id is kept; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.columns import coded, get, put, steps
from tidewater.llm.common import bounded_batches, keep_bucketed, map_batches, texts_of
from tidewater.llm.setjoin import WordHashes

GEAR_BYTES = 16
CUT_BITS = 2
MOST_WORDS = 64
MIN_WORDS = 30
GROUP_CHUNKS = 1_000_000
BUCKET_CHUNKS = 1_500_000
PASSAGE_WORDS = 50
SEED_WORDS = 24
MOST_GAP = 16
GROUP_WORDS = 1_000_000

#: One random number for each byte value, from a fixed seed.
GEAR = np.random.default_rng(20240229).integers(0, 2**16, 256, dtype=np.uint16)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte: shift left by one, add the byte's gear; 16 bits hold 16 bytes."""
    h = GEAR[data]
    for k in (1, 2, 4, 8):  # doubles the bytes that are summed
        h[k:] = h[k:] + (h[:-k] << np.uint16(k))
    return h


def cut(normal: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(end byte, end word) of each chunk of a normalised text; ends are exclusive."""
    data = np.frombuffer(normal, np.uint8)
    ends = np.append(np.flatnonzero(data == 32), len(data))  # of words
    words = np.flatnonzero(gear_hashes(data)[ends - 1] >> np.uint16(16 - CUT_BITS) == 0) + 1
    words = np.unique(np.append(words, len(ends)))
    gaps = np.diff(words, prepend=0)
    if gaps.max() > MOST_WORDS:
        before = words - gaps
        extra = [np.arange(b + MOST_WORDS, w, MOST_WORDS) for b, w in zip(before, words, strict=True) if w - b > MOST_WORDS]
        words = np.unique(np.concatenate([words, *extra]))
    return ends[words - 1], words


def word_offsets(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of each word of a text, in code points."""
    data = np.frombuffer(raw, np.uint8)
    space = SPACE[data]
    point = np.cumsum((data & 0xC0) != 0x80) - 1
    before = np.concatenate([[True], space[:-1]])
    after = np.concatenate([space[1:], [True]])
    return point[~space & before], point[~space & after] + 1


def chunks(text: str):
    """(digests, end words, start and end code points) of the chunks of a text."""
    raw = text.encode()
    normal = b" ".join(text.lower().encode().split())
    if not normal:
        return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 3
    end_byte, end_word = cut(normal)
    begin = np.concatenate([[0], end_byte[:-1] + 1])
    digest = xxhash.xxh3_64_intdigest
    digests = np.array([digest(normal[a:b]) for a, b in zip(begin.tolist(), end_byte.tolist(), strict=True)], np.uint64)
    starts, ends = word_offsets(raw)
    return digests, end_word, starts[np.concatenate([[0], end_word[:-1]])], ends[end_word - 1]


# ---- groups of documents ---------------------------------------------------------------------

GROUP = pa.schema([("group", pa.int64()), ("n_chunks", pa.int64()), ("docs", pa.binary()), ("digests", pa.binary()),
                   ("places", pa.binary())])


def write_groups(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Chunks of whole documents in groups, as a table bucketed by group."""

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        keys: list = []
        held: list = []
        n = 0

        def flush():
            nonlocal keys, held, n, number
            digests, words, starts, ends = (np.concatenate([x[i] for x in held]) for i in range(4))
            sizes = np.array([len(x[0]) for x in held], np.uint32)
            row = pa.RecordBatch.from_pylist([{
                "group": (part << 24) | number, "n_chunks": n,
                "docs": put(np.array([0 if k is None else k for k in keys], np.int64),
                            np.array([k is not None for k in keys], np.uint8), sizes),
                "digests": put(digests),
                "places": put(np.diff(words, prepend=0).astype(np.int32), np.diff(starts, prepend=0).astype(np.int32),
                              (ends - starts).astype(np.uint32))}], schema=GROUP)
            keys, held, n, number = [], [], 0, number + 1
            return row

        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                found = chunks(t)
                keys.append(k)
                held.append(found)
                n += len(found[0])
                if n >= GROUP_CHUNKS:
                    yield flush()
        if keys:
            yield flush()

    source = docs.select(F.col(key).cast("long").alias("key"), text)
    return keep_bucketed(map_batches(source, run, "group bigint, n_chunks bigint, docs binary, digests binary, "
                                                  "places binary"), "chunk_groups", "group")


def _owners(digests: np.ndarray, buckets: int):
    """(bucket, positions) of the distinct ascending digests of a group."""
    of = digests % np.uint64(buckets)
    order = np.argsort(of, kind="stable")
    ends = np.searchsorted(of[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(ends)):
        yield int(b), order[ends[b]:ends[b + 1]]


def digest_counts(groups: DataFrame, buckets: int) -> DataFrame:
    """(group, bucket, payload): for each digest a group asked about, its count in the corpus and its first group."""

    def ask(batches):
        for batch in batches:
            for group, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                known, counts = np.unique(get(payload)[0], return_counts=True)
                for b, at in _owners(known, buckets):
                    yield pa.RecordBatch.from_pylist([{
                        "bucket": b, "group": group,
                        "payload": put(steps(known[at]), np.minimum(counts[at], 2**31).astype(np.uint32))}])

    def answer(key, table):
        rows = sorted(((r["group"], *get(r["payload"])) for r in table.to_pylist()), key=lambda x: x[0])
        digests = np.concatenate([np.cumsum(x[1], dtype=np.uint64) for x in rows])
        known, first, inverse = np.unique(digests, return_index=True, return_inverse=True)
        total = np.bincount(inverse, np.concatenate([x[2] for x in rows]), len(known)).astype(np.int64)
        is_first = np.zeros(len(digests), np.uint8)
        is_first[first] = 1  # groups ascend, so the first index is in the first group
        out, at = [], 0
        for group, mine, _ in rows:
            i = slice(at, at + len(mine))
            at += len(mine)
            out.append({"group": group, "bucket": key[0].as_py(),
                        "payload": put(np.minimum(total[inverse[i]], 2**32 - 1).astype(np.uint32), is_first[i])})
        return pa.Table.from_pylist(out, schema=pa.schema(
            [("group", pa.int64()), ("bucket", pa.int64()), ("payload", pa.binary())]))

    asked = map_batches(groups.select("group", "digests"), ask, "bucket bigint, group bigint, payload binary")
    return asked.groupBy("bucket").applyInArrow(answer, "group bigint, bucket bigint, payload binary")


SPANS = ("doc_id bigint, start bigint, end bigint, n_words bigint, n_copies bigint, is_first boolean")


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text",
                      min_words: int = MIN_WORDS) -> DataFrame:
    """One row for each repeated passage of each document.

    Columns: doc_id, start and end (code points, end exclusive), n_words, n_copies (occurrences of
    its rarest chunk), is_first (no chunk of it occurs earlier, so this copy stays).
    """
    groups = write_groups(docs, key, text)
    n = groups.agg(F.sum("n_chunks")).first()[0] or 0
    buckets = max(1, math.ceil(n / BUCKET_CHUNKS))
    answers = digest_counts(groups, buckets)
    bounded_batches(docs.sparkSession)

    def run(key, left, right):
        row = left.to_pylist()[0]
        keys, valid, sizes = get(row["docs"])
        (digests,) = get(row["digests"])
        words, starts, lengths = get(row["places"])
        known, first_at, inverse = np.unique(digests, return_index=True, return_inverse=True)
        count, here = np.zeros(len(known), np.int64), np.zeros(len(known), bool)
        given = {r["bucket"]: r["payload"] for r in right.to_pylist()}
        for b, at in _owners(known, buckets):
            total, first = get(given[b])
            count[at], here[at] = total, first.astype(bool)
        count = count[inverse]
        is_first = np.zeros(len(digests), bool)
        is_first[first_at] = here
        doc = np.repeat(np.arange(len(keys)), sizes)
        words, starts = np.cumsum(words), np.cumsum(starts)
        begin = np.concatenate([[0], np.cumsum(sizes[:-1], dtype=np.int64)]).astype(np.int64)
        in_chunk = np.diff(words, prepend=0)
        has = sizes > 0
        in_chunk[begin[has]] = words[begin[has]]
        again = count > 1
        edge = again.copy()
        edge[1:] &= ~again[:-1] | (doc[1:] != doc[:-1])
        runs = np.flatnonzero(edge)
        if not len(runs):
            return pa.table({n: pa.array([], t) for n, t in kinds})
        run_of = np.cumsum(edge) - 1
        at = np.flatnonzero(again)
        of = run_of[at]
        last = np.append(np.flatnonzero(np.diff(of)), len(of) - 1)
        n_words = np.bincount(of, in_chunk[at], len(runs)).astype(np.int64)
        least = np.minimum.reduceat(count[at], np.searchsorted(of, np.arange(len(runs))))
        earlier = np.bincount(of, ~is_first[at], len(runs)) > 0
        ok = n_words >= min_words
        ends = (starts + lengths)[at[last]]
        return pa.table({
            "doc_id": pa.array(keys[doc[runs]][ok], pa.int64(), mask=(valid[doc[runs]] == 0)[ok]),
            "start": starts[runs][ok].astype(np.int64), "end": ends[ok].astype(np.int64), "n_words": n_words[ok],
            "n_copies": least[ok].astype(np.int64), "is_first": ~earlier[ok]})

    kinds = (("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("n_words", pa.int64()),
             ("n_copies", pa.int64()), ("is_first", pa.bool_()))
    return groups.groupBy("group").cogroup(answers.groupBy("group")).applyInArrow(run, SPANS)


# ---- exact passages ----------------------------------------------------------------------------

def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of each pair of hashes."""
    h = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def window_digests(hashes: np.ndarray, width: int) -> np.ndarray:
    """A digest of the ``width`` words from each word on, as far as so many are left."""
    if len(hashes) < width:
        return np.zeros(0, np.uint64)
    size = 1
    while 2 * size <= width:
        hashes = _mixed(hashes[:-size], hashes[size:])
        size *= 2
    rest = width - size
    return _mixed(hashes[:len(hashes) - rest], hashes[rest:])


def seed_places(normal: bytes) -> np.ndarray:
    """Words of a normalised text at which seeds start: its first, and those after a cut."""
    data = np.frombuffer(normal, np.uint8)
    ends = np.append(np.flatnonzero(data == 32), len(data))
    cuts = gear_hashes(data)[ends - 1] >> np.uint16(16 - CUT_BITS) == 0
    at = np.concatenate([[-1], np.flatnonzero(cuts), [len(ends)]])
    cuts |= np.repeat(np.diff(at) > MOST_GAP, np.diff(at))[:len(cuts)]
    return np.append(0, np.flatnonzero(cuts[:-1]) + 1)


def _in_document(sizes: np.ndarray, width: int) -> np.ndarray:
    """For each word of a group, whether ``width`` words of its document are left from there on."""
    ends = np.repeat(np.cumsum(sizes, dtype=np.int64), sizes)
    return np.arange(len(ends)) + width <= ends


WORD_GROUPS = "group bigint, n_seeds bigint, docs binary, words binary, places binary, seeds binary"


def write_words(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Words of whole documents in groups, with the places of their seeds, as a table bucketed by group."""

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        hashes = WordHashes()
        keys: list = []
        held: list = []
        n = 0

        def flush():
            nonlocal keys, held, n, number
            sizes = np.array([len(x[0]) for x in held], np.uint32)
            words, starts, ends = (np.concatenate([x[i] for x in held]) for i in range(3))
            before = np.cumsum(sizes, dtype=np.int64) - sizes
            seeds = np.concatenate([x[3] + b for x, b in zip(held, before, strict=True)])
            seeds = seeds[_in_document(sizes, SEED_WORDS)[seeds]]
            row = pa.RecordBatch.from_pylist([{
                "group": (part << 24) | number, "n_seeds": len(seeds),
                "docs": put(np.array([0 if k is None else k for k in keys], np.int64),
                            np.array([k is not None for k in keys], np.uint8), sizes),
                "words": put(*coded(words)),
                "places": put(np.diff(starts, prepend=0).astype(np.int32), (ends - starts).astype(np.uint32)),
                "seeds": put(np.diff(seeds, prepend=0).astype(np.uint32))}])
            keys, held, n, number = [], [], 0, number + 1
            return row

        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                words = t.lower().encode().split()
                if len(words) < PASSAGE_WORDS:
                    continue
                keys.append(k)
                held.append((np.array([hashes[w] for w in words], np.uint64), *word_offsets(t.encode()),
                             seed_places(b" ".join(words))))
                n += len(words)
                if n >= GROUP_WORDS:
                    yield flush()
        if keys:
            yield flush()

    source = docs.select(F.col(key).cast("long").alias("key"), text)
    return keep_bucketed(map_batches(source, run, WORD_GROUPS), "word_groups", "group")


def _seeds_of(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sizes of documents, word hashes, words where seeds start, their digests) of a group."""
    sizes = get(row["docs"])[2]
    codes, values = get(row["words"])
    words = values[codes]
    at = np.cumsum(get(row["seeds"])[0], dtype=np.int64)
    return sizes, words, at, window_digests(words, SEED_WORDS)[at] if len(at) else np.zeros(0, np.uint64)


def seed_digests(groups: DataFrame) -> DataFrame:
    """(group, digests) of the seeds."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist([{"group": row["group"], "digests": put(_seeds_of(row)[3])}])

    return map_batches(groups.select("group", "docs", "words", "seeds"), run, "group bigint, digests binary")


def _answered(digests: np.ndarray, right: pa.Table, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(occurrences in the corpus, whether it is the first one) of each digest of a group."""
    known, first_at, inverse = np.unique(digests, return_index=True, return_inverse=True)
    count, here = np.zeros(len(known), np.int64), np.zeros(len(known), bool)
    given = {r["bucket"]: r["payload"] for r in right.to_pylist()}
    for b, at in _owners(known, buckets):
        total, first = get(given[b])
        count[at], here[at] = total, first.astype(bool)
    is_first = np.zeros(len(digests), bool)
    is_first[first_at] = here
    return count[inverse], is_first


def seeded_windows(groups: DataFrame, answers: DataFrame, buckets: int) -> DataFrame:
    """(group, n, docs, digests, places): the windows that hold a repeated seed, in order.

    ``places``: document, first word, start and end code points.
    """

    def run(key, left, right):
        row = left.to_pylist()[0]
        sizes, words, at, digests = _seeds_of(row)
        again = at[_answered(digests, right, buckets)[0] > 1]
        if not len(again):
            return pa.table({n: pa.array([], t) for n, t in kinds})
        steps_ = np.zeros(len(words) + 1, np.int64)  # windows that start in [seed - slack, seed]
        np.add.at(steps_, np.maximum(again - (PASSAGE_WORDS - SEED_WORDS), 0), 1)
        np.add.at(steps_, again + 1, -1)
        window = np.flatnonzero((np.cumsum(steps_[:-1]) > 0) & _in_document(sizes, PASSAGE_WORDS))
        doc = np.repeat(np.arange(len(sizes)), sizes)[window]
        starts, lengths = get(row["places"])
        starts = np.cumsum(starts, dtype=np.int64)
        ends = starts + lengths
        step = lambda a: np.diff(a, prepend=0).astype(np.int32)
        return pa.table({
            "group": pa.array([row["group"]], pa.int64()), "n": pa.array([len(window)], pa.int64()),
            "docs": pa.array([row["docs"]], pa.binary()),
            "digests": pa.array([put(window_digests(words, PASSAGE_WORDS)[window])], pa.binary()),
            "places": pa.array([put(step(doc), step(window), step(starts[window]),
                                    step(ends[window + PASSAGE_WORDS - 1]))], pa.binary())})

    kinds = (("group", pa.int64()), ("n", pa.int64()), ("docs", pa.binary()), ("digests", pa.binary()),
             ("places", pa.binary()))
    found = groups.groupBy("group").cogroup(answers.groupBy("group")).applyInArrow(
        run, "group bigint, n bigint, docs binary, digests binary, places binary")
    return keep_bucketed(found, "passage_windows", "group")


def exact_passages(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each repeated passage of ``PASSAGE_WORDS`` words or more of each document.

    Columns as ``repeated_passages``; n_copies is the count of its rarest window. A window is first where no
    equal one comes earlier, and a passage is divided where that changes: is_first rows stay, and
    the others are what no first window covers, so without them each repeated window is still there.
    Such a row can have fewer words than a passage; rows of a document may overlap.
    """
    groups = write_words(docs, key, text)
    buckets = max(1, math.ceil((groups.agg(F.sum("n_seeds")).first()[0] or 0) / BUCKET_CHUNKS))
    windows = seeded_windows(groups, digest_counts(seed_digests(groups), buckets), buckets)
    owners = max(1, math.ceil((windows.agg(F.sum("n")).first()[0] or 0) / BUCKET_CHUNKS))
    answers = digest_counts(windows, owners)
    bounded_batches(docs.sparkSession)

    def run(key, left, right):
        row = left.to_pylist()[0]
        keys, valid, _ = get(row["docs"])
        (digests,) = get(row["digests"])
        count, is_first = _answered(digests, right, owners)
        doc, window, start, end = (np.cumsum(x, dtype=np.int64) for x in get(row["places"]))
        again = count > 1
        doc, window, start, end, count, is_first = (x[again] for x in (doc, window, start, end, count, is_first))
        if not len(window):
            return pa.table({n: pa.array([], t) for n, t in kinds})
        edge = np.append(True, (np.diff(window) > 1) | (np.diff(doc) > 0) | (is_first[1:] != is_first[:-1]))
        a = np.flatnonzero(edge)
        z = np.append(a[1:], len(edge)) - 1
        word, end_word, start_at, end_at = window[a], window[z] + PASSAGE_WORDS, start[a], end[z]
        firsts = np.flatnonzero(is_first)
        if len(firsts):  # rows that go leave out the words of the first windows before and after them
            after = np.searchsorted(firsts, a)
            f, g = firsts[np.maximum(after - 1, 0)], firsts[np.minimum(after, len(firsts) - 1)]
            goes = ~is_first[a]
            over = goes & (f < a) & (doc[f] == doc[a]) & (window[f] + PASSAGE_WORDS > word)
            word = np.where(over, window[f] + PASSAGE_WORDS, word)
            start_at = np.where(over, end[f] + 1, start_at)  # after one white space
            under = goes & (g > z) & (doc[g] == doc[a]) & (window[g] < end_word)
            end_word = np.where(under, window[g], end_word)
            end_at = np.where(under, start[g], end_at)
        ok = end_word > word
        return pa.table({
            "doc_id": pa.array(keys[doc[a]][ok], pa.int64(), mask=(valid[doc[a]] == 0)[ok]), "start": start_at[ok],
            "end": end_at[ok], "n_words": (end_word - word)[ok], "n_copies": np.minimum.reduceat(count, a)[ok],
            "is_first": is_first[a][ok]})

    kinds = (("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("n_words", pa.int64()),
             ("n_copies", pa.int64()), ("is_first", pa.bool_()))
    return windows.groupBy("group").cogroup(answers.groupBy("group")).applyInArrow(run, SPANS)
