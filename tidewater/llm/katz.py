"""Katz backoff language model: learnt, stored and evaluated over whole texts.

Lower-cased words and one end of text are tokens. The unigram level is the
add-half distribution over the training vocabulary and one unknown word; each
higher order has Good-Turing discounted counts, and gives the mass it saves to
the order below through a weight that makes every history sum to exactly 1.

Work is dealt twice. A *chunk* holds the tokens of some documents, about
``CHUNK_TOKENS``. For each order it asks once for each distinct n-gram in it
whose history was learnt (after any other the order below decides),
whatever number of times that occurs, so a frequent word or pair costs one
request a chunk. A *bucket* owns the n-grams of some histories: it sums the
training counts that chunks send, stores the table of its n-grams, and answers
each chunk with counts and, for histories that back off in it, with sums. Those sums
(types, lower-order mass) add up, so a history with more than a bucket's share
of the tokens is split over several buckets by the word that follows, and each chunk
adds the parts. The chunk then evaluates its tokens recursively.
Requests and answers are compact arrays in binary columns, dealt by Spark.

Words and histories are named by 64-bit hashes and numbers derived from them;
two of 10 million words share a hash with probability 3e-6.

Defined results: a null or empty text is its end token alone; a null key counts
as the empty text in the training rule; rows are handled one by one, repeated rows
count each; an empty table gives an empty result; without training tokens every
token has the unknown word's probability, 1.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.columns import coded, get, put, steps
from tidewater.llm.common import bounded_batches, drop_shuffles, keep_bucketed, keep_table, map_batches, texts_of

CHUNK_TOKENS = 1_000_000
BUCKET_TOKENS = 1_500_000
#: Counts up to this are discounted; larger ones are taken as they are.
LARGEST_DISCOUNTED = 5
START = 0  # the history before a text's first token
END = b""  # no word is empty


def training_rule(key: str) -> F.Column:
    """True for documents that are learnt from: crc32 of the key as text, modulo 5, is not 1."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 != 1


# ---- chunks ---------------------------------------------------------------------------------

def write_chunks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Tokens of whole documents in chunks, as a table bucketed by chunk.

    Columns: chunk, n_tokens, n_train_docs, docs (key, validity, training flag, length),
    words (hashes, the most frequent first), tokens (positions in words).
    """
    source = docs.select(F.col(key).cast("long").alias("key"), training_rule(key).alias("train"), F.col(text))

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        keys: list = []
        train: list = []
        sizes: list = []
        tokens: list = []
        words: dict[bytes, int] = {}

        def flush():
            nonlocal keys, train, sizes, tokens, words, number
            ids = np.array(tokens, np.int64)
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
            order = np.argsort(-np.bincount(ids, minlength=len(words)), kind="stable")
            rank = np.empty(len(words), np.uint32)
            rank[order] = np.arange(len(words), dtype=np.uint32)
            row = pa.RecordBatch.from_pylist([{
                "chunk": (part << 24) | number, "n_tokens": len(tokens), "n_train_docs": int(sum(train)),
                "docs": put(np.array([0 if k is None else k for k in keys], np.int64),
                            np.array([k is not None for k in keys], np.uint8),
                            np.array(train, np.uint8), np.array(sizes, np.uint32)),
                "words": put(hashes[order]), "tokens": put(rank[ids])}], schema=CHUNKS)
            keys, train, sizes, tokens, words, number = [], [], [], [], {}, number + 1
            return row

        for batch in batches:
            for k, learn, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                      texts_of(batch.column(2)), strict=True):
                at = len(tokens)
                name = words.setdefault
                tokens += [name(w, len(words)) for w in body.encode().lower().split()]
                tokens.append(name(END, len(words)))
                keys.append(k)
                train.append(learn)
                sizes.append(len(tokens) - at)
                if len(tokens) >= CHUNK_TOKENS:
                    yield flush()
        if keys:
            yield flush()

    return keep_bucketed(map_batches(source, run, "chunk bigint, n_tokens bigint, n_train_docs bigint, "
                                                  "docs binary, words binary, tokens binary"), "katz_chunks", "chunk")


CHUNKS = pa.schema([("chunk", pa.int64()), ("n_tokens", pa.int64()), ("n_train_docs", pa.int64()),
                    ("docs", pa.binary()), ("words", pa.binary()), ("tokens", pa.binary())])
REQUESTS = "bucket bigint, chunk bigint, payload binary"
ANSWERS = "kind string, bucket bigint, chunk bigint, payload binary, sums array<double>"
ANSWER_SCHEMA = pa.schema([("kind", pa.string()), ("bucket", pa.int64()), ("chunk", pa.int64()),
                           ("payload", pa.binary()), ("sums", pa.list_(pa.float64()))])


@dataclass(frozen=True)
class Plan:
    """What all tasks need to know: a few numbers, none of which grows with the corpus."""
    order: int
    buckets: int
    hot: float  # training count of a history from which it is split
    starts: int  # training documents
    n: float = 0.0  # training tokens
    v: float = 0.0  # distinct training tokens
    discounts: tuple[tuple[float, ...], ...] = ()  # of orders 2, 3, ...

    def unit(self, level: int) -> float:
        """Lower-order probabilities of level 2 are odd multiples of this; others are discounted counts."""
        return 0.5 / (self.n + 0.5 * (self.v + 1)) if level == 2 else 0.0


def _masses(values: np.ndarray, unit: float) -> tuple[np.ndarray, np.ndarray]:
    """Sums of lower-order probabilities, few of them different, as codes and values; of level 2 whole numbers of units."""
    codes, values = coded(values)
    return codes, _small(values.astype(np.uint64)) if unit else values


def _masses_of(codes: np.ndarray, values: np.ndarray, unit: float) -> np.ndarray:
    return values[codes] * unit if unit else values[codes]


def _cuts(counts: np.ndarray, flat: np.ndarray, discounts: tuple[float, ...]) -> np.ndarray:
    """What comes off each count; half a count where the history has no small count."""
    off = np.array([0.0, *(r * (1 - d) for r, d in enumerate(discounts, 1)), 0.0])
    return np.where(flat, np.minimum(counts, 0.5), off[np.minimum(counts, len(discounts) + 1)])


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``np.unique`` with first positions and inverse; where both fit, value and position are sorted as one number."""
    bits = max(1, (len(values) - 1).bit_length())
    if not len(values) or int(values.max()) < 1 << (64 - bits):
        packed = (values << np.uint64(bits)) | np.arange(len(values), dtype=np.uint64)
        packed.sort()
        order, ordered = (packed & np.uint64((1 << bits) - 1)).astype(np.int64), packed >> np.uint64(bits)
    else:
        order = np.argsort(values, kind="stable")
        ordered = values[order]
    new = np.ones(len(values), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    inverse = np.empty(len(values), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return ordered[new], order[new], inverse


def good_turing(of_counts: list[float]) -> tuple[float, ...]:
    """Discount factors of counts 1 to k by Katz's formula from n_1 to n_{k+1}.

    Where the counts of counts give no factor between 0 and 1, half a count is taken off.
    """
    k = len(of_counts) - 1
    n = [0.0, *of_counts]
    share = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
    out = []
    for r in range(1, k + 1):
        d = 0.0
        if n[r] and share < 1:
            d = ((r + 1) * n[r + 1] / (r * n[r]) - share) / (1 - share)
        out.append(d if 0 < d < 1 else 1 - 0.5 / r)
    return tuple(out)


# ---- level 1: words ---------------------------------------------------------------------------

def word_requests(chunks: DataFrame, plan: Plan) -> DataFrame:
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                (hashes,), (tokens,) = get(row["words"]), get(row["tokens"])
                learn = _token_flags(row["docs"])
                counts = np.bincount(tokens[learn], minlength=len(hashes)).astype(np.uint32)
                buckets = hashes % np.uint64(plan.buckets)
                for b, at in _by_bucket(buckets, plan.buckets):
                    at = at[np.argsort(hashes[at])]
                    yield pa.RecordBatch.from_pylist([{
                        "bucket": b, "chunk": row["chunk"], "payload": put(steps(hashes[at]), counts[at])}])

    return map_batches(chunks.select("chunk", "docs", "words", "tokens"), run, REQUESTS)


def _by_bucket(buckets: np.ndarray, n: int):
    """(bucket, positions in it) of every bucket that occurs."""
    buckets = buckets.astype(np.uint16 if n <= 1 << 16 else np.uint64)
    order = np.argsort(buckets, kind="stable")
    ends = np.searchsorted(buckets[order], np.arange(n + 1))
    for b in np.flatnonzero(np.diff(ends)):
        yield int(b), order[ends[b]:ends[b + 1]]


def _token_flags(docs: bytes) -> np.ndarray:
    _, _, train, sizes = get(docs)
    return np.repeat(train.astype(bool), sizes)


def word_answers(requests: DataFrame, plan: Plan) -> DataFrame:
    def run(key, table):
        bucket = key[0].as_py()
        asked = [(row["chunk"], *get(row["payload"])) for row in table.to_pylist()]
        hashes = np.concatenate([np.cumsum(x[1], dtype=np.uint64) for x in asked])
        counts = np.concatenate([x[2] for x in asked])
        known, inverse = np.unique(hashes, return_inverse=True)
        total = np.bincount(inverse, counts, len(known)).astype(np.int64)
        # the most frequent words get the smallest names, which makes sorted lists of names small
        rank = np.empty(len(known), np.uint64)
        rank[np.argsort(-total, kind="stable")] = np.arange(1, len(known) + 1, dtype=np.uint64)
        falling, each = np.unique(-total, return_counts=True)  # counts by rank: a few steps
        last = np.cumsum(each).astype(np.uint64)
        rows = [{"kind": "model", "bucket": bucket, "chunk": -1, "payload": put(steps(known), total),
                 "sums": [float(total.sum()), float((total > 0).sum())]}]
        at = 0
        for chunk, mine, _ in asked:
            i = inverse[at:at + len(mine)]
            at += len(mine)
            rows.append({"kind": "answer", "bucket": bucket, "chunk": chunk,
                         "payload": put(_small(rank[i]), -falling, last), "sums": None})
        return pa.Table.from_pylist(rows, schema=ANSWER_SCHEMA)

    return requests.groupBy("bucket").applyInArrow(run, ANSWERS)


# ---- higher levels ---------------------------------------------------------------------------

class ChunkState:
    """The tokens of one chunk, and for each the probability under the orders answered so far."""

    def __init__(self, row: dict, plan: Plan):
        self.plan, self.chunk = plan, row["chunk"]
        self.keys, self.valid, train, self.sizes = get(row["docs"])
        self.train_docs = train.astype(bool)
        self.train = np.repeat(self.train_docs, self.sizes)
        (self.hashes,), (self.tokens,) = get(row["words"]), get(row["tokens"])
        self.first = np.zeros(len(self.tokens), bool)
        self.first[np.cumsum(self.sizes) - self.sizes] = True
        self.level = 0

    def words(self, payloads: dict[int, bytes]) -> None:
        """Answers of level 1: names and training counts of the words."""
        self.word = np.zeros(len(self.hashes), np.uint64)
        self.count = np.zeros(len(self.hashes), np.int64)
        for b, at in _by_bucket(self.hashes % np.uint64(self.plan.buckets), self.plan.buckets):
            at = at[np.argsort(self.hashes[at])]
            rank, counts, last = get(payloads[b])
            self.word[at] = rank.astype(np.uint64) * np.uint64(self.plan.buckets) + np.uint64(b)
            self.count[at] = counts[np.searchsorted(last, rank)]
        by_word = (self.count + 0.5) / (self.plan.n + 0.5 * (self.plan.v + 1))
        self.known = (self.count > 0)[self.tokens]
        self.base = by_word[self.tokens]
        self.p = self.base
        self.gram = self.word[self.tokens]  # name of the n-gram that ends at each token
        self.gram_count = self.count[self.tokens]
        self.code = 2 * self.gram_count  # of each token's n-gram: twice its count, and 1 if its history is flat
        self.scale = None
        by_name = np.argsort(self.word)
        self.word_by_name = self.word[by_name]
        place = np.empty(len(by_name), np.uint64)
        place[by_name] = np.arange(len(by_name), dtype=np.uint64)
        self.place = place[self.tokens]  # of each token's word in the order of names
        self.level = 1

    @property
    def unit(self) -> float:
        return self.plan.unit(self.level + 1)

    def _pairs(self) -> None:
        """The distinct (history, word) of the next level, in order of their names.

        Only of learnt histories: after any other the order below decides.
        """
        before = np.concatenate([[np.uint64(START)], self.gram[:-1]])
        before[self.first] = START
        times = np.concatenate([[0], self.gram_count[:-1]])
        times[self.first] = self.plan.starts
        self.asked = np.flatnonzero(times > 0)
        self.history, of_history, local = _distinct(before[self.asked])
        self.history_count = times[self.asked[of_history]]
        bits = np.uint64(max(1, len(self.word_by_name).bit_length()))
        pair, at, self.pair_of_token = _distinct((local.astype(np.uint64) << bits) | self.place[self.asked])
        self.pair_history = (pair >> bits).astype(np.int64)
        self.pair_word = self.word_by_name[(pair & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)]
        self.pair_lower, self.pair_code = self.p[self.asked[at]], self.code[self.asked[at]]
        if self.scale is not None:
            self.history_scale = self.scale[self.asked[of_history]]

    def _layout(self):
        """(bucket, positions of its histories, which of them are split, positions of its pairs, pairs of each history).

        A history with more than a bucket's share is split by the word that follows. Every bucket that has
        a part of a history is asked about the history, also where this chunk has no pair in that part.
        """
        n = np.uint64(self.plan.buckets)
        splits = np.clip(np.ceil(self.history_count / self.plan.hot), 1, self.plan.buckets).astype(np.int64)
        part_history = np.repeat(np.arange(len(self.history)), splits)
        begin = np.cumsum(splits) - splits
        shift = (np.arange(len(part_history)) - begin[part_history]).astype(np.uint64)
        part_bucket = (self.history[part_history] + shift) % n
        part_of_pair = begin[self.pair_history] + (
            self.pair_word // n % splits[self.pair_history].astype(np.uint64)).astype(np.int64)
        each = np.bincount(part_of_pair, minlength=len(part_history))
        pairs = dict(_by_bucket(part_bucket[part_of_pair], self.plan.buckets))
        for b, parts in _by_bucket(part_bucket, self.plan.buckets):
            histories = part_history[parts]  # ascending, as are the pairs: both in order of names
            yield b, histories, splits[histories] > 1, pairs.get(b, np.zeros(0, np.int64)), each[parts]

    def requests(self):
        self._pairs()
        counts = np.bincount(self.pair_of_token[self.train[self.asked]], minlength=len(self.pair_word))
        for b, histories, split, mine, each in self._layout():
            words = self.pair_word[mine]
            gaps = np.diff(words, prepend=np.uint64(0))  # wraps around where a history begins
            begin = (np.cumsum(each) - each)[each > 0]
            gaps[begin] = words[begin]
            here = counts[mine]
            # only learnt pairs have a lower mass, and each is learnt in some chunk
            # a bucket's histories have its number as the rest of their names, but for split ones
            n = np.uint64(self.plan.buckets)
            yield b, put((_small(steps(self.history[histories] // n)), self.plan.buckets), _small(each), _small(gaps),
                         _small(here), _small(self.pair_code[mine[here > 0]]),
                         np.flatnonzero(split).astype(np.uint32), _small(self.history[histories[split]] % n))

    def answers(self, payloads: dict[int, bytes], discounts: tuple[float, ...]) -> None:
        """Answers of the next level: counts of pairs and sums of histories; moves one level up."""
        self._pairs()
        k = len(discounts)
        count = np.zeros(len(self.pair_word), np.int64)
        gram = np.zeros(len(self.pair_word), np.uint64)
        flat = np.ones(len(self.history), bool)  # no small count: half a count comes off each type
        lower = np.zeros(len(self.history))
        types = np.zeros((len(self.history), k + 1))  # all, of count 1 to k
        for b, histories, split, mine, each in self._layout():
            here, names, small, *columns, parts, values = get(payloads[b])
            count[mine] = here
            if len(names):
                gram[mine[here > 0]] = np.cumsum(names, dtype=np.uint64) + np.uint64(b)
            flat[histories] &= small == 0
            wanted = histories[_backing_off(here, each, split)]
            types[wanted] += np.column_stack(columns)
            lower[wanted] += _masses_of(parts, values, self.unit)
        if self.scale is not None:
            lower /= self.history_scale
        off = np.array([r * (1 - d) for r, d in enumerate(discounts, 1)])
        saved = np.where(flat, 0.5 * types[:, 0], types[:, 1:] @ off)
        weight = saved / self.history_count / np.maximum(1 - lower, 1e-300)  # of the histories that back off here
        flat, seen = flat[self.pair_history], self.history_count[self.pair_history]
        p = np.where(count > 0, (count - _cuts(count, flat, discounts)) / seen, weight[self.pair_history] * self.pair_lower)

        def of_tokens(of_pairs, other):
            out = np.full(len(self.tokens), other, of_pairs.dtype)
            out[self.asked] = of_pairs[self.pair_of_token]
            return out

        # an n-gram learnt one level up is learnt here, so its lower mass is (count - cut) / seen: a small number to
        # send, and one divisor for each history
        self.p = self.p.copy()
        self.p[self.asked] = p[self.pair_of_token]
        self.code = of_tokens(2 * count + flat, 0)
        self.scale = of_tokens(seen, 1)
        self.gram = of_tokens(gram, 0)
        self.gram_count = of_tokens(count, 0)
        self.level += 1


def _backing_off(counts: np.ndarray, each: np.ndarray, split: np.ndarray) -> np.ndarray:
    """Which histories of a request have their sums sent: those after which a word of the chunk was not
    learnt, for no others need the weight, and split ones, for such a word may be in another part."""
    of = np.repeat(np.arange(len(each)), each)
    return (np.bincount(of[counts == 0], minlength=len(each)) > 0) | split


def pair_answers(requests: DataFrame, plan: Plan, level: int) -> DataFrame:
    """One bucket of a level: its table of n-grams, and answers to each chunk."""
    k, unit, more = LARGEST_DISCOUNTED, plan.unit(level), level < plan.order  # more: names are needed

    def lower_of(codes):
        if level == 2:  # the unigram level, in units
            return codes + 1.0
        counts = codes // 2
        return counts - _cuts(counts, codes % 2 == 1, plan.discounts[level - 3])

    def run(key, table):
        bucket = key[0].as_py()
        asked = []
        for row in table.to_pylist():
            h, each, gaps, counts, codes, parts, rest = get(row["payload"])
            h = np.cumsum(h, dtype=np.uint64)
            words = np.cumsum(gaps, dtype=np.uint64)
            begin = np.cumsum(each, dtype=np.int64) - each
            offset = np.where(begin > 0, words[np.maximum(begin, 1) - 1], 0).astype(np.uint64) if len(words) else h * 0
            split = np.zeros(len(h), bool)
            split[parts] = True
            h += np.uint64(bucket)
            h[split] += rest.astype(np.uint64) - np.uint64(bucket)  # the difference may wrap around, the sum does not
            asked.append((row["chunk"], h, each, words - np.repeat(offset, each), counts,
                          codes, split))
        known, _, history_of = _distinct(np.concatenate([x[1] for x in asked]))
        word = np.concatenate([x[3] for x in asked])
        bits = np.uint64(int(word.max(initial=0)).bit_length())
        gram, _, gram_of = _distinct(
            (np.repeat(history_of, np.concatenate([x[2] for x in asked])).astype(np.uint64) << bits) | word)
        of, word = (gram >> bits).astype(np.int64), gram & ((np.uint64(1) << bits) - np.uint64(1))
        counts = np.concatenate([x[4] for x in asked])
        total = np.bincount(gram_of, counts, len(gram)).astype(np.int64)
        learnt = total > 0
        code = np.zeros(len(gram), np.int64)
        code[gram_of[counts > 0]] = np.concatenate([x[5] for x in asked])
        number = np.cumsum(learnt, dtype=np.uint64)  # an n-gram's name is its number times the buckets, plus the bucket

        of_count = np.bincount(of * (k + 2) + np.minimum(total, k + 1), minlength=len(known) * (k + 2)).reshape(-1, k + 2)
        small = of_count[:, 1:k + 1].any(axis=1).astype(np.uint8)
        sums = [of_count[:, 1:].sum(axis=1), *of_count[:, 1:k + 1].T]
        mass = np.bincount(of[learnt], lower_of(code[learnt]), len(known))
        rows = [{"kind": "model", "bucket": bucket, "chunk": -1,
                 "payload": put(steps(known[of[learnt]]), word[learnt], total[learnt].astype(np.uint32)),
                 "sums": [float((total == r).sum()) for r in range(1, k + 2)]}]
        at = at_history = 0
        for chunk, h, each, words, _, _, split in asked:
            i = gram_of[at:at + len(words)]
            j = history_of[at_history:at_history + len(h)]
            at, at_history = at + len(words), at_history + len(h)
            here = total[i]
            # a chunk asks in order of history and word, as n-grams are named, so its names ascend: small steps
            name = (_small(steps(number[i[here > 0]])) if more else np.zeros(0, np.uint32), plan.buckets)
            m = j[_backing_off(here, each, split)]
            rows.append({"kind": "answer", "bucket": bucket, "chunk": chunk, "sums": None,
                         "payload": put(_small(here), name, small[j], *[_small(s[m]) for s in sums], *_masses(mass[m], unit))})
        return pa.Table.from_pylist(rows, schema=ANSWER_SCHEMA)

    return requests.groupBy("bucket").applyInArrow(run, ANSWERS)


def _small(a: np.ndarray) -> np.ndarray:
    return a.astype(np.uint32 if not len(a) or a.max() < 2**32 else np.uint64)


# ---- the model over a corpus -----------------------------------------------------------------

SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
          "base_score double, score double")


def _with_answers(chunks: DataFrame, levels: list[DataFrame], plan: Plan, then, schema: str) -> DataFrame:
    """``then(state)`` for every chunk, brought to the level of the answers given."""
    answers = reduce(DataFrame.unionByName, [
        t.where("kind = 'answer'").select("chunk", F.lit(i).alias("level"), "bucket", "payload")
        for i, t in enumerate(levels, 1)])
    bounded_batches(chunks.sparkSession)
    n_levels = len(levels)

    def run(key, left, right):
        given: list[dict[int, bytes]] = [{} for _ in range(n_levels)]
        for row in right.to_pylist():
            given[row["level"] - 1][row["bucket"]] = row["payload"]
        state = ChunkState(left.to_pylist()[0], plan)
        state.words(given[0])
        for payloads, discounts in zip(given[1:], plan.discounts, strict=True):
            state.answers(payloads, discounts)
        return then(state)

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, schema)


def _requests_of(state: ChunkState) -> pa.Table:
    rows = [{"bucket": b, "chunk": state.chunk, "payload": payload} for b, payload in state.requests()]
    return pa.Table.from_pylist(rows, schema=pa.schema(
        [("bucket", pa.int64()), ("chunk", pa.int64()), ("payload", pa.binary())]))


def _scores_of(state: ChunkState) -> pa.Table:
    begin = np.cumsum(state.sizes, dtype=np.int64) - state.sizes
    per_doc = lambda values: np.add.reduceat(values, begin)
    n = len(begin)
    return pa.table({
        "doc_id": pa.array(state.keys, pa.int64(), mask=state.valid == 0),
        "held_out": ~state.train_docs,
        "n_tokens": state.sizes.astype(np.int64),
        "n_known": per_doc(state.known.astype(np.int64)),
        "train_tokens": np.full(n, int(state.plan.n), np.int64),
        "base_score": per_doc(np.log10(state.base)),
        "score": per_doc(np.log10(state.p)),
    })


@dataclass
class Model:
    """The tables of all orders, and the numbers that belong to them."""
    chunks: DataFrame
    levels: list[DataFrame]
    plan: Plan

    def scores(self) -> DataFrame:
        """Log10 probabilities of the chunks' documents."""
        return _with_answers(self.chunks, self.levels, self.plan, _scores_of, SCORES)


def learn(docs: DataFrame, order: int = 2, key: str = "doc_id", text: str = "text") -> Model:
    """Count, discount and store the n-grams of the training documents, up to ``order``.

    Each order is one table in the shared folder, its rows partitioned by kind: the model's
    n-grams by bucket, and the answers to the chunks of ``docs``.
    """
    chunks = write_chunks(docs, key, text)
    size = chunks.agg(F.sum("n_tokens"), F.sum("n_train_docs")).first()
    plan = Plan(order, max(1, math.ceil((size[0] or 0) / BUCKET_TOKENS)), BUCKET_TOKENS, size[1] or 0)
    levels = [keep_table(word_answers(word_requests(chunks, plan), plan), "katz-1", "kind")]
    of_model = levels[0].where("kind = 'model'").agg(F.sum(F.col("sums")[0]), F.sum(F.col("sums")[1])).first()
    drop_shuffles(docs.sparkSession)
    plan = replace(plan, n=of_model[0] or 0.0, v=of_model[1] or 0.0)
    for level in range(2, order + 1):
        requests = _with_answers(chunks, levels, plan, _requests_of, REQUESTS)
        levels.append(keep_table(pair_answers(requests, plan, level), f"katz-{level}", "kind"))
        of_counts = levels[-1].where("kind = 'model'").agg(
            *[F.sum(F.col("sums")[r]) for r in range(LARGEST_DISCOUNTED + 1)]).first()
        drop_shuffles(docs.sparkSession)
        plan = replace(plan, discounts=(*plan.discounts, good_turing([x or 0.0 for x in of_counts])))
    return Model(chunks, levels, plan)
