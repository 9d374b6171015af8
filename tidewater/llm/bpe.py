"""Byte-level BPE encoding and decoding by the tiktoken library with a local rank file.

A text is encoded as the concatenation of its regex matches, each merged on its
own. Long texts are cut first at boundaries where the pattern always ends a
match, whatever surrounds them: before white space that follows another
character, and before the last character of a run of white space that another
character follows. Long runs of white space are one match and go to the merger
directly, for the pattern's look-ahead overflows its stack on them.

Defined results: a null or empty text has no ids and decodes to no bytes; rows
are handled one by one, so ties, repeated rows and further columns do not
matter; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame

from tidewater.llm.common import map_batches, texts_of

RANKS = "byte_bpe_multi_50k.tiktoken"
LONG_TEXT = 1 << 16
LONG_RUN = 1 << 12

# White space as the pattern has it: Python's \s without the four separator controls.
_SPACE = r"[^\S\x1c-\x1f]"
_OTHER = r"[\S\x1c-\x1f]"
_BOUNDARY = re.compile(rf"(?<={_OTHER})(?={_SPACE})|(?<={_SPACE})(?={_SPACE}{_OTHER})")
_LONG_SPACE = re.compile(rf"{_SPACE}{{{LONG_RUN},}}")


def rank_file(name: str = RANKS) -> str:
    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def encoding(path: str):
    """The tiktoken encoding of one rank file; built once in each Python worker."""
    import tiktoken
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str):
    """(part, is_one_match) of a text, in order; a part's ids do not depend on the other parts."""
    if len(text) <= LONG_RUN:
        yield text, False
        return
    at = 0
    for run in _LONG_SPACE.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        yield from ((part, False) for part in _cut(text, at, run.start()))
        yield text[run.start():end], True
        at = end
    yield from ((part, False) for part in _cut(text, at, len(text)))


def _cut(text: str, at: int, end: int):
    while end - at > LONG_TEXT:
        boundary = _BOUNDARY.search(text, at + LONG_TEXT, end)
        if boundary is None or boundary.start() >= end:
            break
        yield text[at:boundary.start()]
        at = boundary.start()
    if at < end:
        yield text[at:end]


def encode(text: str, path: str) -> list[int]:
    enc = encoding(path)
    if len(text) <= LONG_RUN:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    for part, one_match in pieces(text):
        ids += enc._encode_single_piece(part) if one_match else enc.encode_ordinary(part)
    return ids


def decode(ids: list[int], path: str) -> bytes:
    """The raw bytes; they need not be valid text."""
    return encoding(path).decode_bytes(ids)


def encode_texts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>) of every row."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            ids = [encode(t, path) for t in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], [key, "ids"])

    return map_batches(docs.select(key, text), run, f"`{key}` {kind}, ids array<int>")


def decode_ids(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, bytes binary) of every row of ids."""
    kind = encoded.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            raw = [decode(x or [], path) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], [key, "bytes"])

    return map_batches(encoded.select(key, ids), run, f"`{key}` {kind}, bytes binary")


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text encoded and decoded in one pass: (key, n_tokens, ids_sha256, decoded_sha256)."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            n, of_ids, of_bytes = [], [], []
            for t in texts_of(batch.column(1)):
                ids = encode(t, path)
                n.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(decode(ids, path)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids), pa.array(of_bytes)],
                [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(docs.select(key, text), run,
                       f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
