"""Token ids: packing, cached encoding, shard files, byte-level BPE and length sums against the libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.llm import bpe, lengths, packing
from tidewater.llm.common import new_folder

HF = public_tokenizers.path("byte_bpe_50k.json")
RANKS = bpe.rank_file()
SCHEMA = "doc_id bigint, text string"
TEXTS = ["Hello, world. It's a test...", "", None, "  leading\n\n and   trailing  ", "é中文½² word.\x1cctrl　wide",
         "<|endoftext|> as text", "a" * 3000, "1,234.56 'll 're\t\ttabs \n", "x.y,z. .. ,, '.'", "\x00\x7f"] * 4


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 32])
def test_packing_round_trip(bits):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 2**bits, 1001, dtype=np.uint64).astype(np.uint32)
    data = packing.pack(ids, bits)
    assert len(data) == -(-1001 * bits // 8)
    assert (packing.unpack(data, 1001, bits) == ids).all()


def test_bits_are_the_fewest():
    assert [packing.bits_for(n) for n in (1, 2, 3, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab1 .,'\n\t_-é中²½ st re　\x1c!%")), max_size=60) | st.text(max_size=40))
def test_cached_ids_are_the_librarys(text):
    tok = packing.tokenizer(HF)
    assert tok.encode([text, text]) == tok._whole([text, text])


def test_ids_are_those_of_a_fresh_library():
    """Names of added tokens in a text are those tokens, alone, glued to words, and repeated."""
    from tokenizers import Tokenizer
    fresh, tok = Tokenizer.from_file(HF), packing.CachedTokenizer(HF)
    texts = [t or "" for t in TEXTS] + ["a <|endoftext|> b", "x<|endoftext|>y.<|endoftext|>", "<|endoftext|>" * 3, " <|endoftext",
                                        "<|endoftext|>\n\n  end  <|endoftext|>", "|endoftext|>"]
    assert [np.frombuffer(x, "<u4").tolist() for x in tok.encode(texts)] == [
        fresh.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(fresh.encode("<|endoftext|>", add_special_tokens=False).ids) == 1


def test_cache_generations(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_ENTRIES", 5)
    tok = packing.CachedTokenizer(HF)
    texts = [f"word{i} and word{i // 2}, end." for i in range(50)]
    assert [x for t in texts for x in tok.encode([t])] == tok._whole(texts)


def expected(rows):
    tok = packing.tokenizer(HF)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out, start = [], 0
    for k, t in ordered:
        ids = np.append(np.frombuffer(tok._whole([t or ""])[0], "<u4"), np.uint32(0)).astype("<u4")
        out.append((k, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out, start


@pytest.mark.parametrize("shard_ids", [packing.SHARD_IDS, 50])
def test_shards_hold_documents_in_order(spark, shard_ids):
    rows = [((i * 37) % 101, t) for i, t in enumerate(TEXTS)] + [(5, "twice"), (5, "twice"), (None, "no key")]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", start int").repartition(4)
    folder = new_folder(spark, "test-ids")
    manifest = packing.write_shards(df, folder, HF, shard_ids=shard_ids)
    got = packing.read_shards(manifest, folder).collect()
    want, total = expected(rows)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got[:-1]]).tolist()
    assert got[-1].start + got[-1].n_tokens == total
    keys = [r.doc_id for r in got]
    assert keys[0] is None and keys[1:] == sorted(keys[1:])
    if shard_ids == 50:
        assert manifest.count() > 5


def test_shard_random_access(tmp_path):
    rng = np.random.default_rng(1)
    ids = [rng.integers(0, 50257, n).astype(np.uint32) for n in (0, 1, 5000, 9000, 3)]
    path = tmp_path / "x.bin"
    path.write_bytes(b"".join(packing.shard_parts([3, None, 5, 6, 7], ids, 17, block=1000)))
    shard = packing.Shard(f"file://{path}")
    assert shard.keys == [3, None, 5, 6, 7] and shard.bits == 17
    assert all((shard.document(i) == x).all() for i, x in enumerate(ids))
    whole = np.concatenate(ids)
    assert all((shard.range(a, b) == whole[a:b]).all() for a, b in ((0, 0), (999, 1001), (4000, 14000), (14003, 14004)))
    assert [(k, a, x.tolist()) for k, a, x in shard.documents(4000)] == [
        (k, int(shard.offsets[i]), x.tolist()) for i, (k, x) in enumerate(zip(shard.keys, ids, strict=True))]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert packing.packed(spark, empty, HF).count() == 0
    assert bpe.round_trip(empty, RANKS).count() == 0
    hist = lengths.histogram(lengths.encoded_lengths(empty.selectExpr("*", "'x' AS lang"), RANKS))
    assert lengths.cumulative(hist).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_cut_texts_encode_as_whole(monkeypatch, seed):
    monkeypatch.setattr(bpe, "LONG_TEXT", 40)
    monkeypatch.setattr(bpe, "LONG_RUN", 10)
    monkeypatch.setattr(bpe, "_LONG_SPACE", __import__("re").compile(rf"{bpe._SPACE}{{10,}}"))
    rng = random.Random(seed)
    text = "".join(rng.choice(["ab", " ", "  ", " " * 15, "\n" * 12, "'s", "é", "中", "½", ".", "\x1c", "　", "1"])
                   for _ in range(400))
    want = bpe.encoding(RANKS).encode_ordinary(text)
    assert bpe.encode(text, RANKS) == want and bpe.decode(want, RANKS) == text.encode()
    assert "".join(p for p, _ in bpe.pieces(text)) == text


def test_very_long_runs_of_space():
    text = "x" + " " * 1_500_000 + "y"  # the library alone overflows its stack here
    ids = bpe.encode(text, RANKS)
    assert bpe.decode(ids, RANKS) == text.encode()


def test_round_trip_digests(spark):
    rows = list(enumerate(TEXTS)) + [(None, "no key"), (0, "again")]
    df = spark.createDataFrame([(*r, 2) for r in rows], SCHEMA + ", n_tokens int")
    got = sorted((tuple(r) for r in bpe.round_trip(df, RANKS).collect()), key=str)
    want = []
    for k, t in rows:
        ids = bpe.encoding(RANKS).encode_ordinary(t or "")
        want.append((k, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    ids = bpe.encode_texts(df, RANKS)
    assert sorted((bytes(r.bytes) for r in bpe.decode_ids(ids, RANKS).collect())) == sorted(
        (t or "").encode() for _, t in rows)


def test_length_sums(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), " ".join("w" * rng.randint(1, 9) for _ in range(rng.randint(0, 30))))
            for _ in range(200)] + [("a", None)]
    df = spark.createDataFrame(rows, "lang string, text string")
    sums = lengths.cumulative(lengths.histogram(lengths.encoded_lengths(df, RANKS))).cache()
    size = {("group", g): sorted(len(bpe.encode(t or "", RANKS)) for k, t in rows if k == g) for g in ("a", "b", None)}
    size["corpus", None] = sorted(sum(size.values(), []))
    for r in sums.collect():
        n = size[r.scope, r.group]
        assert (r.n_docs, r.docs_up_to, r.docs_from) == (
            n.count(r.length), sum(x <= r.length for x in n), sum(x >= r.length for x in n))
        assert r.tokens_from == sum(x for x in n if x >= r.length)
        assert r.truncated_tokens == sum(min(x, r.length) for x in n)
        assert r.quantile == pytest.approx(r.docs_up_to / len(n))
    limits = spark.createDataFrame([(0,), (7,), (20,), (10**6,)], "limit bigint")
    got = {((r.scope, r.group), r.limit): r.truncated_tokens for r in lengths.truncated_totals(sums, limits).collect()}
    assert got == {(g, m): sum(min(x, m) for x in n) for g, n in size.items() for m in (0, 7, 20, 10**6)}
    levels = {((r.scope, r.group), r.level): r.length for r in lengths.quantiles(sums, (0.1, 0.5, 1.0)).collect()}
    for (g, q), x in levels.items():
        n = size[g]
        assert sum(y <= x for y in n) >= q * len(n) > sum(y < x for y in n)
