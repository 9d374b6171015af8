"""The pipeline's stages, each on what its predecessor kept, against plain Python over the same rows."""

import hashlib
import re

import public_tokenizers
import pytest

import __spark_entry__
import corpus_pipeline
from tests.conftest import SF_SMALL
from tidewater.llm import bpe, decontamination, quality, secret_scan
from tidewater.llm.common import keep_table
from tidewater.sources.tables import table
from tests.llm.test_quality import measures
from tests.llm.test_secret_scan import brute as base_spans

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage, first the documents themselves."""
    docs = table(spark, SF_SMALL, "documents")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = keep_table(stage(spark, docs, SF_SMALL), "stage")
        out.append(docs.collect())
    return out


def by_id(rows):
    return {r.doc_id: r for r in rows}


def test_stage_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "n-gram Jaccard join", "benchmark decontamination", "secret scans",
        "byte-level BPE encoding and decoding"]
    assert all(list(rows[0].asDict()) == COLUMNS for rows in stages[:-1])
    assert list(stages[-1][0].asDict()) == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_quality_keeps_what_passes(spark, stages):
    hosts = {r.host: r.host_ok for r in quality.host_verdicts(quality.measure(table(spark, SF_SMALL, "documents"))).collect()}
    want = {r.doc_id for r in stages[0] if (m := measures(r.text))[0] >= 10 and 100 * m[4] <= 20 * m[0] and hosts[r.source]}
    assert {r.doc_id for r in stages[1]} == want


def test_one_document_of_each_group(stages):
    words = {r.doc_id: (r.text or "").encode().lower().split() for r in stages[1]}
    sets = {k: {tuple(w[i:i + 4]) for i in range(len(w) - 3)} for k, w in words.items()}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert {r.doc_id for r in stages[2]} == {k for k in ids if find(k) == k}


def test_documents_with_benchmark_items_go(spark, stages):
    items = [decontamination.normal(r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    verbatim = {r.doc_id for r in stages[2] if any(i in decontamination.normal(r.text) for i in items)}
    gone = by_id(stages[2]).keys() - by_id(stages[3]).keys()
    assert verbatim and gone == verbatim


def test_secrets_are_masked_and_nothing_else(stages):
    before, after = by_id(stages[3]), by_id(stages[4])
    assert before.keys() == after.keys()
    for k, r in after.items():
        assert not base_spans(r.text) and r.n_chars == len(r.text)
        if not base_spans(before[k].text):
            assert r.text == before[k].text
        kept = re.escape(secret_scan.MASK)
        assert len(re.sub(kept, "", r.text)) <= len(before[k].text)


def test_encoding_round_trip(stages):
    enc = bpe.encoding(public_tokenizers.path(bpe.RANKS))
    texts = by_id(stages[4])
    assert len(stages[5]) == len(texts)
    for r in stages[5]:
        ids = enc.encode_ordinary(texts[r.doc_id].text)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(texts[r.doc_id].text.encode()).hexdigest())


def test_run_is_the_stages_and_is_registered(spark, stages):
    got = sorted(tuple(r) for r in __spark_entry__.queries()["pipeline"](spark, SF_SMALL).collect())
    assert got == sorted(tuple(r) for r in stages[-1])


def test_empty_documents(spark):
    docs = table(spark, SF_SMALL, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = keep_table(stage(spark, docs, SF_SMALL), "stage")
        assert docs.count() == 0
