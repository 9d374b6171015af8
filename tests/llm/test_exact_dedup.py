"""Stateful exact dedup against a dictionary in plain Python."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tidewater.llm import exact_dedup
from tidewater.llm.common import new_folder

SCHEMA = "doc_id bigint, text string, digest string, at string, first string, n bigint, file_path string"


def write(spark, rows, files=3):
    path = new_folder(spark, "dedup-docs")
    wide = [(i, t, "d", "a", "f", 7, "p") for i, t in rows]
    spark.createDataFrame(wide, SCHEMA).repartition(files).write.parquet(path)
    return path


def brute(rows):
    groups = {}
    for i, t in rows:
        body = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        groups.setdefault(body, []).append(i)
    out = []
    for body, ids in groups.items():
        known = sorted(i for i in ids if i is not None)
        keep = known[0] if known else None
        sha = hashlib.sha256(body.encode()).hexdigest()
        out += [(i, keep, len(ids), sha) for i in ids]
    return sorted(out, key=repr)


def check(result, rows):
    got = result.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == brute(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


HOSTILE = ([(1, "a  b"), (2, "a b"), (3, "a\t\n b"), (4, " a b"), (5, None), (6, ""), (7, " "), (8, "\x0b\x0c"),
            (None, "a b"), (None, "only null ids"), (None, "only null ids"), (9, "twice"), (9, "twice"),
            (-3, "minus"), (10, "minus"), (11, "a b"), (12, "a\x00b"), (13, "é"), (14, "é"),
            (15, "long " * 40_000), (16, "long  " * 40_000), (17, "long " * 40_000 + "x")]
           + [(100 + i, "the same text in a large group") for i in range(700)]
           + [(900 + i, f"text number {i}") for i in range(200)])


def test_hostile_rows_and_a_large_group(spark):
    check(exact_dedup.deduplicate(spark, write(spark, HOSTILE)), HOSTILE)


@pytest.mark.parametrize("hex_digits", [0, 1, 2])
def test_full_bytes_decide_where_digests_collide(spark, hex_digits):
    weak = lambda sha: F.substring(sha, 1, hex_digits).cast("binary")
    check(exact_dedup.deduplicate(spark, write(spark, HOSTILE), digest=weak), HOSTILE)


def test_state_is_kept_without_expiry_and_meets_later_files(spark):
    path, state = write(spark, HOSTILE), new_folder(spark, "seen")
    exact_dedup.remember(spark, path, state)
    seen = exact_dedup.index(spark, state)
    assert seen.agg(F.sum("n")).first()[0] == len(HOSTILE)
    later = [(0, "a b"), (50_000, "text number 3"), (50_001, "new")]
    spark.createDataFrame([(i, t, "d", "a", "f", 7, "p") for i, t in later], SCHEMA).write.mode("append").parquet(path)
    exact_dedup.remember(spark, path, state)
    assert exact_dedup.index(spark, state).agg(F.sum("n")).first()[0] == len(HOSTILE) + len(later)
    check(exact_dedup.judge(spark.read.parquet(path), exact_dedup.index(spark, state)), HOSTILE + later)


def test_the_callers_settings_stay(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    exact_dedup.deduplicate(spark, write(spark, [(1, "a")])).collect()
    assert spark.conf.get(key, None) == before


def test_empty_table(spark):
    path = new_folder(spark, "dedup-empty")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    assert exact_dedup.deduplicate(spark, path).collect() == []


def test_no_python_in_the_plan(spark):
    plan = exact_dedup.deduplicate(spark, write(spark, HOSTILE))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "ExternalRDD"))
