"""The registered queries ``opN_<name>`` of this package, and their DuckDB oracles.

Each takes (spark, sf_dir) and applies its operator, with production parameters,
to the whole table it is meant for.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tidewater.llm import (bpe, decontamination, exact_dedup, katz, lengths, merkle, packing, page_text, quality, secret_scan,
                           setjoin, sql, substrings, whitening)
from tidewater.llm.common import keep_table
from tidewater.sources.tables import table, table_path


def op1_token_id_output(spark, sf_dir):
    return packing.packed(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_benchmark_decontamination(spark, sf_dir):
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_lm_scoring(spark, sf_dir):
    return katz.learn(table(spark, sf_dir, "documents"), order=3).scores()


def op4_ngram_jaccard_join(spark, sf_dir):
    return setjoin.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op5_substring_dedup(spark, sf_dir):
    return substrings.exact_passages(table(spark, sf_dir, "documents"))


def op6_secret_scans(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.learn_formats(docs))


def op7_token_counts(spark, sf_dir):
    counted = lengths.encoded_lengths(table(spark, sf_dir, "documents"), bpe.rank_file())
    return lengths.cumulative(lengths.histogram(counted))


def op8_byte_level_bpe(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"), bpe.rank_file())


def op9_html_extraction(spark, sf_dir):
    return page_text.main_text(table(spark, sf_dir, "pages"))


def op10_quality_rules(spark, sf_dir):
    measured = quality.measure(table(spark, sf_dir, "documents"))
    narrow = keep_table(measured.select(F.col("doc.doc_id").alias("doc_id"), "host", "n_lines",
                                        *quality.MEASURES, "base_failed"), "measures")
    judged = quality.judge(narrow, keep_table(quality.host_verdicts(narrow), "hosts"), "doc_id")
    return judged.select("doc_id", *quality.MEASURES, "base_failed", "kept")


def op11_exact_dedup(spark, sf_dir):
    path = table_path(sf_dir, "documents")  # as a pattern, for a stream takes a folder or a pattern and no single file
    return exact_dedup.deduplicate(spark, f"{path[:-1]}[{path[-1]}]")


def op12_embedding_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_merkle_dataset_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    one_more = {"n_chars": F.col("n_chars").cast("decimal(38,0)") + 1}
    versions = merkle.build(docs, where=tampered, changes=one_more).versions()
    siblings = F.concat_ws("", F.transform("path", lambda step: F.substr(step, F.lit(2))))
    return versions.select("doc_id", "leaf", "subroot", "root",
                           F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"), "folded_root",
                           (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {
    "op1_token_id_output": op1_token_id_output,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_secret_scans": op6_secret_scans,
    "op7_token_counts": op7_token_counts,
    "op8_byte_level_bpe": op8_byte_level_bpe,
    "op9_html_extraction": op9_html_extraction,
    "op10_quality_rules": op10_quality_rules,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_merkle_dataset_manifest": op13_merkle_dataset_manifest,
}

ORACLES = {
    "op10_quality_rules": sql.QUALITY,
    "op11_exact_dedup": sql.EXACT_DEDUP,
    "op13_merkle_dataset_manifest": sql.MERKLE,
}
