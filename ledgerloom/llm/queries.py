"""The registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    bpe,
    byte_shards,
    chunk_dedup,
    divergence,
    gated_lm,
    host_rules,
    line_runs,
    odd_sketch,
    pii_tagger,
    resident_codes,
    spaced_seed,
    url_templates,
    zip_warc,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components over two-word shingles at 0.8."""
    return odd_sketch.near_duplicates(_table(spark, folder, "documents"), width=2, percent=80)


def op5_byte_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 40 contiguous shards of nearly equal bytes."""
    return byte_shards.balanced_shards(_table(spark, folder, "documents"), shards=40)


def op7_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rule measures, base verdict and host-aware verdict of every document; the host is its source."""
    judged = host_rules.host_verdicts(_table(spark, folder, "documents"), host="source")
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text of every document."""
    return bpe.encoded(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_spaced_seed(spark: SparkSession, folder: str) -> DataFrame:
    """Every document and benchmark item that share a passage, with the place and extent of the longest overlap."""
    return spaced_seed.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op2_chunk_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every passage of a document that occurs earlier in the corpus, with the document that has it first."""
    found = chunk_dedup.repeated_passages(_table(spark, folder, "documents"))
    return found.select("doc_id", "first_doc_id", "start", "stop", "n_words", "n_chunks")


def op9_zip_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written to ZIP-packaged archives and read back by ranges."""
    return zip_warc.archived(_table(spark, folder, "pages"))


def op10_url_templates(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path, listed rule and verdict of every page; unlisted URLs by their path template."""
    found = url_templates.judged(_table(spark, folder, "pages"), _table(spark, folder, "labels"))
    return found.select("page_id", "host", "path", "rule", "verdict")


def op3_gated_lm(spark: SparkSession, folder: str) -> DataFrame:
    """Smoothed corpus scores and the language model's log-likelihood of every document."""
    return gated_lm.document_scores(_table(spark, folder, "documents"))


def op8_pii_tagger(spark: SparkSession, folder: str) -> DataFrame:
    """Pattern counts and all spans of personal data in every document."""
    return pii_tagger.personal_data(_table(spark, folder, "documents"))


def op11_resident_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Product-quantisation codes of all embeddings after two Lloyd rounds: 16 parts, 64 entries."""
    return resident_codes.vector_codes(_table(spark, folder, "embeddings"), parts=16, entries=64, rounds=2)


def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Distances between all sources of each language, and each source's 50 most typical terms."""
    return divergence.source_divergence(_table(spark, folder, "documents"))


def op13_line_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines that an earlier document has; the digest is that of the text that stays."""
    kept = line_runs.without_repeated_lines(_table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_near_dedup": op1_near_dedup,
        "op2_chunk_dedup": op2_chunk_dedup,
        "op3_gated_lm": op3_gated_lm,
        "op4_spaced_seed": op4_spaced_seed,
        "op5_byte_shards": op5_byte_shards,
        "op6_bpe": op6_bpe,
        "op7_host_rules": op7_host_rules,
        "op8_pii_tagger": op8_pii_tagger,
        "op9_zip_warc": op9_zip_warc,
        "op10_url_templates": op10_url_templates,
        "op11_resident_codes": op11_resident_codes,
        "op12_divergence": op12_divergence,
        "op13_line_runs": op13_line_runs,
    }
