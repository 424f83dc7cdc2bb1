"""The corpus pipeline: quality rules, near-dedup, decontamination, personal data and BPE over ``documents``.

Each stage works on everything its predecessor kept. All but the last return the columns of ``documents``.
``run`` writes each stage's rows as Parquet in the shared folder and reads them back for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import bpe, host_rules, odd_sketch, pii_tagger, spaced_seed
from ledgerloom.llm.staging import staged


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that fail the base rules, or whose source is rejected, go."""
    return host_rules.kept_documents(docs, host="source")


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each near-duplicate group stays: that with the smallest doc_id (five-word shingles, 0.8)."""
    return odd_sketch.deduplicated(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return spaced_seed.decontaminated(docs, _table(spark, folder, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Spans of personal data in the text are replaced by their kind; ``n_chars`` follows the new text."""
    return pii_tagger.without_personal_data(docs)


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every document, with the digests of the ids and of the decoded text."""
    return bpe.encoded(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("bpe", tokens),
]
# A trained tagger, near-duplicate classes and exact BPE are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, folder), f"stage-{name}")
    return STAGES[-1][1](spark, docs, folder)
