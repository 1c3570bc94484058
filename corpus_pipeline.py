"""From raw documents to token ids: quality, near copies, benchmark leaks, personal data, BPE.

Each stage reads what the one before has kept, written as Parquet in the shared
folder, and returns the columns of ``documents``; the last returns tokens. What a
stage drops stays dropped: rejected documents, all but one of each group of near
copies, documents that hold a benchmark item. The fourth stage masks personal
data in the texts, and the last encodes the masked texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from verisift.llm import bpe, decontam, ngram_join, pii, quality
from verisift.llm.common import cut, fresh_path, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, a similarity of 0.8 or more; the smallest id of a group stays."""
    return ngram_join.first_of_group(docs, 5, 80)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path, pattern = bpe.default_vocabulary()
    # Blocks of 8 MB, and ids written before they are decoded, so that a task needs one Python worker
    # at a time: the workers' share beside a heap that four stages have filled.
    return bpe.digests(cut(bpe.encode(docs, path, pattern, block_bytes=8 << 20)), path, keep_ids=True)


STAGES = [
    ("quality", quality_stage),
    ("near_copies", near_copies_stage),
    ("benchmark", benchmark_stage),
    ("personal_data", pii_stage),
    ("tokens", tokens_stage),
]

# A trained classifier, MinHash order and BPE merges are beyond SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, at, sf_dir).write.parquet(path)
        at = spark.read.parquet(path)
    return at
