"""The corpus pipeline: five stages, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept; all
but the last return the columns they got. SQL can't express a trained model, so there is none.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tracewright.llm.common import documents, shared_folder
from tracewright.llm.near_dedup import without_near_duplicates
from tracewright.llm.packing import pack_documents
from tracewright.llm.quality import quality_filter
from tracewright.llm.secrets_scan import redacted_documents
from tracewright.llm.substring_dedup import deduplicated_documents


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality_filter(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.3)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity of 0.8 or more."""
    return without_near_duplicates(docs, width=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that stand twice are cut out of the texts."""
    return deduplicated_documents(docs, window=50)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark."""
    return redacted_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        folder = shared_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
