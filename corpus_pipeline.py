"""A training corpus from documents, in five stages; each reads what the one before it wrote.

quality rules: documents judged bad go. n-gram Jaccard join: one document of each group stays. secret scans: live
secrets are masked. mixing: documents are left out or repeated to meet the sources' target weights. byte-level BPE:
every copy is encoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wardspark.llm import bpe, jaccard, mixing, quality, secret_scan
from wardspark.llm.common import table
from wardspark.llm.queries import RANKS
from wardspark.session import scratch_path, scratch_scope


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.distinct_documents(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redacted_documents(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and ids of every copy."""
    return bpe.encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep=("doc_id", "source"))


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("secret_scans", secret_scans),
    ("source_mixing", source_mixing),
    ("byte_bpe", byte_bpe),
]

#: SQL can express neither the Jaccard classes nor the merges; a brute-force version stands in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encoded corpus of the documents at ``sf_dir``.

    Documents with null or empty text, or too few words, go in the first stage; repeated ids are rows of their own and
    repeated rows copies of each other; an empty table gives no rows; other columns stay until the last stage, whatever
    their names. What a stage staged is removed once its own rows are written.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
