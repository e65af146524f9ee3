"""From documents to token ids: language, exact copies, near copies, benchmark passages, BPE.

Each stage takes what the one before it kept, written as Parquet and read again, so a lost
executor costs the tasks of one stage and a stopped run can go on from the last table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bagminhash, bpe, exact_dedup, langid, tiling
from tidemark.llm.queries import MULTI_BPE
from tidemark.llm.tables import table, written
from tidemark.session import apply_settings


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no language; learned from the rows that have one."""
    return langid.reject(docs, langid.fit(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id stays."""
    return exact_dedup.keep(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies, the document with the smallest id stays."""
    return bagminhash.keep(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a benchmark item."""
    return tiling.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with the digest of the bytes that they decode to."""
    ranks = public_tokenizers.path(MULTI_BPE)
    decoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True)
    return decoded.select(
        "doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", decontaminate),
    ("byte_bpe", encode),
]

# Language models, signatures and merges are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_settings(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
