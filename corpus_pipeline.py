"""Training corpus from raw documents: quality rules, near-dedup, secret redaction, packing.

Every stage but the last returns the columns of ``documents``; each is written
as Parquet under the shared folder and read back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paymart.llm import line_crf, minhash, packing, secrets
from paymart.llm.common import ship, staged, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the line field keep."""
    ship(spark)
    return line_crf.keep_quality(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship(spark)
    return minhash.keep_one(docs)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    ship(spark)
    return secrets.redact_secrets(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in training sequences."""
    ship(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_redaction", secret_redaction),
    ("pack_sequences", pack_sequences),
]

#: The line field of the first stage is trained, so SQL cannot express the result.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
