"""The training-data pipeline: its stages in order, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet in the shared
folder and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import minhash, mixing, packing, quality_rules, secrets
from tidemark.llm.tables import shared_dir, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a quality rule go."""
    return quality_rules.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, that of the least doc_id."""
    shared_dir(spark)
    return minhash.keep(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; no document goes."""
    return secrets.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, once for each time the mix takes them."""
    return mixing.keep(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, tokens, length bucket, batch and slot of each document of the mix."""
    return packing.pack(docs)


STAGES = [("quality_rules", quality), ("near_dedup", near_dedup), ("secret_scan", secret_scan), ("mixing", mix), ("packing", pack)]

#: SQL cannot express the sampled bands of the near-duplicate stage; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
