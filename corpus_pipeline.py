"""Corpus pipeline: documents through the llm operators, stage by stage.

quality classifier (rejected documents go) -> near-duplicates (one document
of each class stays) -> secret scan (secret values are masked) -> packing
(pieces in sequences of at most 4096 tokens).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bazaar.llm.common import prepared, read, saved
from bazaar.llm.neardup import keep_one
from bazaar.llm.packing import pack_documents
from bazaar.llm.quality import keep_quality
from bazaar.llm.secrets import redact_secrets


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, learned from the table ``labels``, does not reject."""
    prepared(spark)
    return keep_quality(docs, read(spark, sf_dir, "labels"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    prepared(spark)
    return keep_one(docs)


def masked_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secret values masked."""
    prepared(spark)
    return redact_secrets(docs)


def packed_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences."""
    prepared(spark)
    return pack_documents(docs)


STAGES = [("quality_classifier", good_documents), ("near_duplicates", distinct_documents),
          ("secret_scan", masked_documents), ("packing", packed_pieces)]

# The stages train models and walk graphs, which SQL cannot express; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``; each result is written as Parquet and read again."""
    docs = read(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
