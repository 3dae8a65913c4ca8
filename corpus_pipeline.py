"""The corpus pipeline: documents through quality, near copies, repeated passages, personal data and packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tracewell.llm import packing, pii, quality, simhash, suffix_dedup
from tracewell.llm.common import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labels of those that are there."""
    return quality.kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints link (four words, at most 4 of 64 bits), that with the smallest doc_id.

    Documents without words (null and empty texts too) are one group.
    """
    return simhash.kept(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 200-byte strings that occur more than once."""
    return suffix_dedup.deduplicated(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with identifiers, disguised ones too, replaced by their kind."""
    return pii.masked(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, in pieces whose lengths are powers of two."""
    return packing.pieces(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good),
    ("near_copies", without_near_copies),
    ("repeated_passages", without_repeated_passages),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: Trained models, fingerprints and tokens: SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
