"""A corpus pipeline: quality rules, exact and near duplicates, repeated passages, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from featloom.llm.common import table
from featloom.llm.exact import drop_exact
from featloom.llm.packing import packed
from featloom.llm.quality import drop_low_quality
from featloom.llm.repeats import cut_repeats
from featloom.llm.simhash import drop_near
from featloom.session import delete_path, scratch_path, scratch_scope

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule for texts or hosts rejects."""
    return drop_low_quality(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of those with equal texts, the one with the largest id."""
    return drop_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of those whose SimHash fingerprints are linked, the one with the smallest id."""
    return drop_near(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand elsewhere too."""
    return cut_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents placed in sequences."""
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again by the next.

    What a stage wrote on its way goes when it is done, and its result when the next one is.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with scratch_scope(spark):
            result = stage(spark, docs, sf_dir)
            result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if before:
            delete_path(spark, before)
        before = path
    return docs


ORACLE_SQL = None
"""Fingerprints, repeated byte strings and packing are beyond SQL; tests compare with brute force."""

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
