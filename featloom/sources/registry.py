"""Stored tables of metrics and model versions.

Each is a keyed table that changes in one step: metrics by ``(run_id, metric)``, versions by
``(name, version)``. Rows may be computed from the table they go into.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from featloom.operators.runs import METRICS, PRODUCTION, metric_rows, next_versions, promote
from featloom.sources.feature_tables import create_feature_table, merge

VERSIONS = "name string, version int, run_id string, stage string"


def create_metrics(spark: SparkSession, table: str, location: str | None = None) -> bool:
    """An empty table of metrics; False if it is there."""
    schema = StructType.fromDDL(METRICS)
    return create_feature_table(spark, table, ("run_id", "metric"), schema, location=location)


def create_versions(spark: SparkSession, table: str, location: str | None = None) -> bool:
    """An empty table of versions; False if it is there."""
    schema = StructType.fromDDL(VERSIONS)
    return create_feature_table(spark, table, ("name", "version"), schema, location=location)


def record_metrics(
    spark: SparkSession, table: str, values: Mapping[str, Mapping[str, float]] | DataFrame
) -> DataFrame:
    """Store the metrics of many runs at once; a metric recorded again takes the new value."""
    rows = values if isinstance(values, DataFrame) else metric_rows(spark, values)
    return merge(spark, table, rows)


def register(spark: SparkSession, table: str, new: DataFrame) -> DataFrame:
    """Store ``(name, run_id)`` rows as the next versions of their names."""
    return merge(spark, table, next_versions(spark.table(table), new))


def promote_stored(
    spark: SparkSession, table: str, promotions: DataFrame, stage: str = PRODUCTION
) -> DataFrame:
    """Move the promoted versions into a stage; only rows whose stage changes are written anew."""
    before = spark.table(table)
    names = promotions.select("name").distinct()
    moved = promote(before.join(names, "name", "left_semi"), promotions, stage)
    old = before.select("name", "version", F.col("stage").alias("__before"))
    changed = moved.join(old, ["name", "version"]).where("stage <> __before").drop("__before")
    return merge(spark, table, changed.select(*before.columns))
