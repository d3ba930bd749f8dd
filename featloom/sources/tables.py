"""Tables, views and SQL text."""

from __future__ import annotations

from dataclasses import replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from featloom.sources.feature_tables import FeatureTable, feature_table, publish


def load(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A table or view by name, or Parquet files by path (anything with a slash)."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def save_overwrite(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Replace table ``name`` with ``df`` in one step and return the table as read back.

    The new rows are complete before readers see any of them, and a failed write leaves the old
    ones; ``df`` may read the table itself. The table is managed unless ``path`` places its files. A table
    of that name that was not written by this function is an error.
    """
    spark = df.sparkSession
    table = FeatureTable(name, (), "", 0, 0, path)
    if spark.catalog.tableExists(name):
        table = replace(table, snapshot=feature_table(spark, name).snapshot + 1)
    return publish(df, table)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Create or replace the session view ``name``; a view is a plan, no data is stored."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def sql(spark: SparkSession, text: str, args: dict[str, Any] | None = None) -> DataFrame:
    """SQL text over tables and views, with optional named parameters."""
    return spark.sql(text, args) if args else spark.sql(text)
