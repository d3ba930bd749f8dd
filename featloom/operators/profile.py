"""Group counts, modes and category levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.operators.ranking import running_totals


def group_count(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key (NULL is a group) as ``count``; counted per task before the shuffle."""
    return df.groupBy(*keys).count()


def _value_counts(df: DataFrame, cols: Sequence[str], value_type: str) -> DataFrame:
    """``(column, value, n)`` for all ``cols`` in one scan."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(c).cast(value_type).alias("value"))
            for c in cols
        ]
    )
    return df.select(F.inline(pairs)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def column_modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, mode)``: the most frequent value of each numeric column, the smallest on ties.

    NULL and NaN do not count. A column without a value gets no row. Values are counted before
    the shuffle and again reduced per task, so a frequent value costs no more than a rare one.
    """
    counted = _value_counts(df, cols, "double").filter(
        F.col("value").isNotNull() & ~F.isnan("value")
    )
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("value")))
    return counted.groupBy("column").agg(best.alias("best")).select(
        "column", F.col("best.value").alias("mode")
    )


def distinct_levels(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, level)``: the distinct values of text columns without NULL, in one scan."""
    counted = _value_counts(df, cols, "string")
    return counted.filter(F.col("value").isNotNull()).select("column", F.col("value").alias("level"))


def category_levels(
    df: DataFrame, cols: Sequence[str], ranges: int | None = None
) -> DataFrame:
    """``(column, level, position)``: the levels with their place in sort order from 0."""
    return numbered_levels(distinct_levels(df, cols), ranges)


def numbered_levels(levels: DataFrame, ranges: int | None = None) -> DataFrame:
    """``(column, level, position)`` of distinct levels, over as many ranges as they need."""
    placed = running_totals(
        levels,
        order="level",
        totals={"place": F.lit(1)},
        keys=["column"],
        ranges=ranges,
    )
    return placed.select("column", "level", (F.col("place") - 1).alias("position"))
