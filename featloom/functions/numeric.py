"""Numeric features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(c: Column | str) -> Column:
    """NULL for NaN, else the number."""
    return F.nanvl(c, F.lit(None).cast("double"))


def round0(c: Column | str) -> Column:
    """Round to whole numbers, halves away from zero; a double stays a double."""
    return F.round(c, 0)


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as double, 0 where the denominator is 0 (in both ANSI modes)."""
    return F.when(
        denominator != 0, numerator.cast("double") / denominator.cast("double")
    ).otherwise(F.lit(0.0))
