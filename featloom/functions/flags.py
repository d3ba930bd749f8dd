"""Flags and bands as strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def missing_flag(c: Column | str) -> Column:
    """``'1'`` for NULL, else ``'0'``."""
    return F.when(F.isnull(c), F.lit("1")).otherwise(F.lit("0"))


def present_flag(c: Column | str) -> Column:
    """``'1'`` for a value, ``'0'`` for NULL."""
    return F.when(F.isnotnull(c), F.lit("1")).otherwise(F.lit("0"))


def band(c: Column | str, threshold: float, low: str, high: str) -> Column:
    """``low`` below the threshold, ``high`` for everything else, NULL and the threshold included."""
    value = F.col(c) if isinstance(c, str) else c
    return F.when(value < threshold, F.lit(low)).otherwise(F.lit(high))
