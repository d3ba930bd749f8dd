"""Merge of keyed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from featloom.operators.keys import assert_unique


def upsert_rows(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], check: bool = True
) -> DataFrame:
    """Rows of ``target`` without an update, and all rows of ``updates``.

    Keys are unique in ``target``; with ``check`` they are verified to be unique in ``updates``.
    Only the key columns of the updates take part in the join, so Spark broadcasts them when they
    are small and the target is then not shuffled.
    """
    if set(target.columns) != set(updates.columns):
        raise ValueError("target and updates have different columns")
    if check:
        assert_unique(updates, keys)
    kept = target.join(updates.select(*keys), list(keys), "left_anti")
    return kept.select(target.columns).unionByName(updates)
