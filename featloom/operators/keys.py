"""Primary-key checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assert_unique(df: DataFrame, keys: Sequence[str], missing: bool = True) -> None:
    """Raise if a key occurs twice or, with ``missing``, is NULL.

    Counts are combined before the shuffle; at most one row comes back.
    """
    absent = reduce(or_, [F.col(k).isNull() for k in keys])
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    wrong = (F.col("rows") > 1) & ~absent
    found = counted.filter(wrong | absent if missing else wrong).limit(1).collect()
    if found:
        raise ValueError(f"missing or duplicate key: {found[0].asDict()}")
