"""Running totals over an order without sending a whole group to one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featloom.session import checkpointed

RANGE = "__range"
IS_ROW = "__is_row"


def running_totals(
    df: DataFrame,
    order: str,
    totals: Mapping[str, Column],
    keys: Sequence[str] = (),
    descending: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Add, per output name, the sum of a column up to and including each row.

    Rows are ordered by ``order`` within ``keys``. Values of ``order`` must not repeat within a
    key; aggregate first. NULL comes first in ascending order and last in descending order.

    The rows are range-partitioned by keys and order and written with the number of their range.
    A key with many rows so lies in several ranges, and a range holds many small keys. Each part of a
    key within a range is one window; it is opened by a row with the key's totals from the ranges
    before. ``ranges`` fixes the number of ranges; by default Spark suits it to the data.
    """
    direction = F.col(order).desc() if descending else F.col(order).asc()
    valued = df.select("*", *[c.alias(f"__v_{n}") for n, c in totals.items()])
    by = [*[F.col(k).asc() for k in keys], direction]
    ranged = valued.repartitionByRange(*([ranges] if ranges else []), *by)
    # Written once: the numbers of the ranges are the same in every pass from here on.
    placed = checkpointed(ranged.withColumns({RANGE: F.spark_partition_id(), IS_ROW: F.lit(1)}))
    inside = (
        Window.partitionBy(*keys, RANGE)
        .orderBy(IS_ROW, direction)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    opened = placed.unionByName(_openings(placed, totals, keys), allowMissingColumns=True)
    summed = opened.withColumns({n: F.sum(f"__v_{n}").over(inside) for n in totals})
    return summed.filter(F.col(IS_ROW) == 1).select(*df.columns, *totals)


def _openings(placed: DataFrame, totals: Mapping[str, Column], keys: Sequence[str]) -> DataFrame:
    """One row per key and range with the totals of the key in the ranges before it.

    A key has at most one such row per range. Added as rows, they need no join and share the shuffle
    of the window.
    """
    sums = placed.groupBy(*keys, RANGE).agg(*[F.sum(f"__v_{n}").alias(n) for n in totals])
    before = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(
        *keys,
        RANGE,
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"__v_{n}") for n in totals],
        F.lit(0).alias(IS_ROW),
    )
