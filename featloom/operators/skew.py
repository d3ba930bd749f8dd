"""Hot join keys: found in one scan, and joined apart from the ordinary ones.

A spine may carry one key (or NULL) in a large share of its rows, and a hash-partitioned join
would send all of them to one task. Hot keys are found in one pass over the key columns with a
bounded sketch. Their rows meet the few feature rows of hot keys where they are; all other rows are joined
by the key alone, so a stored side keeps its buckets. The sketch only steers which way a row goes, so
its approximation never changes a result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

MEAN_PARTITIONS = 4
"""A key is hot above this many mean partitions, or a twentieth of the rows if that is less."""
MERGE_GROUPS = 256
HASH = "__hot_hash"


def key_hash(keys: Sequence[str]) -> Column:
    """One 64-bit value per key tuple; NULL has one, too."""
    return F.xxhash64(*keys)


@dataclass(frozen=True)
class HotKeys:
    """A table of key hashes; it has fewer rows than there are shuffle partitions, or than 21."""

    hashes: DataFrame | None = None

    def __bool__(self) -> bool:
        return self.hashes is not None

    def rows_of(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The rows with a hot key."""
        hashed = df.withColumn(HASH, key_hash(keys))
        return hashed.join(F.broadcast(self.hashes), HASH, "left_semi").drop(HASH)

    def rows_beside(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The rows with an ordinary key."""
        hashed = df.withColumn(HASH, key_hash(keys))
        return hashed.join(F.broadcast(self.hashes), HASH, "left_anti").drop(HASH)


def find_hot_keys(
    df: DataFrame, key_sets: Sequence[Sequence[str]], partitions: int | None = None
) -> list[HotKeys]:
    """Per set of key columns the keys that would overfill one shuffle partition.

    One scan of the key columns for all sets. Every task sketches its rows, groups of tasks merge
    their sketches in parallel, and one row comes to the driver. The sketch tracks a few times as many
    keys as can be hot, so none of them is missed.
    """
    spark = df.sparkSession
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = min(1 / 20, MEAN_PARTITIONS / partitions)
    most = math.ceil(1 / share)
    tracked = min(1_000_000, max(4096, 1 << math.ceil(math.log2(8 * most))))
    names = [f"h{i}" for i in range(len(key_sets))]
    hashed = df.select(
        F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("merge_group"),
        *[key_hash(keys).alias(n) for n, keys in zip(names, key_sets)],
    )
    merged = hashed.groupBy("merge_group").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.expr(f"approx_top_k_accumulate({n}, {tracked})").alias(n) for n in names],
    )
    # Grouped by a constant, so that an empty input gives no row: there is no sketch to combine.
    whole = merged.groupBy(F.lit("all")).agg(
        F.sum("n").alias("n"),
        *[F.expr(f"approx_top_k_combine({n}, {tracked})").alias(n) for n in names],
    )
    rows = whole.select(
        "n", *[F.expr(f"approx_top_k_estimate({n}, {most})").alias(n) for n in names]
    ).collect()
    if not rows:
        return [HotKeys() for _ in names]

    def above(top: Sequence[Row]) -> HotKeys:
        found = [(item["item"],) for item in top if item["count"] > share * rows[0]["n"]]
        return HotKeys(spark.createDataFrame(found, f"{HASH} bigint") if found else None)

    return [above(rows[0][n]) for n in names]
