"""Reproducible train/validation split."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.session import checkpointed

VALIDATION = "is_validation"
DIGITS = 15
"""Hexadecimal digits of a key's hash that rows are ordered by."""
STEP = 16
"""Bits that one pass of a selection settles: its histogram has at most 2^STEP bars."""


def hash_bucket(key: str, seed: int, buckets: int = 100) -> Column:
    """A bucket from 0 to ``buckets - 1`` that depends on seed and key only."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets


def mark_split(df: DataFrame, key: str, test: float = 0.25, seed: int = 123) -> DataFrame:
    """Add ``is_validation``.

    A projection: no shuffle, no sort, and the same rows whatever the partitioning and the order of
    the input. ``test`` is in whole percent; the share is met up to sampling error, not exactly.
    A NULL key counts as training.
    """
    percent = round(test * 100)
    if abs(percent - test * 100) > 1e-9:
        raise ValueError("test share must be a whole percentage")
    marked = F.coalesce(hash_bucket(key, seed) < percent, F.lit(False))
    return df.withColumn(VALIDATION, marked)


def split(
    df: DataFrame, key: str, test: float = 0.25, seed: int = 123
) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows."""
    marked = mark_split(df, key, test, seed)
    return (
        marked.filter(~F.col(VALIDATION)).drop(VALIDATION),
        marked.filter(VALIDATION).drop(VALIDATION),
    )


def bound_of(df: DataFrame, column: Column, k: int) -> tuple[int, int, int]:
    """The k-th smallest (from 1) of a column of whole numbers from 0 on: it, how many are below, how many equal it.

    Every pass counts the rows by the next 16 bits of the number, below the bits that are settled already;
    counts are combined per task before the shuffle, and the driver sees one histogram. Four passes settle
    any number, and fewer do if a bar of the histogram ends just at the k-th row. NULL does not count.
    """
    numbers = df.select(column.alias("number")).where(F.col("number").isNotNull())
    settled, below, inside = 0, 0, 0
    for shift in range(64 - STEP, -1, -STEP):
        high = F.shiftright("number", shift + STEP) if shift + STEP < 64 else F.lit(0)
        bar = F.shiftright("number", shift).bitwiseAND((1 << STEP) - 1).alias("bar")
        counted = numbers.where(high == settled).groupBy(bar).count().orderBy("bar").collect()
        for row in counted:
            if below + row["count"] >= k:
                break
            below += row["count"]
        else:
            raise ValueError(f"fewer than {k} rows")
        settled, inside = settled << STEP | row["bar"], row["count"]
        if below + inside == k and shift:
            # all of this bar: any number that ends it will do as the bound
            return (settled << shift) + (1 << shift) - 1, below, inside
    return settled, below, inside


def mark_exact_split(df: DataFrame, key: str, test: float = 0.25, seed: int = 123) -> DataFrame:
    """Add ``is_validation``, true for exactly ceil(test * n) of the n rows.

    The rows with the smallest hashes of seed and key are taken, up to a bound found by histograms: no
    sort, and no shuffle but of counts; the result is a projection, the same whatever the partitioning.
    Rows of one key that lie across the bound are ordered by a hash of all their columns, so that which
    rows are taken does not depend on the partitioning either; rows that are equal in all columns are
    told apart by a number written with them, and only that many of them are taken. A NULL key counts as training, so fewer
    rows are taken if there are not enough with a key.
    """
    if not 0 <= test <= 1:
        raise ValueError("the share lies between 0 and 1")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    number = F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("bigint")
    total, known = df.agg(F.count(F.lit(1)), F.count(key)).first()
    wanted = min(math.ceil(round(test * total, 9)), known)
    if not wanted:
        return df.withColumn(VALIDATION, F.lit(False))
    bound, below, equal = bound_of(df, number, wanted)
    if below + equal == wanted:
        return df.withColumn(VALIDATION, F.coalesce(number <= bound, F.lit(False)))
    # one key lies across the bound: its rows by content, and equal ones by their number
    tag = "__row"
    rows = checkpointed(df.withColumn(tag, F.monotonically_increasing_id()))
    content = F.shiftrightunsigned(F.xxhash64(*[F.to_json(F.struct(c)) for c in df.columns]), 1)
    taken, left, fits = number < bound, wanted - below, number == bound
    for order in (content, F.col(tag)):
        bound, below, equal = bound_of(rows.where(fits), order, left)
        if below + equal == left:
            taken = taken | (fits & (order <= bound))
            break
        taken, left, fits = taken | (fits & (order < bound)), left - below, fits & (order == bound)
    return rows.withColumn(VALIDATION, F.coalesce(taken, F.lit(False))).drop(tag)


def exact_split(
    df: DataFrame, key: str, test: float = 0.25, seed: int = 123
) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows, exactly ceil(test * n) of the latter."""
    marked = mark_exact_split(df, key, test, seed)
    return (
        marked.filter(~F.col(VALIDATION)).drop(VALIDATION),
        marked.filter(VALIDATION).drop(VALIDATION),
    )
