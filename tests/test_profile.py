"""Counts, modes, levels, running totals."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from featloom.operators.profile import category_levels, column_modes, group_count
from featloom.operators.ranking import running_totals


def test_null_is_a_group(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "k string")
    assert {r.k: r["count"] for r in group_count(df, "k").collect()} == {"a": 1, None: 2}


def test_modes(spark):
    df = spark.createDataFrame(
        [(1, 5.0), (1, float("nan")), (2, float("nan")), (2, None), (None, 5.5)], "a int, b double"
    )
    assert {r["column"]: r["mode"] for r in column_modes(df, ["a", "b"]).collect()} == {
        "a": 1.0,
        "b": 5.0,
    }


@pytest.mark.parametrize("ranges", [None, 7])
def test_levels(spark, ranges):
    letters = [chr(97 + i) for i in range(26)]
    df = spark.createDataFrame([(x, None if x > "c" else x) for x in letters * 2], "a string, b string")
    found = category_levels(df, ["a", "b"], ranges).collect()
    places = sorted((r["column"], r["position"], r["level"]) for r in found)
    assert places == [("a", i, x) for i, x in enumerate(letters)] + [
        ("b", i, x) for i, x in enumerate("abc")
    ]


@pytest.mark.parametrize("ranges", [None, 1, 40])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, ranges, descending):
    """One key holds most rows, keys and one order value are NULL."""
    draw = random.Random(3)
    rows = []
    for i in range(1500):
        key = draw.choice(["hot", "hot", "hot", "a", None])
        rows.append((key, None if i == 0 else float(i), draw.randint(-5, 5)))
    df = spark.createDataFrame(rows, "k string, o double, v int")
    found = running_totals(
        df,
        "o",
        {"total": F.col("v"), "n": F.lit(1)},
        ["k"],
        descending=descending,
        ranges=ranges,
    )
    wanted, sums = {}, {}
    ordered = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0), reverse=descending)
    for key, order, value in ordered:
        total, n = sums.get(key, (0, 0))
        sums[key] = (total + value, n + 1)
        wanted[(key, order)] = sums[key]
    assert {(r.k, r.o): (r.total, r.n) for r in found.collect()} == wanted
