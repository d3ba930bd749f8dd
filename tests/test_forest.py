"""Forests of any depth against plain trees, and what pure leaves promise."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from featloom.learning.forest import Forest, bootstrap, fit_forest
from featloom.learning.grow import turns
from featloom.learning.prep import FeatureSpec
from featloom.learning.score import StoredModel, load_model, save_model
from featloom.learning.train import predict, train_deep_forest

NAN = float("nan")
SCHEMA = "id long, x array<double>, y int"


def gini(rows):
    ones = sum(y for _, y in rows)
    return 2 * ones * (len(rows) - ones) / len(rows) if rows else 0.0


def brute_tree(rows, edges, depth=None):
    """(entry, cut, missing_low, low, high) by trying every split, or the share of class 1."""
    ones = sum(y for _, y in rows)
    best = None
    for k in range(len(edges)) if 0 < ones < len(rows) and depth != 0 else ():
        for v in sorted({x[k] for x, _ in rows if not math.isnan(x[k])}):
            for missing_low in (False, True) if any(math.isnan(x[k]) for x, _ in rows) else (False,):
                low = [r for r in rows if r[0][k] <= v or (missing_low and math.isnan(r[0][k]))]
                if not 0 < len(low) < len(rows):
                    continue
                high = [r for r in rows if not (r[0][k] <= v or (missing_low and math.isnan(r[0][k])))]
                left = gini(low) + gini(high)
                if best is None or left < best[0] - 1e-9:
                    best = left, k, v, missing_low, low, high
    if best is None:
        return ones / len(rows)
    _, k, v, missing_low, low, high = best
    cut = min((e for e in edges[k] if e > v), default=math.inf)
    deeper = None if depth is None else depth - 1
    return k, cut, missing_low, brute_tree(low, edges, deeper), brute_tree(high, edges, deeper)


def nested(forest, node):
    if forest.entry[node] < 0:
        return pytest.approx(float(forest.value[node]))
    sides = nested(forest, forest.low[node]), nested(forest, forest.high[node])
    return forest.entry[node], forest.cut[node], bool(forest.missing_low[node]), *sides


def depth_of(tree):
    return 1 + max(depth_of(tree[3]), depth_of(tree[4])) if isinstance(tree, tuple) else 0


def edges_of(x):
    return [sorted({r[k] for r in x if not math.isnan(r[k])}) for k in range(len(x[0]))]


@pytest.mark.parametrize("local, depth", [(1 << 16, None), (0, 4), (25, None)])
def test_equal_to_a_plain_tree(spark, local, depth):
    rng = random.Random(7)
    x = [[float(rng.randint(0, 12)), round(rng.gauss(0, 1), 1), rng.choice([1.0, NAN, NAN])] for _ in range(120)]
    y = [int((r[0] > 6) ^ (r[1] > 0) ^ math.isnan(r[2]) ^ (rng.random() < 0.2)) for r in x]
    rows = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(zip(x, y))], SCHEMA).repartition(6)
    found = fit_forest(rows, "x", "y", None, trees=2, depth=depth, local_rows=local)
    wanted = brute_tree(list(zip(x, y)), edges_of(x), depth)
    # without keys both trees see all rows
    assert all(nested(found, r) == wanted for r in found.roots)


def test_depth_forty(spark):
    """Alternating labels along a line: no split gains much, and pure leaves need many levels."""
    x, y = [[float(k)] for k in range(90)], [k % 2 for k in range(90)]
    rows = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(zip(x, y))], SCHEMA).repartition(4)
    wanted = brute_tree(list(zip(x, y)), edges_of(x))
    assert depth_of(wanted) >= 40
    for local in (1 << 16, 20):
        found = fit_forest(rows, "x", "y", None, trees=1, local_rows=local)
        assert nested(found, 0) == wanted
        assert set(found.value[found.entry < 0]) == {0.0, 1.0}
    scored = found.transform(rows).collect()
    assert all(r["prediction"] == r["y"] and r["probability"][1] == r["y"] for r in scored)


def test_splits_that_gain_nothing(spark):
    """Exclusive or: the first split gains nothing and is made all the same; equal rows stay together."""
    rows = [(k, [float(k // 2 % 2), float(k % 2)], (k // 2 + k) % 2) for k in range(40)]
    found = fit_forest(spark.createDataFrame(rows, SCHEMA), "x", "y", None, trees=1)
    assert set(found.value[found.entry < 0]) == {0.0, 1.0}
    same = [(k, [1.0], int(k < 3)) for k in range(12)]
    found = fit_forest(spark.createDataFrame(same, SCHEMA), "x", "y", None, trees=1)
    assert found.entry.tolist() == [-1] and found.value.tolist() == [0.25]


def test_bootstrap():
    keys = np.random.default_rng(0).integers(0, 1 << 62, 40_000).astype(np.uint64)
    one, two = bootstrap(keys, 0, 5), bootstrap(keys, 1, 5)
    for times in (one, two):
        shares = np.bincount(times, minlength=5)[:5] / len(keys)
        assert np.abs(shares - [math.exp(-1) / math.factorial(k) for k in range(5)]).max() < 0.01
    assert abs(np.corrcoef(one, two)[0, 1]) < 0.03
    assert (one != bootstrap(keys, 0, 6)).any()


def test_entries_take_turns():
    order = turns(list(range(1, 4001)), 5)
    assert (np.sort(order, axis=1) == np.arange(5)).all()
    assert np.abs((order < 2).mean(axis=0) - 0.4).max() < 0.04


def made(spark, n=700):
    rng = random.Random(2)
    rows = [(k, [rng.gauss(0, 1) for _ in range(4)]) for k in range(n)]
    return spark.createDataFrame(
        [(k, x, int(x[0] + x[1] > 0) ^ int(rng.random() < 0.1)) for k, x in rows], SCHEMA
    )


def test_same_forest_in_any_partitioning(spark):
    rows = made(spark)
    fits = [
        fit_forest(rows.repartition(n), "x", "y", "id", trees=6, fraction=0.5, local_rows=local)
        for n, local in ((1, 1 << 16), (17, 1 << 16), (5, 200))
    ]
    for other in fits[1:]:
        assert all(nested(fits[0], a) == nested(other, b) for a, b in zip(fits[0].roots, other.roots))
    trees = [str(nested(fits[0], r)) for r in fits[0].roots]
    assert len(set(trees)) == 6
    x = np.array([r["x"] for r in rows.collect()])
    right = (fits[0].chances(x) > 0.5) == (x[:, 0] + x[:, 1] > 0)
    assert right.mean() > 0.85
    bounded = fit_forest(rows, "x", "y", "id", trees=2, least_rows=40)
    assert len(bounded.entry) < 2 * 40


def test_wrong_tables(spark):
    for rows in ([], [(1, [1.0], None)], [(1, [1.0], 2)], [(1, [1.0], 0), (2, [1.0, 2.0], 1)], [(1, [], 1)]):
        with pytest.raises(ValueError):
            fit_forest(spark.createDataFrame(rows, SCHEMA), "x", "y", "id")
    some = spark.createDataFrame([(1, [1.0], 1)], SCHEMA)
    for wrong in ({"trees": 0}, {"fraction": 0.0}, {"fraction": 1.5}, {"least_rows": 0}):
        with pytest.raises(ValueError):
            fit_forest(some, "x", "y", "id", **wrong)
    # a tree that drew no row says what all rows say
    only = fit_forest(some, "x", "y", "id", trees=30)
    assert set(only.value) == {1.0}


def test_train_and_store(spark, tmp_path):
    rng = random.Random(3)
    rows = [(str(k), rng.choice("abc"), rng.choice([1.0, 2.0, None]), rng.choice("01")) for k in range(500)]
    labelled = spark.createDataFrame(
        [(*r, int(r[1] == "a" and r[2] is None)) for r in rows],
        "id string, level string, size double, flag string, y int",
    )
    spec = FeatureSpec(("level",), ("size",), ("flag",))
    model = train_deep_forest(labelled, spec, "y", "id", trees=9, fraction=0.7, fill=False)
    scored = predict(model, labelled)
    assert scored.where(F.col("prediction") != F.col("y")).count() == 0
    assert model.trees.getNumTrees == 9
    save_model(StoredModel(model), f"{tmp_path}/m", spark)
    loaded = load_model(spark, f"{tmp_path}/m").model
    assert isinstance(loaded.trees, Forest)
    again = predict(loaded, labelled).collect()
    assert Counter(again) == Counter(scored.collect())
