"""Boosted trees of second order against a plain fit that tries every split of every node."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from featloom.learning.boost import SQUARES, BoostedTrees, BoostSettings, fit_boosted
from featloom.learning.prep import FeatureSpec
from featloom.learning.score import StoredModel, load_model, save_model, score
from featloom.learning.sketch import ROOM, Summary, weighted_cuts
from featloom.learning.train import (
    fit_validate_refit,
    predict,
    train_boosted,
    train_boosted_regressor,
)

NAN = float("nan")


def brute_fit(x, y, w, s):
    """Trees as nested (entry, cut, missing_low, low, high) or a leaf value, and the margins after each."""
    margins = [s.start] * len(x)
    edges = [sorted({r[k] for r in x if not math.isnan(r[k])}) for k in range(len(x[0]))]

    def slopes(i):
        if s.objective == SQUARES:
            return (margins[i] - y[i]) * w[i], w[i]
        p = 1 / (1 + math.exp(-margins[i]))
        return (p - y[i]) * w[i], p * (1 - p) * w[i]

    def grow(rows, depth, found):
        g, h = (math.fsum(found[i][k] for i in rows) for k in (0, 1))
        best = None
        for k in range(len(x[0])):
            values = sorted({x[i][k] for i in rows if not math.isnan(x[i][k])})
            nan = [i for i in rows if math.isnan(x[i][k])]
            for v in values if depth else []:
                later = [e for e in edges[k] if e > v]
                cut = later[0] if later else math.inf
                for missing_low in (False, True) if nan else (False,):
                    low = [i for i in rows if x[i][k] <= v or (missing_low and math.isnan(x[i][k]))]
                    if not 0 < len(low) < len(rows):
                        continue
                    gl, hl = (math.fsum(found[i][j] for i in low) for j in (0, 1))
                    if min(hl, h - hl) < s.least_weight:
                        continue
                    gain = gl * gl / (hl + s.ridge) + (g - gl) ** 2 / (h - hl + s.ridge) - g * g / (h + s.ridge)
                    if gain / 2 > max(s.least_gain, 1e-6) and (best is None or gain > best[0] + 1e-9):
                        best = gain, k, cut, missing_low, low
        if best is None:
            value = -g / (h + s.ridge) * s.rate
            for i in rows:
                margins[i] += value
            return value
        _, k, cut, missing_low, low = best
        rest = [i for i in rows if i not in set(low)]
        return k, cut, missing_low, grow(low, depth - 1, found), grow(rest, depth - 1, found)

    trees = []
    for _ in range(s.rounds):
        found = [slopes(i) for i in range(len(x))]
        trees.append(grow(list(range(len(x))), s.depth, found))
    return trees, margins


def nested(tree, node=0):
    if tree.entry[node] < 0:
        return tree.value[node]
    sides = nested(tree, tree.low[node]), nested(tree, tree.high[node])
    return tree.entry[node], tree.cut[node], tree.missing_low[node], *sides


def same(a, b):
    if isinstance(a, tuple) and isinstance(b, tuple):
        return a[:3] == b[:3] and same(a[3], b[3]) and same(a[4], b[4])
    return a == pytest.approx(b, abs=1e-7)


def made(seed, n=160, missing=0.2):
    """Rows with ties, missing entries that tell something, a constant entry and one that is never there."""
    rng = random.Random(seed)
    x = [[rng.randint(0, 9) / 2, rng.gauss(0, 1), float(rng.random() < 0.3), 7.0, NAN] for _ in range(n)]
    y = [float((r[0] > 2) ^ (r[1] > 0.4) or rng.random() < 0.15) for r in x]
    for r, label in zip(x, y):
        if rng.random() < missing * (1.5 if label else 0.5):
            r[rng.randrange(2)] = NAN
    return x, y, [rng.choice([0.5, 1.0, 3.0]) for _ in x]


@pytest.mark.parametrize(
    "seed, weighted, parts, local", [(0, False, 1, 1 << 16), (1, True, 7, 0), (2, True, 40, 30)]
)
def test_three_rounds_equal_a_plain_fit(spark, seed, weighted, parts, local):
    x, y, w = made(seed)
    if not weighted:
        w = [1.0] * len(x)
    s = BoostSettings(rounds=3, depth=4)
    rows = spark.createDataFrame(list(zip(x, y, w)), "x array<double>, y double, w double").repartition(parts)
    found = fit_boosted(rows, "x", "y", s, "w" if weighted else None, local)
    wanted, margins = brute_fit(x, y, w, s)
    assert all(same(nested(a), b) for a, b in zip(found.trees, wanted))
    assert found.margins(np.array(x)) == pytest.approx(margins, abs=1e-7)
    scored = found.transform(rows.select("x")).select("prediction", "probability").collect()
    chances = sorted(r["probability"][1] for r in scored)
    assert chances == pytest.approx(sorted(1 / (1 + math.exp(-m)) for m in margins), abs=1e-7)
    assert all(r["prediction"] == (r["probability"][1] > 0.5) for r in scored)


def test_regression_equals_a_plain_fit(spark):
    x, _, w = made(5)
    y = [round(3 * r[2] + (0 if math.isnan(r[0]) else r[0] ** 2), 3) for r in x]
    s = BoostSettings(rounds=3, depth=3, objective=SQUARES, ridge=0.5, least_gain=0.2, least_weight=4.0)
    rows = spark.createDataFrame(list(zip(x, y)), "x array<double>, y double").repartition(3)
    found = fit_boosted(rows, "x", "y", s)
    wanted, margins = brute_fit(x, y, [1.0] * len(x), s)
    assert all(same(nested(a), b) for a, b in zip(found.trees, wanted))
    predicted = sorted(r["prediction"] for r in found.transform(rows).collect())
    assert predicted == pytest.approx(sorted(margins), abs=1e-6)
    deep = train_boosted_regressor(rows, "x", "y")
    assert deep.settings.depth == 10 and len(deep.trees) == 10


def test_same_trees_in_any_partitioning(spark):
    x, y, _ = made(7, n=900)
    rows = spark.createDataFrame(list(zip(x, y)), "x array<double>, y double")
    s = BoostSettings(rounds=12, depth=4)
    found = fit_boosted(rows.repartition(1), "x", "y", s)
    assert found == fit_boosted(rows.repartition(23), "x", "y", s)
    # nodes finished in a task, or level by level: the same splits and values in another order
    wide = fit_boosted(rows.repartition(5), "x", "y", s, local_rows=100)
    assert [nested(t) for t in wide.trees] == [nested(t) for t in found.trees]


def test_missing_has_a_side(spark):
    """Only missing entries are of class 1: one split sends them away from all values."""
    rows = [([NAN if k % 3 == 0 else float(k)], float(k % 3 == 0)) for k in range(60)]
    frame = spark.createDataFrame(rows, "x array<double>, y double")
    found = fit_boosted(frame, "x", "y", BoostSettings(rounds=1, depth=1))
    assert nested(found.trees[0])[1:3] == (math.inf, False)
    low, high = nested(found.trees[0])[3:]
    assert low < 0 < high
    got = found.margins(np.array([[NAN], [1e9], [math.inf], [-math.inf]]))
    assert got.tolist() == [high, low, low, low]


def test_wrong_tables(spark):
    schema = "x array<double>, y double"
    for rows in ([], [([1.0], None)], [([1.0], 2.0)], [([1.0], NAN)], [([1.0], 0.0), ([1.0, 2.0], 1.0)], [([], 1.0)]):
        with pytest.raises(ValueError):
            fit_boosted(spark.createDataFrame(rows, schema), "x", "y")
    for wrong in ({"objective": "none"}, {"rounds": 0}, {"depth": 0}, {"bins": 1}, {"base": 1.0}):
        with pytest.raises(ValueError):
            BoostSettings(**wrong)
    one = fit_boosted(spark.createDataFrame([([None], 1.0)], schema), "x", "y", BoostSettings(rounds=2))
    assert all(t.entry == [-1] for t in one.trees) and one.margins(np.array([[NAN]]))[0] > 0


def plain_rank(values, weights, v):
    return sum(w for x, w in zip(values, weights) if x < v), sum(w for x, w in zip(values, weights) if x <= v)


def test_summaries():
    rng = np.random.default_rng(0)
    values, weights = rng.integers(0, 400, 3000).astype(float), rng.choice([0.5, 1, 8], 3000)
    parts = [Summary.of(values[k : k + 300], weights[k : k + 300]).pruned(50) for k in range(0, 3000, 300)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.merged(part).pruned(50)
    assert len(whole.value) <= 50 and whole.total == pytest.approx(weights.sum())
    assert whole.value[0] == values.min() and whole.value[-1] == values.max()
    for v, least, most, own in zip(whole.value, whole.least, whole.most, whole.weight):
        below, upto = plain_rank(values, weights, v)
        assert least <= below + 1e-6 and upto <= most + 1e-6 and own <= upto - below + 1e-6
        assert most - least - own <= 0.25 * whole.total
    exact = Summary.of(values, weights)
    assert exact.merged(Summary.of(np.empty(0), np.empty(0))).value.tolist() == exact.value.tolist()
    few = Summary.of(np.array([3.0, NAN, 1.0, 1.0]), np.ones(4))
    assert few.cuts(9).tolist() == [3.0] and few.total == 3


def test_weighted_cuts(spark):
    rng = np.random.default_rng(1)
    values = np.column_stack([rng.exponential(1, 20_000), rng.integers(0, 5, 20_000), np.full(20_000, NAN)])
    weights = np.where(values[:, 0] > 2, 10.0, 1.0)
    rows = spark.createDataFrame(
        [(v.tolist(), float(w)) for v, w in zip(values, weights)], "x array<double>, w double"
    ).repartition(40)
    cuts = weighted_cuts(rows, "x", 3, bins=16, weight="w")
    assert cuts[1].tolist() == [1, 2, 3, 4] and len(cuts[2]) == 0 and len(cuts[0]) == 15
    place = np.searchsorted(cuts[0], values[:, 0], side="right")
    shares = np.bincount(place, weights, 16) / weights.sum()
    # sixteenths of the weight, up to the error of the summaries
    assert np.abs(np.cumsum(shares) - np.arange(1, 17) / 16).max() < 4 / (ROOM * 16)


SPEC = FeatureSpec(("level",), ("size",), ("flag",))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(3)
    rows = []
    for k in range(600):
        level, size = rng.choice(["a", "b", None]), rng.choice([1.0, 2.0, 3.0, None])
        rows.append((str(k), level, size, rng.choice("01"), int(level == "a" or size is None)))
    return spark.createDataFrame(rows, "id string, level string, size double, flag string, y int")


def test_train_and_store(spark, labelled, tmp_path):
    model = train_boosted(labelled, SPEC, "y", rounds=8, fill=False)
    scored = predict(model, labelled)
    assert scored.columns == [*labelled.columns, "prediction", "score"]
    assert scored.where(F.col("prediction") != F.col("y")).count() == 0
    # a number that is not there is no mode: with the mode it cannot be told
    filled = train_boosted(labelled, SPEC, "y", rounds=8)
    assert predict(filled, labelled).where(F.col("prediction") != F.col("y")).count() > 50
    save_model(StoredModel(model), f"{tmp_path}/m", spark)
    loaded = load_model(spark, f"{tmp_path}/m")
    assert isinstance(loaded.model.trees, BoostedTrees) and loaded.model.trees == model.trees
    unseen = spark.createDataFrame([("x", "new", None, "1"), ("y", "b", 1.0, None)], "id string, level string, size double, flag string")
    assert [r["predictions"] for r in score(unseen, loaded).orderBy("id").collect()] == [1.0, 0.0]


def test_refit(labelled):
    refit = fit_validate_refit(labelled, SPEC, "y", "id", rounds=4, fit=train_boosted)
    assert isinstance(refit.model.trees, BoostedTrees) and len(refit.model.trees.trees) == 4
    assert refit.metrics.count() == 2
