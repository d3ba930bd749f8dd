"""Hard negatives against scoring all pairs."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from featloom.llm.negatives import Best, Vectors, mined, stored, summary, taking_part, wanted_pairs

SCHEMA = "vec_id long, embedding array<double>, label int"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows):
    clean = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        if i % 7 == 0:
            label = (label + 1) % 10
        clean.append((i, [math.floor(256 * c) for c in v], label))
    out = []
    for a, (i, x, label) in enumerate(clean):
        if i % 100:
            continue
        found = [(-sum(p * q for p, q in zip(x, y)), j, m) for b, (j, y, m) in enumerate(clean) if b != a]
        found.sort()
        for s, j, _ in [f for f in found if f[2] == label][:5]:
            band = [f for f in found if f[2] != label and 30 * -s <= 100 * -f[0] <= 90 * -s]
            out += [(i, j, k, f[1], -s, -f[0]) for k, f in enumerate(band[:10], 1)]
    return Counter(out)


def near(rng, centre, spread):
    return [c + rng.gauss(0, spread) for c in centre]


def some_rows(seed=0, n=600, width=20):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(4)]
    rows = [(k * 5, near(rng, rng.choice(centres), 0.6), rng.randrange(10)) for k in range(n)]
    # a third of the rows: one vector, and so ties without end
    return rows + [(10_000 + 10 * k, centres[0], k % 3) for k in range(n // 2)]


ODD = [
    (None, [1.0] * 20, 1), (100, None, 1), (200, [1.0] * 20, None), (300, [1.0, None] * 10, 2),
    (300, [float("nan")] * 20, 2), (400, [float("inf")] * 20, 3), (400, [], 3), (500, [2.0, -1.0], 3),
    (700, [0.5] * 20, 4), (700, [0.5] * 20, 4), (-100, [0.25] * 20, 0), (-7, [0.75] * 20, -3),
]


@pytest.mark.parametrize("parts, block", [(1, 16384), (9, 7)])
def test_mined(spark, parts, block):
    rows = some_rows() + ODD
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 row", "'x' anchor", "2 rank").repartition(parts)
    found = mined(frame, block=block)
    assert found.columns == NAMES
    wanted = brute(rows)
    assert Counter(map(tuple, found.collect())) == wanted and len(wanted) > 500


@pytest.mark.parametrize("levels", [(1,), (2, 3, 50), ()])
def test_any_levels(spark, levels):
    rows = some_rows(3, n=240)
    found = mined(spark.createDataFrame(rows, SCHEMA).repartition(3), levels=levels)
    assert Counter(map(tuple, found.collect())) == brute(rows)


def test_large_numbers(spark):
    """Scores of over 53 bits are exact; a row that does not fit a long with itself takes no part."""
    rng = random.Random(2)
    rows = [(50 * k, [rng.uniform(-2e6, 2e6) for _ in range(6)], k % 4) for k in range(120)]
    rows.append((100_000, [1e8] * 6, 1))
    found = mined(spark.createDataFrame(rows, SCHEMA))
    assert Counter(map(tuple, found.collect())) == brute(rows[:-1])


def test_nothing_to_find(spark):
    assert mined(spark.createDataFrame([], SCHEMA)).collect() == []
    assert mined(spark.createDataFrame([(100, [1.0], 1)], SCHEMA)).collect() == []
    assert mined(spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 2)], SCHEMA)).collect() == []
    far = [(100, [1.0], 1), (1, [-1.0], 1), (2, [1.0], 2)]
    assert mined(spark.createDataFrame(far, SCHEMA)).collect() == []


def test_bounds_hold_and_prune(spark):
    """Every bound holds, finer ones are closer, and pairs of clustered vectors are pruned unscored."""
    rng = np.random.default_rng(1)
    x = rng.integers(-300, 300, (40, 30))
    scores = x @ x.T
    last = None
    for parts in (1, 5, 15, 30):
        mean, spread = summary(x, parts)
        middle = mean * 30 / parts @ mean.T
        reach = spread @ spread.T
        assert (middle + reach >= scores - 1e-6).all() and (middle - reach <= scores + 1e-6).all()
        assert last is None or (middle + reach <= last + 1e-6).all()
        last = middle + reach
    assert np.allclose(last, scores)
    rows = [(7 * k + 1, [float(c) for c in np.repeat(rng.normal(0, 1, 4), 8) + rng.normal(0, 0.02, 32)], 0) for k in range(300)]
    whole, width = stored(taking_part(spark.createDataFrame(rows, SCHEMA)))
    one = Vectors.of(whole.toArrow(), width, (1, 4, 16))
    low = np.sort((one.x @ one.x.T), axis=1)[:, -6]
    a, r, score, left = wanted_pairs(one, one, True, low, np.full(len(low), np.iinfo(np.int64).max))
    assert len(a) >= 5 * 300 and (score >= low[a]).all()
    assert left[0] == 300 * 299 and left[1] < left[0] and left[2] < 0.2 * left[0]


def test_best_keeps_ties_by_id():
    low, high = np.array([[1, 3]]), np.array([[9, 5]])
    best = Best(low, high, 2, np.full((1, 2), np.iinfo(np.int64).min))
    for score, name in [(4, 8), (9, 7), (4, 2), (10, 1), (4, 5), (2, 3)]:
        best.add(np.array([0]), np.array([score]), np.array([name]))
    assert best.score.tolist() == [[9, 4], [4, 4]] and best.vec_id.tolist() == [[7, 2], [2, 5]]
    assert best.limits(slice(0, 1))[0].tolist() == [4] and best.limits(slice(0, 1))[1].tolist() == [9]
