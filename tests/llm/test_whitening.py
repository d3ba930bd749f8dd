"""Whitening against eigenvectors of the covariance, and its small solver on hard matrices."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest

from featloom.llm.bidiagonal import bidiagonal, right_singular
from featloom.llm.whitening import deviations, fit_whitening, prepared, square_sums, whitened

SCHEMA = "vec_id long, embedding array<float>, label int"


def matrices():
    rng = np.random.default_rng(0)
    turn = np.linalg.qr(rng.standard_normal((24, 24)))[0]
    back = np.linalg.qr(rng.standard_normal((24, 24)))[0]
    close = np.r_[np.full(8, 5.0), 3 + 1e-10 * np.arange(8), np.linspace(1, 2, 8)]
    yield np.zeros((4, 4))
    yield np.eye(7)
    yield np.ones((1, 1)) * -3
    yield turn
    yield turn * close @ back
    yield np.diag(np.abs(np.arange(21) - 10.0)) + np.diag(np.ones(20), 1)
    yield np.triu(np.full((30, 30), -0.3), 1) + np.eye(30)
    for n in (1, 2, 3, 9, 40):
        yield rng.standard_normal((n, n))
        half = rng.standard_normal((n, n))
        half[:, : n // 2] = 0
        yield half


@pytest.mark.parametrize("m", list(matrices()))
def test_solver(m):
    squares, vectors = right_singular(m)
    wanted = np.linalg.svd(m, compute_uv=False) ** 2
    scale = max(wanted[0], 1e-300)
    assert np.abs(squares - wanted).max() <= 1e-13 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(m))).max() < 1e-11
    assert np.abs(m.T @ m @ vectors - vectors * squares).max() <= 1e-12 * scale


def test_bidiagonal():
    m = np.random.default_rng(1).standard_normal((9, 9))
    a, b, right = bidiagonal(m)
    upper = np.diag(a) + np.diag(b, 1)
    assert np.allclose(upper.T @ upper, right.T @ m.T @ m @ right, atol=1e-12)


def test_small_values_keep_their_digits():
    """A graded bidiagonal matrix: its smallest singular value is many orders below the largest."""
    a = 10.0 ** -np.arange(12.0)
    m = np.diag(a) + np.diag(a[:-1] / 3, 1)
    squares, _ = right_singular(m)
    inverse = np.linalg.inv(m[::1])
    assert squares[-1] == pytest.approx(1 / np.linalg.svd(inverse, compute_uv=False)[0] ** 2, rel=1e-10)


def brute(vectors, components=32):
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors], object)
    n, sums = len(x), x.sum(0)
    gaps = n * x - sums
    centred = gaps.astype(float) / n
    cov = centred.T @ centred / n
    e, u = np.linalg.eigh(cov)
    order = np.argsort(-e)[:components]
    e, u = e[order], u[:, order]
    return gaps, (gaps**2).sum(1), centred @ u / np.sqrt(e), e / np.trace(cov), u


def by_row(found):
    rows = defaultdict(dict)
    for r in found:
        rows[r["vec_id"]][r["component"]] = r
    return rows


def test_whitened(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.standard_normal((400, 40)) * np.linspace(3, 0.2, 40)).tolist()
    rows = [(k, v, k % 3) for k, v in enumerate(vectors)]
    odd = [
        (900, None, 1), (901, [], 1), (902, [1.0, None] * 20, 1), (903, [float("nan")] * 40, 1),
        (904, [float("inf")] * 40, 2), (905, [1.0] * 39, 2), (906, [1e38] * 40, 2),
    ]
    rows = spark.createDataFrame(rows + odd, SCHEMA).selectExpr("*", "1 x", "'c' component", "2 n").repartition(40)
    gaps, deviation, wanted, explained, _ = brute(vectors)
    found = whitened(rows).collect()
    assert len(found) == 400 * 32
    assert {r["n"] for r in found} == {400} and max(r["identity_error"] for r in found) < 1e-10
    assert len({r["identity_error"] for r in found}) == 1
    rows = by_row(found)
    for c in range(1, 33):
        own = np.array([rows[k][c]["whitened"] for k in range(400)])
        sign = np.sign(own @ wanted[:, c - 1])
        assert np.abs(own * sign - wanted[:, c - 1]).max() < 1e-8
        assert rows[0][c]["explained"] == pytest.approx(explained[c - 1], rel=1e-10)
    assert [rows[k][1]["deviation"] for k in range(400)] == deviation.tolist()


def test_ties_and_repeated_rows(spark):
    """Equal eigenvalues: any directions do that whiten; repeated rows and null ids stay."""
    corners = [[s * 4.0 if k == j else 0.0 for k in range(6)] for j in range(6) for s in (-1, 1)]
    rows = [(None if k == 3 else k % 9, v, 0) for k, v in enumerate(corners * 2)]
    found = whitened(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(found) == 24 * 6 and sum(r["vec_id"] is None for r in found) == 6
    assert max(r["identity_error"] for r in found) < 1e-12
    assert all(r["explained"] == pytest.approx(1 / 6) for r in found)


def test_few_components(spark):
    """Constant and dependent entries have no component of their own; equal rows have none at all."""
    rng = np.random.default_rng(5)
    base = np.round(rng.standard_normal((50, 2)) * 8) / 4
    rows = [(k, [float(a), 2.0, float(b), float(a + b)], 0) for k, (a, b) in enumerate(base)]
    found = whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["component"] for r in found} == {1, 2} and max(r["identity_error"] for r in found) < 1e-10
    assert sum({r["component"]: r["explained"] for r in found}.values()) == pytest.approx(1)
    assert whitened(spark.createDataFrame([(1, [1.0, 2.0], 0)] * 5, SCHEMA)).collect() == []
    empty = whitened(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns[:3] == ["vec_id", "component", "n"]


def test_same_in_any_partitioning(spark):
    rng = np.random.default_rng(8)
    rows = [(k, v, 0) for k, v in enumerate(rng.standard_normal((300, 12)).tolist())]
    frame = spark.createDataFrame(rows, SCHEMA)
    fits = []
    for parts in (1, 50):
        whole, width = prepared(frame.repartition(parts))
        fits.append(fit_whitening(whole, width, 12))
    assert fits[0].sums == fits[1].sums
    assert np.abs(fits[0].directions - fits[1].directions).max() < 1e-10


def test_exact_beyond_sixty_four_bits():
    x = np.array([[1 << 45, 5], [-(1 << 45), 7]], np.int64)
    n = 1 << 20
    gaps = deviations(x, n, [3, 4])
    assert gaps[0, 0] == n * (1 << 45) - 3 and square_sums(gaps) == [None, None]
    small = deviations(np.array([[3, 4]], np.int64), 2, [1, 1])
    assert square_sums(small) == [25 + 49]
