"""The Parzen estimator: densities against sums over the range, and searches on made-up losses."""

from __future__ import annotations

import math

import numpy as np
import pytest

from featloom.learning.parzen import STARTUP, Mixture, Setting, good_count, split_by_loss, suggest
from featloom.learning.search import SearchSpace, run_trials

WHOLE = Setting(20, 100, step=1)
SHARE = Setting(0.5, 0.9)


@pytest.mark.parametrize("values", [[], [20], [55, 55, 55], list(range(20, 101)), [100, 99, 20] * 30])
def test_density_of_steps_sums_to_one(values):
    mixture = Mixture(values, WHOLE)
    assert np.exp(mixture.log_density(np.arange(20, 101))).sum() == pytest.approx(1)
    drawn = mixture.draw(4000, np.random.default_rng(0))
    assert set(drawn) <= set(range(20, 101))
    # what is drawn follows the density
    mass = np.exp(mixture.log_density(np.arange(20, 101)))
    counts = np.array([(drawn == k).sum() for k in range(20, 101)])
    assert np.abs(counts / 4000 - mass).max() < 0.03


@pytest.mark.parametrize("values", [[], [0.5], [0.9, 0.9], [0.6, 0.61, 0.62, 0.8]])
def test_density_integrates_to_one(values):
    mixture = Mixture(values, SHARE)
    at = np.linspace(0.5, 0.9, 40_001)
    density = np.exp(mixture.log_density(at))
    assert np.trapezoid(density, at) == pytest.approx(1, rel=1e-6)
    # the curves one by one
    slow = 0.0
    for centre, width, weight in zip(mixture.centres, mixture.widths, mixture.weights):
        curve = np.exp(-(((at - centre) / width) ** 2) / 2)
        slow = slow + weight * curve / np.trapezoid(curve, at)
    assert np.allclose(density, slow, rtol=1e-5)


def test_curves():
    mixture = Mixture([30, 34, 90], WHOLE)
    # the larger gap to a neighbour, the range's centre and its ends among them
    assert mixture.widths.tolist() == [16.2, 26, 30, 81]
    assert mixture.weights.tolist() == [0.25] * 4
    old = Mixture([50.0] * 30, WHOLE).weights
    assert old[0] < old[4] <= old[5] == old[-1] and old.sum() == pytest.approx(1)
    with pytest.raises(ValueError):
        Setting(1, 1)
    with pytest.raises(ValueError):
        Setting(0, 1, step=0)


def test_good_trials():
    assert [good_count(n) for n in (1, 4, 16, 17, 100, 40_000)] == [1, 1, 1, 2, 3, 25]
    losses = [0.5, 0.2, 0.2, float("nan"), 0.1] + [0.9] * 15
    assert split_by_loss(losses) == ([1, 4], [0, 2, 3, *range(5, 20)])
    assert split_by_loss([float("nan")] * 3) == ([0], [1, 2])


def test_settings_follow_from_losses():
    space = {"trees": WHOLE, "fraction": SHARE}
    tried = [suggest(space, [], [], 5, n) for n in range(30)]
    low = [s["trees"] / 100 for s in tried]
    high = [-s["trees"] / 100 for s in tried]
    drawn = [[suggest(space, tried, x, 5, n)["trees"] for n in range(30, 60)] for x in (low, high)]
    assert np.median(drawn[0]) < 45 and np.median(drawn[1]) > 75
    assert suggest(space, tried, low, 5, 30) == suggest(space, tried, low, 5, 30)
    # before there are enough losses they do not matter
    few = [suggest(space, tried[:19], x[:19], 5, 19) for x in (low, high)]
    assert few[0] == few[1] == tried[19]


def noisy(settings):
    """A loss with one best place, and noise that the settings decide."""
    noise = 0.01 * math.sin(1000 * settings["fraction"] + 37 * settings["trees"])
    return (settings["trees"] - 83) ** 2 / 2000 + (settings["fraction"] - 0.57) ** 2 * 40 + noise


def trials_to(target, startup, seed):
    space = SearchSpace().settings
    _, losses = run_trials(space, lambda b: [noisy(s) for s in b], 300, 1000, 0.5, seed, startup)
    return next((n for n, x in enumerate(losses, 1) if x <= target), 301)


def test_fewer_trials_than_random_search():
    """Ten seeds to the same loss: the settings learned from losses get there sooner."""
    learned = [trials_to(0.0, STARTUP, seed) for seed in range(10)]
    random = [trials_to(0.0, 300, seed) for seed in range(10)]
    assert sum(learned) < 0.7 * sum(random)
    assert sum(a <= b for a, b in zip(learned, random)) >= 7


@pytest.mark.parametrize("ahead", [1, 4])
def test_run_trials(ahead):
    space = SearchSpace().settings
    sizes, seen = [], []

    def attempts(batch):
        sizes.append(len(batch))
        seen.extend(batch)
        return [noisy(s) for s in batch]

    tried, losses = run_trials(space, attempts, 50, 50, 0.5, 3, 20, ahead)
    assert tried == seen and losses == [noisy(s) for s in tried] and len(tried) == 50
    assert sizes[0] == 20 and set(sizes[1:-1]) <= {ahead} and sum(sizes) == 50
    again = SearchSpace().draw(50, 3)
    same = [(int(s["trees"]), s["fraction"]) == r for s, r in zip(tried, again)]
    assert all(same[:20]) and not any(same[20:])
    stopped, _ = run_trials(space, lambda b: [0.5] * len(b), 100, 25, 0.5, 3, 20, ahead)
    assert len(stopped) == 25
    assert run_trials(space, attempts, 0) == ([], [])
    assert all(20 <= s["trees"] <= 100 and s["trees"] % 1 == 0 and 0.5 <= s["fraction"] <= 0.9 for s in tried)
