"""Tree-structured Parzen estimator: the next settings of a search from the losses of its trials.

The trials are split by loss into a few good ones and the others. For every setting both groups get a
density, a mixture of one normal curve per trial and a broad one for the range as a whole. Candidates are
drawn from the density of the good ones; the next setting is the candidate whose density there is highest
compared with the density of the others. Nothing here sees data: trials are a few numbers each.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

# The usual settings of the estimator.
STARTUP = 20
GAMMA = 0.25
MOST_GOOD = 25
CANDIDATES = 24
RECENT = 25


@dataclass(frozen=True)
class Setting:
    """A range to search: whole multiples of ``step`` from ``low`` to ``high``, or all of it."""

    low: float
    high: float
    step: float | None = None

    def __post_init__(self) -> None:
        if not self.low < self.high or (self.step is not None and self.step <= 0):
            raise ValueError("a range has a low end below its high end, and a step above zero")

    @property
    def ends(self) -> tuple[float, float]:
        """The range of the curves: values round to the nearest step, so half a step on either side."""
        half = (self.step or 0) / 2
        return self.low - half, self.high + half

    def rounded(self, values: np.ndarray) -> np.ndarray:
        """Drawn values as settings."""
        if self.step is not None:
            values = np.round(values / self.step) * self.step
        return np.clip(values, self.low, self.high)

    def random(self, generator: np.random.Generator) -> float:
        """A setting, all equally likely."""
        return float(self.rounded(np.array([generator.uniform(*self.ends)]))[0])


class Mixture:
    """A mixture of normal curves cut off at the ends of a setting's range.

    One curve stands for every value, as wide as the larger gap to a neighbour (neither a hundredth of the
    range nor, with few values, less than its share of it; never more than the range); one with the weight
    of a value is centred on the range and as wide as it. Values that are not among the RECENT last ones
    weigh the less the older they are.
    """

    def __init__(self, values: Sequence[float], setting: Setting):
        low, high = setting.ends
        width = high - low
        centres = np.append(np.asarray(values, float), (low + high) / 2)
        weights = np.append(_weights(len(values)), 1.0)
        order = np.argsort(centres, kind="stable")
        edges = np.concatenate([[low], centres[order], [high]])
        gaps = np.maximum(np.diff(edges)[:-1], np.diff(edges)[1:])
        narrowest = width / min(100.0, 2.0 + len(values))
        self.widths = np.empty(len(centres))
        self.widths[order] = np.clip(gaps, narrowest, width)
        self.widths[-1] = width
        self.centres, self.weights = centres, weights / weights.sum()
        self.setting, self.low, self.high = setting, low, high
        # what of each curve lies in the range
        self.inside = _normal(high, centres, self.widths) - _normal(low, centres, self.widths)

    def draw(self, count: int, generator: np.random.Generator) -> np.ndarray:
        """``count`` settings of the mixture; a value outside the range is drawn again."""
        out = np.empty(0)
        while len(out) < count:
            which = generator.choice(len(self.centres), count, p=self.weights)
            values = generator.normal(self.centres[which], self.widths[which])
            out = np.append(out, values[(values >= self.low) & (values <= self.high)])
        return self.setting.rounded(out[:count])

    def log_density(self, at: np.ndarray) -> np.ndarray:
        """The logarithm of the density at settings; for steps, of the probability of the step."""
        at = np.asarray(at, float)[:, None]
        if self.setting.step is None:
            z = (at - self.centres) / self.widths
            each = np.exp(-z * z / 2) / (self.widths * math.sqrt(2 * math.pi))
        else:
            half = self.setting.step / 2
            top = np.minimum(at + half, self.high)
            bottom = np.maximum(at - half, self.low)
            each = _normal(top, self.centres, self.widths) - _normal(bottom, self.centres, self.widths)
        return np.log(np.maximum((each / self.inside * self.weights).sum(1), 1e-300))


def _weights(count: int) -> np.ndarray:
    """1 for the RECENT last of ``count`` values, falling in a line to 1 / count for the first one."""
    older = max(count - RECENT, 0)
    ramp = np.linspace(1 / count, 1.0, older) if older else np.empty(0)
    return np.append(ramp, np.ones(count - older))


def _normal(x: np.ndarray | float, centre: np.ndarray, width: np.ndarray) -> np.ndarray:
    """The distribution function of normal curves."""
    erf = np.frompyfunc(math.erf, 1, 1)
    return 0.5 * (1 + erf((x - centre) / (width * math.sqrt(2))).astype(float))


def good_count(count: int, gamma: float = GAMMA) -> int:
    """How many of ``count`` trials are the good ones."""
    return min(math.ceil(gamma * math.sqrt(count)), MOST_GOOD)


def split_by_loss(losses: Sequence[float], gamma: float = GAMMA) -> tuple[list[int], list[int]]:
    """Numbers of the good trials and of the others, both in the order of the trials.

    The earlier of two equal losses is the better one; a loss that is NaN is the worst there is.
    """
    ranked = sorted(range(len(losses)), key=lambda k: (math.isnan(losses[k]), losses[k], k))
    good = set(ranked[: good_count(len(losses), gamma)])
    return sorted(good), [k for k in range(len(losses)) if k not in good]


def suggest(
    space: dict[str, Setting],
    tried: Sequence[dict[str, float]],
    losses: Sequence[float],
    seed: int,
    trial: int,
    startup: int = STARTUP,
) -> dict[str, float]:
    """The settings of trial number ``trial``, from the trials that have a loss by now.

    Until there are ``startup`` of those, settings are random. The draws of a trial depend on seed and number
    only, so a search that is run again makes the same trials.
    """
    generator = np.random.default_rng([seed, trial])
    if len(losses) < max(startup, 1):
        return {name: one.random(generator) for name, one in space.items()}
    good, others = split_by_loss(losses)
    found = {}
    for name, one in space.items():
        likely = Mixture([tried[k][name] for k in good], one)
        rest = Mixture([tried[k][name] for k in others], one)
        candidates = likely.draw(CANDIDATES, generator)
        gain = likely.log_density(candidates) - rest.log_density(candidates)
        found[name] = float(candidates[int(np.argmax(gain))])
    return found
