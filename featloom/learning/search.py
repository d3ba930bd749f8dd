"""Search over forest settings that learns from its trials."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from featloom.learning.parzen import STARTUP, Setting, suggest
from featloom.learning.prep import FEATURES, FeatureSpec, fit_preprocessor
from featloom.learning.train import TreeModel, forest, train_forest
from featloom.operators.evaluate import weighted_prf
from featloom.session import kept


@dataclass(frozen=True)
class SearchSpace:
    """Whole numbers of trees and a range for the share of features per split."""

    # The ranges searched.
    trees: tuple[int, int] = (20, 100)
    fraction: tuple[float, float] = (0.5, 0.9)

    @property
    def settings(self) -> dict[str, Setting]:
        return {"trees": Setting(*self.trees, step=1), "fraction": Setting(*self.fraction)}

    def draw(self, count: int, seed: int) -> list[tuple[int, float]]:
        """The first ``count`` random settings of a seed; a longer draw begins with the same ones."""
        drawn = [suggest(self.settings, [], [], seed, number) for number in range(count)]
        return [(int(one["trees"]), one["fraction"]) for one in drawn]


@dataclass(frozen=True)
class Trial:
    """One fit: its settings, the unrounded loss ``1 - f1``, and the metrics."""

    trial: int
    trees: int
    fraction: float
    loss: float
    precision: float
    recall: float
    f1: float


@dataclass(frozen=True)
class SearchResult:
    trials: tuple[Trial, ...]

    @property
    def best(self) -> Trial:
        return min(self.trials, key=lambda t: (t.loss, t.trial))

    def to_df(self, spark: SparkSession, digits: int = 3) -> DataFrame:
        """One row per trial; metrics rounded, the loss as it is."""
        schema = (
            "trial int, trees int, fraction double, loss double, "
            "precision double, recall double, f1 double"
        )
        rows = spark.createDataFrame([tuple(asdict(t).values()) for t in self.trials], schema)
        return rows.withColumns({n: F.round(n, digits) for n in ("precision", "recall", "f1")})


def trials_until_stop(losses: Sequence[float], patience: int, min_gain: float) -> int | None:
    """How many trials count, or None if the search goes on.

    The search stops once ``patience`` trials in a row fail to lower the reference loss by more
    than ``min_gain`` percent. The first trial sets the reference and counts as one of the row.
    """
    reference, idle = losses[0] if losses else 0.0, 1
    for number, loss in enumerate(losses[1:], start=2):
        if loss < reference - abs(reference) * min_gain / 100:
            reference, idle = loss, 0
        else:
            idle += 1
        if idle >= patience:
            return number
    return None


def run_trials(
    space: dict[str, Setting],
    attempts: Callable[[list[dict[str, float]]], list[float]],
    max_trials: int = 100,
    patience: int = 25,
    min_gain: float = 0.5,
    seed: int = 50,
    startup: int = STARTUP,
    ahead: int = 1,
) -> tuple[list[dict[str, float]], list[float]]:
    """Settings and losses of the trials of a search, up to its stopping point.

    ``attempts`` takes a few settings and returns their losses. Until ``startup`` trials settings are random;
    from then on they follow from the losses so far, ``ahead`` of them at a time from the same losses.
    Trials past the stopping point do not count.
    """
    tried: list[dict[str, float]] = []
    losses: list[float] = []
    while len(tried) < max_trials:
        count = startup - len(tried) if len(tried) < startup else ahead
        count = min(max(count, 1), max_trials - len(tried), max(patience, 1))
        numbers = range(len(tried), len(tried) + count)
        batch = [suggest(space, tried, losses, seed, n, startup) for n in numbers]
        losses += attempts(batch)
        tried += batch
        stop = trials_until_stop(losses, patience, min_gain)
        if stop is not None:
            return tried[:stop], losses[:stop]
    return tried, losses


def search(
    train: DataFrame,
    validation: DataFrame,
    spec: FeatureSpec,
    label: str,
    space: SearchSpace | None = None,
    max_trials: int = 100,
    patience: int = 25,
    min_gain: float = 0.5,
    seed: int = 50,
    parallelism: int = 4,
    depth: int = 5,
    startup: int = STARTUP,
    ahead: int = 4,
) -> SearchResult:
    """Minimise ``1 - f1`` (weighted, on the validation rows) over forests.

    Settings come from a Parzen estimator over the losses so far; the first ``startup`` are random, and
    with ``startup`` = ``max_trials`` all are. ``ahead`` settings at a time follow from the same losses:
    1 learns most from each trial, more keep more of the cluster busy. Preprocessing is fitted once and both
    prepared frames stay on the executors. ``parallelism`` fits are submitted at a time, each a
    distributed job; only settings and metrics come back. The result does not depend on ``parallelism``.
    """
    spark = train.sparkSession
    columns = [*spec.columns, F.col(label).cast("double").alias(label)]

    with kept(train.select(columns)) as rows:
        preprocessor = fit_preprocessor(rows, spec)
        prepared = preprocessor.transform(rows, one_hot=False).select(FEATURES, label)
        held_out = preprocessor.transform(validation.select(columns), one_hot=False)
        held_out = held_out.select(FEATURES, label)
        with kept(prepared) as fit_rows, kept(held_out) as check_rows, ThreadPoolExecutor(parallelism) as pool:
            metrics: list[Row] = []

            def attempt(settings: dict[str, float]) -> Row:
                estimator = forest(label, int(settings["trees"]), settings["fraction"], depth, seed)
                model = estimator.fit(fit_rows)
                return weighted_prf(model.transform(check_rows), label).collect()[0]

            def attempts(batch: list[dict[str, float]]) -> list[float]:
                found = [pool.submit(inheritable_thread_target(spark)(attempt), one) for one in batch]
                metrics.extend(one.result() for one in found)
                return [1 - one["f1"] for one in metrics[-len(batch) :]]

            tried, losses = run_trials(
                (space or SearchSpace()).settings, attempts, max_trials, patience, min_gain, seed, startup, ahead
            )
    return SearchResult(
        tuple(
            Trial(n, int(s["trees"]), s["fraction"], loss, m["precision"], m["recall"], m["f1"])
            for n, (s, loss, m) in enumerate(zip(tried, losses, metrics))
        )
    )


def fit_best(
    train: DataFrame,
    spec: FeatureSpec,
    label: str,
    found: SearchResult,
    seed: int = 50,
    depth: int = 5,
) -> TreeModel:
    """The forest of the best trial's settings, fitted on ``train``."""
    best = found.best
    return train_forest(train, spec, label, best.trees, best.fraction, depth, seed)
