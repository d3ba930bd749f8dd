"""Boosted trees of second order: each tree follows from gradients and curvatures of the loss.

Rows are binned once by weighted quantiles and kept as blocks, with the margin that the trees before have
given them; ``grow`` makes the trees.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featloom.learning.grow import (
    EXACT_BITS,
    LOCAL_ROWS,
    STATE,
    Block,
    Rules,
    Tree,
    block,
    blocks,
    grow_trees,
)
from featloom.learning.sketch import weighted_cuts
from featloom.session import checkpointed, ship_code

LOGISTIC, SQUARES = "logistic", "squares"
LEAST_ROWS = 20_000
"""A task has at least so many rows, if there are as many."""
LINEAGE = 10
"""After so many trees the state of the rows is written down, so that a lost executor costs few of them."""


@dataclass(frozen=True)
class BoostSettings:
    """The usual settings of such trees."""

    rounds: int = 25
    depth: int = 6
    rate: float = 0.3
    ridge: float = 1.0
    least_gain: float = 0.0
    least_weight: float = 1.0
    bins: int = 256
    base: float = 0.5
    objective: str = LOGISTIC

    def __post_init__(self) -> None:
        if self.objective not in (LOGISTIC, SQUARES):
            raise ValueError(f"objective {self.objective!r}")
        if self.objective == LOGISTIC and not 0 < self.base < 1:
            raise ValueError("the base of a chance lies between 0 and 1")
        if self.rounds < 1 or self.depth < 1 or not 2 <= self.bins < 1 << 16:
            raise ValueError("at least one round, one level and two bins")

    @property
    def start(self) -> float:
        """The margin before the first tree."""
        return float(np.log(self.base / (1 - self.base))) if self.objective == LOGISTIC else self.base


@dataclass(frozen=True)
class BoostedTrees:
    """Fitted trees on a vector or array column, with the interface of the other tree models."""

    settings: BoostSettings
    trees: tuple[Tree, ...]
    features: str = "features"

    def margins(self, values: np.ndarray) -> np.ndarray:
        total = np.full(len(values), self.settings.start)
        for tree in self.trees:
            total += np.array(tree.value)[tree.leaves(values, coded=False)]
        return total

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction`` and, for classes, ``probability`` of both."""
        ship_code(df.sparkSession)
        width = 1 + max((max(t.entry) for t in self.trees), default=0)

        @F.arrow_udf("double")
        def margin(x: pa.Array) -> pa.Array:
            sizes = x.value_lengths().to_numpy(zero_copy_only=False)
            flat = x.flatten().to_numpy(zero_copy_only=False)
            if len(sizes) and (sizes != sizes[0]).any() or len(sizes) and sizes[0] < width:
                raise ValueError("features are narrower than those of the fit, or not all as wide")
            return pa.array(self.margins(flat.reshape(len(sizes), -1)) if len(sizes) else np.empty(0))

        found = margin(as_array_column(df, self.features))
        if self.settings.objective == SQUARES:
            return df.withColumn("prediction", found)
        scored = df.withColumn("__margin", found)
        chance = 1 / (1 + F.exp(-F.col("__margin")))
        return scored.withColumns(
            {
                "probability": array_to_vector(F.array(1 - chance, chance)),
                "prediction": (F.col("__margin") > 0).cast("double"),
            }
        ).drop("__margin")

    def save(self, path: str, spark: SparkSession) -> None:
        """Write everything as one line of JSON; numbers come back as they were."""
        facts = {"settings": asdict(self.settings), "trees": [asdict(t) for t in self.trees], "features": self.features}
        spark.createDataFrame([(json.dumps(facts),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        facts = json.loads(spark.read.text(path).collect()[0]["value"])
        trees = tuple(Tree(**t) for t in facts["trees"])
        return cls(BoostSettings(**facts["settings"]), trees, facts["features"])


def as_array_column(df: DataFrame, features: str):
    """The features as an array of doubles, whichever of vector and array they are; null is NaN."""
    column = F.col(features)
    if isinstance(df.schema[features].dataType, VectorUDT):
        return vector_to_array(column)
    return F.transform(column, lambda x: F.coalesce(x.cast("double"), F.lit(float("nan"))))


def slopes(margin: np.ndarray, label: np.ndarray, objective: str) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the loss at the margins."""
    if objective == SQUARES:
        return margin - label, np.ones(len(margin))
    chance = 1 / (1 + np.exp(-margin))
    return chance - label, np.maximum(chance * (1 - chance), 1e-16)


def fit_boosted(
    rows: DataFrame,
    features: str,
    label: str,
    settings: BoostSettings | None = None,
    weight: str | None = None,
    local_rows: int = LOCAL_ROWS,
) -> BoostedTrees:
    """Trees that each follow from the gradients and curvatures of the loss at the ones before.

    A leaf's value is -G / (H + ridge) times the rate, a split's gain is what it adds to G * G / (H + ridge).
    NaN, and null in an array, is missing: each split sends missing entries to the side that gains more (the
    high one on ties, so also where none is missing). Between equal gains the first entry and the lowest cut
    win. A split needs a gain above ``least_gain`` and a curvature of at least ``least_weight`` on both sides.
    A label that is null, or not 0 or 1 for classes, is an error, and so is a table without rows.
    A node of at most ``local_rows`` rows is finished in one task; the trees do not depend on it.
    """
    settings = settings or BoostSettings()
    spark = rows.sparkSession
    ship_code(spark)
    given = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    prepared = rows.select(
        as_array_column(rows, features).alias("x"), F.col(label).cast("double").alias("y"), given.alias("w")
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        y = F.col("y")
        odd = y.isNull() | F.isnan(y) | F.col("w").isNull() | ~(F.col("w") >= 0)
        if settings.objective == LOGISTIC:
            odd = odd | ~y.isin(0.0, 1.0)
        found = prepared.agg(
            F.count("*").alias("n"),
            F.count_if(odd).alias("odd"),
            F.min(F.size("x")).alias("low"),
            F.max(F.size("x")).alias("width"),
            F.max(F.abs(y)).alias("top"),
            F.max("w").alias("heaviest"),
        ).first()
        if not found["n"] or found["odd"]:
            raise ValueError(f"{found['odd']} of {found['n']} labels or weights cannot be used")
        if found["low"] != found["width"] or not found["width"]:
            raise ValueError("features must all be of one width, and not empty")
        width = found["width"]
        cuts = weighted_cuts(prepared, "x", width, settings.bins, "w")
        # gradients are below this bound; all sums of their multiples of 1 / scale are exact
        bound = 1.0 if settings.objective == LOGISTIC else 8 * max(found["top"], abs(settings.base), 1.0)
        size = int(np.ceil(np.log2(max(bound * found["heaviest"], 1.0))))
        rows_bits = int(found["n"]).bit_length()
        scale = 2.0 ** (min(EXACT_BITS, 62 - rows_bits) - size)
        # few rows are no work for many tasks
        placed = prepared.coalesce(max(1, found["n"] // LEAST_ROWS))
        state = binned(placed, cuts, settings.start).persist(StorageLevel.MEMORY_AND_DISK)
        state.count()
    finally:
        prepared.unpersist()
    rules = Rules(
        settings.depth, settings.ridge, max(settings.least_gain, 1e-6), settings.least_weight, settings.rate
    )
    objective = settings.objective

    def whole_slopes(one: Block, _: int) -> tuple[np.ndarray, ...]:
        _, label, own, margin, _ = one
        g, h = slopes(margin, label, objective)
        return np.ones(len(label), bool), np.rint(g * own * scale), np.rint(h * own * scale)

    trees: list[Tree] = []
    held = [state]
    try:
        for number in range(settings.rounds):
            trees += grow_trees(held[-1], whole_slopes, 1, cuts, rules, scale, found["n"], local_rows)
            # the first pass over a state has kept it, so the one before can go
            while len(held) > 1:
                held.pop(0).unpersist()
            if number + 1 < settings.rounds:
                held.append(_moved_on(held[-1], trees[-1], (number + 1) % LINEAGE == 0))
    finally:
        for state in held:
            state.unpersist()
    return BoostedTrees(settings, tuple(trees), features)


def binned(
    prepared: DataFrame, cuts: list[np.ndarray], start: float = 0.0, key: str | None = None
) -> DataFrame:
    """The rows (x, y, w) as blocks of bin codes, with labels, weights, margins and keys."""
    width = len(cuts)
    ship_code(prepared.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            codes = np.empty(x.shape, np.uint16)
            for k, edges in enumerate(cuts):
                codes[:, k] = np.where(np.isnan(x[:, k]), 0, 1 + np.searchsorted(edges, x[:, k], side="right"))
            label, weight = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("y", "w"))
            keys = batch.column("key").to_numpy().astype(np.uint64) if key else np.empty(0, np.uint64)
            yield block(codes, label, weight, np.full(len(x), start), keys)

    columns = ["x", "y", "w"] + ([F.xxhash64(key).alias("key")] if key else [])
    return prepared.select(*columns).mapInArrow(run, STATE)


def _moved_on(state: DataFrame, tree: Tree, write: bool) -> DataFrame:
    """The state with the tree's values added to the margins, computed and kept by the next pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = np.array(tree.value)
        for batch in batches:
            for codes, label, weight, margin, key in blocks(batch):
                yield block(codes, label, weight, margin + values[tree.leaves(codes, coded=True)], key)

    found = state.mapInArrow(run, STATE)
    found = checkpointed(found) if write else found
    return found.persist(StorageLevel.MEMORY_AND_DISK)
