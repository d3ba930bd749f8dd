"""Random forests of any depth: trees that grow until their leaves are pure."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featloom.learning.boost import LEAST_ROWS, as_array_column, binned
from featloom.learning.grow import LOCAL_ROWS, Block, Rules, Tree, grow_trees, mixed
from featloom.learning.sketch import weighted_cuts
from featloom.session import ship_code

BINS = 4096
"""Values of an entry that a split can tell apart; of no more distinct values all are."""
# Poisson numbers of mean 1: a draw below the k-th bound counts at most k
BOUNDS = np.cumsum([np.exp(-1.0) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320)])


def bootstrap(key: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often the rows of these keys are drawn for a tree: Poisson numbers of mean 1, by a hash."""
    with np.errstate(over="ignore"):
        start = mixed(np.uint64(seed) * np.uint64(0x632BE59BD9B4E019) + np.uint64(tree))
    drawn = (mixed(key ^ start) >> np.uint64(11)) / float(1 << 53)
    return np.searchsorted(BOUNDS, drawn, side="right")


@dataclass(frozen=True)
class Forest:
    """Fitted trees on a vector or array column, with the interface of the other tree models.

    The nodes of all trees lie in one array each, so that tasks get the forest as a broadcast of a few arrays.
    """

    entry: np.ndarray
    cut: np.ndarray
    missing_low: np.ndarray
    low: np.ndarray
    high: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    features: str = "features"

    @classmethod
    def of(cls, trees: list[Tree], features: str) -> Forest:
        sizes = [len(t.entry) for t in trees]
        roots = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        columns = [np.concatenate([np.array(getattr(t, n)) for t in trees]) for n in ("entry", "cut", "missing_low")]
        sides = [np.concatenate([np.array(getattr(t, n)) + r for t, r in zip(trees, roots)]) for n in ("low", "high")]
        return cls(*columns, *sides, np.concatenate([np.array(t.value) for t in trees]), roots, features)

    @cached_property
    def getNumTrees(self) -> int:  # noqa: N802, the name that the other forests have
        return len(self.roots)

    def chances(self, values: np.ndarray) -> np.ndarray:
        """The mean over the trees of the share of class 1 in a row's leaf."""
        total = np.zeros(len(values))
        for root in self.roots:
            node = np.full(len(values), root)
            at = np.arange(len(values))
            while len(at):
                at = at[self.entry[node[at]] >= 0]
                of = node[at]
                x = values[at, self.entry[of]]
                below = (x < self.cut[of]) | np.isposinf(self.cut[of])
                node[at] = np.where(np.where(np.isnan(x), self.missing_low[of], below), self.low[of], self.high[of])
            total += self.value[node]
        return total / max(len(self.roots), 1)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction`` (0 on a tie) and ``probability`` of both classes."""
        spark = df.sparkSession
        ship_code(spark)
        shared = spark.sparkContext.broadcast(self)
        width = int(self.entry.max(initial=-1)) + 1

        @F.arrow_udf("double")
        def chance(x: pa.Array) -> pa.Array:
            sizes = x.value_lengths().to_numpy(zero_copy_only=False)
            if not len(sizes):
                return pa.array([], pa.float64())
            if (sizes != sizes[0]).any() or sizes[0] < width:
                raise ValueError("features are narrower than those of the fit, or not all as wide")
            flat = x.flatten().to_numpy(zero_copy_only=False)
            return pa.array(shared.value.chances(flat.reshape(len(sizes), -1)))

        scored = df.withColumn("__chance", chance(as_array_column(df, self.features)))
        return scored.withColumns(
            {
                "probability": array_to_vector(F.array(1 - F.col("__chance"), F.col("__chance"))),
                "prediction": (F.col("__chance") > 0.5).cast("double"),
            }
        ).drop("__chance")

    def save(self, path: str, spark: SparkSession) -> None:
        """Write the nodes as a table in their order, and the roots as JSON beside it."""
        names = ("entry", "cut", "missing_low", "low", "high", "value")
        nodes = pa.table({"at": np.arange(len(self.entry)), **{n: getattr(self, n) for n in names}})
        spark.createDataFrame(nodes).write.mode("overwrite").parquet(f"{path}/nodes")
        facts = {"roots": self.roots.tolist(), "features": self.features}
        text = spark.createDataFrame([(json.dumps(facts),)], "value string")
        text.coalesce(1).write.mode("overwrite").text(f"{path}/facts")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Forest:
        facts = json.loads(spark.read.text(f"{path}/facts").collect()[0]["value"])
        nodes = spark.read.parquet(f"{path}/nodes").toArrow().sort_by("at")
        names = ("entry", "cut", "missing_low", "low", "high", "value")
        columns = [nodes.column(n).to_numpy(zero_copy_only=False) for n in names]
        return cls(*columns, np.array(facts["roots"], np.int64), facts["features"])


def fit_forest(
    rows: DataFrame,
    features: str,
    label: str,
    key: str | None,
    trees: int = 100,
    fraction: float | None = None,
    depth: int | None = None,
    least_rows: int = 1,
    seed: int = 123,
    bins: int = BINS,
    local_rows: int = LOCAL_ROWS,
) -> Forest:
    """A forest for labels 0 and 1 whose trees grow until leaves are pure, if ``depth`` is None.

    Every tree sees each row as often as a hash of ``key`` says (Poisson numbers of mean 1; equal keys are
    drawn together), and looks at ``fraction`` of the entries at each node. Without ``key`` all trees see
    all rows once. Splits are those of the lowest Gini impurity; one that gains nothing is made, too, as
    long as a leaf is not pure and its rows can be told apart. NaN is missing and goes to the side that
    suits it better. Wide nodes grow level by level on all executors, nodes of at most ``local_rows`` rows
    within a task; the forest does not depend on that, nor on the partitioning.

    The model lies on the driver: without ``depth``, a forest of noisy labels has about as many
    leaves as rows, so for very large tables give ``depth`` or ``least_rows`` (rows a leaf has at least).
    """
    if trees < 1 or least_rows < 1 or (fraction is not None and not 0 < fraction <= 1):
        raise ValueError("trees and least_rows are at least 1, fraction is above 0 and at most 1")
    columns = [
        as_array_column(rows, features).alias("x"),
        F.col(label).cast("double").alias("y"),
        F.lit(1.0).alias("w"),
        *([F.col(key).cast("string").alias("key")] if key else []),
    ]
    prepared = rows.select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        odd = ~F.coalesce(F.col("y").isin(0.0, 1.0), F.lit(False))
        found = prepared.agg(
            F.count("*").alias("n"),
            F.count_if(odd).alias("odd"),
            F.avg("y").alias("share"),
            F.min(F.size("x")).alias("low"),
            F.max(F.size("x")).alias("width"),
        ).first()
        if not found["n"] or found["odd"]:
            raise ValueError(f"{found['odd']} of {found['n']} labels cannot be used")
        if found["low"] != found["width"] or not found["width"]:
            raise ValueError("features must all be of one width, and not empty")
        cuts = weighted_cuts(prepared, "x", found["width"], bins)
        placed = prepared.coalesce(max(1, found["n"] // LEAST_ROWS))
        state = binned(placed, cuts, key="key" if key else None).persist(StorageLevel.MEMORY_AND_DISK)
        state.count()
    finally:
        prepared.unpersist()

    def drawn(one: Block, tree: int) -> tuple[np.ndarray, ...]:
        _, labels, _, _, keys = one
        times = bootstrap(keys, tree, seed) if key else np.ones(len(labels), np.int64)
        return times > 0, -labels * times, times.astype(float)

    rules = Rules(
        depth,
        ridge=0.0,
        least_gain=-1e-9,
        least_weight=float(least_rows),
        fraction=fraction,
        seed=seed,
        classes=True,
        empty=float(found["share"]),
    )
    try:
        grown = grow_trees(state, drawn, trees, cuts, rules, 1.0, found["n"], local_rows)
    finally:
        state.unpersist()
    return Forest.of(grown, features)
