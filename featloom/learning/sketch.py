"""Weighted quantiles of many columns by summaries that tasks build and Spark merges."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.session import checkpointed, ship_code

ROOM = 8
"""A summary holds this many times the bins asked for."""
FAN = 16
SUMMARY = "feature int, value array<double>, least array<double>, most array<double>, weight array<double>"


@dataclass(frozen=True)
class Summary:
    """Values in order with bounds of their rank: the weight surely below, and surely not above.

    ``weight`` is what a value itself weighs at least. While no value has been left out the bounds are
    exact.
    """

    value: np.ndarray
    least: np.ndarray
    most: np.ndarray
    weight: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray, weights: np.ndarray) -> Summary:
        """All distinct values; NaN does not count."""
        known = ~np.isnan(values)
        found, place = np.unique(values[known], return_inverse=True)
        weight = np.bincount(place, weights[known], len(found))
        ends = np.cumsum(weight)
        return cls(found, ends - weight, ends, weight)

    @property
    def total(self) -> float:
        return float(self.most[-1]) if len(self.most) else 0.0

    def _ranks(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bounds and weight that this summary gives to ``values``, its own or others."""
        if not len(self.value):
            return (np.zeros(len(values)),) * 3
        at = np.searchsorted(self.value, values)
        here = np.minimum(at, len(self.value) - 1)
        before = np.maximum(at - 1, 0)
        own = self.value[here] == values
        below = np.where(at > 0, self.least[before] + self.weight[before], 0.0)
        above = np.where(at < len(self.value), self.most[here] - self.weight[here], self.total)
        return (
            np.where(own, self.least[here], below),
            np.where(own, self.most[here], above),
            np.where(own, self.weight[here], 0.0),
        )

    def merged(self, other: Summary) -> Summary:
        """The summary of both; bounds of a value that only one has come from its neighbours."""
        values = np.union1d(self.value, other.value)
        both = zip(self._ranks(values), other._ranks(values))
        return Summary(values, *(a + b for a, b in both))

    def pruned(self, size: int) -> Summary:
        """At most ``size`` values, evenly spaced by rank, the first and the last among them."""
        if len(self.value) <= size:
            return self
        keep = self._nearest(np.linspace(0, self.total, size))
        keep = np.unique(np.concatenate([[0], keep, [len(self.value) - 1]]))[:size]
        keep[-1] = len(self.value) - 1
        return Summary(self.value[keep], self.least[keep], self.most[keep], self.weight[keep])

    def _nearest(self, ranks: np.ndarray) -> np.ndarray:
        """The values whose rank is nearest to ``ranks``."""
        middle = (self.least + self.most) / 2
        at = np.clip(np.searchsorted(middle, ranks), 1, len(middle) - 1)
        return at - (ranks - middle[at - 1] <= middle[at] - ranks)

    def cuts(self, bins: int) -> np.ndarray:
        """Where bins begin, without the first: every value but the smallest if there are few enough."""
        if len(self.value) <= bins:
            return self.value[1:]
        chosen = np.unique(self._nearest(np.linspace(0, self.total, bins + 1)[1:-1]))
        return self.value[chosen[chosen > 0]]


def weighted_cuts(
    rows: DataFrame, features: str, width: int, bins: int = 256, weight: str | None = None
) -> list[np.ndarray]:
    """For each entry of the array column ``features`` where its bins begin, by weighted quantiles.

    NaN is missing and has no bin. An entry of at most ``bins`` distinct values has a bin for each. Every
    task keeps a summary per entry, ROOM times ``bins`` values long; summaries of an entry meet sixteen at
    a time, so no task and no driver holds more, however many rows there are. Each round adds at most one
    part in ROOM * bins of the weight to the error of a rank.
    """
    ship_code(rows.sparkSession)
    size = ROOM * bins

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Summary.of(np.empty(0), np.empty(0)) for _ in range(width)]
        for batch in batches:
            values = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            weights = batch.column("w").to_numpy(zero_copy_only=False)
            for k in range(width):
                held[k] = held[k].merged(Summary.of(values[:, k], weights))
                if len(held[k].value) > 2 * size:
                    held[k] = held[k].pruned(size)
        yield _rows([(k, one.pruned(size)) for k, one in enumerate(held) if len(one.value)])

    def meet(parts: pa.Table) -> pa.Table:
        found: Summary | None = None
        for part in parts.select(["value", "least", "most", "weight"]).to_pylist():
            one = Summary(*(np.array(part[n], float) for n in ("value", "least", "most", "weight")))
            found = one if found is None else found.merged(one)
        return pa.Table.from_batches([_rows([(parts.column("feature")[0].as_py(), found.pruned(size))])])

    given = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    parts = rows.select(F.col(features).alias("x"), given.alias("w")).mapInArrow(run, SUMMARY)
    while True:
        parts = checkpointed(parts.withColumn("part", F.monotonically_increasing_id()))
        most = parts.groupBy("feature").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            break
        place = F.pmod(F.xxhash64("part"), F.lit(-(-most // FAN))).alias("place")
        parts = parts.groupBy("feature", place).applyInArrow(meet, SUMMARY)
    found = [np.empty(0)] * width
    for row in parts.drop("part").collect():
        one = Summary(*(np.array(row[n]) for n in ("value", "least", "most", "weight")))
        found[row["feature"]] = one.cuts(bins)
    return found


def _rows(found: list[tuple[int, Summary]]) -> pa.RecordBatch:
    lists = pa.list_(pa.float64())
    columns = [pa.array([k for k, _ in found], pa.int32())]
    columns += [pa.array([getattr(s, n) for _, s in found], lists) for n in ("value", "least", "most", "weight")]
    return pa.RecordBatch.from_arrays(columns, names=["feature", "value", "least", "most", "weight"])
