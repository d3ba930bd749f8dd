"""Hard negatives: neighbours of other labels that score in a band below an anchor's positives.

Every vector is stored with the mean and deviation of its segments, at several levels of fineness.
For two vectors the inner product of a segment lies within length * mean * mean of both, plus or
minus the product of their deviations; summed over the segments that bounds the score. Pairs that
cannot be wanted by the bounds of one level never reach the next, and only the rest is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featloom.llm.common import Batches, as_array, ship, to_arrow
from featloom.operators.ranking import running_totals
from featloom.session import checkpointed

SCALE = 256
"""A component x counts as floor(SCALE * x)."""
EVERY = 100
"""Rows whose vec_id this divides are anchors."""
SHIFTED = 7
CLASSES = 10
"""Where SHIFTED divides vec_id, label first becomes (label + 1) % CLASSES."""
POSITIVES = 5
NEGATIVES = 10
LOWEST, HIGHEST = 30, 90
"""The band of a negative's score, in percent of the positive's."""
LEVELS = (1, 4, 16)
"""Segments a vector is cut into, level by level."""
BLOCK = 16384
"""So many anchors, with their summaries and best rows, are on an executor at a time."""
TILE = (512, 2048)
"""Anchors and rows that are compared at once in a task."""
DENSE = 0.2
"""A tile stays whole for the next level while more than this share of its pairs is left."""
LARGEST = float(1 << 46)
NONE = np.iinfo(np.int64).min


def whole_components(vector: str | Column, scale: int = SCALE) -> Column:
    """floor(scale * x) for every component, taken as double."""
    values = F.col(vector) if isinstance(vector, str) else vector
    return F.transform(values, lambda c: F.floor(c.cast("double") * scale))


def taking_part(
    rows: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label"
) -> DataFrame:
    """vec_id, label, x and row (a number of its own) of the rows that take part, written once."""
    values = F.col(vector)
    fine = F.forall(values, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False)))
    whole = whole_components(vector)
    # a row that fits a long with itself does so with every other one
    length = F.aggregate(whole, F.lit(0.0), lambda s, c: s + c.cast("double") * c)
    name = F.col(vec_id).cast("long")
    shifted = F.when(name % SHIFTED == 0, (F.col(label).cast("int") + 1) % CLASSES)
    chosen = rows.where(name.isNotNull() & F.col(label).isNotNull() & values.isNotNull() & fine)
    found = chosen.where(length < float(1 << 63)).select(
        name.alias("vec_id"),
        F.coalesce(shifted, F.col(label).cast("int")).alias("label"),
        whole.alias("x"),
        F.monotonically_increasing_id().alias("row"),
    )
    return checkpointed(found)


def cuts(width: int, parts: int) -> np.ndarray:
    """Where the segments of a vector begin, as even as they can be; none is empty."""
    parts = max(1, min(parts, width))
    return np.arange(parts) * width // parts


def summary(x: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation (root of the sum of squares around the mean) of every segment of every row."""
    width = x.shape[1]
    starts = cuts(width, parts)
    lengths = np.diff(np.append(starts, width))
    values = x.astype(float)
    mean = np.add.reduceat(values, starts, axis=1) / lengths
    rest = values - np.repeat(mean, lengths, axis=1)
    return mean, np.sqrt(np.add.reduceat(rest * rest, starts, axis=1))


def stored(rows: DataFrame, levels: tuple[int, ...] = LEVELS) -> tuple[DataFrame, int]:
    """``rows`` with ``summary``, the means and deviations of all levels; and the width.

    Vectors shorter than the longest count as zero beyond their end.
    """
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    missing = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x"))
    filled = rows.withColumn("x", F.when(F.size("x") < width, F.concat("x", missing)).otherwise(F.col("x")))
    spark = rows.sparkSession
    ship(spark)
    schema = "vec_id long, label int, row long, x array<long>, summary array<double>"
    arrow = to_arrow(spark, schema)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            x = _matrix(batch, "x", width)
            parts = [half for n in levels for half in summary(x, n)] if width else []
            flat = np.hstack(parts).ravel() if parts else np.zeros(0)
            size = len(flat) // max(len(x), 1)
            offsets = pa.array(np.arange(len(x) + 1) * size, pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(flat))
            columns = [batch.column(n) for n in ("vec_id", "label", "row", "x")] + [lists]
            yield pa.RecordBatch.from_arrays(
                [as_array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
            )

    return checkpointed(filled.select("vec_id", "label", "row", "x").mapInArrow(run, schema)), width


def _flat(batch: pa.RecordBatch | pa.Table, name: str) -> np.ndarray:
    """The numbers of a column of lists, one after the other."""
    column = batch.column(name)
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False)


def _matrix(batch: pa.RecordBatch | pa.Table, name: str, width: int) -> np.ndarray:
    return _flat(batch, name).reshape(batch.num_rows, width)


@dataclass
class Vectors:
    """Vectors with what bounds their scores: per level root(length) * mean beside the deviations."""

    vec_id: np.ndarray
    row: np.ndarray
    label: np.ndarray
    x: np.ndarray
    bounds: list[tuple[np.ndarray, np.ndarray]]
    largest: int
    norm: float

    @classmethod
    def of(cls, batch: pa.RecordBatch | pa.Table, width: int, levels: tuple[int, ...]) -> Vectors:
        x = _matrix(batch, "x", width) if width else np.zeros((batch.num_rows, 0), np.int64)
        flat = _flat(batch, "summary")
        held = flat.reshape(batch.num_rows, -1) if len(flat) else np.zeros((batch.num_rows, 0))
        bounds, at = [], 0
        for parts in levels if width else ():
            starts = cuts(width, parts)
            root = np.sqrt(np.diff(np.append(starts, width)))
            n = len(starts)
            bounds.append((held[:, at : at + n] * root, held[:, at + n : at + 2 * n]))
            at += 2 * n
        names = [batch.column(n).to_numpy() for n in ("vec_id", "row", "label")]
        largest = int(np.abs(x).max(initial=0))
        return cls(*names, x, bounds, largest, largest * float(np.sqrt(max(width, 1))))

    def some(self, which: slice | np.ndarray) -> Vectors:
        bounds = [(m[which], d[which]) for m, d in self.bounds]
        return Vectors(
            self.vec_id[which], self.row[which], self.label[which], self.x[which], bounds, self.largest, self.norm
        )


def wanted_pairs(
    anchors: Vectors, rows: Vectors, same: bool, low: np.ndarray, high: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Places of anchors and rows whose score lies from ``low`` to ``high`` of the anchor, and the score.

    Only pairs of the same label, or of different ones, and never a row with itself. The last value
    says how many pairs were left after the labels and after each level.
    """
    keep = (anchors.label[:, None] == rows.label[None, :]) == same
    if same:
        keep &= anchors.row[:, None] != rows.row[None, :]
    left = [int(keep.sum())]
    # rounding of the bounds; scores are whole numbers, so half of one is no risk
    slack = 0.5 + 1e-12 * anchors.norm * rows.norm
    floor, ceiling = low - slack, high + slack
    at = None
    for (am, ad), (rm, rd) in zip(anchors.bounds, rows.bounds, strict=True):
        if at is None and keep.mean() <= DENSE:
            at = np.nonzero(keep)
        if at is None:
            middle, reach = am @ rm.T, ad @ rd.T
            keep &= (middle + reach >= floor[:, None]) & (middle - reach <= ceiling[:, None])
            left.append(int(keep.sum()))
        else:
            a, r = at
            middle = np.einsum("ij,ij->i", am[a], rm[r])
            reach = np.einsum("ij,ij->i", ad[a], rd[r])
            fits = (middle + reach >= floor[a]) & (middle - reach <= ceiling[a])
            at = a[fits], r[fits]
            left.append(len(at[0]))
    if at is None and keep.mean() > DENSE:
        exact = anchors.x.shape[1] * anchors.largest * rows.largest < 1 << 53
        kind = np.float64 if exact else np.int64
        scores = (anchors.x.astype(kind) @ rows.x.astype(kind).T).astype(np.int64)
        keep &= (scores >= low[:, None]) & (scores <= high[:, None])
        a, r = np.nonzero(keep)
        return a, r, scores[a, r], left
    a, r = np.nonzero(keep) if at is None else at
    scores = np.einsum("ij,ij->i", anchors.x[a], rows.x[r])
    fits = (scores >= low[a]) & (scores <= high[a])
    return a[fits], r[fits], scores[fits], left


@dataclass
class Best:
    """The best rows of every slot so far; a slot is an anchor and one of its bands.

    ``low`` and ``high`` are anchors by bands, ``high`` below ``low`` for a band that is not there.
    ``least`` is a score that a slot's worst row is known to reach.
    """

    low: np.ndarray
    high: np.ndarray
    count: int
    least: np.ndarray

    def __post_init__(self) -> None:
        slots = self.low.size
        self.score = np.full((slots, self.count), NONE, np.int64)
        self.vec_id = np.zeros((slots, self.count), np.int64)

    def limits(self, which: slice) -> tuple[np.ndarray, np.ndarray]:
        """The lowest and highest score that any band of the anchors still takes."""
        bands = self.low.shape[1]
        worst = np.maximum(self.score[:, -1].reshape(-1, bands), self.least)[which]
        low = np.maximum(self.low[which], worst)
        none = self.high[which] < low
        low = np.where(none, np.iinfo(np.int64).max, low).min(1)
        return low, np.where(none, NONE, self.high[which]).max(1)

    def add(self, anchor: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        """Rows of anchors; each goes to all bands that take it. Ties go to the smaller id."""
        bands = self.low.shape[1]
        least = np.maximum(self.least, self.low)[anchor]
        worst = self.score[:, -1].reshape(-1, bands)[anchor]
        fits = (score[:, None] >= np.maximum(least, worst)) & (score[:, None] <= self.high[anchor])
        pair, band = np.nonzero(fits)
        if not len(pair):
            return
        slot = anchor[pair] * bands + band
        touched = np.unique(slot)
        slots = np.concatenate([np.repeat(touched, self.count), slot])
        scores = np.concatenate([self.score[touched].ravel(), score[pair]])
        ids = np.concatenate([self.vec_id[touched].ravel(), vec_id[pair]])
        order = np.lexsort((ids, -scores.astype(float), slots))
        # floats order whole numbers of up to 53 bits; beyond that by the numbers themselves
        if np.abs(score).max() >= 1 << 53:
            order = np.array(sorted(range(len(slots)), key=lambda k: (slots[k], -int(scores[k]), ids[k])))
        slots, scores, ids = slots[order], scores[order], ids[order]
        starts = np.searchsorted(slots, touched)
        rank = np.arange(len(slots)) - np.repeat(starts, np.diff(np.append(starts, len(slots))))
        first = rank < self.count
        self.score[slots[first], rank[first]] = scores[first]
        self.vec_id[slots[first], rank[first]] = ids[first]


def best_rows(
    rows: DataFrame, anchors: pa.Table, width: int, best: Best, same: bool, levels: tuple[int, ...] = LEVELS
) -> DataFrame:
    """anchor (row), anchor_id, band, vec_id, score: the best rows of every slot, ranked over all tasks.

    One pass over ``rows``; the anchors of the block are broadcast, at most BLOCK of them. A task
    returns the best it met of each slot, and Spark takes the best of those, task by task before
    the shuffle.
    """
    spark = rows.sparkSession
    ship(spark)
    schema = "anchor long, anchor_id long, band int, vec_id long, score long"
    arrow = to_arrow(spark, schema)
    shared = spark.sparkContext.broadcast((anchors, best.low, best.high, best.count, best.least))

    def run(batches: Batches) -> Batches:
        block, *settings = shared.value
        found = Best(*settings)
        own = Vectors.of(block, width, levels)
        for batch in batches:
            seen = Vectors.of(batch, width, levels)
            for r in range(0, batch.num_rows, TILE[1]):
                part = seen.some(slice(r, r + TILE[1]))
                for a in range(0, len(own.row), TILE[0]):
                    which = slice(a, a + TILE[0])
                    low, high = found.limits(which)
                    at, place, score, _ = wanted_pairs(own.some(which), part, same, low, high)
                    found.add(at + a, score, part.vec_id[place])
        slot, rank = np.nonzero(found.score != NONE)
        anchor, band = np.divmod(slot, found.low.shape[1])
        columns = [own.row[anchor], own.vec_id[anchor], band, found.vec_id[slot, rank], found.score[slot, rank]]
        yield pa.RecordBatch.from_arrays(
            [as_array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
        )

    parts = rows.select("vec_id", "label", "row", "x", "summary").mapInArrow(run, schema)
    order = Window.partitionBy("anchor", "band").orderBy(F.desc("score"), "vec_id")
    return parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best.count)


def known_least(found: DataFrame, anchors: pa.Table, bands: int, count: int) -> np.ndarray:
    """The worst score of the slots that are full already: all rows can only do better."""
    full = found.where(F.col("rank") == count).select("anchor", "band", "score").toArrow()
    place = {row: k for k, row in enumerate(anchors.column("row").to_pylist())}
    least = np.full((anchors.num_rows, bands), NONE, np.int64)
    at = [place[row] for row in full.column("anchor").to_pylist()]
    least[at, full.column("band").to_numpy()] = full.column("score").to_numpy()
    return least


def anchor_blocks(anchors: DataFrame, block: int = BLOCK) -> Iterator[pa.Table]:
    """The anchors, at most ``block`` at a time; they are numbered over ranges for it."""
    numbers = running_totals(anchors.select("row"), order="row", totals={"place": F.lit(1)})
    numbers = numbers.withColumn("block", ((F.col("place") - 1) / block).cast("long"))
    placed = checkpointed(anchors.join(numbers.select("row", "block"), "row"))
    last = placed.agg(F.max("block")).first()[0]
    for number in range(0 if last is None else last + 1):
        yield placed.where(F.col("block") == number).orderBy("row").drop("block").toArrow()


def mined(
    rows: DataFrame,
    vector: str = "embedding",
    vec_id: str = "vec_id",
    label: str = "label",
    levels: tuple[int, ...] = LEVELS,
    block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null id, label or vector, a component that is null or not finite (or of 2^46 and more), or
    whose product with themselves does not fit a long take no part. An empty vector scores 0 with all,
    and a shorter one counts as zero beyond its end. Repeated rows are rows of their own, as anchors,
    positives and negatives; ties go to the smaller id. An anchor without positives, and a positive
    without negatives in its band, gives no row; so does an empty table. Further columns are not read.

    The anchors are a stated share of the rows and meet all of them block by block: two passes over
    the stored vectors for each block, one for positives and one for negatives. Before each pass the
    block's anchors meet all anchors, which tells scores that the best rows reach at least; that is
    what the bounds prune by from the first tile on.
    """
    spark = rows.sparkSession
    whole, width = stored(taking_part(rows, vector, vec_id, label), levels)
    anchors = checkpointed(whole.where(F.col("vec_id") % EVERY == 0))
    results = []
    for own in anchor_blocks(anchors, block):
        n = own.num_rows
        unknown = np.full((n, 1), NONE, np.int64)
        top = np.full((n, 1), np.iinfo(np.int64).max, np.int64)
        sought = Best(unknown, top, POSITIVES, unknown)
        first = best_rows(anchors, own, width, sought, True, levels)
        sought = Best(unknown, top, POSITIVES, known_least(first, own, 1, POSITIVES))
        positives = checkpointed(best_rows(whole, own, width, sought, True, levels).drop("band"))

        # the bands of the block's anchors: at most POSITIVES numbers for each of BLOCK anchors
        bands = positives.select("anchor", "rank", "score").toArrow()
        place = {row: k for k, row in enumerate(own.column("row").to_pylist())}
        at = np.array([place[row] for row in bands.column("anchor").to_pylist()], int)
        rank, score = bands.column("rank").to_numpy() - 1, bands.column("score").to_numpy()
        low, high = np.ones((n, POSITIVES), np.int64), np.zeros((n, POSITIVES), np.int64)
        low[at, rank] = [-(-LOWEST * s // 100) for s in score.tolist()]
        high[at, rank] = [HIGHEST * s // 100 for s in score.tolist()]
        unknown = np.full((n, POSITIVES), NONE, np.int64)
        first = best_rows(anchors, own, width, Best(low, high, NEGATIVES, unknown), False, levels)
        sought = Best(low, high, NEGATIVES, known_least(first, own, POSITIVES, NEGATIVES))
        negatives = best_rows(whole, own, width, sought, False, levels)
        paired = negatives.withColumn("place", F.col("band") + 1).drop("anchor_id").join(
            positives.select(
                "anchor",
                "anchor_id",
                F.col("rank").alias("place"),
                F.col("vec_id").alias("positive_id"),
                F.col("score").alias("positive_score"),
            ),
            ["anchor", "place"],
        )
        results.append(
            checkpointed(
                paired.select(
                    "anchor_id",
                    "positive_id",
                    "rank",
                    F.col("vec_id").alias("negative_id"),
                    "positive_score",
                    F.col("score").alias("negative_score"),
                )
            )
        )
    if not results:
        schema = (
            "anchor_id long, positive_id long, rank int, negative_id long, "
            "positive_score long, negative_score long"
        )
        return spark.createDataFrame([], schema)
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    return found
