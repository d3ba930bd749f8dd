"""Whitening of vectors: blockwise QR on the executors, a bidiagonal qd solver for the small rest."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.llm.bidiagonal import EPS, right_singular
from featloom.llm.common import Batches, as_array, map_batches, ship, to_arrow
from featloom.session import checkpointed

SCALE = 64
SHIFT = 1_000_000
"""An entry c counts as floor(SCALE * c) + SHIFT."""
COMPONENTS = 32
FAN = 16
"""So many triangles meet in one task of the reduction."""
LARGEST = float(1 << 46)
"""Entries of this size and more have no place in the whole numbers; such rows count as not finite."""
HALF = 26


def whole_entries(vector: str | Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """floor(scale * c) + shift for every entry, taken as double."""
    values = F.col(vector) if isinstance(vector, str) else vector
    return F.transform(values, lambda c: F.floor(c.cast("double") * scale) + shift)


def usable(vector: str | Column) -> Column:
    """Whether a vector is there, not empty, and all its entries are finite numbers."""
    values = F.col(vector) if isinstance(vector, str) else vector
    fine = F.forall(values, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False)))
    return F.coalesce((F.size(values) > 0) & fine, F.lit(False))


def prepared(rows: DataFrame, vector: str = "embedding", vec_id: str = "vec_id") -> tuple[DataFrame, int]:
    """vec_id and x, the whole entries of the usable vectors, written once; and their width.

    Vectors of another width than most have (the largest such width on a tie) are not usable either.
    """
    found = rows.where(usable(vector)).select(
        F.col(vec_id).cast("long").alias("vec_id"), whole_entries(vector).alias("x")
    )
    found = checkpointed(found)
    widths = found.groupBy(F.size("x").alias("width")).count()
    most = widths.orderBy(F.desc("count"), F.desc("width")).first()
    width = most["width"] if most else 0
    return found.where(F.size("x") == width), width


def matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The vectors of a batch as rows of whole numbers."""
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def fold(
    df: DataFrame, step: Callable[[object, pa.RecordBatch], object], out: Callable[[object], dict], schema: str
) -> DataFrame:
    """One pass that carries ``step`` over the batches of a task and gives ``out`` of the end."""
    spark = df.sparkSession
    ship(spark)
    arrow = to_arrow(spark, schema)

    def run(batches: Batches) -> Batches:
        held = None
        for batch in batches:
            if batch.num_rows:
                held = step(held, batch)
        if held is not None:
            columns = out(held)
            yield pa.RecordBatch.from_arrays([as_array(columns[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def exact_sums(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of every entry; both halves of the numbers are added apart."""

    def step(held: np.ndarray | None, batch: pa.RecordBatch) -> np.ndarray:
        x = matrix(batch, width)
        sums = np.stack([(x >> HALF).sum(0), (x & ((1 << HALF) - 1)).sum(0), np.full(width, len(x))])
        return sums if held is None else held + sums

    def out(held: np.ndarray) -> dict:
        return {"at": np.arange(width), "high": held[0], "low": held[1], "n": held[2]}

    parts = fold(rows.select("x"), step, out, "at int, high long, low long, n long")
    wide = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("high", "low", "n")]
    found = {r["at"]: r for r in parts.groupBy("at").agg(*wide).collect()}
    if not found:
        return 0, [0] * width
    sums = [(int(found[k]["high"]) << HALF) + int(found[k]["low"]) for k in range(width)]
    return int(found[0]["n"]), sums


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S exactly: as 64-bit numbers where they fit, else as numbers without limit."""
    top = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums), default=0))
    if top < 1 << 62:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def square_sums(gaps: np.ndarray) -> list[int | None]:
    """The exact sum of squares of every row, null where a long does not hold it."""
    top = int(np.abs(gaps).max(initial=0))
    if gaps.shape[1] * top * top < 1 << 63:
        return (gaps.astype(np.int64) ** 2).sum(1).tolist()
    sums = (gaps.astype(object) ** 2).sum(1)
    return [int(v) if v < 1 << 63 else None for v in sums]


def triangle(rows: DataFrame, width: int, n: int, sums: list[int]) -> np.ndarray:
    """R of a QR factorisation of the centred rows, width by width.

    Every task keeps one triangle and factorises it together with the next batch. The triangles of
    all tasks meet sixteen at a time, in as many rounds as that takes, so no task or driver holds
    more than a few of them.
    """

    def step(held: np.ndarray | None, batch: pa.RecordBatch) -> np.ndarray:
        centred = deviations(matrix(batch, width), n, sums).astype(float) / n
        return np.linalg.qr(centred if held is None else np.vstack([held, centred]), mode="r")

    def out(held: np.ndarray) -> dict:
        return {"r": [held.ravel()]}

    def meet(batches: Batches) -> Batches:
        held = None
        for batch in batches:
            for one in batch.column("r"):
                block = np.array(one.as_py()).reshape(-1, width)
                held = block if held is None else np.linalg.qr(np.vstack([held, block]), mode="r")
        yield pa.RecordBatch.from_arrays([pa.array([held.ravel()], pa.list_(pa.float64()))], names=["r"])

    parts = fold(rows.select("x"), step, out, "r array<double>")
    parts = checkpointed(parts.withColumn("part", F.monotonically_increasing_id()))
    count = parts.count()
    while count > 1:
        # parts are numbered task by task; a hash deals them into groups of sixteen on average
        groups = -(-count // FAN)
        place = F.pmod(F.xxhash64("part"), F.lit(groups)).alias("place")
        met = parts.groupBy(place).applyInArrow(lambda t: _met(t, meet), "r array<double>")
        parts = checkpointed(met.withColumn("part", F.monotonically_increasing_id()))
        count = parts.count()
    found = parts.first()
    out_r = np.zeros((width, width))
    if found is not None:
        r = np.array(found["r"]).reshape(-1, width)
        out_r[: len(r)] = r
    return out_r


def _met(rows: pa.Table, meet: Callable[[Batches], Batches]) -> pa.Table:
    return pa.Table.from_batches(list(meet(iter(rows.to_batches()))))


@dataclass(frozen=True)
class Whitening:
    """What was learned: n and the exact sums, eigenvalues e and directions (columns) of the covariance."""

    n: int
    sums: list[int]
    e: np.ndarray
    directions: np.ndarray
    trace: float

    def whiten(self, gaps: np.ndarray) -> np.ndarray:
        """The rows of n * x - S on the components, over their standard deviations."""
        return gaps.astype(float) / self.n @ (self.directions / np.sqrt(self.e))


def fit_whitening(rows: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    """The first ``components`` eigenvectors of the covariance of ``rows`` (x).

    Singular values of R are those of the centred rows, so no product of rows is ever formed and
    small ones keep their digits. Components without variance, to double precision, are left out.
    """
    n, sums = exact_sums(rows, width)
    if not n:
        return Whitening(0, sums, np.zeros(0), np.zeros((width, 0)), 0.0)
    r = triangle(rows, width, n, sums)
    squares, vectors = right_singular(r)
    trace = float((r * r).sum()) / n
    noise = (EPS * width) ** 2 * squares[:1].sum()
    used = min(components, int((squares > noise).sum()))
    return Whitening(n, sums, squares[:used] / n, vectors[:, :used], trace)


def identity_error(rows: DataFrame, width: int, fit: Whitening) -> float | None:
    """The largest absolute entry of the whitened rows' covariance less the identity."""
    used = len(fit.e)
    if not used:
        return None
    upper = np.triu_indices(used)

    def step(held: np.ndarray | None, batch: pa.RecordBatch) -> np.ndarray:
        w = fit.whiten(deviations(matrix(batch, width), fit.n, fit.sums))
        both = np.concatenate([w.sum(0), (w.T @ w)[upper]])
        return both if held is None else held + both

    def out(held: np.ndarray) -> dict:
        return {"at": np.arange(len(held)), "total": held}

    parts = fold(rows.select("x"), step, out, "at int, total double")
    found = {r["at"]: r["total"] for r in parts.groupBy("at").agg(F.sum("total").alias("total")).collect()}
    total = np.array([found[k] for k in range(len(found))]) / fit.n
    mean, products = total[:used], total[used:]
    covariance = products - mean[upper[0]] * mean[upper[1]]
    return float(np.abs(covariance - (upper[0] == upper[1])).max())


def whitened(
    rows: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", components: int = COMPONENTS
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every usable row.

    Rows whose vector is null, empty, of another width than most, or holds a null, an entry that is
    not finite or one of 2^46 and more are left out. Repeated rows all count and all come back; a null
    vec_id stays null. ``deviation`` is exact, and null where a long cannot hold it. If all vectors
    are equal there is no component and so no row; an empty table gives an empty one. Further columns
    are not read. What is sent to the tasks is a few width by width matrices.
    """
    whole, width = prepared(rows, vector, vec_id)
    fit = fit_whitening(whole, width, components)
    error = identity_error(whole, width, fit)
    used = len(fit.e)

    def make(batch: pa.RecordBatch) -> dict | None:
        if not used:
            return None
        gaps = deviations(matrix(batch, width), fit.n, fit.sums)
        number = np.repeat(np.arange(batch.num_rows), used)
        return {
            "vec_id": batch.column("vec_id").take(pa.array(number)),
            "component": np.tile(np.arange(1, used + 1), batch.num_rows),
            "n": np.full(len(number), fit.n),
            "deviation": pa.array(square_sums(gaps), pa.int64()).take(pa.array(number)),
            "whitened": fit.whiten(gaps).ravel(),
            "explained": np.tile(fit.e / fit.trace if fit.trace else fit.e, batch.num_rows),
            "identity_error": np.full(len(number), error if error is not None else 0.0),
        }

    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double"
    )
    return map_batches(whole, make, schema)
