"""Preprocessing: fill, encode, impute and assemble columns into one vector."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featloom.operators.profile import column_modes, distinct_levels, numbered_levels
from featloom.session import checkpointed, kept

FEATURES = "features"
BROADCAST_BYTES = 32 << 20
"""Levels of up to so many bytes go to the executors whole; columns beyond that meet theirs by a shuffle."""
FEW_LEVELS = 1 << 16
"""Up to so many levels are numbered without ranges."""
LEVEL_BYTES = 40
"""What a level takes beside its text."""


@dataclass(frozen=True)
class FeatureSpec:
    """Column groups of a model.

    NULL in a categorical column becomes ``missing_level``; a value of that name is the same level,
    and an empty string is a level of its own. Flags are never NULL in a feature table; for an id
    without features they count as 0.
    """

    categorical: tuple[str, ...]
    numeric: tuple[str, ...] = ()
    binary: tuple[str, ...] = ()
    missing_level: str = "missing"

    @property
    def columns(self) -> list[str]:
        return [*self.categorical, *self.numeric, *self.binary]


@dataclass(frozen=True)
class Preprocessor:
    """What was learned on the training rows.

    ``levels`` is a table ``(column, level, position)`` of any size that stays on the executors; the
    driver knows the number of levels of each column and the modes.
    """

    spec: FeatureSpec
    levels: DataFrame | None = None
    sizes: Mapping[str, int] = field(default_factory=dict)
    modes: Mapping[str, float] = field(default_factory=dict)
    bytes: Mapping[str, int] = field(default_factory=dict)

    def transform(self, df: DataFrame, one_hot: bool = True, fill: bool = True) -> DataFrame:
        """``df`` with ``features``.

        With ``one_hot`` every level has a slot, and an unseen level sets none. Otherwise a column
        has one slot with the position of its level, and -1 for an unseen one: a few numbers a row,
        however many levels there are. Without ``fill`` a number that is not there stays NaN instead of
        the mode, and so does the position of an unseen level, for models that take missing values.
        """
        spec = self.spec
        found = self._placed(df)
        absent = -1 if fill else float("nan")
        unseen = {c: self.sizes[c] if one_hot else absent for c in spec.categorical}
        found = found.withColumns(
            {
                **{f"__at_{c}": F.coalesce(F.col(f"__at_{c}").cast("double"), F.lit(float(n))) for c, n in unseen.items()},
                **{f"__number_{c}": _imputed(c, self.modes[c] if fill else float("nan")) for c in spec.numeric},
                **{f"__number_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in spec.binary},
            }
        )
        parts = [f"__at_{c}" for c in spec.categorical]
        if one_hot and parts:
            slots = [f"__slots_{c}" for c in spec.categorical]
            # The last slot is the one of unseen levels, and it is dropped.
            encoder = OneHotEncoder(inputCols=parts, outputCols=slots, handleInvalid="keep")
            last = tuple(float(self.sizes[c] - 1) for c in spec.categorical)
            schema = ", ".join(f"`{p}` double" for p in parts)
            found = encoder.fit(df.sparkSession.createDataFrame([last], schema)).transform(found)
            parts = slots
        parts = [*parts, *[f"__number_{c}" for c in (*spec.numeric, *spec.binary)]]
        assembler = VectorAssembler(inputCols=parts, outputCol=FEATURES, handleInvalid="error" if fill else "keep")
        return assembler.transform(found).select(*df.columns, FEATURES)


    def _placed(self, df: DataFrame) -> DataFrame:
        """``df`` with the position of each column's level as ``__at_<column>``, null for an unseen one.

        All columns look into one table of levels, named by column and level. Columns whose levels are
        small together share one broadcast of it and move no row. With one larger column the rows are
        shuffled by its level. With several, the rows are written once with a number, the cells of those
        columns meet the levels in one shuffle, and what they found comes back by number: the rows
        themselves are shuffled once, however many such columns there are.
        """
        spec = self.spec
        numbers = {c: k for k, c in enumerate(spec.categorical)}
        if not numbers:
            return df
        small, large = _by_size(self.bytes, spec.categorical)
        column = F.col("column")
        number = F.coalesce(*[F.when(column == c, F.lit(str(k))) for c, k in numbers.items()])
        named = self.levels.select(F.concat(number, F.lit(":"), "level").alias("name"), "position", "column")

        def key(c: str) -> Column:
            return F.concat(F.lit(f"{numbers[c]}:"), _level(spec, c)).alias(f"__level_{c}")

        found = df.select("*", *[key(c) for c in small])
        few = F.broadcast(named.where(column.isin(small)).select("name", "position"))
        for c in small:
            # the same table each time, so Spark broadcasts it once
            own = few.select(F.col("name").alias(f"__level_{c}"), F.col("position").alias(f"__at_{c}"))
            found = found.join(own, f"__level_{c}", "left")
        if len(large) == 1:
            (c,) = large
            own = named.where(column == c).select(
                F.col("name").alias(f"__level_{c}"), F.col("position").alias(f"__at_{c}")
            )
            return found.select("*", key(c)).join(own, f"__level_{c}", "left")
        if large:
            found = checkpointed(found.withColumn("__row", F.monotonically_increasing_id()))
            cells = F.explode(F.array(*[F.struct(F.lit(c).alias("of"), key(c).alias("name")) for c in large]))
            cells = found.select("__row", cells.alias("cell")).select("__row", "cell.*")
            met = cells.join(named.where(column.isin(large)).select("name", "position"), "name")
            places = [F.max(F.when(F.col("of") == c, F.col("position"))).alias(f"__at_{c}") for c in large]
            found = found.join(met.groupBy("__row").agg(*places), "__row", "left")
        return found


def _by_size(sizes: Mapping[str, int], columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """The columns whose levels fit the broadcast together, the smallest first, and the others.

    A column of unknown size counts as large.
    """
    room, small = BROADCAST_BYTES, []
    for c in sorted((c for c in columns if c in sizes), key=lambda c: (sizes[c], c)):
        room -= sizes[c]
        if room >= 0:
            small.append(c)
    return [c for c in columns if c in small], [c for c in columns if c not in small]


def _level(spec: FeatureSpec, column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(spec.missing_level))


def _imputed(column: str, mode: float) -> Column:
    return F.coalesce(F.nanvl(F.col(column).cast("double"), F.lit(None)), F.lit(mode))


def fill_missing(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """``df`` with its categorical columns filled in place."""
    return df.withColumns({c: _level(spec, c) for c in spec.categorical})


def fit_preprocessor(train: DataFrame, spec: FeatureSpec) -> Preprocessor:
    """Learn levels with their positions in sort order, and modes (the smallest on ties).

    Levels are found, sorted and numbered on the executors; a column may have any number of them. A column without a level or without a number is an error.
    """
    levels, sizes, modes, volume = None, {}, {}, {}
    # both passes read the columns from memory
    with kept(train.select(*spec.categorical, *spec.numeric)) as rows:
        if spec.categorical:
            filled = rows.select(*[_level(spec, c).alias(c) for c in spec.categorical])
            levels = checkpointed(distinct_levels(filled, spec.categorical))
        if spec.numeric:
            found = column_modes(rows.select(*spec.numeric), spec.numeric)
            modes = {r["column"]: r["mode"] for r in found.collect()}
    if spec.categorical:
        size = F.sum(F.octet_length("level") + LEVEL_BYTES).alias("bytes")
        for row in levels.groupBy("column").agg(F.count("*").alias("count"), size).collect():
            sizes[row["column"]], volume[row["column"]] = row["count"], row["bytes"]
        if sum(sizes.values()) <= FEW_LEVELS:
            # a bounded number of levels: sorted by one task a column wherever they are used
            place = F.row_number().over(Window.partitionBy("column").orderBy("level")) - 1
            levels = levels.withColumn("position", place.cast("long"))
        else:
            levels = checkpointed(numbered_levels(levels))
    absent = [c for c in spec.categorical if c not in sizes] + [c for c in spec.numeric if c not in modes]
    if absent:
        raise ValueError(f"nothing to learn from in columns {absent}")
    return Preprocessor(spec, levels, sizes, modes, volume)


def assemble(df: DataFrame, preprocessor: Preprocessor, *keep: str, one_hot: bool = True) -> DataFrame:
    """The kept columns and ``features``; everything else is dropped."""
    return preprocessor.transform(df, one_hot).select(*keep, FEATURES)


def width_and_values(vector: str = FEATURES) -> tuple[Column, Column]:
    """The width of a vector and its values in order, without the zeros that a sparse one leaves out.

    One-hot columns are as wide as they have levels, and those grow with the rows: what is made of the whole
    width for each row takes work that grows with their square.
    """
    stored = F.unwrap_udt(vector)
    return F.coalesce(stored["size"], F.size(stored["values"])), stored["values"]
