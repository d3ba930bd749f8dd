"""Feature lookups: left joins of keyed feature tables onto a spine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import groupby
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featloom.operators.keys import assert_unique
from featloom.operators.skew import HotKeys, find_hot_keys
from featloom.sources.feature_tables import feature_table
from featloom.sources.tables import load


@dataclass(frozen=True)
class FeatureLookup:
    """Features ``features`` of ``table`` (a name, a path or a DataFrame) by the spine's ``key``.

    ``table_key`` is the key's name in the table if it is another one there.
    """

    table: str | DataFrame
    features: tuple[str, ...]
    key: str
    table_key: str | None = None

    def read(self, spark: SparkSession, keys: Sequence[Any] | None = None) -> DataFrame:
        """The table's rows, or only those of ``keys``.

        Keys are given to the scan as values: a bucketed feature table is then read in the buckets that they
        hash to, and within those in the row groups whose range they lie in.
        """
        source = load(spark, self.table) if isinstance(self.table, str) else self.table
        if keys is not None:
            source = source.where(F.col(self.table_key or self.key).isin(list(keys)))
        return source.select(F.col(self.table_key or self.key).alias(self.key), *self.features)


def lookup(
    spine: DataFrame,
    one: FeatureLookup,
    hot_keys: Mapping[str, HotKeys] | None = None,
    check_unique: bool | None = None,
) -> DataFrame:
    """Attach the features of one lookup; see :func:`lookup_all`."""
    return lookup_all(spine, [one], hot_keys, check_unique)


def lookup_all(
    spine: DataFrame,
    lookups: Sequence[FeatureLookup],
    hot_keys: Mapping[str, HotKeys] | None = None,
    check_unique: bool | None = None,
    few: int = 0,
) -> DataFrame:
    """Attach the features of several lookups in order. Every spine row stays; misses give NULL.

    Lookups that follow each other on the same key share one placement of the spine, so the spine
    is shuffled once for all of them. Rows of hot keys are joined apart, with the few feature rows they
    need; the others by the key alone, so that bucketed tables stay where they are. Hot keys are
    detected in one extra scan of the spine's key columns, unless ``hot_keys`` gives them by key
    (``{}`` for none) or the tables are so small that Spark broadcasts them; a spine that is costly to
    compute should be stored first, as it is read again.

    A table in which a key is missing or occurs twice is an error. ``check_unique`` says whether to look;
    by default feature tables of the catalog, which guarantee it, are not looked at.

    With ``few`` a spine of at most so many keys tells them to the scans before they read: that costs
    one look at the spine's keys, which stops at one more than ``few``, and then only the parts of the
    tables are read that can hold them. Such lookups need no search for hot keys.
    """
    spark = spine.sparkSession
    asked = _few_keys(spine, lookups, few) if few else {}
    if asked and hot_keys is None and all(one.key in asked for one in lookups):
        hot_keys = {}
    read = [(one, one.read(spark, asked.get(one.key))) for one in lookups]
    for one, features in read:
        if check_unique or (check_unique is None and not _guaranteed(spark, one)):
            assert_unique(features, [one.key], missing=False)
    large = dict.fromkeys(one.key for one, features in read if not _small(features))
    df = spine
    known = dict(hot_keys or {})
    if hot_keys is None:
        keys = [k for k in large if k in spine.columns]
        known = dict(zip(keys, find_hot_keys(spine, [[k] for k in keys]))) if keys else {}
    for key, same_key in groupby(read, lambda pair: pair[0].key):
        if hot_keys is None and key in large and key not in known:
            # The key is itself a looked-up feature.
            known[key] = find_hot_keys(df, [[key]])[0]
        hot = known.get(key, HotKeys())
        plain = hot.rows_beside(df, [key]) if hot else df
        frequent = hot.rows_of(df, [key]) if hot else None
        for one, features in same_key:
            taken = set(plain.columns) & set(one.features)
            if taken:
                raise ValueError(f"columns exist already: {sorted(taken)}")
            if features.schema[key].dataType != plain.schema[key].dataType:
                raise TypeError(f"key {key} has another type in the feature table")
            plain = plain.join(features, key, "left")
            if hot:
                # At most one feature row for each hot key.
                few = F.broadcast(hot.rows_of(features, [key]))
                frequent = frequent.join(few, key, "left")
        df = plain.unionByName(frequent) if hot else plain
    names = [name for one in lookups for name in one.features]
    return df.select(*spine.columns, *names)


def _few_keys(spine: DataFrame, lookups: Sequence[FeatureLookup], few: int) -> dict[str, list[Any]]:
    """The keys of the spine by column, for columns that have at most ``few``; NULL finds nothing anyway."""
    found = {}
    for key in dict.fromkeys(one.key for one in lookups if one.key in spine.columns):
        rows = spine.select(key).where(F.col(key).isNotNull()).distinct().limit(few + 1).collect()
        if len(rows) <= few:
            found[key] = [r[0] for r in rows]
    return found


def _guaranteed(spark: SparkSession, one: FeatureLookup) -> bool:
    """Whether the lookup's key is that of a feature table in the catalog."""
    if not isinstance(one.table, str) or "/" in one.table:
        return False
    try:
        return feature_table(spark, one.table).key == (one.table_key or one.key,)
    except ValueError:
        return False


def _small(features: DataFrame) -> bool:
    """Whether Spark's own estimate lets it broadcast the table."""
    plan = features._jdf.queryExecution().optimizedPlan()
    limit = features.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(plan.stats().sizeInBytes())) <= limit


@dataclass(frozen=True)
class TrainingSet:
    """A joined frame and what is needed to score with the same features later."""

    df: DataFrame
    lookups: tuple[FeatureLookup, ...]
    label: str
    exclude: tuple[str, ...]

    @property
    def features(self) -> list[str]:
        return feature_columns(self.df, self.label, self.exclude)


def training_set(
    spine: DataFrame,
    lookups: Sequence[FeatureLookup],
    label: str,
    exclude: Sequence[str] = (),
    hot_keys: Mapping[str, HotKeys] | None = None,
    check_unique: bool | None = None,
) -> TrainingSet:
    """Spine and looked-up features with the label, without the excluded columns."""
    if label not in spine.columns:
        raise ValueError(f"label {label} is not a spine column")
    joined = lookup_all(spine, lookups, hot_keys, check_unique)
    return TrainingSet(joined.drop(*exclude), tuple(lookups), label, tuple(exclude))


def feature_columns(df: DataFrame, label: str, ids: Sequence[str] = ()) -> list[str]:
    """Every column but the label and the ids, in order."""
    return [name for name in df.columns if name != label and name not in ids]
