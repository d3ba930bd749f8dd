"""Runs and model versions as tables.

Runs: one row per run, with its metrics. Versions: ``(name, version, run_id, stage)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featloom.operators.lookup import FeatureLookup, lookup
from featloom.operators.ranking import running_totals
from featloom.operators.skew import HotKeys

# The stages of a version.
NO_STAGE = "None"
PRODUCTION = "Production"
ARCHIVED = "Archived"


def _best_first(metric: str) -> Column:
    """Falling, with NULL and NaN, the metric of a failed run, after all numbers."""
    return F.nanvl(F.col(metric).cast("double"), F.lit(None)).desc_nulls_last()


def champion(runs: DataFrame, metric: str, run_id: str = "run_id") -> DataFrame:
    """The run with the highest metric; NULL and NaN come last, ties go to the smallest id.

    Each task keeps one row, so nothing is sorted as a whole.
    """
    return runs.orderBy(_best_first(metric), run_id).limit(1)


def champion_per_group(
    runs: DataFrame, metric: str, by: str, run_id: str = "run_id"
) -> DataFrame:
    """The champion of every group.

    The rank is limited to 1 on both sides of the shuffle, so a task sends one row per group, however
    large the group is.
    """
    order = Window.partitionBy(by).orderBy(_best_first(metric), run_id)
    return runs.withColumn("__rank", F.row_number().over(order)).filter("__rank = 1").drop("__rank")


METRICS = "run_id string, metric string, value double"


def metric_rows(spark: SparkSession, values: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """The metrics of some runs as rows ``(run_id, metric, value)``."""
    rows = [(r, name, float(value)) for r, found in values.items() for name, value in found.items()]
    return spark.createDataFrame(rows, METRICS)


def log_metrics(metrics: DataFrame, values: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """The long table ``(run_id, metric, value)`` with the metrics of more runs, all in one step."""
    return metrics.unionByName(metric_rows(metrics.sparkSession, values))


def metrics_wide(metrics: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per run, one column per metric name; a metric logged twice shows its maximum.

    The names are given, so no extra pass looks for them; aggregation is partial before the shuffle.
    """
    return metrics.groupBy("run_id").agg(
        *[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names]
    )


def next_versions(
    versions: DataFrame, new: DataFrame, ranges: int | None = None
) -> DataFrame:
    """Number the rows ``(name, run_id)`` of ``new``: ``(name, version, run_id, stage)``.

    Per name the numbers go on from the highest one in ``versions`` (from 1 for a new name) in the
    order of ``run_id``, which is unique per name. A name may hold any share of the rows.
    """
    highest = versions.groupBy("name").agg(F.max("version").cast("bigint").alias("step"))
    # The highest number enters the running total as one more row, ahead of the new ones (its NULL
    # run id sorts first), so no join meets a frequent name and ``new`` is read once.
    opening = highest.select(
        "name",
        F.lit(None).cast(new.schema["run_id"].dataType).alias("run_id"),
        "step",
        F.lit(False).alias("is_new"),
    )
    rows = new.select(
        "name", "run_id", F.lit(1).cast("bigint").alias("step"), F.lit(True).alias("is_new")
    )
    numbered = running_totals(
        rows.unionByName(opening),
        order="run_id",
        totals={"version": F.col("step")},
        keys=["name"],
        ranges=ranges,
    )
    return numbered.filter("is_new").select(
        "name", F.col("version").cast("int"), "run_id", F.lit(NO_STAGE).alias("stage")
    )


def add_versions(
    versions: DataFrame, new: DataFrame, ranges: int | None = None
) -> DataFrame:
    """``versions`` with the numbered rows of ``new`` appended."""
    return versions.unionByName(next_versions(versions, new, ranges))


def promote(
    versions: DataFrame,
    promotions: DataFrame,
    stage: str = PRODUCTION,
    hot_keys: Mapping[str, HotKeys] | None = None,
    check: bool = True,
) -> DataFrame:
    """Put the versions of ``promotions`` (``name, version``; one per name) into ``stage``.

    A version of the same name that held the stage is archived; everything else stays. With
    ``check`` a promotion of a version that does not exist, or a second one for a name, is an
    error.
    """
    if check:
        known = versions.select("name", "version", F.lit(1).alias("__known"))
        # With few promotions Spark broadcasts them, and no version is shuffled.
        found = promotions.select("name", "version").join(known, ["name", "version"], "left")
        per_name = found.groupBy("name").agg(
            F.countDistinct("version").alias("versions"), F.count("__known").alias("known")
        )
        wrong = per_name.filter("versions <> 1 OR known = 0").limit(1).collect()
        if wrong and wrong[0]["versions"] > 1:
            raise ValueError(f"promoted twice: {wrong[0]['name']}")
        if wrong:
            raise LookupError(f"no such version of {wrong[0]['name']}")
        promotions = promotions.select("name", "version").distinct()
    target = promotions.select("name", F.col("version").alias("__promoted"))
    joined = lookup(
        versions, FeatureLookup(target, ("__promoted",), "name"), hot_keys, check_unique=False
    )
    moved = (
        F.when(F.col("version") == F.col("__promoted"), F.lit(stage))
        .when(F.col("__promoted").isNotNull() & (F.col("stage") == stage), F.lit(ARCHIVED))
        .otherwise(F.col("stage"))
    )
    return joined.select(
        *[moved.alias("stage") if c == "stage" else F.col(c) for c in versions.columns]
    )


def current_versions(versions: DataFrame, stage: str = PRODUCTION) -> DataFrame:
    """Per name the highest version in ``stage``; names without one are absent."""
    held = versions.filter(F.col("stage") == stage)
    order = Window.partitionBy("name").orderBy(F.col("version").desc())
    return held.withColumn("__rank", F.row_number().over(order)).filter("__rank = 1").drop("__rank")


def current(versions: DataFrame, name: str, stage: str = PRODUCTION) -> DataFrame:
    """The one current version of ``name``; an error if there is none."""
    found = (
        versions.filter((F.col("name") == name) & (F.col("stage") == stage))
        .orderBy(F.col("version").desc())
        .limit(1)
    )
    rows = found.collect()
    if not rows:
        raise LookupError(f"no version of {name} in stage {stage}")
    return versions.sparkSession.createDataFrame(rows, found.schema)


def run(runs: DataFrame, run_id: str) -> DataFrame:
    """The location of one run."""
    return runs.filter(F.col("run_id") == run_id).select("run_id", "location")
