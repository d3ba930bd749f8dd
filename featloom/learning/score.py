"""Stored models and batch scoring."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass
from typing import Any

import pandas as pd
from pyspark import SparkFiles
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from featloom.learning.boost import BoostedTrees
from featloom.learning.forest import Forest
from featloom.learning.prep import FeatureSpec, Preprocessor
from featloom.learning.train import TreeModel
from featloom.operators.evaluate import evaluate_classifier
from featloom.operators.lookup import FeatureLookup, lookup_all
from featloom.operators.runs import PRODUCTION, current, run
from featloom.operators.skew import HotKeys


FEW_IDS = 1000
"""Ids that are told to the scans of feature tables before they read."""
# Trees of our own, by the name that a stored model has for them; others are stored by Spark.
OWN = {"boosted": BoostedTrees, "forest": Forest}


@dataclass(frozen=True)
class StoredModel:
    """A fitted model and the lookups that supply its inputs."""

    model: TreeModel
    lookups: tuple[FeatureLookup, ...] = ()

    @property
    def spec(self) -> FeatureSpec:
        return self.model.preprocessor.spec


def save_model(stored: StoredModel, path: str, spark: SparkSession) -> None:
    """Write the trees, the table of levels, and a small JSON with all else below ``path``."""
    if not all(isinstance(one.table, str) for one in stored.lookups):
        raise TypeError("a stored lookup needs the name or path of its table")
    prepared = stored.model.preprocessor
    trees = stored.model.trees
    kind = next((name for name, one in OWN.items() if isinstance(trees, one)), None)
    facts = {
        "kind": kind,
        "fill": stored.model.fill,
        "spec": asdict(prepared.spec),
        "sizes": dict(prepared.sizes),
        "modes": dict(prepared.modes),
        "bytes": dict(prepared.bytes),
        "lookups": [asdict(one) for one in stored.lookups],
    }
    if kind:
        trees.save(f"{path}/trees", spark)
    else:
        trees.write().overwrite().save(f"{path}/trees")
    if prepared.levels is not None:
        prepared.levels.write.mode("overwrite").parquet(f"{path}/levels")
    text = spark.createDataFrame([(json.dumps(facts),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(f"{path}/inputs")


def load_model(spark: SparkSession, path: str) -> StoredModel:
    """Read back what :func:`save_model` wrote; the levels stay a table."""
    facts = json.loads(spark.read.text(f"{path}/inputs").collect()[0]["value"])
    groups = {k: tuple(v) if isinstance(v, list) else v for k, v in facts["spec"].items()}
    lookups = tuple(
        FeatureLookup(one["table"], tuple(one["features"]), one["key"], one["table_key"])
        for one in facts["lookups"]
    )
    levels = spark.read.parquet(f"{path}/levels") if facts["sizes"] else None
    prepared = Preprocessor(FeatureSpec(**groups), levels, facts["sizes"], facts["modes"], facts.get("bytes", {}))
    if facts.get("kind"):
        trees = OWN[facts["kind"]].load(spark, f"{path}/trees")
    else:
        trees = DefaultParamsReader.loadParamsInstance(f"{path}/trees", spark.sparkContext)
    return StoredModel(TreeModel(prepared, trees, facts.get("fill", True)), lookups)


def load_current(
    spark: SparkSession,
    versions: DataFrame,
    runs: DataFrame,
    name: str,
    stage: str = PRODUCTION,
) -> StoredModel:
    """The model of a name in a stage: its newest version there, that version's run, its files."""
    chosen = current(versions, name, stage).first()
    found = run(runs, chosen["run_id"]).collect()
    if len(found) != 1:
        raise LookupError(f"{len(found)} runs {chosen['run_id']}")
    return load_model(spark, found[0]["location"])


def score(
    df: DataFrame,
    model: StoredModel,
    output: str = "predictions",
    probability: str | None = None,
) -> DataFrame:
    """The columns of ``df`` and the prediction as double.

    ``probability`` names one more column, the probability of class 1. Inputs are chosen by the
    model's own list; the rows meet the levels of their categories, and no more.
    """
    absent = [c for c in model.spec.columns if c not in df.columns]
    if absent:
        raise ValueError(f"input columns are absent: {absent}")
    scored = model.model.transform(df)
    more = [vector_to_array("probability")[1].alias(probability)] if probability else []
    return scored.select(*df.columns, F.col("prediction").cast("double").alias(output), *more)


def evaluate_model(
    df: DataFrame, model: StoredModel, label: str, ranges: int | None = None
) -> DataFrame:
    """All metrics of a stored classifier on rows with its inputs and a label, in one row."""
    inputs = df.select(label, *model.spec.columns)
    found = score(inputs, model, "prediction", "score")
    return evaluate_classifier(found, label, "prediction", "score", ranges)


def score_batch(
    ids: DataFrame,
    model: StoredModel,
    output: str = "prediction",
    hot_keys: Mapping[str, HotKeys] | None = None,
    few: int = FEW_IDS,
) -> DataFrame:
    """Score bare ids: join the features the model was trained with, then predict.

    The features stay in the result, between the columns of ``ids`` and the prediction. Of at most ``few``
    ids only the buckets of the feature tables are read that they hash to.
    """
    return score(lookup_all(ids, model.lookups, hot_keys, few=few), model, output)


def add_n(df: DataFrame, n: int) -> DataFrame:
    """Every column plus ``n``, as plain column expressions."""
    return df.select([(F.col(c) + n).alias(c) for c in df.columns])


def score_python(
    df: DataFrame,
    inputs: Sequence[str],
    load: Callable[[str | None], Any],
    predict: Callable[[Any, pd.DataFrame], Any],
    keep: Sequence[str] = (),
    output: str = "predictions",
    artifact: str | None = None,
) -> DataFrame:
    """Predictions of a Python model, as ``keep`` columns plus a double.

    Only the kept and input columns reach Python. ``load`` runs once per task, with the local path of
    ``artifact``, which Spark ships to every executor; ``predict`` gets the model and the
    input columns of one Arrow batch. Filter before this call: a filter after it
    cannot move through the Python function.
    """
    context = df.sparkSession.sparkContext
    file_name = None
    if artifact is not None:
        context.addFile(artifact)
        file_name = artifact.rstrip("/").rsplit("/", 1)[-1]
    inputs, keep = list(inputs), list(keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load(SparkFiles.get(file_name) if file_name else None)
        for batch in batches:
            result = batch[keep].copy()
            result[output] = pd.Series(predict(model, batch[inputs]), index=batch.index).astype(
                "float64"
            )
            yield result

    needed = df.select(*dict.fromkeys([*keep, *inputs]))
    schema = StructType([df.schema[c] for c in keep]).add(output, "double")
    return needed.mapInPandas(run, schema)
