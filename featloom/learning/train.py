"""Tree ensembles on prepared features."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.ml.base import Estimator, Model
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.learning.boost import SQUARES, BoostedTrees, BoostSettings, fit_boosted
from featloom.learning.forest import Forest, fit_forest
from featloom.learning.prep import FEATURES, FeatureSpec, Preprocessor, fit_preprocessor
from featloom.operators.evaluate import compare_splits
from featloom.operators.split import VALIDATION, mark_split
from featloom.session import kept

# The settings of the boosted trees.
TREE_DEPTH = 6
LEARNING_RATE = 0.3


@dataclass(frozen=True)
class TreeModel:
    """Preprocessing and trees.

    The trees see the position of a level as one number. They split it as often as they need to, so
    neither their bins nor the rows grow with the number of levels. Without ``fill`` the trees see what is
    missing.
    """

    preprocessor: Preprocessor
    trees: Model | BoostedTrees | Forest
    fill: bool = True

    def transform(self, df: DataFrame) -> DataFrame:
        return self.trees.transform(self.preprocessor.transform(df, one_hot=False, fill=self.fill))


def _fit(train: DataFrame, spec: FeatureSpec, label: str, estimator: Estimator) -> TreeModel:
    """Preprocessing and trees in one model. Only the columns in use are kept for the passes."""
    with kept(train.select(*spec.columns, F.col(label).cast("double").alias(label))) as rows:
        preprocessor = fit_preprocessor(rows, spec)
        prepared = preprocessor.transform(rows, one_hot=False).select(FEATURES, label)
        return TreeModel(preprocessor, estimator.fit(prepared))


def train_gbt(
    train: DataFrame, spec: FeatureSpec, label: str, rounds: int = 25, seed: int = 123
) -> TreeModel:
    """Boosted-tree classifier for 0/1 labels."""
    return _fit(
        train,
        spec,
        label,
        GBTClassifier(
            featuresCol=FEATURES,
            labelCol=label,
            maxIter=rounds,
            maxDepth=TREE_DEPTH,
            stepSize=LEARNING_RATE,
            seed=seed,
        ),
    )


def train_boosted(
    train: DataFrame,
    spec: FeatureSpec,
    label: str,
    rounds: int = 25,
    fill: bool = True,
    settings: BoostSettings | None = None,
) -> TreeModel:
    """Boosted trees of second order for 0/1 labels.

    With ``fill`` numbers that are missing become the mode first, as for the other trees; without it
    each split learns on which side they belong. ``settings`` replaces ``rounds`` and all defaults.
    """
    settings = settings or BoostSettings(rounds=rounds, depth=TREE_DEPTH, rate=LEARNING_RATE)
    with kept(train.select(*spec.columns, F.col(label).cast("double").alias(label))) as rows:
        preprocessor = fit_preprocessor(rows, spec)
        prepared = preprocessor.transform(rows, one_hot=False, fill=fill).select(FEATURES, label)
        return TreeModel(preprocessor, fit_boosted(prepared, FEATURES, label, settings), fill)


def forest(
    label: str, trees: int, fraction: float, depth: int = 5, seed: int = 123
) -> RandomForestClassifier:
    """A random forest that tries ``fraction`` of the features per split."""
    return RandomForestClassifier(
        featuresCol=FEATURES,
        labelCol=label,
        numTrees=trees,
        featureSubsetStrategy=str(fraction),
        maxDepth=depth,
        seed=seed,
    )


def train_forest(
    train: DataFrame,
    spec: FeatureSpec,
    label: str,
    trees: int,
    fraction: float,
    depth: int = 5,
    seed: int = 123,
) -> TreeModel:
    """Random-forest classifier."""
    return _fit(train, spec, label, forest(label, trees, fraction, depth, seed))


def train_deep_forest(
    train: DataFrame,
    spec: FeatureSpec,
    label: str,
    key: str,
    trees: int = 100,
    fraction: float = 1.0,
    depth: int | None = None,
    least_rows: int = 1,
    seed: int = 123,
    fill: bool = True,
) -> TreeModel:
    """Random-forest classifier whose trees are as deep as the rows ask for; ``key`` names the rows."""
    columns = [*dict.fromkeys([key, *spec.columns]), F.col(label).cast("double").alias(label)]
    with kept(train.select(*columns)) as rows:
        preprocessor = fit_preprocessor(rows, spec)
        prepared = preprocessor.transform(rows, one_hot=False, fill=fill)
        grown = fit_forest(prepared, FEATURES, label, key, trees, fraction, depth, least_rows, seed)
        return TreeModel(preprocessor, grown, fill)


def predict(model: TreeModel, df: DataFrame) -> DataFrame:
    """The columns of ``df``, ``prediction``, and the probability of class 1 as ``score``."""
    scored = model.transform(df)
    return scored.select(
        *df.columns, "prediction", vector_to_array("probability")[1].alias("score")
    )


@dataclass(frozen=True)
class Refit:
    """A model fitted on all rows, with the metrics of the validated fit before it."""

    model: TreeModel
    validated: TreeModel
    metrics: DataFrame


def fit_validate_refit(
    df: DataFrame,
    spec: FeatureSpec,
    label: str,
    key: str,
    rounds: int = 50,
    test: float = 0.25,
    seed: int = 123,
    fit: Callable[[DataFrame, FeatureSpec, str, int], TreeModel] | None = None,
) -> Refit:
    """Fit on the training part, measure both parts, and fit again on all rows.

    ``fit`` takes rows, spec, label and rounds: by default :func:`train_gbt` with the seed, or for
    instance :func:`train_boosted`.

    ``metrics`` has one row for each part (``is_validation``). Neither fit needs the other, so
    their jobs are submitted side by side and share the kept rows.
    """
    spark = df.sparkSession
    marked = mark_split(df.select(key, label, *spec.columns), key, test, seed)
    with kept(marked) as rows, ThreadPoolExecutor(2) as pool:
        learn = inheritable_thread_target(spark)(fit or partial(train_gbt, seed=seed))
        training = rows.filter(~F.col(VALIDATION))
        fits = [pool.submit(learn, part, spec, label, rounds) for part in (training, rows)]
        validated, final = [one.result() for one in fits]
        metrics = compare_splits(predict(validated, rows), VALIDATION, label).collect()
    schema = (
        f"{VALIDATION} boolean, precision double, recall double, f1 double, support bigint"
    )
    return Refit(final, validated, spark.createDataFrame(metrics, schema))


def train_gbt_regressor(
    train: DataFrame,
    features: str,
    label: str,
    rounds: int = 10,
    depth: int = 10,
    seed: int = 42,
) -> GBTRegressionModel:
    """Boosted-tree regression on a vector column; class codes are regressed as numbers."""
    regressor = GBTRegressor(
        featuresCol=features,
        labelCol=label,
        maxIter=rounds,
        maxDepth=depth,
        stepSize=LEARNING_RATE,
        seed=seed,
    )
    with kept(train.select(features, F.col(label).cast("double").alias(label))) as rows:
        return regressor.fit(rows)


def train_boosted_regressor(
    train: DataFrame, features: str, label: str, rounds: int = 10, depth: int = 10, **settings: float
) -> BoostedTrees:
    """Regression by boosted trees of second order on a vector or array column; NaN is missing."""
    return fit_boosted(
        train, features, label, BoostSettings(rounds=rounds, depth=depth, objective=SQUARES, **settings)
    )
