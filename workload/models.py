"""Preprocessing, training, search and scoring."""

from __future__ import annotations

import json
import tempfile
import uuid
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featloom.learning import score as scoring
from featloom.learning.forest import fit_forest
from featloom.learning.prep import FeatureSpec, assemble, fill_missing, fit_preprocessor, width_and_values
from featloom.learning.search import SearchSpace, fit_best, search
from featloom.learning.train import (
    fit_validate_refit,
    predict,
    train_boosted,
    train_boosted_regressor,
    train_deep_forest,
    train_forest,
    train_gbt,
    train_gbt_regressor,
)
from featloom.operators.lookup import FeatureLookup, feature_columns, lookup, training_set
from featloom.operators.split import VALIDATION, hash_bucket, mark_split, split
from featloom.plans.passengers import (
    FLAT_SPEC,
    ID,
    LABEL,
    LOOKUP_SPEC,
    demographic_features,
    flat_features,
    passenger_lookups,
    ticket_features,
)
from featloom.session import checkpointed, scratch_path
from featloom.sources.feature_tables import create_feature_table, merge
from workload.features import FLAT_FEATURES, MEASURED, measured_events
from workload.inputs import (
    AGE,
    CABIN_MULTI,
    NAME_PREFIX,
    NAME_SECONDARY,
    RAW_PASSENGERS,
    TICKET_CHARS,
    is_validation,
    raw_passengers,
    table,
)
from workload.joins import TRAINING_SET, spine_and_lookups


def impute_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document quality as text: NULL without a label, empty for toxic documents."""
    labels = table(spark, sf_dir, "labels").select(
        "doc_id",
        F.when(F.col("toxic") == 1, "").otherwise(F.col("quality").cast("string")).alias("quality"),
    )
    documents = table(spark, sf_dir, "documents").select("doc_id")
    joined = lookup(documents, FeatureLookup(labels, ("quality",), "doc_id"))
    return fill_missing(joined, FeatureSpec(("quality",)))


TYPES = ("ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD", "missing")


def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part types, NULL for size 1; promotions are unseen in training."""
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_size") != 1, F.col("p_type")).alias("p_type")
    )
    seen = parts.filter(F.col("p_type").isNull() | (F.col("p_type") != "PROMO"))
    encoder = fit_preprocessor(seen, FeatureSpec(("p_type",)))
    slots = vector_to_array("features")
    return assemble(parts, encoder, "p_partkey").select(
        "p_partkey", *[slots[i].alias(f"is_{name}") for i, name in enumerate(TYPES)]
    )


def impute_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = measured_events(spark, sf_dir)
    imputer = fit_preprocessor(events, FeatureSpec((), ("value",)))
    return assemble(events, imputer, "event_id").select(
        "event_id", vector_to_array("features")[0].alias("value")
    )


def assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Width and sum of the feature vectors of all documents."""
    flat = flat_features(raw_passengers(spark, sf_dir))
    vectors = assemble(flat, fit_preprocessor(flat, FLAT_SPEC), ID)
    width, values = width_and_values()
    total = F.aggregate(values, F.lit(0.0), lambda a, b: a + b)
    return vectors.select(
        ID,
        width.cast("bigint").alias("width"),
        F.round(total, 3).alias("total"),
    )


DEPTH = 8


def _labelled(rows: DataFrame) -> DataFrame:
    """``rows`` with a label that is an exact function of the language."""
    return rows.withColumn(LABEL, F.col("Sex").isin("en", "fr").cast("int"))


def _labelled_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat features of the labelled documents, stored with their split.

    The label follows from the language alone, so that a right model makes no mistake.
    """
    spine = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias(ID))
    flat = flat_features(raw_passengers(spark, sf_dir))
    rows = lookup(spine, FeatureLookup(flat, tuple(FLAT_SPEC.columns), ID))
    return checkpointed(mark_split(_labelled(rows), ID))


def _parts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return rows.filter(~F.col(VALIDATION)), rows.filter(VALIDATION)


def gbt_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, validation = _parts(_labelled_flat(spark, sf_dir))
    model = train_gbt(train, FLAT_SPEC, LABEL)
    return predict(model, validation).select(ID, LABEL, "prediction")


def boosted_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by trees of second order, which see that ages and fares are missing."""
    train, validation = _parts(_labelled_flat(spark, sf_dir))
    model = train_boosted(train, FLAT_SPEC, LABEL, fill=False)
    return predict(model, validation).select(ID, LABEL, "prediction")


def missing_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number that only the missing measurements of all events tell, learned from a part of them."""
    events = measured_events(spark, sf_dir).select(
        "event_id", "value", F.isnan("value").cast("double").alias("target"), F.array("value").alias("features")
    )
    train, _ = split(events, "event_id", test=0.5, seed=42)
    model = train_boosted_regressor(train, "features", "target", rounds=4, depth=3, rate=1.0, ridge=0.0)
    return model.transform(events).select("event_id", F.round("prediction", 6).alias("prediction"))


def boosted_refit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of both parts by trees of second order, before they are fitted again on all rows."""
    rows = checkpointed(_looked_up(spark, sf_dir))
    refit = fit_validate_refit(rows, LOOKUP_SPEC, LABEL, ID, rounds=5, fit=train_boosted)
    wrong = predict(refit.model, rows).where(F.col("prediction") != F.col(LABEL)).count()
    return refit.metrics.withColumn("wrong_after_refit", F.lit(wrong).cast("long"))


def forest_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, validation = _parts(_labelled_flat(spark, sf_dir))
    model = train_forest(train, FLAT_SPEC, LABEL, trees=40, fraction=0.7, depth=DEPTH)
    return predict(model, validation).select(ID, LABEL, "prediction")


def deep_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions for the rows of the fit, whose labels are a hash of their id: leaves must be pure."""
    digit = F.floor(F.col("s_suppkey") / (1 << 12))
    keys = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"),
        hash_bucket("s_suppkey", seed=3, buckets=2).alias("label"),
        F.array(*[c.cast("double") for c in (digit, F.col("s_suppkey") % (1 << 12), F.col("s_acctbal"))]).alias(
            "features"
        ),
    )
    rows = checkpointed(keys)
    grown = fit_forest(rows, "features", "label", None, trees=3, fraction=0.4)
    return grown.transform(rows).select("key", "label", "prediction")


def deep_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The held-out labels by a forest without a bound on depth."""
    train, validation = _parts(_labelled_flat(spark, sf_dir))
    model = train_deep_forest(train, FLAT_SPEC, LABEL, ID, trees=40, fraction=0.7)
    return predict(model, validation).select(ID, LABEL, "prediction")


def _looked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    spine, lookups = spine_and_lookups(spark, sf_dir)
    rows = training_set(spine, lookups, LABEL).df
    return _labelled(rows)


def refit_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = checkpointed(_looked_up(spark, sf_dir))
    refit = fit_validate_refit(rows, LOOKUP_SPEC, LABEL, ID)
    return predict(refit.model, rows).select(ID, LABEL, "prediction")


def search_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trials of a search that cannot do better than its first trial, and so stops early."""
    train, validation = _parts(_labelled_flat(spark, sf_dir))
    found = search(train, validation, FLAT_SPEC, LABEL, parallelism=8, depth=DEPTH).to_df(spark)
    return found.select(
        "trial",
        F.col("trees").between(20, 100).alias("trees_in_range"),
        F.col("fraction").between(0.5, 0.9).alias("fraction_in_range"),
        "loss",
        "precision",
        "recall",
        "f1",
    )


def searched_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of the forest that is fitted with the best settings of a short search."""
    train, validation = _parts(_labelled_flat(spark, sf_dir))
    found = search(train, validation, FLAT_SPEC, LABEL, max_trials=4, parallelism=4, depth=DEPTH)
    model = fit_best(train, FLAT_SPEC, LABEL, found, depth=DEPTH)
    return predict(model, validation).select(ID, LABEL, "prediction")


NOISE = 20
SEARCHED, RANDOM_FIRST = 24, 12


def noisy_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trials of a search on labels of which a fifth is wrong, so that settings differ in loss.

    From the thirteenth trial on, settings follow from the losses before and are no longer the random ones.
    """
    wrong = hash_bucket(ID, seed=7) < NOISE
    labelled = _labelled_flat(spark, sf_dir)
    noisy = labelled.withColumn(LABEL, F.when(wrong, 1 - F.col(LABEL)).otherwise(F.col(LABEL)))
    train, validation = _parts(noisy)
    space = SearchSpace(trees=(2, 12))
    found = search(
        train,
        validation,
        FLAT_SPEC,
        LABEL,
        space,
        max_trials=SEARCHED,
        patience=SEARCHED,
        parallelism=8,
        depth=3,
        startup=RANDOM_FIRST,
    )
    losses = [t.loss for t in found.trials]
    rows = [
        (
            t.trial,
            2 <= t.trees <= 12,
            0.5 <= t.fraction <= 0.9,
            abs(1 - t.f1 - t.loss) < 1e-12,
            (t.trees, t.fraction) != drawn,
        )
        for t, drawn in zip(found.trials, space.draw(SEARCHED, 50))
    ]
    trials = spark.createDataFrame(
        rows, "trial int, trees_in_range boolean, fraction_in_range boolean, loss_of_f1 boolean, guided boolean"
    )
    return trials.withColumns(
        {"losses_differ": F.lit(len(set(losses)) > 1), "best_is_least": F.lit(found.best.loss == min(losses))}
    )


def gbt_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out vectors with a number that follows from their label, one more part of the vector."""
    parts = F.concat(F.col("embedding").cast("array<double>"), F.array(F.col("label").cast("double")))
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", (F.col("label") % 3 * 2.5 - 1).alias("target"), array_to_vector(parts).alias("features")
    )
    train, held_out = split(vectors, "vec_id", test=0.2, seed=42)
    model = train_gbt_regressor(train, "features", "target")
    return model.transform(held_out).select(
        "vec_id", "target", F.round("prediction", 6).alias("prediction")
    )


def _stored_forest(spark: SparkSession, rows: DataFrame) -> str:
    """The folder of a forest of labelled rows."""
    model = train_forest(rows, FLAT_SPEC, LABEL, trees=20, fraction=0.7, depth=DEPTH)
    path = scratch_path(spark, "model")
    scoring.save_model(scoring.StoredModel(model), path, spark)
    return path


def score_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store a model trained on the labelled rows, load it, and score the whole flat table."""
    path = _stored_forest(spark, _labelled_flat(spark, sf_dir))
    return scoring.score(
        flat_features(raw_passengers(spark, sf_dir)), scoring.load_model(spark, path)
    )


def production_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the name of the model: its version in production, that version's run, its files."""
    path = _stored_forest(spark, _labelled_flat(spark, sf_dir))
    runs = spark.createDataFrame(
        [("r1", "/nowhere"), ("r2", path)], "run_id string, location string"
    )
    versions = spark.createDataFrame(
        [("language", 1, "r1", "Archived"), ("language", 2, "r2", "Production"), ("other", 3, "r1", "Production")],
        "name string, version int, run_id string, stage string",
    )
    stored = scoring.load_current(spark, versions, runs, "language")
    flat = flat_features(raw_passengers(spark, sf_dir))
    return scoring.score(flat, stored).select(ID, "predictions")


def stored_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of a stored model on rows that it was not trained on."""
    train, validation = _parts(_labelled_flat(spark, sf_dir))
    stored = scoring.load_model(spark, _stored_forest(spark, train))
    found = scoring.evaluate_model(validation, stored, LABEL)
    return found.drop("log_loss")


def _batch_model(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, scoring.StoredModel]:
    """Fill two feature tables, train on them, store the model; the spine and the model as loaded."""
    raw = raw_passengers(spark, sf_dir)
    names = []
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for label, frame in (("ticket", ticket_features(raw)), ("people", demographic_features(raw))):
        name = f"{label}_{uuid.uuid4().hex}"
        location = scratch_path(spark, name)
        create_feature_table(spark, name, ID, frame.schema, label, buckets, location)
        merge(spark, name, frame)
        names.append(name)
    spine, _ = spine_and_lookups(spark, sf_dir)
    data = training_set(spine, passenger_lookups(*names), LABEL, [ID])
    rows = _labelled(data.df)
    model = train_forest(rows, LOOKUP_SPEC, LABEL, trees=20, fraction=0.7, depth=DEPTH)
    path = scratch_path(spark, "model")
    scoring.save_model(scoring.StoredModel(model, data.lookups), path, spark)
    return spine, scoring.load_model(spark, path)


def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bare ids of all labelled documents, scored by a stored model with its feature tables."""
    spine, stored = _batch_model(spark, sf_dir)
    return scoring.score_batch(spine.select(ID), stored)


def score_few(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for the twenty largest ids, as numbers: only the buckets they hash to are read."""
    spine, stored = _batch_model(spark, sf_dir)
    largest = spine.select(ID).orderBy(F.col(ID).cast("long").desc()).limit(20)
    return scoring.score_batch(checkpointed(largest), stored)


NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
WEIGHTS = (0.5, 0.001, -2.0, 3.0)


def add_five(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.add_n(
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *NUMBERS), 5
    )


def python_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A linear model in Python, from a file that is shipped to the executors and read once per task."""
    folder = Path(tempfile.mkdtemp(prefix="weights-"))
    artifact = folder / f"{uuid.uuid4().hex}.json"
    artifact.write_text(json.dumps(WEIGHTS))

    def linear(weights: np.ndarray, rows: pd.DataFrame) -> np.ndarray:
        return np.round(rows.to_numpy(dtype="float64") @ weights, 6)

    def read(path: str) -> np.ndarray:
        with open(path) as file:
            return np.array(json.load(file))

    return scoring.score_python(
        table(spark, sf_dir, "lineitem"),
        inputs=NUMBERS,
        load=read,
        predict=linear,
        keep=["l_orderkey", "l_linenumber"],
        artifact=str(artifact),
    )


def feature_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the features of its training set, as text: all columns but label and id."""
    spine, lookups = spine_and_lookups(spark, sf_dir)
    rows = training_set(spine, lookups, LABEL).df
    return rows.select(ID, F.lit(",".join(sorted(feature_columns(rows, LABEL, [ID])))).alias("features"))


QUERIES = {
    "impute_constant": impute_constant,
    "one_hot": one_hot,
    "impute_mode": impute_mode,
    "assemble": assembled,
    "gbt_predictions": gbt_predictions,
    "deep_forest": deep_forest,
    "deep_predictions": deep_predictions,
    "boosted_predictions": boosted_predictions,
    "boosted_refit": boosted_refit,
    "missing_side": missing_side,
    "forest_predictions": forest_predictions,
    "refit_predictions": refit_predictions,
    "search_trials": search_trials,
    "searched_forest": searched_forest,
    "noisy_search": noisy_search,
    "gbt_regression": gbt_regression,
    "score_table": score_table,
    "score_batch": score_batch,
    "score_few": score_few,
    "production_scores": production_scores,
    "stored_evaluation": stored_evaluation,
    "feature_list": feature_list,
    "add_n": add_five,
    "python_model": python_model,
}

MODES = """
  SELECT (SELECT Age FROM flat WHERE Age IS NOT NULL
          GROUP BY Age ORDER BY count(*) DESC, Age LIMIT 1) AS age_mode,
         (SELECT FareRounded FROM flat WHERE FareRounded IS NOT NULL
          GROUP BY FareRounded ORDER BY count(*) DESC, FareRounded LIMIT 1) AS fare_mode"""

LEVELS = " + ".join(
    f"(SELECT count(DISTINCT coalesce({c}, 'missing')) FROM flat)" for c in FLAT_SPEC.categorical
)

LABELLED = f"""
labelled AS (
  SELECT CAST(l.doc_id AS VARCHAR) AS PassengerId,
         CASE WHEN d.lang IN ('en', 'fr') THEN 1 ELSE 0 END AS Survived,
         {is_validation("l.doc_id")} AS is_validation
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""

HELD_OUT = f"""
WITH {LABELLED}
SELECT PassengerId, Survived, CAST(Survived AS DOUBLE) AS prediction
FROM labelled WHERE is_validation"""

ORACLES = {
    "gbt_predictions": HELD_OUT,
    "forest_predictions": HELD_OUT,
    "boosted_predictions": HELD_OUT,
    "deep_predictions": HELD_OUT,
    "deep_forest": """
        SELECT s_suppkey AS key, label, CAST(label AS DOUBLE) AS prediction
        FROM (SELECT s_suppkey, ('0x' || substr(md5(concat('3:', s_suppkey)), 1, 8))::BIGINT % 2 AS label FROM supplier)""",
    "boosted_refit": f"""
        WITH {LABELLED}
        SELECT is_validation, 1.0::DOUBLE AS precision, 1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1,
               count(*) AS support, 0::BIGINT AS wrong_after_refit
        FROM labelled GROUP BY is_validation""",
    "missing_side": f"""
        WITH {MEASURED}
        SELECT event_id, CASE WHEN isnan(value) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM measured""",
    "searched_forest": HELD_OUT,
    "refit_predictions": f"""
        WITH {LABELLED}
        SELECT PassengerId, Survived, CAST(Survived AS DOUBLE) AS prediction FROM labelled""",
    "search_trials": """
        SELECT CAST(range AS INTEGER) AS trial, true AS trees_in_range, true AS fraction_in_range,
               0.0::DOUBLE AS loss, 1.0::DOUBLE AS precision, 1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1
        FROM range(25)""",
    "noisy_search": f"""
        SELECT CAST(range AS INTEGER) AS trial, true AS trees_in_range, true AS fraction_in_range,
               true AS loss_of_f1, range >= {RANDOM_FIRST} AS guided, true AS losses_differ, true AS best_is_least
        FROM range({SEARCHED})""",
    "gbt_regression": f"""
        SELECT vec_id, label % 3 * 2.5::DOUBLE - 1 AS target, label % 3 * 2.5::DOUBLE - 1 AS prediction
        FROM embeddings WHERE {is_validation("vec_id", seed=42, percent=20)}""",
    "score_table": f"""
        SELECT *, CASE WHEN Sex IN ('en', 'fr') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS predictions
        FROM ({FLAT_FEATURES})""",
    "production_scores": """
        SELECT CAST(doc_id AS VARCHAR) AS PassengerId,
               CASE WHEN lang IN ('en', 'fr') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS predictions
        FROM documents""",
    "stored_evaluation": f"""
        WITH {LABELLED}
        SELECT count(*) FILTER (Survived = 0) AS true_negatives, 0::BIGINT AS false_positives,
               0::BIGINT AS false_negatives, count(*) FILTER (Survived = 1) AS true_positives,
               count(*) AS example_count, 1.0::DOUBLE AS accuracy, 1.0::DOUBLE AS precision,
               1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1, 1.0::DOUBLE AS roc_auc, 1.0::DOUBLE AS pr_auc
        FROM labelled WHERE is_validation""",
    "score_batch": f"""
        WITH {TRAINING_SET}
        SELECT CAST(doc_id AS VARCHAR) AS PassengerId, * EXCLUDE (doc_id, Survived),
               CASE WHEN Sex IN ('en', 'fr') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
        FROM training_set""",
    "score_few": f"""
        WITH {TRAINING_SET}
        SELECT CAST(doc_id AS VARCHAR) AS PassengerId, * EXCLUDE (doc_id, Survived),
               CASE WHEN Sex IN ('en', 'fr') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
        FROM training_set ORDER BY doc_id DESC LIMIT 20""",
    "feature_list": f"""
        SELECT CAST(doc_id AS VARCHAR) AS PassengerId, '{",".join(sorted(LOOKUP_SPEC.columns))}' AS features
        FROM labels""",
    "impute_constant": """
        SELECT d.doc_id,
               CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN l.toxic = 1 THEN ''
                    ELSE CAST(l.quality AS VARCHAR) END AS quality
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "one_hot": "SELECT p_partkey, "
    + ", ".join(
        f"CASE WHEN CASE WHEN p_size = 1 THEN 'missing' ELSE p_type END = '{name}' "
        f"THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_{name}"
        for name in TYPES
    )
    + " FROM part",
    "impute_mode": f"""
        WITH {MEASURED},
        best AS (SELECT value FROM measured WHERE NOT isnan(value)
                 GROUP BY value ORDER BY count(*) DESC, value LIMIT 1)
        SELECT event_id, CASE WHEN isnan(m.value) THEN best.value ELSE m.value END AS value
        FROM measured m, best""",
    "assemble": f"""
        WITH {RAW_PASSENGERS},
        flat AS (
          SELECT PassengerId, {AGE} AS Age, round(Fare, 0) AS FareRounded,
                 {NAME_PREFIX} AS NamePrefix, Sex, substr(Cabin, 1, 1) AS CabinChar,
                 {CABIN_MULTI} AS CabinMulti, Embarked, Parch, Pclass, SibSp,
                 CASE WHEN {NAME_SECONDARY} IS NOT NULL THEN 1 ELSE 0 END AS NameMultiple,
                 CASE WHEN {TICKET_CHARS} IS NULL THEN 1 ELSE 0 END AS MissingTicketChars
          FROM raw),
        modes AS ({MODES})
        SELECT PassengerId, CAST({LEVELS} + 4 AS BIGINT) AS width,
               round(8::DOUBLE + coalesce(Age, age_mode) + coalesce(FareRounded, fare_mode)
                     + NameMultiple + MissingTicketChars, 3) AS total
        FROM flat, modes""",
    "add_n": "SELECT "
    + ", ".join(f"{c} + 5 AS {c}" for c in ("l_orderkey", "l_linenumber", *NUMBERS))
    + " FROM lineitem",
    "python_model": "SELECT l_orderkey, l_linenumber, round("
    + " + ".join(f"{c} * ({w}::DOUBLE)" for c, w in zip(NUMBERS, WEIGHTS))
    + ", 6) AS predictions FROM lineitem",
}
