"""Preprocessing, training, search, scoring."""

from __future__ import annotations

import uuid

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from featloom.learning import prep
from featloom.learning.prep import FeatureSpec, assemble, fill_missing, fit_preprocessor, width_and_values
from featloom.learning.score import (
    StoredModel,
    add_n,
    evaluate_model,
    load_current,
    load_model,
    save_model,
    score,
    score_batch,
    score_python,
)
from featloom.learning.search import (
    SearchResult,
    SearchSpace,
    Trial,
    fit_best,
    search,
    trials_until_stop,
)
from featloom.learning.train import (
    fit_validate_refit,
    predict,
    train_forest,
    train_gbt,
    train_gbt_regressor,
)
from featloom.operators.lookup import FeatureLookup, training_set
from featloom.operators.split import VALIDATION, split
from workload import models

NAN = float("nan")


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(
        [("a", 1.0, "0"), ("b", 1.0, "1"), ("c", 2.0, "1"), (None, 2.0, "0"), ("", NAN, "1")],
        "level string, size double, flag string",
    )


SPEC = FeatureSpec(("level",), ("size",), ("flag",))


def vectors(df):
    return [r.v for r in df.select(vector_to_array("features").alias("v")).collect()]


def test_preprocessing(spark, small):
    """Levels sort as the empty text, a, b, c, missing; then the size with mode 1, then the flag."""
    model = fit_preprocessor(small, SPEC)
    assert vectors(assemble(small, model)) == [
        [0, 1, 0, 0, 0, 1, 0],
        [0, 0, 1, 0, 0, 1, 1],
        [0, 0, 0, 1, 0, 2, 1],
        [0, 0, 0, 0, 1, 2, 0],
        [1, 0, 0, 0, 0, 1, 1],
    ]
    unseen = spark.createDataFrame([("zz", None, "1")], small.schema)
    assert vectors(assemble(unseen, model)) == [[0, 0, 0, 0, 0, 1, 1]]


def test_columns_with_few_and_many_levels(spark):
    df = spark.range(50).select(
        F.col("id").cast("string").alias("many"), F.lit("x").alias("one"), F.lit("'").alias("quote")
    )
    model = fit_preprocessor(df, FeatureSpec(("many", "one", "quote")))
    found = np.array(vectors(assemble(df, model)))
    assert found.shape == (50, 52) and (found.sum(axis=1) == 3).all()
    assert (found.sum(axis=0)[:50] == 1).all()


def test_values_without_the_zeros_left_out(spark):
    """A vector of two thousand million slots is never written out; a dense one has all of its values."""
    rows = [(Vectors.sparse(2_000_000_000, [3, 1_999_999_999], [1.5, 2.0]),), (Vectors.dense([0.0, 4.0, 0.5]),)]
    df = spark.createDataFrame(rows, ["features"])
    assert [tuple(r) for r in df.select(*width_and_values()).collect()] == [
        (2_000_000_000, [1.5, 2.0]),
        (3, [0.0, 4.0, 0.5]),
    ]


def test_assembled_vectors_are_not_written_out(spark, tmp_path):
    """Every document has a prefix of its own; no row's work follows the number of levels."""
    rows = [(n, f"x{'abcdefghij'[n // 10]}{'abcdefghij'[n % 10]}. text", "en", f"src{n % 3}", 40 + n % 2) for n in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = models.assembled(spark, str(tmp_path))
    # 100 prefixes, 3 classes from the source, one level in each of the other six columns, four numbers
    assert {r["width"] for r in found.collect()} == {100 + 3 + 6 + 4}
    expected = {str(n): round(8 + (40 + n % 2) / 10 + round((40 + n % 2) / 4) + 1, 3) for n, *_ in rows}
    assert {r["PassengerId"]: r["total"] for r in found.collect()} == expected
    assert "vector_to_array" not in found._jdf.queryExecution().toString()


def exchanges(df):
    """How often the plan that has run shuffles, broadcasts and reuses."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    names = ("Exchange hashpartitioning", "BroadcastExchange", "ReusedExchange")
    # levels are numbered by a shuffle of their own table, by column
    plan = "\n".join(line for line in plan.split("\n") if "hashpartitioning(column" not in line)
    found = {n: sum(n in line for line in plan.split("\n")) for n in names}
    # by the number of a row: the rows, and what their cells have found
    found["rows"] = sum("Exchange hashpartitioning(__row" in line for line in plan.split("\n"))
    return found


@pytest.mark.parametrize("room", [32 << 20, 4000, 0])
def test_one_pass_for_all_columns(spark, monkeypatch, room):
    """All columns small, some, and none: the same positions, with at most one shuffle of the rows."""
    columns = [f"c{k}" for k in range(6)]
    df = spark.range(0, 3000, 1, 4).select(
        "id",
        # a hot level, nulls, a text of digits and a colon, and one column with the levels of another
        *[F.when(F.col("id") % 3 > 0, (F.col("id") % (7 + 40 * k)).cast("string")).alias(c) for k, c in enumerate(columns[:4])],
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("0:"), (F.col("id") % 5).cast("string"))).alias("c4"),
        (F.col("id") % 7).cast("string").alias("c5"),
    )
    monkeypatch.setattr(prep, "BROADCAST_BYTES", room)
    spec = FeatureSpec(tuple(columns))
    model = fit_preprocessor(df.where("id < 2000"), spec)
    small, large = prep._by_size(model.bytes, columns)
    assert len(small) == {32 << 20: 6, 4000: 4, 0: 0}[room] and sorted(small + large) == columns
    found = model.transform(df, one_hot=False)
    rows = df.collect()
    wanted = {}
    for c in columns:
        levels = sorted({"missing" if r[c] is None else r[c] for r in rows if r["id"] < 2000})
        wanted[c] = {v: k for k, v in enumerate(levels)}
    got = {r["id"]: r["v"] for r in found.select("id", vector_to_array("features").alias("v")).collect()}
    for r in rows:
        assert got[r["id"]] == [wanted[c].get("missing" if r[c] is None else r[c], -1) for c in columns]
    seen = exchanges(found)
    if not large:
        assert seen["BroadcastExchange"] - seen["ReusedExchange"] == 1 == len(small) - seen["ReusedExchange"]
    # the rows and the cells that come back to them by number; the cells and the levels by level
    assert seen["rows"] <= 2 and seen["Exchange hashpartitioning"] <= (4 if large else 0)


@pytest.mark.parametrize("levels", [60, 200_000])
def test_any_number_of_levels_trains(spark, levels):
    """As many levels as rows, and more than a driver would want to hold."""
    df = spark.range(levels).select(
        F.col("id").cast("string").alias("many"),
        F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("few"),
        (F.col("id") % 3 == 0).cast("int").alias("y"),
    )
    spec = FeatureSpec(("many", "few"))
    model = train_forest(df, spec, "y", trees=2, fraction=0.9)
    unseen = spark.createDataFrame([("zz", "x", 1), (None, "y", 0), ("", "x", 1)], "many string, few string, y int")
    found = predict(model, df.limit(500).unionByName(unseen))
    assert found.count() == min(levels, 500) + 3
    assert accuracy(found) == 1.0
    assert dict(model.preprocessor.sizes) == {"many": levels, "few": 2}


def test_nothing_to_learn_from(small):
    with pytest.raises(ValueError, match="nothing to learn"):
        fit_preprocessor(small.filter("isnan(size)"), SPEC)


def test_fill(small):
    assert [r.level for r in fill_missing(small, SPEC).collect()] == [
        "a", "b", "c", "missing", "",
    ]


@pytest.fixture(scope="module")
def labelled(spark):
    """The label follows level and size, with noise."""
    df = spark.range(0, 1200, 1, 4).select(
        "id",
        F.when(F.col("id") % 7 == 0, None).otherwise(F.chr(97 + F.col("id") % 3)).alias("level"),
        F.when(F.col("id") % 11 == 0, NAN).otherwise((F.col("id") % 20).cast("double")).alias("size"),
        (F.col("id") % 2).cast("string").alias("flag"),
    )
    rule = (F.col("level") == "a") | (F.col("size") > 14)
    noise = F.pmod(F.xxhash64("id"), F.lit(20)) == 0
    return df.withColumn("y", F.coalesce((rule != noise), F.lit(False)).cast("int")).persist()


def accuracy(df):
    return df.select(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]


def test_boosted_trees(labelled):
    train, held = split(labelled, "id")
    model = train_gbt(train, SPEC, "y", rounds=4)
    found = predict(model, held)
    assert found.columns == [*held.columns, "prediction", "score"]
    assert found.count() == held.count()
    assert accuracy(found) > 0.85
    assert found.filter("score < 0 OR score > 1").count() == 0
    # The learned levels and modes belong to the training rows; NULL and NaN are handled.
    assert found.filter("level IS NULL OR isnan(size)").count() > 0


def test_positions_of_levels(spark, small):
    """One slot per column: the place of the level, and -1 for an unseen one."""
    model = fit_preprocessor(small, SPEC)
    assert [v[0] for v in vectors(assemble(small, model, one_hot=False))] == [1, 2, 3, 4, 0]
    unseen = spark.createDataFrame([("zz", None, "1")], small.schema)
    assert vectors(assemble(unseen, model, one_hot=False)) == [[-1, 1, 1]]


def test_forest_is_repeatable(labelled):
    train, held = split(labelled, "id")
    made = [train_forest(train, SPEC, "y", trees=5, fraction=0.7) for _ in range(2)]
    wanted = ("id", "prediction", "score")
    first, second = [predict(m, held).select(*wanted).orderBy("id").collect() for m in made]
    assert first == second
    assert accuracy(predict(made[0], held)) > 0.8


def test_refit_sees_all_rows(labelled):
    refit = fit_validate_refit(labelled, SPEC, "y", "id", rounds=2)
    rows = {r[VALIDATION]: r for r in refit.metrics.collect()}
    train, held = split(labelled, "id")
    assert rows[False].support == train.count() and rows[True].support == held.count()
    assert rows[True].f1 > 0.8
    # A level that only the validation rows have is known to the final model alone.
    odd = labelled.withColumn("level", F.when(F.col("id") == held.first().id, "odd").otherwise(
        F.col("level")))
    models = fit_validate_refit(odd, SPEC, "y", "id", rounds=1)
    levels = [
        {r.level for r in m.preprocessor.levels.collect()} for m in (models.validated, models.model)
    ]
    assert "odd" not in levels[0] and "odd" in levels[1]


def test_regression(spark):
    df = spark.range(300).select(
        F.array((F.col("id") % 10).cast("double"), F.lit(1.0)).alias("a"),
        (F.col("id") % 10 % 3).alias("code"),
    )
    from pyspark.ml.functions import array_to_vector

    df = df.select("code", array_to_vector("a").alias("features"))
    model = train_gbt_regressor(df, "features", "code", rounds=3, depth=4)
    errors = model.transform(df).select(F.max(F.abs(F.col("prediction") - F.col("code"))))
    assert errors.first()[0] < 0.5


def test_stopping_rule():
    flat = [0.5] * 30
    assert trials_until_stop(flat, 25, 0.5) == 25
    assert trials_until_stop(flat[:24], 25, 0.5) is None
    # A gain of just half a percent is none; a larger one starts the row again.
    assert trials_until_stop([0.5, 0.4975, 0.5], 3, 0.5) == 3
    assert trials_until_stop([0.5, 0.49, 0.5, 0.5], 3, 0.5) is None
    assert trials_until_stop([0.5, 0.49, 0.5, 0.5, 0.5], 3, 0.5) == 5
    assert trials_until_stop([], 3, 0.5) is None


def test_settings_are_drawn_by_seed():
    settings = SearchSpace().draw(200, 50)
    assert settings == SearchSpace().draw(200, 50) and settings[:5] == SearchSpace().draw(5, 50)
    assert settings != SearchSpace().draw(200, 51)
    trees, fractions = zip(*settings)
    assert min(trees) >= 20 and max(trees) <= 100 and all(isinstance(t, int) for t in trees)
    assert min(fractions) >= 0.5 and max(fractions) <= 0.9


def test_search_does_not_depend_on_parallelism(spark, labelled):
    train, held = split(labelled, "id")
    space = SearchSpace(trees=(2, 6))
    found = [
        search(train, held, SPEC, "y", space, max_trials=6, patience=3, parallelism=n)
        for n in (1, 4)
    ]
    assert found[0] == found[1]
    assert found[0].best.loss == min(t.loss for t in found[0].trials)
    frame = found[0].to_df(spark)
    assert frame.count() == len(found[0].trials)
    one = frame.first()
    assert one.f1 == round(one.f1, 3) and one.loss == found[0].trials[0].loss
    best = fit_best(train, SPEC, "y", found[0])
    assert best.trees.getNumTrees == found[0].best.trees
    tie = SearchResult(tuple(Trial(i, 2, 0.5, 0.1, 1, 1, 0.9) for i in range(2)))
    assert tie.best.trial == 0


def test_search_learns_from_its_trials(spark, labelled):
    """The same random beginning, then settings of its own, whatever the number of threads."""
    noisy = labelled.withColumn("y", F.when(F.col("id").cast("int") % 4 == 0, 1 - F.col("y")).otherwise(F.col("y")))
    train, held = split(noisy, "id")
    space = SearchSpace(trees=(1, 9), fraction=(0.1, 0.9))
    found = [
        search(train, held, SPEC, "y", space, max_trials=8, parallelism=n, startup=5, ahead=2)
        for n in (1, 3)
    ]
    assert found[0] == found[1] and len(found[0].trials) == 8
    settings = [(t.trees, t.fraction) for t in found[0].trials]
    drawn = space.draw(8, 50)
    assert settings[:5] == drawn[:5] and not set(settings[5:]) & set(drawn[5:])
    assert len({t.loss for t in found[0].trials}) > 1


def test_stored_model_scores_tables_and_ids(spark, labelled, tmp_path):
    source = f"{tmp_path}/features"
    labelled.drop("y").write.parquet(source)
    lookups = (
        FeatureLookup(source, ("level", "size"), "id"),
        FeatureLookup(source, ("flag",), "id"),
    )
    rows = training_set(labelled.select("id", "y"), lookups, "y", ["id"])
    model = train_forest(rows.df, SPEC, "y", trees=3, fraction=0.7)
    path = f"{tmp_path}/model"
    save_model(StoredModel(model, rows.lookups), path, spark)
    loaded = load_model(spark, path)
    assert (loaded.spec, loaded.lookups) == (SPEC, lookups)

    table = labelled.withColumn("other", F.lit("kept"))
    scored = score(table, loaded)
    assert scored.columns == [*table.columns, "predictions"]
    assert scored.schema["predictions"].dataType.simpleString() == "double"
    by_id = {r.id: r.predictions for r in scored.collect()}
    with_chance = score(table, loaded, probability="chance")
    assert with_chance.columns == [*scored.columns, "chance"]
    assert with_chance.filter((F.col("chance") > 0.5) != (F.col("predictions") == 1)).count() == 0
    found = evaluate_model(table, loaded, "y").first()
    assert found.example_count == 1200 and found.accuracy == pytest.approx(accuracy(
        scored.withColumnRenamed("predictions", "prediction")))
    runs = spark.createDataFrame([("r", path)], "run_id string, location string")
    versions = spark.createDataFrame(
        [("m", 1, "r", "Production"), ("n", 1, "q", "Production")],
        "name string, version int, run_id string, stage string",
    )
    assert load_current(spark, versions, runs, "m").spec == SPEC
    with pytest.raises(LookupError):
        load_current(spark, versions, runs, "n")

    ids = labelled.select("id").union(spark.createDataFrame([(10**6,)], "id bigint"))
    batch = score_batch(ids, loaded)
    assert batch.columns == ["id", "level", "size", "flag", "prediction"]
    found = {r.id: r.prediction for r in batch.filter("flag IS NOT NULL").collect()}
    assert found == by_id
    # An id without features is scored, too.
    assert batch.filter(F.col("id") == 10**6).first().prediction in (0.0, 1.0)
    with pytest.raises(ValueError, match="absent"):
        score(table.drop("size"), loaded)
    with pytest.raises(TypeError, match="name or path"):
        unnamed = (FeatureLookup(labelled, ("size",), "id"),)
        save_model(StoredModel(model, unnamed), path, spark)


def test_add_n(spark):
    df = spark.createDataFrame([(1, 0.5)], "a int, b double")
    assert tuple(add_n(df, 5).first()) == (6, 5.5)
    assert "Python" not in add_n(df, 5)._jdf.queryExecution().executedPlan().toString()


def test_python_model_loads_once_per_task(spark, tmp_path):
    artifact = tmp_path / f"weights-{uuid.uuid4().hex}.txt"
    artifact.write_text("2.0")
    loads = tmp_path / "loads"
    loads.mkdir()

    def load(path):
        (loads / uuid.uuid4().hex).touch()
        return float(open(path).read())

    def double(weight, rows):
        assert list(rows.columns) == ["x"]
        return rows["x"] * weight

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        df = spark.range(0, 100, 1, 2).select("id", F.col("id").alias("x"), F.lit(0).alias("z"))
        found = score_python(df, ["x"], load, double, keep=["id"], artifact=str(artifact))
        assert found.dtypes == [("id", "bigint"), ("predictions", "double")]
        assert {r.id: r.predictions for r in found.collect()} == {i: i * 2.0 for i in range(100)}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(list(loads.iterdir())) == 2
    empty = score_python(df.filter("id < 0"), ["x"], load, double, artifact=str(artifact))
    assert empty.count() == 0
