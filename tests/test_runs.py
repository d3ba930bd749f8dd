"""Runs, versions, stages."""

from __future__ import annotations

import uuid

import pytest

from featloom.operators.runs import (
    add_versions,
    champion,
    champion_per_group,
    current,
    current_versions,
    log_metrics,
    metrics_wide,
    next_versions,
    promote,
    run,
)

from featloom.sources.registry import (
    create_metrics,
    create_versions,
    promote_stored,
    record_metrics,
    register,
)


@pytest.fixture
def runs(spark):
    return spark.createDataFrame(
        [("r1", "g", 0.7), ("r2", "g", None), ("r3", "g", 0.9), ("r0", "g", 0.9), ("r9", "h", None),
         ("r4", "g", float("nan")), ("r8", "h", float("nan"))],
        "run_id string, experiment string, f1_score double",
    )


VERSIONS = "name string, version int, run_id string, stage string"


@pytest.fixture
def versions(spark):
    return spark.createDataFrame(
        [("m", 1, "r1", "Production"), ("m", 2, "r2", "None"), ("n", 1, "r3", "Staging")], VERSIONS
    )


def test_champion(runs):
    assert champion(runs, "f1_score").first().run_id == "r0"
    found = champion_per_group(runs, "f1_score", "experiment")
    assert found.columns == runs.columns
    assert {r.experiment: r.run_id for r in found.collect()} == {"g": "r0", "h": "r8"}


def test_large_groups_are_cut_before_the_shuffle(runs):
    plan = champion_per_group(runs, "f1_score", "experiment")._jdf.queryExecution()
    assert plan.executedPlan().toString().count("WindowGroupLimit") == 2


@pytest.mark.parametrize("ranges", [None, 30])
def test_versions_are_consecutive(spark, versions, ranges):
    new = [("m", f"s{i:03d}") for i in range(300)] + [("k", "t1"), ("k", "t2"), ("n", "u")]
    frame = spark.createDataFrame(new, "name string, run_id string")
    found = {(r.name, r.run_id): r.version for r in next_versions(
        versions, frame, ranges).collect()}
    assert found == {
        **{("m", f"s{i:03d}"): i + 3 for i in range(300)},
        ("k", "t1"): 1,
        ("k", "t2"): 2,
        ("n", "u"): 2,
    }
    everything = add_versions(versions, frame)
    assert everything.schema.fieldNames() == versions.schema.fieldNames()
    assert everything.count() == 306


def test_promotion(spark, versions):
    chosen = spark.createDataFrame([("m", 2)], "name string, version int")
    found = promote(versions, chosen)
    assert {(r.name, r.version): r.stage for r in found.collect()} == {
        ("m", 1): "Archived", ("m", 2): "Production", ("n", 1): "Staging",
    }
    assert sorted(promote(found, chosen).collect()) == sorted(found.collect())
    held = current_versions(found).collect()
    assert [(r.name, r.version) for r in held] == [("m", 2)]
    for bad in ([("m", 5)], [("x", 1)], [("m", 1), ("m", 2)]):
        with pytest.raises((LookupError, ValueError)):
            promote(versions, spark.createDataFrame(bad, "name string, version int"))


def test_current(versions):
    assert current(versions, "m").first().run_id == "r1"
    assert current(versions, "n", "Staging").count() == 1
    with pytest.raises(LookupError, match="no version of n in stage Production"):
        current(versions, "n")


def test_metrics(spark):
    empty = spark.createDataFrame([], "run_id string, metric string, value double")
    logged = log_metrics(empty, {"r1": {"f1": 0.5, "loss": 1}, "r2": {"f1": 0.7}})
    found = {r.run_id: (r.f1, r.loss) for r in metrics_wide(logged, ["f1", "loss"]).collect()}
    assert found == {"r1": (0.5, 1.0), "r2": (0.7, None)}


def test_run_location(spark):
    df = spark.createDataFrame([("r1", "/a"), ("r2", "/b")], "run_id string, location string")
    assert [tuple(r) for r in run(df, "r2").collect()] == [("r2", "/b")]


def test_promotion_takes_few_jobs(spark, versions):
    """One check before the result; small promotions are neither sketched nor looked up again."""
    chosen = spark.createDataFrame([("m", 2)], "name string, version int")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("promotion", "promotion")
    promote(versions, chosen)
    jobs = len(tracker.getJobIdsForGroup("promotion"))
    spark.sparkContext.setJobGroup("rest", "rest")
    assert jobs <= 7


def test_stored_tables(spark, tmp_path):
    name = f"metrics_{uuid.uuid4().hex}"
    assert create_metrics(spark, name) and not create_metrics(spark, name)
    record_metrics(spark, name, {"r1": {"f1": 0.5, "loss": 1}, "r2": {"f1": 0.7}})
    found = record_metrics(spark, name, {"r1": {"f1": 0.6}})
    assert sorted(map(tuple, found.collect())) == [("r1", "f1", 0.6), ("r1", "loss", 1.0), ("r2", "f1", 0.7)]

    name = f"versions_{uuid.uuid4().hex}"
    create_versions(spark, name, f"{tmp_path}/versions")
    new = spark.createDataFrame([("m", "r1"), ("m", "r2"), ("n", "r3")], "name string, run_id string")
    register(spark, name, new)
    promote_stored(spark, name, spark.createDataFrame([("m", 1)], "name string, version int"))
    found = promote_stored(spark, name, spark.createDataFrame([("m", 2)], "name string, version int"))
    assert sorted(map(tuple, found.collect())) == [
        ("m", 1, "r1", "Archived"), ("m", 2, "r2", "Production"), ("n", 1, "r3", "None"),
    ]
