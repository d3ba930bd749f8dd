"""Metrics against MLlib's evaluators and against plain arithmetic."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from featloom.operators.evaluate import (
    compare_splits,
    confusion,
    evaluate_classifier,
    log_loss,
    ranking_areas,
    round_metrics,
    weighted_prf,
)


@pytest.fixture(scope="module")
def graded(spark):
    """Two thirds of the rows have the same score."""
    draw = random.Random(11)
    rows = []
    for i in range(3000):
        label = int(draw.random() < 0.3)
        score = 0.5 if i % 3 else round(min(1.0, max(0.0, draw.gauss(0.4 + 0.2 * label, 0.2))), 3)
        rows.append((label, float(score > 0.5), score, "ab"[i % 2]))
    df = spark.createDataFrame(rows, "label int, prediction double, score double, part string")
    return df.persist()


def test_weighted_metrics_agree_with_mllib(graded):
    found = weighted_prf(graded).first()
    cast = graded.withColumn("label", F.col("label").cast("double"))
    for name, metric in (
        ("precision", "weightedPrecision"),
        ("recall", "weightedRecall"),
        ("f1", "f1"),
    ):
        wanted = MulticlassClassificationEvaluator(metricName=metric).evaluate(cast)
        assert found[name] == pytest.approx(wanted, abs=1e-12)
    assert found.support == 3000


def test_weighted_metrics_by_hand(spark):
    """Class 2 is never predicted, class 3 never occurs."""
    df = spark.createDataFrame(
        [(0, 0), (0, 0), (0, 1), (1, 1), (2, 0), (2, 3)], "label int, prediction int"
    )
    found = weighted_prf(df).first()
    assert found.precision == pytest.approx((3 * 2 / 3 + 1 * 1 / 2) / 6)
    assert found.recall == pytest.approx((3 * 2 / 3 + 1 * 1) / 6)
    assert found.f1 == pytest.approx((3 * 2 / 3 + 1 * 2 / 3) / 6)


def test_rounding_is_for_the_report_only(graded):
    found = weighted_prf(graded)
    rounded = round_metrics(found, 2).first()
    assert rounded.f1 == round(found.first().f1, 2)
    assert round_metrics(found, 2, "f1").first().recall == found.first().recall


def test_splits_side_by_side(graded):
    found = {r.part: r for r in compare_splits(graded, "part").collect()}
    for part in "ab":
        alone = weighted_prf(graded.filter(F.col("part") == part)).first()
        assert (found[part].f1, found[part].support) == (alone.f1, alone.support)


@pytest.mark.parametrize("ranges", [None, 20])
def test_areas(graded, ranges):
    found = ranking_areas(graded, ranges=ranges).first()
    exact = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert found.roc_auc == pytest.approx(exact.evaluate(graded), abs=1e-12)
    # MLlib starts the other curve elsewhere; the first step is the only difference.
    near = exact.evaluate(graded, {exact.metricName: "areaUnderPR"})
    assert found.pr_auc == pytest.approx(near, abs=0.01)


def test_areas_by_hand(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1)], "label int, score double")
    found = ranking_areas(df).first()
    assert found.roc_auc == pytest.approx(3.5 / 4)
    assert found.pr_auc == pytest.approx(0.5 * (1 + 1) / 2 + 0.5 * (1 + 2 / 3) / 2)
    alone = ranking_areas(df.filter("label = 1")).first()
    assert (alone.roc_auc, alone.pr_auc) == (None, 1.0)
    assert tuple(ranking_areas(df.filter("label = 5")).first()) == (None, None)


def test_confusion_and_loss_by_hand(spark):
    df = spark.createDataFrame(
        [(1, 1, 0.9), (1, 0, 0.2), (0, 1, 0.7), (0, 0, 0.0)],
        "label int, prediction int, score double",
    )
    found = confusion(df).first()
    assert tuple(found) == (1, 1, 1, 1, 4, 0.5, 0.5, 0.5, 0.5)
    wanted = -(math.log(0.9) + math.log(0.2) + math.log(0.3) + math.log(1 - 1e-15)) / 4
    assert log_loss(df).first().log_loss == pytest.approx(wanted)
    wrong = spark.createDataFrame([(1, 0.0)], "label int, score double")
    assert log_loss(wrong).first().log_loss == pytest.approx(-math.log(1e-15))
    none = confusion(df.filter("prediction = 0")).first()
    assert (none.precision, none.recall, none.f1) == (0.0, 0.0, 0.0)


@pytest.mark.parametrize("ranges", [None, 20])
def test_one_scan_gives_all_metrics(graded, ranges):
    found = evaluate_classifier(graded, ranges=ranges).first().asDict()
    parts = {
        **confusion(graded).first().asDict(),
        **log_loss(graded).first().asDict(),
        **ranking_areas(graded).first().asDict(),
    }
    assert found == pytest.approx(parts)
