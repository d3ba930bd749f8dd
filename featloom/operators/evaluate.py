"""Classifier metrics as aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.functions.numeric import ratio
from featloom.operators.ranking import running_totals

# Fixed value: probabilities are kept this far from 0 and 1 in the log loss.
LOG_LOSS_EPSILON = 1e-15


def _given(name: str, double: bool = False) -> Column:
    """A column that must not be missing: NULL (and NaN in a double) stops the query."""
    value = F.col(name).cast("double") if double else F.col(name)
    absent = value.isNull() | F.isnan(value.cast("double"))
    return F.when(absent, F.raise_error(F.lit(f"{name}: value missing"))).otherwise(value)


def _f1(precision: Column, recall: Column) -> Column:
    return ratio(2 * precision * recall, precision + recall)


def weighted_prf(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """Support-weighted ``precision``, ``recall`` and ``f1``: one row, or one per group of ``by``.

    F1 is the weighted mean of the classes' F1. A class that is never predicted has precision 0.
    A missing label or prediction is an error. The data is read once and counted per (label,
    prediction) before the shuffle; the rest works on those counts.
    """
    counts = df.groupBy(
        *by,
        _given(label, double=True).alias("__label"),
        _given(prediction, double=True).alias("__prediction"),
    ).agg(F.count(F.lit(1)).alias("__n"))
    hit = F.when(F.col("__label") == F.col("__prediction"), F.col("__n")).otherwise(0)
    sides = F.array(
        F.struct(
            F.col("__label").alias("class"),
            F.col("__n").alias("support"),
            F.lit(0).cast("bigint").alias("predicted"),
            hit.alias("hits"),
        ),
        F.struct(
            F.col("__prediction").alias("class"),
            F.lit(0).cast("bigint").alias("support"),
            F.col("__n").alias("predicted"),
            F.lit(0).cast("bigint").alias("hits"),
        ),
    )
    classes = (
        counts.select(*by, F.inline(sides))
        .groupBy(*by, "class")
        .agg(
            F.sum("support").alias("support"),
            F.sum("predicted").alias("predicted"),
            F.sum("hits").alias("hits"),
        )
        .withColumns(
            {
                "p": ratio(F.col("hits"), F.col("predicted")),
                "r": ratio(F.col("hits"), F.col("support")),
            }
        )
        .withColumn("f", _f1(F.col("p"), F.col("r")))
    )
    weight = F.sum("support")
    return classes.groupBy(*by).agg(
        ratio(F.sum(F.col("p") * F.col("support")), weight).alias("precision"),
        ratio(F.sum(F.col("r") * F.col("support")), weight).alias("recall"),
        ratio(F.sum(F.col("f") * F.col("support")), weight).alias("f1"),
        weight.alias("support"),
    )


def round_metrics(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Round the named columns (all doubles if none is named) for a report."""
    chosen = names or [n for n, kind in df.dtypes if kind == "double"]
    return df.withColumns({n: F.round(n, digits) for n in chosen})


def compare_splits(
    df: DataFrame, split_column: str, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """The metrics of :func:`weighted_prf` side by side for every split, from one scan."""
    return weighted_prf(df, label, prediction, by=[split_column])


def _outcomes(label: Column, predicted: Column, n: Column) -> dict[str, Column]:
    def total(is_label: int, is_predicted: int) -> Column:
        chosen = (label == is_label) & (predicted == is_predicted)
        return F.coalesce(F.sum(F.when(chosen, n)), F.lit(0).cast("bigint"))

    return {
        "true_negatives": total(0, 0),
        "false_positives": total(0, 1),
        "false_negatives": total(1, 0),
        "true_positives": total(1, 1),
        "example_count": F.sum(n),
    }


def _binary_rates(counts: DataFrame) -> DataFrame:
    tp = F.col("true_positives")
    rated = counts.withColumns(
        {
            "accuracy": ratio(tp + F.col("true_negatives"), F.col("example_count")),
            "precision": ratio(tp, tp + F.col("false_positives")),
            "recall": ratio(tp, tp + F.col("false_negatives")),
        }
    )
    return rated.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Outcome counts of a 0/1 classifier with accuracy, precision, recall and F1 of class 1."""
    outcomes = _outcomes(_given(label), _given(prediction), F.lit(1).cast("bigint"))
    return _binary_rates(df.agg(*[c.alias(name) for name, c in outcomes.items()]))


def _row_loss(label: Column, score: Column) -> Column:
    kept = F.least(F.greatest(score, F.lit(LOG_LOSS_EPSILON)), F.lit(1 - LOG_LOSS_EPSILON))
    return -F.when(label == 1, F.log(kept)).otherwise(F.log(1 - kept))


def log_loss(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Mean negative log likelihood of 0/1 labels, as ``log_loss``."""
    return df.agg(F.avg(_row_loss(_given(label), _given(score))).alias("log_loss"))


def _curve(counted: DataFrame, ranges: int | None) -> DataFrame:
    """Per distinct score the positives and negatives at or above it."""
    return running_totals(
        counted,
        order="score",
        totals={"tp": F.col("positives"), "fp": F.col("negatives")},
        descending=True,
        ranges=ranges,
    )


def _areas() -> list[Column]:
    """Both areas by trapezoids between neighbouring scores, from aggregates over the curve.

    The point before a score is had by taking off the score's own counts, so no row looks at
    another. The precision-recall curve starts at recall 0 with precision 1.
    """
    positives, negatives = F.sum("positives"), F.sum("negatives")
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    tp_before, fp_before = tp - F.col("positives"), fp - F.col("negatives")
    precision_before = F.when(
        tp_before + fp_before > 0, ratio(tp_before, tp_before + fp_before)
    ).otherwise(1.0)
    roc = F.sum(F.col("negatives") * (tp + tp_before) / 2)
    pr = F.sum(F.col("positives") * (ratio(tp, tp + fp) + precision_before) / 2)
    both = (positives > 0) & (negatives > 0)
    return [
        F.when(
            both, ratio(roc, positives.cast("double") * negatives.cast("double"))
        ).alias("roc_auc"),
        F.when(positives > 0, ratio(pr, positives)).alias("pr_auc"),
    ]


def ranking_areas(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
    ranges: int | None = None,
) -> DataFrame:
    """Exact ``roc_auc`` and ``pr_auc`` of 0/1 labels; NULL where a class is missing.

    Rows are first counted per distinct score, then ranked in ranges of the score, so neither a
    frequent score nor the whole table meets in one task.
    """
    positive = F.when(_given(label) == 1, 1).otherwise(0)
    counted = df.groupBy(_given(score).alias("score")).agg(
        F.sum(positive).alias("positives"), F.sum(1 - positive).alias("negatives")
    )
    return _curve(counted, ranges).agg(*_areas())


def evaluate_classifier(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    score: str = "score",
    ranges: int | None = None,
) -> DataFrame:
    """All metrics of a 0/1 classifier in one row, from one scan of the predictions.

    A missing label, prediction or score is an error.
    """
    positive = F.when(_given(label) == 1, 1).otherwise(0)
    one = F.lit(1).cast("bigint")
    outcomes = _outcomes(F.col(label), _given(prediction), one)
    counted = df.groupBy(_given(score).alias("score")).agg(
        F.sum(positive).alias("positives"),
        F.sum(1 - positive).alias("negatives"),
        F.sum(_row_loss(F.col(label), F.col(score))).alias("loss"),
        *[c.alias(name) for name, c in outcomes.items()],
    )
    totals = [F.sum(name).alias(name) for name in outcomes]
    loss = ratio(F.sum("loss"), F.sum("example_count")).alias("log_loss")
    return _binary_rates(_curve(counted, ranges).agg(*totals, loss, *_areas()))
