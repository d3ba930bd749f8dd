"""Evaluation, runs and versions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
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
from featloom.operators.runs import (
    add_versions,
    champion,
    champion_per_group,
    current_versions,
    metrics_wide,
    promote,
    run,
)
from featloom.operators.split import mark_split
from featloom.session import scratch_path
from featloom.sources.feature_tables import create_feature_table, drop_feature_table, merge
from featloom.sources.registry import (
    create_metrics,
    create_versions,
    promote_stored,
    record_metrics,
    register,
)
from workload.inputs import GRADED, graded_documents, table

DIGITS = 6


def prf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_metrics(weighted_prf(graded_documents(spark, sf_dir)), DIGITS)


def prf_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = mark_split(graded_documents(spark, sf_dir), "doc_id")
    return round_metrics(compare_splits(marked, "is_validation"), DIGITS)


def confusion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_metrics(confusion(graded_documents(spark, sf_dir)), DIGITS)


def loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_metrics(log_loss(graded_documents(spark, sf_dir)), DIGITS)


def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_metrics(ranking_areas(graded_documents(spark, sf_dir)), DIGITS)


def evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_metrics(evaluate_classifier(graded_documents(spark, sf_dir)), DIGITS)


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as runs: the customer is the group, the price the metric.

    Open orders have none, and that of urgent ones is not a number.
    """
    score = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(float("nan"))).otherwise(
        F.col("o_totalprice")
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_custkey").alias("experiment"),
        F.when(F.col("o_orderstatus") != "O", score).alias("f1_score"),
    )


def best_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return champion(runs(spark, sf_dir), "f1_score")


def best_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return champion_per_group(runs(spark, sf_dir), "f1_score", "experiment")


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Finished orders as stored versions, the others as new ones; the market segment is the model."""
    by_segment = (
        table(spark, sf_dir, "orders")
        .join(
            table(spark, sf_dir, "customer").select(
                F.col("c_custkey").alias("o_custkey"), "c_mktsegment"
            ),
            "o_custkey",
        )
        .select("o_orderkey", "o_orderstatus", F.col("c_mktsegment").alias("name"))
    )
    stored = by_segment.filter("o_orderstatus = 'F' AND name <> 'MACHINERY'").select(
        "name",
        F.col("o_orderkey").cast("int").alias("version"),
        F.col("o_orderkey").alias("run_id"),
        F.lit("None").alias("stage"),
    )
    new = by_segment.filter("o_orderstatus <> 'F'").select(
        "name", F.col("o_orderkey").alias("run_id")
    )
    return stored, new


def next_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, new = _versions(spark, sf_dir)
    return add_versions(stored, new)


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as versions of their customer's model; the finished ones hold the stage."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("model_"), F.col("o_custkey").cast("string")).alias("name"),
        F.col("o_orderkey").cast("int").alias("version"),
        F.col("o_orderkey").alias("run_id"),
        F.when(F.col("o_orderstatus") == "F", "Production").otherwise("None").alias("stage"),
    )


def promoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promote the newest version of every model of the customers in one segment."""
    versions = _staged(spark, sf_dir)
    chosen = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(
        F.concat(F.lit("model_"), F.col("c_custkey").cast("string")).alias("name")
    )
    newest = versions.join(chosen, "name", "left_semi").groupBy("name").agg(
        F.max("version").alias("version")
    )
    return promote(versions, newest)


def current_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_versions(_staged(spark, sf_dir))


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def metrics_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    logged = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("run_id"),
        F.col("o_orderpriority").alias("metric"),
        F.col("o_totalprice").alias("value"),
    )
    return metrics_wide(logged, PRIORITIES)


def recorded_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table of metrics: the largest order of each priority, then urgent ones anew."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("run_id"),
        F.col("o_orderpriority").alias("metric"),
        F.col("o_totalprice").alias("value"),
    )
    largest = orders.groupBy("run_id", "metric").agg(F.max("value").alias("value"))
    again = largest.filter("metric = '1-URGENT'").withColumn("value", F.lit(0.0))
    more = largest.filter("metric = '5-LOW'").withColumn("metric", F.lit("low"))
    name = f"metrics_{uuid.uuid4().hex}"
    create_metrics(spark, name, scratch_path(spark, name))
    record_metrics(spark, name, largest)
    return record_metrics(spark, name, again.unionByName(more))


def registered_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table of versions: suppliers by nation, the newest of each nation promoted twice."""
    suppliers = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string")).alias("name"),
        F.format_string("s%010d", "s_suppkey").alias("run_id"),
        (F.col("s_acctbal") > 0).alias("early"),
    )
    name = f"versions_{uuid.uuid4().hex}"
    create_versions(spark, name, scratch_path(spark, name))
    for early in (True, False):
        register(spark, name, suppliers.filter(F.col("early") == early).select("name", "run_id"))
        newest = spark.table(name).groupBy("name").agg(F.max("version").alias("version"))
        promote_stored(spark, name, newest)
    return spark.table(name)


def run_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the runs of the largest order's customer lie; runs are orders, the file is the price."""
    runs_table = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run_id"), F.col("o_totalprice").cast("string").alias("location")
    )
    return run(runs_table, best_run(spark, sf_dir).first()["run_id"])


def dropped_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feature table of all customers: how many rows it has, and whether it is there once dropped."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    name = f"dropped_{uuid.uuid4().hex}"
    create_feature_table(spark, name, "c_custkey", customers.schema, location=scratch_path(spark, name))
    rows = merge(spark, name, customers).count()
    drop_feature_table(spark, name)
    there = spark.catalog.tableExists(name)
    return spark.createDataFrame([(rows, there)], "n_rows bigint, there boolean")


QUERIES = {
    "weighted_prf": prf,
    "prf_by_split": prf_by_split,
    "confusion": confusion_counts,
    "log_loss": loss,
    "roc_auc": roc_auc,
    "evaluate_classifier": evaluation,
    "best_run": best_run,
    "champion_per_group": best_by_group,
    "next_version": next_version,
    "promote": promoted,
    "current_version": current_version,
    "metrics_pivot": metrics_pivot,
    "recorded_metrics": recorded_metrics,
    "registered_versions": registered_versions,
    "run_location": run_locations,
    "dropped_table": dropped_table,
}


def _prf_sql(source: str, by: str) -> str:
    """Weighted metrics of ``source(label, prediction)`` per value of ``by``."""
    return f"""
        counts AS (
          SELECT {by} AS part, label, prediction, count(*) AS n FROM {source} GROUP BY ALL),
        classes AS (
          SELECT part, class, CAST(sum(support) AS DOUBLE) AS support,
                 CAST(sum(predicted) AS DOUBLE) AS predicted, CAST(sum(hits) AS DOUBLE) AS hits
          FROM (SELECT part, label AS class, n AS support, 0 AS predicted,
                       CASE WHEN label = prediction THEN n ELSE 0 END AS hits FROM counts
                UNION ALL SELECT part, prediction, 0, n, 0 FROM counts)
          GROUP BY part, class),
        rated AS (
          SELECT *, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS p,
                 CASE WHEN support > 0 THEN hits / support ELSE 0 END AS r FROM classes),
        scored AS (
          SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM rated)
        SELECT part, round(sum(p * support) / sum(support), 6) AS precision,
               round(sum(r * support) / sum(support), 6) AS recall,
               round(sum(f * support) / sum(support), 6) AS f1,
               CAST(sum(support) AS BIGINT) AS support
        FROM scored GROUP BY part"""


CONFUSION = """
  SELECT *, CASE WHEN precision + recall > 0
                 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1
  FROM (SELECT *, CAST(true_positives + true_negatives AS DOUBLE) / example_count AS accuracy,
               CAST(true_positives AS DOUBLE) / (true_positives + false_positives) AS precision,
               CAST(true_positives AS DOUBLE) / (true_positives + false_negatives) AS recall
        FROM (SELECT count(*) FILTER (label = 0 AND prediction = 0) AS true_negatives,
                     count(*) FILTER (label = 0 AND prediction = 1) AS false_positives,
                     count(*) FILTER (label = 1 AND prediction = 0) AS false_negatives,
                     count(*) FILTER (label = 1 AND prediction = 1) AS true_positives,
                     count(*) AS example_count FROM graded))"""

LOSS = """
  SELECT avg(-CASE WHEN label = 1 THEN ln(least(greatest(score, 1e-15), 1 - 1e-15))
                   ELSE ln(1 - least(greatest(score, 1e-15), 1 - 1e-15)) END) AS log_loss
  FROM graded"""

AREAS = """
by_score AS (
  SELECT score, CAST(sum(label) AS DOUBLE) AS pos, CAST(sum(1 - label) AS DOUBLE) AS neg
  FROM graded GROUP BY score),
curve AS (
  SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp
  FROM by_score),
steps AS (
  SELECT *, tp / (tp + fp) AS precision,
         coalesce(lag(tp / (tp + fp)) OVER (ORDER BY score DESC), 1) AS precision_before
  FROM curve),
areas AS (
  SELECT sum(neg * (tp - pos / 2)) / (sum(pos) * sum(neg)) AS roc_auc,
         sum(pos * (precision + precision_before) / 2) / sum(pos) AS pr_auc
  FROM steps)"""

RUNS = """
runs AS (
  SELECT o_orderkey AS run_id, o_custkey AS experiment,
         CASE WHEN o_orderstatus = 'O' THEN NULL
              WHEN o_orderpriority = '1-URGENT' THEN 'NaN'::DOUBLE
              ELSE o_totalprice END AS f1_score
  FROM orders)"""

ORACLES = {
    "weighted_prf": f"""
        WITH {GRADED}, {_prf_sql("graded", "1")}""".replace("SELECT part, round", "SELECT round"),
    "prf_by_split": f"""
        WITH {GRADED},
        marked AS (
          SELECT *, ('0x' || substr(md5(concat('123:', doc_id)), 1, 8))::BIGINT % 100 < 25
                      AS is_validation FROM graded),
        {_prf_sql("marked", "is_validation")}""".replace(
        "SELECT part, round", "SELECT part AS is_validation, round"
    ),
    "confusion": f"""
        WITH {GRADED}, outcomes AS ({CONFUSION})
        SELECT * REPLACE (round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
                          round(recall, 6) AS recall, round(f1, 6) AS f1) FROM outcomes""",
    "log_loss": f"""
        WITH {GRADED}, loss AS ({LOSS}) SELECT round(log_loss, 6) AS log_loss FROM loss""",
    "roc_auc": f"""
        WITH {GRADED}, {AREAS}
        SELECT round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc FROM areas""",
    "evaluate_classifier": f"""
        WITH {GRADED}, outcomes AS ({CONFUSION}), loss AS ({LOSS}), {AREAS}
        SELECT o.* REPLACE (round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
                            round(recall, 6) AS recall, round(f1, 6) AS f1),
               round(log_loss, 6) AS log_loss, round(roc_auc, 6) AS roc_auc,
               round(pr_auc, 6) AS pr_auc
        FROM outcomes o, loss, areas""",
    "best_run": f"""
        WITH {RUNS}
        SELECT * FROM runs
        ORDER BY CASE WHEN NOT isnan(f1_score) THEN f1_score END DESC NULLS LAST, run_id LIMIT 1""",
    "champion_per_group": f"""
        WITH {RUNS}
        SELECT * FROM runs
        QUALIFY row_number() OVER (
          PARTITION BY experiment
          ORDER BY CASE WHEN NOT isnan(f1_score) THEN f1_score END DESC NULLS LAST, run_id) = 1""",
    "next_version": """
        WITH models AS (
          SELECT o_orderkey, o_orderstatus, c_mktsegment AS name
          FROM orders JOIN customer ON o_custkey = c_custkey),
        stored AS (
          SELECT name, CAST(o_orderkey AS INTEGER) AS version, o_orderkey AS run_id
          FROM models WHERE o_orderstatus = 'F' AND name <> 'MACHINERY'),
        numbered AS (
          SELECT name, o_orderkey AS run_id,
                 row_number() OVER (PARTITION BY name ORDER BY o_orderkey) AS place
          FROM models WHERE o_orderstatus <> 'F'),
        highest AS (SELECT name, max(version) AS start FROM stored GROUP BY name)
        SELECT name, version, run_id, 'None' AS stage FROM stored
        UNION ALL
        SELECT n.name, CAST(coalesce(start, 0) + place AS INTEGER), run_id, 'None'
        FROM numbered n LEFT JOIN highest h ON n.name = h.name""",
    "promote": """
        WITH versions AS (
          SELECT 'model_' || o_custkey AS name, o_custkey, CAST(o_orderkey AS INTEGER) AS version,
                 o_orderkey AS run_id,
                 CASE WHEN o_orderstatus = 'F' THEN 'Production' ELSE 'None' END AS stage
          FROM orders),
        newest AS (
          SELECT name, max(version) AS promoted FROM versions
          WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
          GROUP BY name)
        SELECT v.name, v.version, v.run_id,
               CASE WHEN v.version = n.promoted THEN 'Production'
                    WHEN n.promoted IS NOT NULL AND v.stage = 'Production' THEN 'Archived'
                    ELSE v.stage END AS stage
        FROM versions v LEFT JOIN newest n ON v.name = n.name""",
    "current_version": """
        SELECT 'model_' || o_custkey AS name, CAST(o_orderkey AS INTEGER) AS version,
               o_orderkey AS run_id, 'Production' AS stage
        FROM orders WHERE o_orderstatus = 'F'
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""",
    "metrics_pivot": "SELECT o_custkey AS run_id, "
    + ", ".join(
        f"max(o_totalprice) FILTER (o_orderpriority = '{name}') AS \"{name}\""
        for name in PRIORITIES
    )
    + " FROM orders GROUP BY o_custkey",
    "recorded_metrics": """
        WITH largest AS (
          SELECT CAST(o_custkey AS VARCHAR) AS run_id, o_orderpriority AS metric,
                 max(o_totalprice) AS value
          FROM orders GROUP BY ALL)
        SELECT run_id, metric, CASE WHEN metric = '1-URGENT' THEN 0.0::DOUBLE ELSE value END AS value
        FROM largest
        UNION ALL SELECT run_id, 'low', value FROM largest WHERE metric = '5-LOW'""",
    "registered_versions": """
        WITH placed AS (
          SELECT 'nation_' || s_nationkey AS name, format('s{:010d}', s_suppkey) AS run_id,
                 s_acctbal > 0 AS early FROM supplier),
        numbered AS (
          SELECT name, run_id, early,
                 row_number() OVER (PARTITION BY name ORDER BY NOT early, run_id) AS version
          FROM placed),
        newest AS (
          SELECT name, max(version) AS last, max(version) FILTER (early) AS last_early
          FROM numbered GROUP BY name)
        SELECT n.name, CAST(version AS INTEGER) AS version, run_id,
               CASE WHEN version = last THEN 'Production'
                    WHEN version = last_early THEN 'Archived' ELSE 'None' END AS stage
        FROM numbered n JOIN newest m ON n.name = m.name""",
    "run_location": f"""
        WITH {RUNS}
        SELECT o_orderkey AS run_id, CAST(o_totalprice AS VARCHAR) AS location
        FROM orders
        WHERE o_orderkey = (
          SELECT run_id FROM runs
          ORDER BY CASE WHEN NOT isnan(f1_score) THEN f1_score END DESC NULLS LAST, run_id LIMIT 1)""",
    "dropped_table": "SELECT count(*) AS n_rows, false AS there FROM customer",
}
