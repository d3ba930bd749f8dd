"""Feature lookups, training sets, keyed feature tables, splits."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featloom.operators.lookup import FeatureLookup, lookup, lookup_all, training_set
from featloom.operators.split import VALIDATION, mark_exact_split, mark_split
from featloom.plans.passengers import (
    demographic_features,
    passenger_lookups,
    ticket_features,
)
from featloom.session import scratch_path
from featloom.sources.feature_tables import create_feature_table, merge
from workload.inputs import (
    AGE,
    CABIN_MULTI,
    NAME_PREFIX,
    NAME_SECONDARY,
    RAW_PASSENGERS,
    raw_passengers,
    table,
)


def feature_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with features of their customer; customers of one nation are NULL keys."""
    customer = table(spark, sf_dir, "customer")
    one = FeatureLookup(customer, ("c_acctbal", "c_mktsegment"), "customer_key", "c_custkey")
    spine = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("customer_key"),
    )
    return lookup(spine, one)


def _events_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_events"), F.max("value").alias("top_value")
    )


def _orders_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.round(F.sum("o_totalprice"), 2).alias("spent"),
    )


def multi_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their event and order features and the name of their nation."""
    return lookup_all(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
        [
            FeatureLookup(_events_by_user(spark, sf_dir), ("n_events", "top_value"), "c_custkey"),
            FeatureLookup(_orders_by_customer(spark, sf_dir), ("n_orders", "spent"), "c_custkey"),
            FeatureLookup(
                table(spark, sf_dir, "nation"), ("n_name",), "c_nationkey", "n_nationkey"
            ),
        ],
    )


def spine_and_lookups(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, tuple]:
    """Labelled documents as a spine, and the two lookups on the passenger-shaped documents."""
    spine = table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("PassengerId"), F.col("quality").alias("Survived")
    )
    raw = raw_passengers(spark, sf_dir)
    return spine, passenger_lookups(ticket_features(raw), demographic_features(raw))


def training(spark: SparkSession, sf_dir: str) -> DataFrame:
    spine, lookups = spine_and_lookups(spark, sf_dir)
    return training_set(spine, lookups, "Survived", ["PassengerId"]).df


def _balances(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customer balances, and updates: active users with a new balance, suppliers as new keys."""
    target = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    active = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.max("value").alias("c_acctbal")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal")
    )
    return target, active.unionByName(suppliers)


def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two merges into a new feature table: all customers, then the updates."""
    target, updates = _balances(spark, sf_dir)
    name = f"balances_{uuid.uuid4().hex}"
    create_feature_table(
        spark,
        name,
        "c_custkey",
        target.schema,
        "Balances by customer",
        buckets=int(spark.conf.get("spark.sql.shuffle.partitions")),
        location=scratch_path(spark, name),
    )
    merge(spark, name, target)
    return merge(spark, name, updates)


def upsert_few(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second merge with the richest customer of each nation only: it rewrites their buckets."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    name = f"balances_{uuid.uuid4().hex}"
    create_feature_table(spark, name, "c_custkey", customer.schema, buckets=64, location=scratch_path(spark, name))
    merge(spark, name, customer)
    richest = customer.groupBy("c_nationkey").agg(F.max(F.struct("c_acctbal", "c_custkey")).alias("top"))
    emptied = richest.select("top.c_custkey", "c_nationkey", F.lit(0.0).alias("c_acctbal"))
    return merge(spark, name, emptied)


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


def exact_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of which exactly a quarter, rounded up, is held out."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return mark_exact_split(orders, "o_orderkey")


def exact_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out line items by the key of their part: many rows share a hash, and the bound cuts through one."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber")
    marked = mark_exact_split(lines, "l_partkey", test=0.31, seed=5)
    held = F.count_if(VALIDATION).alias("held_out")
    return marked.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("rows"), held)


QUERIES = {
    "feature_lookup": feature_lookup,
    "multi_lookup": multi_lookup,
    "training_set": training,
    "upsert": upsert,
    "upsert_few": upsert_few,
    "hash_split": hash_split,
    "exact_shares": exact_shares,
    "exact_ties": exact_ties,
}

TRAINING_SET = f"""
{RAW_PASSENGERS},
training_set AS (
  SELECT l.doc_id, l.quality AS Survived, substr(Cabin, 1, 1) AS CabinChar,
         CASE WHEN raw.PassengerId IS NULL THEN NULL ELSE {CABIN_MULTI} END AS CabinMulti,
         Embarked, round(Fare, 0) AS FareRounded, Parch, Pclass, {AGE} AS Age,
         CASE WHEN raw.PassengerId IS NULL THEN NULL
              WHEN {NAME_SECONDARY} IS NOT NULL THEN '1' ELSE '0' END AS NameMultiple,
         {NAME_PREFIX} AS NamePrefix, Sex, SibSp
  FROM labels l LEFT JOIN raw ON CAST(l.doc_id AS VARCHAR) = raw.PassengerId)"""

ORACLES = {
    "feature_lookup": """
        SELECT o.o_orderkey,
               CASE WHEN o.o_orderstatus <> 'P' THEN o.o_custkey END AS customer_key,
               c.c_acctbal, c.c_mktsegment
        FROM orders o
        LEFT JOIN customer c ON o.o_orderstatus <> 'P' AND o.o_custkey = c.c_custkey""",
    "multi_lookup": """
        SELECT c.c_custkey, c.c_nationkey, e.n_events, e.top_value, o.n_orders, o.spent, n.n_name
        FROM customer c
        LEFT JOIN (SELECT user_id, count(*) AS n_events, max(value) AS top_value
                   FROM events GROUP BY user_id) e ON c.c_custkey = e.user_id
        LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS spent
                   FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey
        LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "training_set": f"WITH {TRAINING_SET} SELECT * EXCLUDE (doc_id) FROM training_set",
    "upsert": """
        WITH updates AS (
          SELECT user_id AS c_custkey, max(value) AS c_acctbal FROM events GROUP BY user_id
          UNION ALL SELECT -1 - s_suppkey, s_acctbal FROM supplier)
        SELECT c_custkey, c_acctbal FROM customer
        WHERE c_custkey NOT IN (SELECT c_custkey FROM updates)
        UNION ALL SELECT c_custkey, c_acctbal FROM updates""",
    "upsert_few": """
        SELECT c_custkey, c_nationkey,
               CASE WHEN row_number() OVER (PARTITION BY c_nationkey
                                            ORDER BY c_acctbal DESC, c_custkey DESC) = 1
                    THEN 0.0::DOUBLE ELSE c_acctbal END AS c_acctbal
        FROM customer""",
    "hash_split": """
        SELECT o_orderkey,
               ('0x' || substr(md5(concat('123:', o_orderkey)), 1, 8))::BIGINT % 100 < 25
                 AS is_validation
        FROM orders""",
    "exact_shares": """
        SELECT o_orderkey, row_number() OVER (ORDER BY hash) <= ceil(0.25 * count(*) OVER ()) AS is_validation
        FROM (SELECT o_orderkey, ('0x' || substr(md5(concat('123:', o_orderkey)), 1, 15))::BIGINT AS hash
              FROM orders)""",
    "exact_ties": """
        SELECT l_partkey, count(*) AS rows,
               greatest(0, least(count(*), ceil(0.31 * (SELECT count(*) FROM lineitem))::BIGINT
                 - (sum(count(*)) OVER (ORDER BY hash) - count(*))))::BIGINT AS held_out
        FROM (SELECT l_partkey, ('0x' || substr(md5(concat('5:', l_partkey)), 1, 15))::BIGINT AS hash
              FROM lineitem)
        GROUP BY l_partkey, hash""",
}
