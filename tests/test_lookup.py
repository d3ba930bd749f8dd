"""Lookups, training sets, hot keys, splits."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from featloom.operators.lookup import (
    FeatureLookup,
    feature_columns,
    lookup,
    lookup_all,
    training_set,
)
from featloom.operators.skew import find_hot_keys, key_hash
from featloom.operators.split import mark_split, split
from featloom.sources.feature_tables import create_feature_table, drop_feature_table, merge


@pytest.fixture
def spine(spark):
    return spark.createDataFrame([(1, 0), (2, 1), (9, 1), (None, 0)], "id bigint, y int")


@pytest.fixture
def features(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id bigint, f string, g double")


def test_missing_keys_give_null(spine, features):
    found = lookup(spine, FeatureLookup(features, ("f",), "id"))
    assert found.columns == ["id", "y", "f"]
    assert {(r.id, r.f) for r in found.collect()} == {
        (1, "a"), (2, "b"), (9, None), (None, None),
    }


def test_lookups_in_order_and_by_other_names(spine, features):
    other = features.select(F.col("f").alias("name"), F.col("g").alias("size"))
    found = lookup_all(
        spine,
        [FeatureLookup(features, ("f",), "id"), FeatureLookup(other, ("size",), "f", "name")],
    )
    assert found.columns == ["id", "y", "f", "size"]
    assert {(r.id, r.size) for r in found.collect()} == {
        (1, 1.0), (2, 2.0), (9, None), (None, None),
    }


def test_training_set(spine, features):
    made = training_set(spine, [FeatureLookup(features, ("f", "g"), "id")], "y", ["id"])
    assert made.df.columns == ["y", "f", "g"]
    assert made.features == ["f", "g"]
    assert made.df.count() == spine.count()
    assert feature_columns(spine, "y", ["id"]) == []


def test_errors(spine, features, spark):
    with pytest.raises(ValueError, match="exist already"):
        lookup(spine.withColumn("f", F.lit(1)), FeatureLookup(features, ("f",), "id"))
    with pytest.raises(TypeError, match="another type"):
        as_text = features.withColumn("id", F.col("id").cast("string"))
        lookup(spine, FeatureLookup(as_text, ("f",), "id"))
    with pytest.raises(ValueError, match="duplicate"):
        lookup(spine, FeatureLookup(features.union(features), ("f",), "id"))
    with pytest.raises(ValueError, match="label"):
        training_set(spine, [], "z")


def skewed(spark):
    """One key and NULL hold two thirds of the rows; rows of a key are all equal."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 500)
    return spark.range(0, 30000, 1, 8).select(key.cast("bigint").alias("id"))


def hashes(hot):
    return {r[0] for r in hot.hashes.collect()}


def test_hot_keys_are_found(spark):
    hot = find_hot_keys(skewed(spark), [["id"]], partitions=100)[0]
    wanted = spark.createDataFrame([(7,), (None,)], "id bigint").select(key_hash(["id"])).collect()
    assert hashes(hot) == {r[0] for r in wanted}
    even = spark.range(30000).select((F.col("id") % 1000).alias("id"))
    assert not find_hot_keys(even, [["id"]], partitions=100)[0]


def test_small_shares_are_hot_with_many_partitions(spark):
    """With 10,000 partitions a key with 0.05 % of the rows holds five mean partitions."""
    key = F.when(F.col("id") % 2000 == 0, -1).otherwise(F.col("id"))
    df = spark.range(0, 400_000, 1, 8).select(key.alias("id"))
    wanted = spark.createDataFrame([(-1,)], "id bigint").select(key_hash(["id"])).first()[0]
    assert hashes(find_hot_keys(df, [["id"]], partitions=10_000)[0]) == {wanted}
    assert not find_hot_keys(df, [["id"]], partitions=1000)[0]


def test_several_keys_in_one_scan(spark):
    df = skewed(spark).withColumn("k", F.lit("same"))
    both = find_hot_keys(df, [["id"], ["k"], ["id", "k"]], partitions=100)
    assert [len(hashes(hot)) for hot in both] == [2, 1, 2]
    assert not find_hot_keys(df.filter("k = 'none'"), [["id"]])[0]


def test_lookup_with_hot_keys_is_the_plain_lookup(spark):
    df = skewed(spark)
    features = spark.range(400).select("id", (F.col("id") * 2).alias("f"))
    hot = find_hot_keys(df, [["id"]], partitions=100)[0]
    one = FeatureLookup(features, ("f",), "id")
    two = FeatureLookup(features.withColumnRenamed("f", "g"), ("g",), "id")

    def counted(found):
        return sorted(map(str, found.groupBy("id", "f", "g").count().collect()))

    assert hot
    assert counted(lookup_all(df, [one, two], {"id": hot})) == counted(
        lookup_all(df, [one, two], {})
    )


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_same_key_lookups_shuffle_the_spine_once(spark, no_broadcast):
    df = skewed(spark)
    features = spark.range(400).select("id", (F.col("id") * 2).alias("f"))
    lookups = [
        FeatureLookup(features, ("f",), "id"),
        FeatureLookup(features.withColumnRenamed("f", "g"), ("g",), "id"),
    ]
    found = lookup_all(df, lookups, {"id": find_hot_keys(df, [["id"]], partitions=100)[0]})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3


def test_stored_side_keeps_its_buckets_under_a_hot_key(spark, no_broadcast):
    name = f"stored_{uuid.uuid4().hex}"
    rows = spark.range(400).select("id", (F.col("id") * 2).alias("f"))
    create_feature_table(spark, name, "id", rows.schema, buckets=8)
    merge(spark, name, rows)
    df = skewed(spark)
    found = lookup(df, FeatureLookup(name, ("f",), "id"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan
    plain = df.join(rows, "id", "left")
    assert sorted(map(str, found.groupBy("id", "f").count().collect())) == sorted(
        map(str, plain.groupBy("id", "f").count().collect())
    )
    drop_feature_table(spark, name)


def test_small_tables_need_no_detection(spark, monkeypatch):
    import featloom.operators.lookup as module

    monkeypatch.setattr(module, "find_hot_keys", None)
    small = spark.range(7, 8).select("id", F.lit(1).alias("f"))
    assert lookup(skewed(spark), FeatureLookup(small, ("f",), "id")).count() == 30000


def test_split_does_not_depend_on_placement(spark):
    df = spark.range(20000).withColumnRenamed("id", "key")
    train, validation = split(df, "key")
    assert train.count() + validation.count() == 20000
    assert 0.24 < validation.count() / 20000 < 0.26
    first = {r.key for r in validation.collect()}
    for parts in (3, 7):
        again = split(df.repartition(parts), "key")[1]
        assert {r.key for r in again.collect()} == first
    assert {r.key for r in split(df, "key", seed=124)[1].collect()} != first
    assert "Exchange" not in mark_split(df, "key")._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="percentage"):
        split(df, "key", test=0.123)


def scanned_files(df):
    """The names of the files that the scans of a plan open."""
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves()
    out = []
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        if leaf.getClass().getSimpleName() == "FileSourceScanExec":
            for part in leaf.inputRDDs().apply(0).partitions():
                out += [f.toPath().getName() for f in part.files()]
    return out


def test_few_ids_read_few_buckets(spark, tmp_path):
    """Twenty ids against a table in 64 buckets: the scan opens the buckets they hash to, and no others."""
    name = f"few_{uuid.uuid4().hex}"
    rows = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") * 2).alias("twice"))
    create_feature_table(spark, name, "key", rows.schema, buckets=64, location=f"{tmp_path}/t")
    merge(spark, name, rows)
    ids = [f"k{k * 131}" for k in range(18)] + [None, "nobody"]
    spine = spark.createDataFrame([(k,) for k in ids], "key string")
    one = FeatureLookup(name, ("twice",), "key")
    found = lookup_all(spine, [one], few=20)
    assert {(r["key"], r["twice"]) for r in found.collect()} == {
        (k, int(k[1:]) * 2 if k and k != "nobody" else None) for k in ids
    }
    buckets = {
        r[0]
        for r in spine.where("key IS NOT NULL").select(F.expr("pmod(hash(key), 64)")).collect()
    }
    # the number of a bucket stands at the end of its files' names
    read = [int(f.split("_")[1].split(".")[0]) for f in scanned_files(one.read(spark, ids[:18] + ["nobody"]))]
    assert set(read) == buckets and len(read) < 64
    assert set(read) == {int(f.split("_")[1].split(".")[0]) for f in scanned_files(found)}
    # one id more than few: the whole table
    whole = lookup_all(spine, [one], few=18)
    assert len(scanned_files(whole)) >= 64
    assert {tuple(r) for r in whole.collect()} == {tuple(r) for r in found.collect()}
    drop_feature_table(spark, name)
