"""Exact shares against sorting all hashes."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from featloom.operators.split import bound_of, exact_split, mark_exact_split


def plain(keys, test, seed=123):
    hashes = {k: int(hashlib.md5(f"{seed}:{k}".encode()).hexdigest()[:15], 16) for k in keys}
    return set(sorted(keys, key=hashes.get)[: math.ceil(test * len(keys))])


@pytest.mark.parametrize("n, test", [(1, 0.25), (2, 0.5), (101, 0.25), (1000, 0.2), (1000, 0.0), (37, 1.0), (30, 0.1)])
def test_exact_share(spark, n, test):
    keys = [f"k{k}" for k in range(n)]
    frame = spark.createDataFrame([(k,) for k in keys], "key string")
    for parts in (1, 13):
        train, held = exact_split(frame.repartition(parts), "key", test)
        found = {r["key"] for r in held.collect()}
        assert found == plain(keys, test) and train.count() == n - len(found)


def test_ties(spark):
    """A key with most of the rows lies across the bound, and many of its rows are equal."""
    rng = random.Random(0)
    rows = [("hot", rng.randrange(4), None) for _ in range(900)] + [("hot", 9, {"a": k}) for k in range(50)]
    rows += [(f"k{k}", k, None) for k in range(50)]
    frame = spark.createDataFrame(rows, "key string, v int, m map<string,int>")
    kinds = []
    for parts in (1, 6):
        marked = mark_exact_split(frame.repartition(parts), "key", 0.25)
        held = marked.where("is_validation").drop("is_validation").collect()
        assert len(held) == 250 and marked.columns == [*frame.columns, "is_validation"]
        kinds.append(Counter(str(r) for r in held))
        assert not kinds[-1] - Counter(str(r) for r in marked.drop("is_validation").collect())
    assert kinds[0] == kinds[1]


def test_missing_keys(spark):
    frame = spark.createDataFrame([(None,)] * 90 + [(k,) for k in range(10)], "key int")
    marked = mark_exact_split(frame, "key", 0.25)
    # there are only ten rows with a key
    assert marked.where("is_validation").count() == 10
    assert marked.where("is_validation AND key IS NULL").count() == 0
    none = mark_exact_split(frame.where("key IS NULL"), "key")
    assert none.where("is_validation").count() == 0
    assert mark_exact_split(frame.limit(0), "key").count() == 0
    with pytest.raises(ValueError):
        mark_exact_split(frame, "key", 1.5)


@pytest.mark.parametrize("seed", range(3))
def test_bounds(spark, seed):
    rng = random.Random(seed)
    top = [200, 1 << 20, (1 << 63) - 1][seed]
    numbers = [rng.randint(0, top) for _ in range(500)] + [top] * 30
    frame = spark.createDataFrame([(v,) for v in numbers] + [(None,)], "v long")
    ordered = sorted(numbers)
    for k in (1, 7, 250, 499, 510, 530):
        bound, below, equal = bound_of(frame, F.col("v"), k)
        assert below == sum(v < ordered[k - 1] for v in numbers) or below + equal == k
        assert below < k <= below + equal
        if below + equal == k:
            assert sum(v <= bound for v in numbers) == k
        else:
            assert bound == ordered[k - 1] and equal == numbers.count(bound)
    with pytest.raises(ValueError):
        bound_of(frame, F.col("v"), 531)
