import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskfeat.operators import ordering, sampling


@pytest.mark.parametrize("size", [1, 2, 7, 500])
def test_percentiles_interpolate_like_numpy(spark, size):
    rng = random.Random(size)
    values = [rng.randrange(-5000, 5000) for _ in range(size)]
    values += [42] * (size // 3)
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long")
    got = ordering.percentiles(df, "v", {"a": 0.6, "b": 0.8, "c": 0.0, "d": 1.0}, 100).first()
    assert tuple(got) == pytest.approx(tuple(np.percentile(values, [60, 80, 0, 100])))


def test_percentiles_of_nothing_are_null(spark):
    df = spark.createDataFrame([], "v long")
    assert tuple(ordering.percentiles(df, "v", {"a": 0.5}, 10).first()) == (None,)


@pytest.mark.parametrize("n", [0, 1, 37, 299, 300, 1000])
def test_first_by_hash_takes_exactly_the_smallest(spark, n):
    keys = [f"key-{i}" for i in range(300)]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = sorted(r["k"] for r in ordering.first_by_hash(df, "k", n).collect())
    expected = sorted(sorted(keys, key=lambda k: hashlib.md5(k.encode()).hexdigest())[:n])
    assert got == expected


@pytest.mark.parametrize("key", ["same", None])
def test_first_by_hash_splits_the_rows_of_one_key(spark, key, monkeypatch):
    df = spark.createDataFrame([(key, i) for i in range(500)], "k string, i int")
    at_once = sorted(r["i"] for r in ordering.first_by_hash(df, "k", 20).collect())
    monkeypatch.setattr(ordering, "ORDERED_ROWS", 3)
    assert sorted(r["i"] for r in ordering.first_by_hash(df, "k", 20).collect()) == at_once
    assert len(set(at_once)) == 20 and at_once != list(range(20))


def test_first_by_hash_takes_part_of_a_group_of_copies(spark):
    df = spark.createDataFrame([("same",)] * 500 + [(f"k{i}",) for i in range(20)], "k string")
    hashes = sorted((hashlib.md5(k.encode()).hexdigest(), k) for k in ["same"] * 500 + [f"k{i}" for i in range(20)])
    for n in (3, 100, 511):
        got = sorted(r["k"] for r in ordering.first_by_hash(df, "k", n).collect())
        assert got == sorted(k for _, k in hashes[:n])


@pytest.mark.parametrize("buckets", [1, 2, 16])
def test_running_totals_over_buckets(spark, buckets):
    rng = random.Random(3)
    data = {rng.random(): rng.randrange(1, 9) for _ in range(200)}
    df = spark.createDataFrame(list(data.items()), "v double, n long")
    cuts = ordering.range_boundaries(df, "v", buckets)
    assert len(cuts) <= buckets - 1
    got = ordering.running_totals(df, "v", ["n"], cuts).collect()
    assert len(got) == len(data)
    for r in got:
        assert r["n_upto"] == sum(n for v, n in data.items() if v >= r["v"])
        assert r["n_total"] == sum(data.values())


def test_running_totals_order_no_rows_together(spark):
    df = spark.range(1000).select((F.col("id") / 7).alias("v"), F.lit(1).alias("n"))
    plan = ordering.running_totals(df, "v", ["n"], [10.0, 50.0])._jdf.queryExecution().executedPlan()
    text = plan.toString()
    row_window = [i for i, line in enumerate(text.splitlines()) if "Exchange SinglePartition" in line]
    # The only one-task step is over the bucket totals, which sit below an aggregate.
    assert len(row_window) == 1
    assert "HashAggregate" in text.splitlines()[row_window[0] + 1]


def test_sample_of_candidates_is_that_of_all_rows(spark):
    """Keys repeat and are null, and the rows that share one differ in columns that only the base table has."""
    rows = [(f"k{i % 4000}" if i % 50 else None, int(i % 97 == 0), i) for i in range(6000)]
    events = spark.createDataFrame(rows, "event_key string, is_laundering int, id long")
    for n in (1, 37, 500, 10_000):
        near = sampling.sample_candidates(events, n)
        built = lambda df: df.withColumn("later", F.col("id") * 7 % 13)
        want = sorted(r["id"] for r in sampling.train_sample(built(events), n).collect())
        assert sorted(r["id"] for r in sampling.train_sample(built(near), n).collect()) == want
        assert near.count() <= len(want) + 200
