import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from riskfeat.operators import joins

DAY = dt.datetime(2024, 3, 1)


@pytest.fixture
def skewed(spark):
    """A third of the rows on one key, some on NULL, the rest spread out."""
    keys = ["hot"] * 400 + [None] * 200 + [f"k{i % 150}" for i in range(600)]
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "account_id string, n int")


@pytest.fixture
def views(spark):
    names = ["hot"] + [f"k{i}" for i in range(100)]
    first = spark.createDataFrame([(k, len(k)) for k in names], "account_id string, a int")
    second = spark.createDataFrame([(k, k.upper()) for k in names[::2]], "account_id string, b string")
    return [first, second]


def test_heavy_keys_list_only_large_ones(spark, skewed, rows):
    heavy = joins.heavy_keys(joins.key_counts(skewed, "account_id"), "account_id", rows_per_salt=100)
    assert rows(heavy) == [(None, 2), ("hot", 4)]


def test_every_key_above_its_share_is_salted(spark):
    counts = spark.range(30_000).select(F.col("id").alias("k"), F.when(F.col("id") < 9_000, 10).otherwise(1).alias("n_rows"))
    assert joins.heavy_keys(counts, "k", rows_per_salt=2).count() == 0  # one part in 10,000 is 11 rows
    assert joins.heavy_keys(counts.where("id < 20000 AND (id < 9000 OR id % 11 = 0)"), "k", rows_per_salt=2).count() == 9_000


def test_salted_join_equals_plain_join(skewed, views, rows):
    heavy = joins.heavy_keys(joins.key_counts(skewed, "account_id"), "account_id", rows_per_salt=50)
    got = joins.left_join_by_key(skewed, views, "account_id", heavy)
    plain = skewed.join(views[0], "account_id", "left").join(views[1], "account_id", "left")
    assert rows(got, *plain.columns) == rows(plain)


def test_salts_spread_the_hot_key_and_left_is_shuffled_once(spark, skewed, views):
    heavy = joins.heavy_keys(joins.key_counts(skewed, "account_id"), "account_id", rows_per_salt=50)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.left_join_by_key(skewed, views, "account_id", heavy)
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == 2
    by_salt = [line for line in plan.splitlines() if "Exchange hashpartitioning(account_id" in line and "_salt" in line]
    assert len(by_salt) == 3  # left once, each right side once


def test_broadcast_is_measured(spark):
    df = spark.createDataFrame([("x" * 100,)] * 10, "s string")
    assert joins.fits_broadcast(df, max_bytes=2000)
    assert not joins.fits_broadcast(df, max_bytes=1000)


def test_latest_by_key_breaks_ties_and_skips_missing_times(spark, rows):
    data = [("a", DAY, 1), ("a", DAY, 3), ("a", DAY - dt.timedelta(1), 9), ("b", None, 5)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, v int")
    assert rows(joins.latest_by_key(df, "k", "ts")) == [("a", DAY, 3)]


def test_lookup_answers_each_key_once(spark, rows):
    latest = spark.createDataFrame([("a", 1)], "k string, v int")
    keys = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "k string")
    assert rows(joins.lookup(latest, keys, "k")) == [(None, None), ("a", 1), ("z", None)]


@pytest.mark.parametrize("strict", [False, True])
def test_asof_join_equals_brute_force(spark, strict):
    rng = random.Random(7)

    def stamp():
        return DAY + dt.timedelta(hours=rng.randrange(0, 24 * 5))

    keys = ["hot"] * 6 + ["b", "c", None]
    spine = [(i, rng.choice(keys), stamp()) for i in range(200)] + [(900, "hot", None), (901, "none", DAY)]
    facts = list({(k, t): (k, t, i) for i, (k, t) in enumerate((rng.choice(keys), stamp()) for _ in range(80))}.values())
    got = {
        r["id"]: r["v"]
        for r in joins.asof_join(
            spark.createDataFrame(spine, "id int, k string, ts timestamp_ntz"),
            spark.createDataFrame(facts, "k string, ts timestamp_ntz, v int"),
            "k",
            "ts",
            strict,
        ).collect()
    }
    assert len(got) == len(spine)
    for i, key, ts in spine:
        before = [
            f for f in facts
            if key is not None and ts is not None and f[0] == key and (f[1] < ts or (f[1] == ts and not strict))
        ]
        assert got[i] == (max(before, key=lambda f: f[1])[2] if before else None), (i, key, ts)


def test_null_safe_join_on_two_keys_with_salts(spark, rows):
    left = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate([("a", 1)] * 9 + [(None, 1)] * 9 + [("a", None)])], "k string, t int, i int")
    right = spark.createDataFrame([("a", 1, "x"), (None, 1, "y"), ("a", None, "z"), ("b", 1, "no")], "k string, t int, v string")
    heavy = joins.heavy_keys(joins.key_counts(left, ["k", "t"]), ["k", "t"], rows_per_salt=2)
    assert heavy.count() == 2
    got = rows(joins.left_join_by_key(left, [right], ["k", "t"], heavy, null_safe=True), "i", "v")
    assert got == [(i, "x" if i < 9 else "y" if i < 18 else "z") for i in range(19)]


def test_asof_join_keeps_null_feature_values_of_the_latest_row(spark, rows):
    spine = spark.createDataFrame([("a", DAY + dt.timedelta(3))], "k string, ts timestamp_ntz")
    facts = spark.createDataFrame([("a", DAY, 1), ("a", DAY + dt.timedelta(1), None)], "k string, ts timestamp_ntz, v int")
    assert rows(joins.asof_join(spine, facts, "k", "ts"), "v") == [(None,)]


@pytest.mark.parametrize("strict", [False, True])
def test_asof_join_spreads_a_large_tile_and_keeps_every_row(spark, rows, strict):
    hours = lambda n: DAY + dt.timedelta(hours=n)
    spine = [("hot", hours(i % 30), i % 70) for i in range(200)] + [(None, DAY, 1)] * 30 + [("hot", None, 2)] * 30
    facts = [("hot", hours(n), v) for n, v in ((-40, 1), (3, 2), (3, 7), (20, 4), (26, None))] + [(None, DAY, 5), ("hot", None, 6)]
    left = spark.createDataFrame(spine, "k string, ts timestamp_ntz, _fact int")
    right = spark.createDataFrame(facts, "k string, ts timestamp_ntz, v int")
    got = rows(joins.asof_join(left, right, "k", "ts", strict, rows_per_salt=10))

    def value(k, ts):
        before = [(t, v) for key, t, v in facts if k and ts and key and t and (t < ts or t == ts and not strict)]
        newest = max((t for t, _ in before), default=None)
        return max((v for t, v in before if t == newest), key=lambda v: (v is not None, v), default=None)

    assert got == sorted(((k, t, i, value(k, t)) for k, t, i in spine), key=lambda r: tuple((v is not None, v) for v in r))


@pytest.mark.parametrize("strict", [False, True])
def test_asof_join_moves_the_spine_once(spark, strict):
    spine = spark.createDataFrame([("a", DAY, "row")], "k string, ts timestamp_ntz, label string")
    facts = spark.createDataFrame([("a", DAY, 1)], "k string, ts timestamp_ntz, v int")
    plan = joins.asof_join(spine, facts, "k", "ts", strict)._jdf.queryExecution()
    plan.executedPlan()
    text = plan.toString().split("== Physical Plan ==")[1]
    assert "SortMergeJoin" not in text and text.count("Window") >= 2
