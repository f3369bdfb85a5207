import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings, strategies as st

from riskfeat.operators import rolling
from riskfeat.operators.rolling import VELOCITY_FEATURES, Feature

START = dt.datetime(2024, 3, 1)
SCHEMA = (
    "id int, account_id string, event_ts timestamp_ntz, amount_paid double, receiver_account_id string, "
    "receiver_bank string, is_cross_currency long, is_high_risk_format long"
)


def brute(data, f: Feature):
    names = ["id", "account_id", "event_ts", "amount_paid", "receiver_account_id", "receiver_bank",
             "is_cross_currency", "is_high_risk_format"]
    at = names.index(f.column)
    out = {}
    for row in data:
        window = [
            o[at] for o in data
            if o[1] == row[1] and row[2] - dt.timedelta(hours=f.hours) <= o[2] <= row[2] and o[at] is not None
        ]
        if f.agg == "count":
            out[row[0]] = len(window)
        elif f.agg == "sum":
            out[row[0]] = sum(window) if window else None
        else:
            out[row[0]] = len(set(window))
    return out


def check(spark, data, **options):
    df = spark.createDataFrame(data, SCHEMA)
    got = {r["id"]: r for r in rolling.rolling_features(df, "account_id", "event_ts", **options).collect()}
    assert len(got) == len(data)
    for f in VELOCITY_FEATURES:
        for i, value in brute(data, f).items():
            assert got[i][f.alias] == (value if value is None else pytest.approx(value)), (f, i)


def event(i, key, seconds, micros, amount, receiver):
    ts = START + dt.timedelta(seconds=seconds, microseconds=micros)
    return (i, key, ts, amount, receiver, None if receiver is None else receiver[0], i % 2, int(i % 3 == 0))


def test_features_equal_brute_force_on_a_busy_key(spark):
    rng = random.Random(11)
    data = [
        event(i, rng.choice(["hot"] * 5 + ["b", None]), rng.randrange(0, 5 * 86400, 900), rng.choice([0, 0, 1]),
              rng.choice([None, 1.5, 20.25]), rng.choice([None, "x1", "x2", "y1", "z9"]))
        for i in range(300)
    ]
    check(spark, data)
    check(spark, data, tile_seconds=600)


@pytest.mark.parametrize("odd", [1e16, 1e12, -1e300, float("nan"), float("inf"), float("-inf")])
def test_amounts_that_left_the_window_leave_no_trace(spark, odd):
    hours = [0, 24.5, 30, 47, 49, 72.4, 72.6, 100]
    data = [event(i, "a", int(h * 3600), 0, odd if i == 0 else i / 100, "r1") for i, h in enumerate(hours)]
    df = spark.createDataFrame(data, SCHEMA)
    got = {r["id"]: r for r in rolling.rolling_features(df, "account_id", "event_ts").collect()}
    for hours_back, name in ((24, "amt_sum_24h"), (48, "amt_sum_48h")):
        for i, h in enumerate(hours):
            inside = [data[j][3] for j, g in enumerate(hours) if h - hours_back <= g <= h]
            assert got[i][name] == pytest.approx(sum(inside), rel=1e-12, nan_ok=True), (name, i)


def test_window_edges_are_inclusive_to_the_microsecond(spark):
    hour = 3600
    offsets = [(0, 0), (hour, 0), (hour, 1), (24 * hour, 0), (24 * hour, 1), (48 * hour, 0), (48 * hour, 1), (48 * hour, 1)]
    check(spark, [event(i, "a", s, u, 2.0, f"r{i % 2}") for i, (s, u) in enumerate(offsets)])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(
    st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 200), st.sampled_from([0, 1]),
              st.sampled_from([None, 1.0, 3.5]), st.sampled_from([None, "x1", "y1"])),
    min_size=1, max_size=25,
))
def test_features_equal_brute_force_on_any_events(spark, drawn):
    check(spark, [event(i, k, half * 1800, u, amount, r) for i, (k, half, u, amount, r) in enumerate(drawn)])


def test_copies_of_one_event_shrink_before_the_windows(spark):
    df = spark.createDataFrame([event(0, "a", 0, 0, 1.0, "x1")], SCHEMA)
    copies = df.withColumn("id", F.explode(F.sequence(F.lit(1), F.lit(5000))))
    got = rolling.rolling_features(copies, "account_id", "event_ts")
    assert got.where("txn_count_1h = 5000 AND distinct_banks_24h = 1 AND amt_sum_48h = 5000").count() == 5000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # Rows of events meet no window: those order points, tiles and stays only.
    assert windows and not any("receiver_account_id" in line for line in windows)


@pytest.mark.parametrize("aggs", [("distinct",), ("count",), ("sum", "count")])
def test_any_part_of_the_features_can_be_asked_for(spark, aggs):
    chosen = [f for f in VELOCITY_FEATURES if f.agg in aggs]
    data = [event(i, "a", i * 1700, 0, float(i), f"r{i % 4}") for i in range(30)]
    got = rolling.rolling_features(spark.createDataFrame(data, SCHEMA), "account_id", "event_ts", chosen)
    assert got.columns[8:] == [f.alias for f in chosen]
    for f in chosen:
        exact = brute(data, f)
        assert {r["id"]: r[f.alias] for r in got.collect()} == exact


def test_windows_must_be_whole_tiles(spark):
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError, match="multiple"):
        rolling.rolling_features(df, "account_id", "event_ts", tile_seconds=7000)
    with pytest.raises(ValueError, match="unknown"):
        rolling.rolling_features(df, "account_id", "event_ts", [Feature("median", "amount_paid", 1, "m")])


def test_merged_tiles_equal_tiles_of_all_events(spark, rows):
    data = [event(i, "a", i * 700, 0, float(i), f"r{i % 4}") for i in range(40)]
    both = spark.createDataFrame(data, SCHEMA)
    odd, even = (spark.createDataFrame(data[k::2], SCHEMA) for k in (0, 1))
    tiles = lambda df: rolling.hour_tiles(df, "account_id", "event_ts")
    merged = rolling.merge_tiles(tiles(odd).unionByName(tiles(even)), "account_id")
    plain = ["account_id", "hour", "count_amount_paid", "sum_amount_paid"]
    assert rows(merged, *plain) == rows(tiles(both), *plain)
    as_of = both.selectExpr("max(event_ts)").scalar()
    up = lambda df: rows(rolling.roll_up(df, as_of, "account_id"))
    assert up(merged) == up(tiles(both))


@pytest.mark.parametrize("hours", [1, 2, 3, 24, 48, 63, 64, 200])
def test_nodes_cover_every_hour_of_a_window_once(spark, hours):
    ends = spark.range(480_000, 480_140).select(F.col("id").alias("at"))
    nodes = ends.select("at", F.inline(rolling._covering(F.col("at") - (hours - 1), F.col("at") + 1))).collect()
    for at in range(480_000, 480_140):
        mine = [(r["level"], r["place"]) for r in nodes if r["at"] == at]
        covered = sorted(h for level, place in mine for h in range(place << level, (place + 1) << level))
        assert covered == list(range(at - hours + 1, at + 1))
        assert len(mine) <= 2 * rolling.LEVELS + max(0, hours >> rolling.LEVELS)


def test_tiles_as_of_every_row(spark):
    start = dt.datetime(2024, 1, 1)
    rng = random.Random(5)
    rows = [(rng.choice("aab"), start + dt.timedelta(minutes=rng.randrange(6 * 24 * 60)), float(i), f"b{i % 3}") for i in range(120)]
    events = spark.createDataFrame(rows, "account_id string, event_ts timestamp, amount_paid double, receiver_bank string")
    features = [
        rolling.Feature("count", "amount_paid", 1, "n1"), rolling.Feature("sum", "amount_paid", 48, "s48"),
        rolling.Feature("distinct", "receiver_bank", 24, "d24"), rolling.Feature("count", "amount_paid", 130, "n130"),
    ]
    tiles = rolling.hour_tiles(events, "account_id", "event_ts", features)
    asked = [(k, start + dt.timedelta(hours=h, minutes=59)) for k in ("a", "b", "c", None) for h in (0, 30, 31, 100, 300)] * 2 + [("a", None)]
    spine = spark.createDataFrame([(i, *a) for i, a in enumerate(asked)], "i long, account_id string, at timestamp")
    got = {r["i"]: r for r in rolling.roll_up_at(tiles, spine, "account_id", "at", features).collect()}
    assert len(got) == len(asked)
    whole = lambda t: t.replace(minute=0, second=0, microsecond=0)
    for i, (key, at) in enumerate(asked):
        def inside(h):
            if key is None or at is None:
                return []
            ages = [((whole(at) - whole(t)) // dt.timedelta(hours=1), v, b) for k, t, v, b in rows if k == key]
            return [(v, b) for age, v, b in ages if 0 <= age < h]
        want = (len(inside(1)), sum(v for v, _ in inside(48)) if inside(48) else None, len({b for _, b in inside(24)}), len(inside(130)))
        r = got[i]
        assert (r["n1"], r["s48"], r["d24"], r["n130"]) == want, (i, key, at)
