"""History that loads keep up to date, against one pass over all events."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from riskfeat.operators import curate, history
from riskfeat.sources import files

SCHEMA = (
    "account_id string, receiver_account_id string, receiver_bank string, to_country string, amount_paid double, "
    "is_cross_currency int, is_high_risk_format int, event_ts timestamp_ntz"
)
ROWS = [
    ("a" if i % 3 else "b", f"r{i % 4}", f"k{i % 2}" if i % 5 else None, "US" if i % 7 else None,
     None if i % 6 == 0 else 1e5 + i * 0.01, i % 2, int(i % 3 == 0), dt.datetime(2024, 1, 1 + i))
    for i in range(24)
] + [(None, "r1", "k1", "DE", 5.0, 1, 0, dt.datetime(2024, 2, 1)), ("once", "r", "k", "FR", None, 0, 0, None)]


@pytest.fixture
def events(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumn("i", F.monotonically_increasing_id())


@pytest.fixture
def accounts(spark):
    data = [("a", "Person", "US"), ("a", "Company", "FR"), ("z", "Person", "DE")]
    return spark.createDataFrame(data, "account_id string, entity_type string, bank_country string")


def same(got, want):
    assert got.columns == want.columns
    rows = [sorted(map(tuple, df.collect()), key=lambda r: (r[0] is None, r[0] or "")) for df in (got, want)]
    assert len(rows[0]) == len(rows[1])
    for a, b in zip(*rows):
        for x, y in zip(a, b):
            assert x == y or isinstance(x, float) and math.isclose(x, y, rel_tol=1e-8, abs_tol=1e-8), (a, b)


@pytest.mark.parametrize("loads", [1, 3, 5])
def test_history_after_loads_equals_a_rebuild(spark, events, accounts, tmp_path, loads):
    for load in range(loads):
        history.add_load(spark, str(tmp_path), events.where(F.crc32(F.col("event_ts").cast("string")) % loads == load))
    history.add_load(spark, str(tmp_path), events.where("event_ts IS NULL"))
    same(history.current(spark, str(tmp_path), accounts), curate.account_history(events, accounts))


def test_a_load_that_died_half_way_can_be_added_again(spark, events, accounts, tmp_path, monkeypatch):
    history.add_load(spark, str(tmp_path), events.where("amount_paid > 1e5 + 0.1"))
    write, rest = files.write_version, events.where("NOT coalesce(amount_paid > 1e5 + 0.1, false)")

    def dies(df, root, name, *more):
        if name == history.STATE:
            raise RuntimeError("lost")
        return write(df, root, name, *more)

    monkeypatch.setattr(files, "write_version", dies)
    with pytest.raises(RuntimeError):
        history.add_load(spark, str(tmp_path), rest)
    monkeypatch.setattr(files, "write_version", write)
    history.add_load(spark, str(tmp_path), rest)
    same(history.current(spark, str(tmp_path), accounts), curate.account_history(events, accounts))


def test_a_load_reads_its_own_events_only(spark, events, tmp_path):
    history.add_load(spark, str(tmp_path), events)
    old = files.read_version(spark, str(tmp_path), history.STATE)
    plan = history.merged_stats(old, history.stats_of(events.limit(3)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1  # the state
    assert old.count() == 4 and files.version_stats(spark, str(tmp_path), history.STATE) == {"rows": 4}


def test_a_load_writes_its_own_values_and_full_levels_merge(spark, events, accounts, tmp_path, monkeypatch):
    root, day = str(tmp_path), F.col("i") % 7
    sizes = []
    for load in range(7):
        history.add_load(spark, root, events.where(day == load) if load != 3 else events.limit(0))
        sizes.append(files.version_stats(spark, root, history.VALUES)["rows"])
    missing = events.where(day == 3)
    for load in range(7):
        assert sizes[load] == (history.values_of(events.where(day == load)).count() if load != 3 else 0)
    assert [level for _, level in history.parts_of(spark, root)] == [0] * 7
    history.add_load(spark, root, missing)
    assert [level for _, level in history.parts_of(spark, root)] == [1]
    assert files.version_stats(spark, root, history.VALUES)["rows"] == history.values_of(events).count()
    same(history.current(spark, root, accounts), curate.account_history(events, accounts))
    monkeypatch.setattr(history, "FAN", 2)
    for _ in range(4):
        history.add_load(spark, root, events.limit(0))
    assert [level for _, level in history.parts_of(spark, root)] == [2, 1]
    same(history.current(spark, root, accounts), curate.account_history(events, accounts))


def test_a_table_of_values_without_levels_is_read_on(spark, events, accounts, tmp_path):
    root, early = str(tmp_path), F.col("i") % 2 == 0
    for name, make in ((history.VALUES, history.values_of), (history.STATE, history.stats_of)):
        files.write_version(make(events.where("false")), root, name)
        files.write_version(make(events.where(early)), root, name)
    history.add_load(spark, root, events.where(~early))
    assert len(history.parts_of(spark, root)) == 2
    same(history.current(spark, root, accounts), curate.account_history(events, accounts))
