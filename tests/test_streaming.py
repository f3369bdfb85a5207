import datetime as dt
from pathlib import Path

import pytest

from riskfeat import schemas as S
from riskfeat.operators import rolling
from riskfeat.sources import streams
from riskfeat.streaming import velocity

START = dt.datetime(2024, 3, 1, 10)
DRAIN = {"availableNow": True}


def events(spark, specs):
    """(key, minutes after START, amount) as stream rows."""
    data = [
        (key, START + dt.timedelta(minutes=minutes), float(amount), f"r{minutes % 3}", "b1", minutes % 2, 1)
        for key, minutes, amount in specs
    ]
    return spark.createDataFrame(data, S.EVENT_SCHEMA)


def drain(spark, source, target, **options):
    query = velocity.start_velocity(streams.read_event_stream(spark, source, 1), target, trigger=DRAIN, **options)
    query.awaitTermination()
    return query


@pytest.fixture
def folders(tmp_path):
    return str(tmp_path / "in"), str(tmp_path / "out")


PLAIN = ["account_id", "hour", "count_amount_paid", "sum_amount_paid", "sum_is_cross_currency"]


def test_stream_equals_batch_over_several_files_and_restarts(spark, folders, rows):
    source, target = folders
    batches = [
        [("a", 1, 5), ("a", 59, 6), ("b", 61, 7)],
        [("a", 30, 1), ("b", 125, 2)],
        [("a", 2, 9), ("c", 200, 3)],
    ]
    seen = []
    for batch in batches:
        streams.land_events(events(spark, batch).coalesce(1), source)
        seen += batch
        drain(spark, source, target)
        expected = rolling.hour_tiles(events(spark, seen), "account_id", "event_ts")
        assert rows(velocity.read_tiles(spark, target), *PLAIN) == rows(expected, *PLAIN)
    # Nothing new: the same result again.
    drain(spark, source, target)
    assert rows(velocity.read_tiles(spark, target), *PLAIN) == rows(expected, *PLAIN)


def test_replayed_batch_leaves_the_same_tiles(spark, folders, rows):
    source, target = folders
    streams.land_events(events(spark, [("a", 1, 5), ("b", 2, 6)]).coalesce(1), source)
    drain(spark, source, target)
    before = rows(velocity.read_tiles(spark, target), *PLAIN)
    tiles = rolling.hour_tiles(events(spark, [("a", 1, 5), ("b", 2, 6)]), "account_id", "event_ts")
    velocity._write_batch(target, velocity.passthrough)(tiles, 0)  # the batch's own tiles again
    assert rows(velocity.read_tiles(spark, target), *PLAIN) == before


def test_events_count_however_late_they_come(spark, folders, rows):
    source, target = folders
    days = 24 * 60
    seen = []
    for batch in ([("a", 0, 1)], [("a", 5 * days, 1)], [("a", 1, 100), ("a", 4 * days, 10)]):
        streams.land_events(events(spark, batch).coalesce(1), source)
        seen += batch
        drain(spark, source, target)
    expected = rolling.hour_tiles(events(spark, seen), "account_id", "event_ts")
    assert rows(velocity.read_tiles(spark, target), *PLAIN) == rows(expected, *PLAIN)


def test_events_of_the_backfill_count_once(spark, folders, rows):
    source, target = folders
    past, fresh = [("a", 1, 5), ("a", 10, 10), ("b", 10, 1)], [("a", 20, 7)]
    velocity.backfill(events(spark, past), target)
    streams.land_events(events(spark, past + fresh), source)
    drain(spark, source, target)
    whole = rolling.hour_tiles(events(spark, past + fresh), "account_id", "event_ts")
    assert rows(velocity.read_tiles(spark, target), *PLAIN) == rows(whole, *PLAIN)


def test_backfill_and_stream_meet_within_an_hour(spark, folders, rows):
    source, target = folders
    past, fresh = [("a", 1, 5), ("b", 10, 1)], [("a", 20, 7), ("a", 70, 2)]
    velocity.backfill(events(spark, past), target)
    streams.land_events(events(spark, fresh), source)
    drain(spark, source, target)
    whole = rolling.hour_tiles(events(spark, past + fresh), "account_id", "event_ts")
    got = velocity.read_tiles(spark, target)
    assert rows(got, *PLAIN) == rows(whole, *PLAIN)
    as_of = whole.selectExpr("max(hour)").scalar()
    roll = lambda tiles: rows(rolling.roll_up(tiles, as_of, "account_id"))
    assert roll(got) == roll(whole)


def test_transform_hook_runs_before_the_tiles(spark, folders, rows):
    source, target = folders
    streams.land_events(events(spark, [("a", 1, 5), ("a", 2, -5)]), source)
    drain(spark, source, target, transform=lambda df: df.where("amount_paid > 0"))
    assert rows(velocity.read_tiles(spark, target), "count_amount_paid", "sum_amount_paid") == [(1, 5.0)]


def test_burst_of_a_new_account_shows_in_its_counters(spark, folders):
    source, target = folders
    for start in range(0, 40, 10):
        burst = [("mule", 0, 50_000 + i) for i in range(start, start + 10)]
        streams.land_events(events(spark, burst).coalesce(1), source)
    drain(spark, source, target)
    tiles = velocity.read_tiles(spark, target)
    row = rolling.roll_up(tiles, tiles.selectExpr("max(hour)").scalar(), "account_id").first()
    assert (row["account_id"], row["txn_count_1h"], row["txn_count_24h"]) == ("mule", 40, 40)
    assert row["amt_sum_24h"] == sum(50_000.0 + i for i in range(40))
    assert row["high_risk_cnt_24h"] == 40


def test_latest_rows_whatever_order_they_arrive_in(spark, folders, rows):
    source, target = folders
    for batch in ([("a", 10, 1), ("a", 5, 9)], [("a", 7, 2), ("b", 1, 3)]):
        streams.land_events(events(spark, batch).coalesce(1), source)
        velocity.start_latest(
            streams.read_event_stream(spark, source), target, "account_id", "event_ts", DRAIN
        ).awaitTermination()
    latest = velocity.read_latest(spark, target, "account_id", "event_ts")
    assert rows(latest, "account_id", "amount_paid") == [("a", 1.0), ("b", 3.0)]


def test_compacted_batches_read_the_same_and_the_stream_goes_on(spark, folders, rows):
    source, target = folders
    seen = []
    for batch in ([("a", 1, 5), ("b", 3, 1)], [("a", 2, 6)], [("a", 4, 7), ("c", 65, 2)]):
        streams.land_events(events(spark, batch).coalesce(1), source)
        seen += batch
        drain(spark, source, target)
        velocity.compact_tiles(spark, target)
        expected = rolling.hour_tiles(events(spark, seen), "account_id", "event_ts")
        assert rows(velocity.read_tiles(spark, target), *PLAIN) == rows(expected, *PLAIN)
    assert len(velocity.State(velocity._log(spark, target).entries()).folders) == 1
    assert velocity._batches(spark, target).count() == 3
    assert not list(Path(target, "data").glob("batch=*"))


def test_compacted_latest_rows(spark, folders, rows):
    source, target = folders
    for batch in ([("a", 10, 1), ("b", 1, 4)], [("a", 7, 2), ("b", 2, 3)]):
        streams.land_events(events(spark, batch).coalesce(1), source)
        velocity.start_latest(
            streams.read_event_stream(spark, source), target, "account_id", "event_ts", DRAIN
        ).awaitTermination()
        velocity.compact_latest(spark, target, "account_id", "event_ts")
    latest = velocity.read_latest(spark, target, "account_id", "event_ts")
    assert rows(latest, "account_id", "amount_paid") == [("a", 1.0), ("b", 3.0)]


def test_event_features_equal_the_batch_ones_whatever_the_batches(spark, folders, rows):
    source, target = folders
    specs = [("a", i * 90, i) for i in range(40)] + [("b", i * 400, 1) for i in range(9)]
    specs.sort(key=lambda s: s[1])
    for start in range(0, len(specs), 13):
        streams.land_events(events(spark, specs[start : start + 13]).coalesce(1), source)
        velocity.start_event_features(
            streams.read_event_stream(spark, source, 1), target, trigger=DRAIN
        ).awaitTermination()
    whole = rolling.rolling_features(events(spark, specs), "account_id", "event_ts")
    got = velocity.read_event_features(spark, target)
    assert rows(got, *whole.columns) == rows(whole)


def test_a_late_event_counts_what_has_arrived(spark, folders, rows):
    source, target = folders
    for batch in ([("a", 60, 1)], [("a", 30, 5)]):
        streams.land_events(events(spark, batch).coalesce(1), source)
        velocity.start_event_features(
            streams.read_event_stream(spark, source), target, trigger=DRAIN
        ).awaitTermination()
    got = velocity.read_event_features(spark, target)
    assert rows(got, "amount_paid", "txn_count_1h") == [(1.0, 1), (5.0, 1)]


def test_a_stray_old_event_reads_its_own_days_and_accounts(spark, folders, rows):
    source, target = folders
    days = 24 * 60
    specs = [("a", d * days, 1) for d in range(30, 0, -3)] + [("b", 2 * days, 4), ("a", 2 * days + 5, 8)]
    for batch in (specs[:10], specs[10:], [("a", 3 * days + 5, 2)]):
        streams.land_events(events(spark, batch).coalesce(1), source)
        velocity.start_event_features(
            streams.read_event_stream(spark, source, 1), target, trigger=DRAIN
        ).awaitTermination()
    got = {r["amount_paid"]: (r["txn_count_24h"], r["amt_sum_48h"]) for r in velocity.read_event_features(spark, target).collect()}
    assert got[2.0] == (3, 11.0)  # itself, one five minutes before, and one a day before


def test_reading_before_the_first_batch_fails_clearly(spark, folders):
    with pytest.raises(FileNotFoundError):
        velocity.read_tiles(spark, folders[1])


def compacted_equals_batch(spark, source, target, batches, rows, past=()):
    """Drain and compact after every batch; the tiles are those of all events so far."""
    seen = list(past)
    for batch in batches:
        streams.land_events(events(spark, batch).coalesce(1), source)
        seen += [e for e in batch if e not in past]
        drain(spark, source, target)
        velocity.compact_tiles(spark, target)
        expected = rolling.hour_tiles(events(spark, seen), "account_id", "event_ts")
        assert rows(velocity.read_tiles(spark, target), *PLAIN) == rows(expected, *PLAIN)


def test_compaction_of_batches_without_rows_loses_nothing(spark, folders, rows):
    source, target = folders
    past = [("a", 1, 5), ("b", 10, 1)]
    velocity.backfill(events(spark, past), target)
    compacted_equals_batch(spark, source, target, [past, past[:1], [("a", 20, 7)], [("c", 90, 2), ("a", 21, 1)]], rows, past)


def test_late_events_that_the_backfill_did_not_hold_count_once(spark, folders, rows):
    source, target = folders
    past = [("a", 0, 5), ("a", 600, 10), ("b", 3 * 24 * 60, 1), (None, 7, 3)]
    velocity.backfill(events(spark, past), target)
    late = [("a", 1, 100), ("c", 30, 7), ("b", 3 * 24 * 60, 2), (None, 8, 3)]
    compacted_equals_batch(spark, source, target, [past[:2] + late[:2], past + late[2:], [("a", 5000, 1)]], rows, past)


def test_a_backfill_in_many_slots_and_a_second_one(spark, folders, rows, monkeypatch):
    monkeypatch.setattr(velocity, "KEYS_PER_SLOT", 3)
    source, target = folders
    past = [(f"k{i}", i, i) for i in range(20)]
    velocity.backfill(events(spark, past[:5]), target)
    velocity.backfill(events(spark, past), target)
    compacted_equals_batch(spark, source, target, [past[3:12] + [("x", 2, 2)], past[:4] + [("x", 30, 2)]], rows, past)


def test_a_batch_that_commits_during_a_compaction_stays(spark, folders, rows):
    source, target = folders
    streams.land_events(events(spark, [("a", 1, 5)]).coalesce(1), source)
    drain(spark, source, target)

    def merged(df):
        streams.land_events(events(spark, [("a", 2, 6), ("b", 3, 7)]).coalesce(1), source)
        drain(spark, source, target)
        return rolling.merge_tiles(df, "account_id")

    velocity._compact(spark, target, merged)
    expected = rolling.hour_tiles(events(spark, [("a", 1, 5), ("a", 2, 6), ("b", 3, 7)]), "account_id", "event_ts")
    assert rows(velocity.read_tiles(spark, target), *PLAIN) == rows(expected, *PLAIN)


def test_two_compactions_at_once_keep_one(spark, folders, rows):
    source, target = folders
    for batch in ([("a", 1, 5)], [("a", 2, 6)]):
        streams.land_events(events(spark, batch).coalesce(1), source)
        drain(spark, source, target)

    def merged(df):
        kept = spark.createDataFrame(rolling.merge_tiles(df, "account_id").collect(), df.schema)
        velocity.compact_tiles(spark, target)
        return kept

    velocity._compact(spark, target, merged)
    expected = rolling.hour_tiles(events(spark, [("a", 1, 5), ("a", 2, 6)]), "account_id", "event_ts")
    assert rows(velocity.read_tiles(spark, target), *PLAIN) == rows(expected, *PLAIN)
    assert len(velocity.State(velocity._log(spark, target).entries()).folders) == 1


def test_stored_events_stay_in_few_folders(spark, folders, rows, monkeypatch):
    monkeypatch.setattr(velocity, "FANOUT", 2)
    source, target = folders
    specs = [("a" if i % 3 else None, i * 200, i) for i in range(12)]
    for spec in specs:
        streams.land_events(events(spark, [spec]).coalesce(1), source)
    velocity.start_event_features(streams.read_event_stream(spark, source, 1), target, trigger=DRAIN).awaitTermination()
    velocity.compact_event_features(spark, target)
    held = velocity.State(velocity._log(spark, target).entries()).events
    assert sorted(e["level"] for e in held) == [2, 3]  # 12 batches: 4 and 8
    assert {f"events/{p.name}" for p in Path(target, "events").iterdir()} == {e["folder"] for e in held}
    got = velocity.read_event_features(spark, target)
    whole = rolling.rolling_features(events(spark, specs), "account_id", "event_ts")
    # Files come in the order of their landing, so every event has seen those before it.
    assert rows(got, *whole.columns) == rows(whole)
