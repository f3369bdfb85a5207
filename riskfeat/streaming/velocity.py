"""Velocity tiles and latest rows kept up to date from a stream.

Every micro-batch writes a folder of its own and commits it to a log; a replayed batch finds itself committed and
adds nothing. Compaction commits one folder in place of those it has read, so batches that arrive meanwhile stay.
Readers merge what the log names: replays, restarts and maintenance leave the same result.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from riskfeat.operators.joins import latest_by_key
from riskfeat.operators.rolling import (
    VELOCITY_FEATURES,
    Feature,
    hour_tiles,
    merge_tiles,
    rolling_features,
)
from riskfeat.sources.commits import CommitLog, Stale
from riskfeat.sources.files import remove

#: Keys of a backfilled day that lie in one folder.
KEYS_PER_SLOT = 1_000_000
#: Event folders of one level that are merged into one of the next.
FANOUT = 8


def passthrough(df: DataFrame) -> DataFrame:
    return df


class State:
    """What the log of a stream says: live folders, stored events, the newest batch of each query, the backfill."""

    def __init__(self, entries: list[dict]):
        self.folders: list[str] = []
        self.events: list[dict] = []
        self.done: dict[str, int] = {}
        self.backfill: dict | None = None
        for e in entries:
            gone = set(e.get("without", ()))
            self.folders = [f for f in self.folders if f not in gone]
            self.folders += e.get("folders", [])
            self.events = [f for f in self.events if f["folder"] not in gone] + e.get("events", [])
            for query, batch in e.get("done", {}).items():
                self.done[query] = max(batch, self.done.get(query, -1))
            self.backfill = e.get("backfill", self.backfill)

    def entry(self) -> dict:
        """One entry that stands for all."""
        return {"folders": self.folders, "events": self.events, "done": self.done} | ({"backfill": self.backfill} if self.backfill else {})


def _pruned(entries: list[dict]) -> list[dict]:
    return [{**State(entries).entry(), "number": entries[-1]["number"]}]


def _log(spark: SparkSession, path: str) -> CommitLog:
    return CommitLog(spark, f"{path}/log", _pruned)


def _query_id(spark: SparkSession, path: str) -> str:
    """The id that Spark gave the query of a checkpoint; a new checkpoint is a new query, and counts from 0."""
    return json.loads(spark.read.text(f"{path}/checkpoint/metadata", wholetext=True).first()[0])["id"]


def _write_batch(path: str, shape: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        log, query = _log(spark, path), _query_id(spark, path)

        def commit(entries: list[dict]) -> dict:
            if State(entries).done.get(query, -1) >= batch_id:
                raise Stale
            return {"folders": [folder], "done": {query: batch_id}}

        folder = f"data/batch={batch_id}-{uuid.uuid4().hex}"
        try:
            if State(log.entries()).done.get(query, -1) >= batch_id:
                return
            shape(batch).write.parquet(f"{path}/{folder}")
            log.append(commit)
        except Stale:
            remove(spark, f"{path}/{folder}")

    return write


def _start(stream: DataFrame, path: str, shape: Callable, trigger: dict | None) -> StreamingQuery:
    return (
        stream.writeStream.outputMode("append")
        .foreachBatch(_write_batch(path, shape))
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


# -- what a backfill holds --


def _timed(events: DataFrame, ts: str) -> DataFrame:
    return events.withColumn(ts, F.col(ts).cast("timestamp")).where(F.col(ts).isNotNull())


def _identity(columns: Sequence[str]) -> Column:
    """128 bits that stand for an event's identifying columns; names tell a missing value from a shifted one."""
    return F.md5(F.to_json(F.struct(*sorted(columns))))


def _slot(identity: Column, slots: int) -> Column:
    return F.pmod(F.crc32(identity), F.lit(slots)).cast("int")


def backfill(
    events: DataFrame,
    path: str,
    key: str = "account_id",
    ts: str = "event_ts",
    features: Sequence[Feature] = VELOCITY_FEATURES,
    identity: Sequence[str] | None = None,
) -> None:
    """Tiles of past events, and which events they are.

    A stream that starts afterwards leaves out exactly the events that were backfilled and takes all others, also those that
    are older than the backfill's end and come late. ``identity`` names the columns that tell events apart, all by
    default; the stream must bring them with the same types. A later backfill replaces an earlier one.
    """
    spark = events.sparkSession
    timed = _timed(events, ts)
    columns = list(identity or timed.columns)
    name = f"backfill/{uuid.uuid4().hex}"
    hour_tiles(timed, key, ts, features).write.parquet(f"{path}/{name}/tiles")
    days = timed.groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    most, end = days.agg(F.max("n")).first()[0] or 0, timed.agg(F.max(ts).cast("string")).first()[0]
    slots = -(-most // KEYS_PER_SLOT) or 1
    held = timed.select(F.to_date(ts).alias("event_date"), _identity(columns).alias("event")).distinct()
    held = held.withColumn("slot", _slot(F.col("event"), slots))
    # One file for each folder.
    held.repartition("event_date", "slot").write.partitionBy("event_date", "slot").parquet(f"{path}/{name}/events")
    found = {"name": name, "end": end, "identity": columns, "slots": slots}
    _log(spark, path).append(lambda _: {"backfill": found})


def _not_backfilled(path: str, ts: str) -> Callable[[DataFrame], DataFrame]:
    """Leaves out of a batch the events that the backfill holds; reads only the folders that they may be in."""

    def fresh(batch: DataFrame) -> DataFrame:
        spark = batch.sparkSession
        past = State(_log(spark, path).entries()).backfill
        if past is None or past["end"] is None:
            return batch
        old = F.col(ts) <= F.lit(past["end"]).cast("timestamp")
        event = _identity([c for c in past["identity"]])
        asked = batch.where(old).select(
            F.to_date(ts).alias("event_date"), _slot(event, past["slots"]).alias("slot")
        ).distinct().collect()  # at most as many as there are folders of keys
        if not asked:
            return batch
        held = spark.read.parquet(f"{path}/{past['name']}/events")
        held = held.where(
            F.col("event_date").isin({r["event_date"] for r in asked}) & F.col("slot").isin({r["slot"] for r in asked})
        )
        marked = batch.withColumns({"_event_date": F.to_date(ts), "_event": event})
        same = (F.col("_event_date") == F.col("event_date")) & (F.col("_event") == F.col("event"))
        return marked.join(held, same, "left_anti").drop("_event_date", "_event")

    return fresh


# -- streams --


def start_velocity(
    stream: DataFrame,
    path: str,
    key: str = "account_id",
    ts: str = "event_ts",
    features: Sequence[Feature] = VELOCITY_FEATURES,
    transform: Callable[[DataFrame], DataFrame] = passthrough,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep hour tiles per key. Each batch writes the tiles of its own events.

    Counts, sums and sketches of a tile's parts merge when they are read, so there is no state, and an event counts
    however late it comes, but for those that the backfill holds. Events without a time have no tile. ``transform``
    is applied to what is left; a backfill takes its events as they are.
    """
    fresh = _not_backfilled(path, ts)

    def tiles(batch: DataFrame) -> DataFrame:
        return hour_tiles(_timed(_timed(batch, ts).transform(fresh).transform(transform), ts), key, ts, features)

    return _start(stream, path, tiles, trigger)


def _read(spark: SparkSession, path: str, folders: Sequence[str]) -> DataFrame:
    return spark.read.parquet(*[f"{path}/{f}" for f in folders])


def _batches(spark: SparkSession, path: str) -> DataFrame:
    """All rows committed so far."""
    folders = State(_log(spark, path).entries()).folders
    if not folders:
        raise FileNotFoundError(f"no batch has been written below {path}")
    return _read(spark, path, folders)


def read_tiles(spark: SparkSession, path: str, key: str = "account_id") -> DataFrame:
    """The tile per key and hour, merged from all batches that had events in it and the backfill."""
    state = State(_log(spark, path).entries())
    folders = state.folders + ([f"{state.backfill['name']}/tiles"] if state.backfill else [])
    if not folders:
        raise FileNotFoundError(f"no batch has been written below {path}")
    return merge_tiles(_read(spark, path, folders), key)


def start_latest(
    stream: DataFrame, path: str, key: str, ts: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the latest row per key: each batch adds its own latest rows."""
    return _start(stream, path, lambda batch: latest_by_key(batch, key, ts), trigger)


def read_latest(spark: SparkSession, path: str, key: str, ts: str) -> DataFrame:
    """The latest row per key over all batches, whatever order they came in."""
    return latest_by_key(_batches(spark, path), key, ts)


def _compact(spark: SparkSession, path: str, merged: Callable[[DataFrame], DataFrame]) -> None:
    """Put one folder in the place of those that are committed now, and delete them.

    Batches that commit meanwhile stay. Of two compactions of the same folders the second one
    is given up. A reader that began before may lose files under its hands and has to read again.
    """
    log = _log(spark, path)
    old = State(log.entries()).folders
    if not old:
        raise FileNotFoundError(f"no batch has been written below {path}")
    folder = f"compacted/{uuid.uuid4().hex}"
    merged(_read(spark, path, old)).write.parquet(f"{path}/{folder}")

    def commit(entries: list[dict]) -> dict:
        if not set(old) <= set(State(entries).folders):
            raise Stale
        return {"folders": [folder], "without": old}

    try:
        log.append(commit)
    except Stale:
        old = [folder]
    for gone in old:
        remove(spark, f"{path}/{gone}")


def compact_tiles(spark: SparkSession, path: str, key: str = "account_id") -> None:
    """Fold the batches so far into one table and delete them, while the stream goes on."""
    _compact(spark, path, lambda df: merge_tiles(df, key))


def compact_latest(spark: SparkSession, path: str, key: str, ts: str) -> None:
    _compact(spark, path, lambda df: latest_by_key(df, key, ts))


def compact_event_features(spark: SparkSession, path: str) -> None:
    _compact(spark, path, passthrough)


def start_event_features(
    stream: DataFrame,
    path: str,
    key: str = "account_id",
    ts: str = "event_ts",
    features: Sequence[Feature] = VELOCITY_FEATURES,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Give every event its exact rolling features as it arrives.

    A batch is put beside the earlier events of its accounts on the days that its windows touch,
    and goes through the same function as a table would. An event that arrives late
    gets its features from all that has arrived; what was written before it stays.

    Events are stored by day in folders of growing size: ``FANOUT`` folders of a level are merged, sorted by
    day and key, into one of the next. So a batch looks into few folders, however many came before, and in them
    only at the days and keys it needs.
    """
    longest = dt.timedelta(hours=max(f.hours for f in features))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        log, query = _log(spark, path), _query_id(spark, path)
        state = State(log.entries())
        if state.done.get(query, -1) >= batch_id:
            return
        mine = uuid.uuid4().hex
        arrived, result = f"events/store={mine}", f"data/batch={batch_id}-{mine}"
        dated = batch.withColumn("event_date", F.to_date(ts))
        dated.write.partitionBy("event_date").parquet(f"{path}/{arrived}")
        new = _stored(spark, path, dated.schema, [arrived])
        days = F.sequence(F.to_date(F.col(ts) - F.lit(longest)), F.to_date(ts))
        wanted = (
            new.where(F.col(ts).isNotNull()).select(F.col(key).alias("_key"), F.explode(days).alias("_day")).distinct()
        )
        # As many rows as days.
        asked = wanted.groupBy("_day").agg(F.min("_key").alias("lo"), F.max("_key").alias("hi")).collect()
        recent = new.withColumn("_new", F.lit(True))
        touched = {r["_day"] for r in asked}
        stored = [e["folder"] for e in state.events if any(e["from"] <= str(d) <= e["to"] for d in touched)]
        if stored:
            keys = [r[c] for r in asked for c in ("lo", "hi") if r[c] is not None]
            within = F.col(key).isNull()
            if keys:
                within = within | F.col(key).between(min(keys), max(keys))
            past = _stored(spark, path, dated.schema, stored)
            mine_too = F.col(key).eqNullSafe(F.col("_key")) & (F.col("event_date") == F.col("_day"))
            past = past.where(F.col("event_date").isin(touched) & within).join(wanted, mine_too, "left_semi")
            recent = recent.unionByName(past.withColumn("_new", F.lit(False)))
        rolled = rolling_features(recent, key, ts, features).where("_new").drop("event_date", "_new")
        rolled.write.parquet(f"{path}/{result}")
        span = new.agg(F.min("event_date").cast("string"), F.max("event_date").cast("string")).first()
        held = [{"folder": arrived, "level": 0, "from": span[0], "to": span[1]}] if span[0] else []
        log.append(lambda _: {"folders": [result], "events": held, "done": {query: batch_id}})
        _merge_levels(spark, path, key, dated.schema)

    return (
        stream.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def _stored(spark: SparkSession, path: str, schema: StructType, folders: Sequence[str]) -> DataFrame:
    base = spark.read.schema(schema).option("basePath", f"{path}/events")
    return base.parquet(*[f"{path}/{f}" for f in folders]).select(schema.names)


def _merge_levels(spark: SparkSession, path: str, key: str, schema: StructType) -> None:
    """Merge the event folders of every level that has enough of them."""
    log = _log(spark, path)
    while True:
        levels: dict[int, list[dict]] = {}
        for e in State(log.entries()).events:
            levels.setdefault(e["level"], []).append(e)
        full = [n for n, held in levels.items() if len(held) >= FANOUT]
        if not full:
            return
        old = levels[min(full)]
        folder = f"events/store={uuid.uuid4().hex}"
        rows = _stored(spark, path, schema, [e["folder"] for e in old])
        ordered = rows.repartitionByRange("event_date", key).sortWithinPartitions("event_date", key)
        ordered.write.partitionBy("event_date").parquet(f"{path}/{folder}")
        merged = {
            "folder": folder,
            "level": min(full) + 1,
            "from": min(e["from"] for e in old),
            "to": max(e["to"] for e in old),
        }
        gone = [e["folder"] for e in old]
        log.append(lambda _: {"events": [merged], "without": gone})
        for f in gone:
            remove(spark, f"{path}/{f}")


def read_event_features(spark: SparkSession, path: str) -> DataFrame:
    return _batches(spark, path)
