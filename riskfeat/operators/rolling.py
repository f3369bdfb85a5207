"""Rolling features as of every event, and their hour tiles.

A window of length w as of time t covers [t - w, t], the event itself included.

A sliding frame re-reads its whole window for every row, and one busy key would hold it
in one task. Here events shrink to one row per key and time, grouped by key and tile, so a very
busy key spreads over its tiles. A window is whole tiles long: it is the end of one tile, full tiles,
and the start of another, each a sum of its own, and nothing is ever subtracted from a sum of
amounts. Distinct counts are running sums of values that enter (+1) and leave (-1), in whole
numbers. The sums then join the events.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskfeat.operators.joins import heavy_keys, key_counts, left_join_by_key

MICROS = 1_000_000
HOUR = 3600


@dataclass(frozen=True)
class Feature:
    """One rolling feature: ``agg`` of ``column`` over the last ``hours`` hours."""

    agg: str
    column: str
    hours: int
    alias: str


# --- fixed values: the velocity features ---
VELOCITY_FEATURES = [
    Feature("count", "amount_paid", 1, "txn_count_1h"),
    Feature("count", "amount_paid", 24, "txn_count_24h"),
    Feature("sum", "amount_paid", 24, "amt_sum_24h"),
    Feature("sum", "amount_paid", 48, "amt_sum_48h"),
    Feature("distinct", "receiver_bank", 24, "distinct_banks_24h"),
    Feature("distinct", "receiver_account_id", 24, "distinct_receivers_24h"),
    Feature("sum", "is_cross_currency", 24, "cross_ccy_cnt_24h"),
    Feature("sum", "is_high_risk_format", 24, "high_risk_cnt_24h"),
]
# --- end of fixed values ---


def _split(features: Sequence[Feature]) -> tuple[list[Feature], list[Feature]]:
    unknown = [f.agg for f in features if f.agg not in ("count", "sum", "distinct")]
    if unknown:
        raise ValueError(f"unknown aggregates: {unknown}")
    return (
        [f for f in features if f.agg != "distinct"],
        [f for f in features if f.agg == "distinct"],
    )


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _tile(micros: Column, tile_micros: int) -> Column:
    return F.floor(micros / F.lit(tile_micros)).cast("long")


def _sum_parts(features: Sequence[Feature]) -> dict[str, tuple[Column, int]]:
    """Summed columns per feature: its count of values and, for sums, the total."""
    parts: dict[str, tuple[Column, int]] = {}
    for f in features:
        parts[f"{f.alias}__n"] = (F.when(F.col(f.column).isNotNull(), 1).otherwise(0).cast("long"), f.hours)
        if f.agg == "sum":
            parts[f"{f.alias}__s"] = (F.coalesce(F.col(f.column), F.lit(0)), f.hours)
    return parts


def _presence(timed: DataFrame, key: str, features: Sequence[Feature], tile_micros: int) -> DataFrame:
    """+1 when a value enters the window of a key, -1 when its last use has left it.

    Uses of one value no more than a window apart are one stay. Uses within a tile
    are merged first, so a pair that repeats all day is one row per tile.
    """
    values = F.array(
        *[
            F.struct(
                F.lit(f.alias).alias("feature"),
                F.col(f.column).cast("string").alias("value"),
                F.lit(f.hours * HOUR * MICROS).alias("window"),
            )
            for f in features
        ]
    )
    uses = (
        timed.select(key, "_tile", "_at", F.explode(values).alias("u"))
        .where(F.col("u.value").isNotNull())
        .groupBy(key, "u.feature", "u.value", "u.window", "_tile")
        .agg(F.min("_at").alias("first"), F.max("_at").alias("last"))
    )
    order = Window.partitionBy(key, "feature", "value").orderBy("_tile")
    window = F.col("window")
    opens = F.coalesce(F.col("first") - F.lag("last").over(order) > window, F.lit(True))
    closes = F.coalesce(F.lead("first").over(order) - F.col("last") > window, F.lit(True))
    stays = uses.select(key, "feature", "window", "first", "last", opens.alias("opens"), closes.alias("closes"))
    marks = F.array(
        F.struct(F.when(F.col("opens"), F.col("first")).alias("at"), F.lit(1).alias("step")),
        F.struct(F.when(F.col("closes"), F.col("last") + window + 1).alias("at"), F.lit(-1).alias("step")),
    )
    return (
        stays.select(key, "feature", F.explode(marks).alias("m"))
        .where(F.col("m.at").isNotNull())
        .groupBy(key, F.col("m.at").alias("_at"))
        .agg(*[F.sum(F.when(F.col("feature") == f.alias, F.col("m.step"))).alias(f.alias) for f in features])
        .withColumn("_tile", _tile(F.col("_at"), tile_micros))
    )


def _merge(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _tile_ends(
    points: DataFrame, key: str, parts: dict[str, tuple[Column, int]], tile_seconds: int
) -> DataFrame:
    """For every point and window the sum from the window's start to the end of the tile it starts in.

    Starts are put among the points of that tile and summed from its end backwards.
    """
    tiles = {h: h * HOUR // tile_seconds for _, h in parts.values()}
    starts = F.array(
        *[
            F.struct(
                F.lit(h).alias("hours"),
                (F.col("_at") - h * HOUR * MICROS).alias("at"),
                (F.col("_tile") - n).alias("tile"),
            )
            for h, n in sorted(tiles.items())
        ]
    )
    asked = points.where(F.col("_at").isNotNull()).select(key, F.col("_at").alias("_of"), F.explode(starts).alias("s"))
    asked = asked.select(key, "_of", F.col("s.hours").alias("_hours"), F.col("s.at").alias("_at"), F.col("s.tile").alias("_tile"))
    backwards = (
        Window.partitionBy(key, "_tile")
        .orderBy(F.desc("_at"))
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = _merge([points.where(F.col("_at").isNotNull()).drop("_asked"), asked]).withColumns(
        {name: F.when(F.coalesce(F.col("_hours"), F.lit(h)) == h, F.sum(name).over(backwards)) for name, (_, h) in parts.items()}
    )
    return summed.where(F.col("_of").isNotNull()).select(key, F.col("_of").alias("_at"), *parts)


def rolling_features(
    events: DataFrame,
    key: str,
    ts: str,
    features: Sequence[Feature] = VELOCITY_FEATURES,
    tile_seconds: int = HOUR,
) -> DataFrame:
    """``events`` plus one column per feature, exact as of every event.

    ``tile_seconds`` must divide every window; smaller tiles split busy keys finer.
    """
    additive, distinct = _split(features)
    tile_micros = tile_seconds * MICROS
    for f in features:
        if f.hours * HOUR % tile_seconds:
            raise ValueError(f"{f.alias}: the window is no multiple of {tile_seconds} seconds")
    parts = _sum_parts(additive)
    names = [f.alias for f in distinct]

    stamped = events.withColumn("_at", _micros(ts))
    points = (
        stamped.groupBy(key, "_at")
        .agg(
            F.count(F.lit(1)).alias("_asked"),
            *[F.sum(value).alias(name) for name, (value, _) in parts.items()],
        )
        .withColumn("_tile", _tile(F.col("_at"), tile_micros))
    )

    # One row per key and tile, with what happened in it.
    frames = [
        points.groupBy(key, "_tile")
        .agg(*[F.sum(name).alias(name) for name in ("_asked", *parts)])
    ]
    if distinct:
        used = stamped.where(F.col("_at").isNotNull())
        used = used.withColumn("_tile", _tile(F.col("_at"), tile_micros))
        presence = _presence(used, key, distinct, tile_micros)
        frames.append(presence.drop("_at"))
    per_tile = (
        _merge(frames)
        .groupBy(key, "_tile")
        .agg(*[F.sum(n).alias(n) for n in ("_asked", *parts, *names)])
    )
    # A window is whole tiles long, so it is the end of its first tile, full tiles, and the
    # start of the point's own tile. Full tiles and stays not yet closed come as a carry row.
    by_tile = Window.partitionBy(key).orderBy("_tile")
    before = by_tile.rowsBetween(Window.unboundedPreceding, -1)

    def full_tiles(name: str, hours: int) -> Column:
        n = hours * HOUR // tile_seconds - 1
        return F.sum(name).over(by_tile.rangeBetween(-n, -1)) if n else F.lit(None)

    carries = (
        per_tile.select(
            key,
            "_tile",
            "_asked",
            (F.col("_tile") * tile_micros).alias("_at"),
            *[full_tiles(name, h).cast(per_tile.schema[name].dataType).alias(name) for name, (_, h) in parts.items()],
            *[F.sum(name).over(before).alias(name) for name in names],
        )
        .where(F.col("_asked").isNotNull() & F.col("_tile").isNotNull())
        .drop("_asked")
    )
    upto = (
        Window.partitionBy(key, "_tile")
        .orderBy("_at")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = (
        _merge([points, carries, *([presence] if distinct else [])])
        .withColumns({name: F.sum(name).over(upto) for name in (*parts, *names)})
        .where(F.col("_asked").isNotNull())
    )
    ends = _tile_ends(points, key, parts, tile_seconds) if parts else None
    running = (
        _merge([running, *([ends] if parts else [])])
        .groupBy(key, "_at")
        .agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in (*parts, *names)])
    )

    def finished(f: Feature) -> Column:
        if f.agg == "sum":
            return F.when(F.col(f"{f.alias}__n") > 0, F.col(f"{f.alias}__s"))
        return F.col(f"{f.alias}__n" if f.agg == "count" else f.alias)

    answers = running.select(
        key, "_at", *[finished(f).alias(f.alias) for f in features]
    )
    heavy = heavy_keys(key_counts(stamped, [key, "_at"]), [key, "_at"])
    joined = left_join_by_key(stamped, [answers], [key, "_at"], heavy, null_safe=True)
    return joined.select(*events.columns, *[f.alias for f in features])


def features_as_of(
    events: DataFrame, key: str, ts: str, as_of: Column, features: Sequence[Feature] = VELOCITY_FEATURES
) -> DataFrame:
    """Per key its features over the windows that end at ``as_of``, from the events themselves.

    This is what a lookup at that moment returns; keys without events in the longest
    window have no row.
    """
    longest = max(f.hours for f in features)

    def inside(hours: int) -> Column:
        return F.col(ts) >= as_of - F.make_dt_interval(hours=F.lit(hours))

    aggs = []
    for f in features:
        value = F.when(inside(f.hours), F.col(f.column))
        agg = {"count": F.count, "sum": F.sum, "distinct": F.count_distinct}[f.agg]
        aggs.append(agg(value).alias(f.alias))
    return events.where(inside(longest) & (F.col(ts) <= as_of)).groupBy(key).agg(*aggs)


def hour_tiles(events: DataFrame, key: str, ts: str, features: Sequence[Feature] = VELOCITY_FEATURES) -> DataFrame:
    """Mergeable per-key hour totals; the same code serves a batch and a stream.

    Counts and sums add up, distinct counts are sketches that can be united.
    """
    aggs: dict[str, Column] = {}
    for f in features:
        if f.agg == "count":
            aggs[f"count_{f.column}"] = F.count(f.column)
        elif f.agg == "sum":
            aggs[f"sum_{f.column}"] = F.sum(f.column)
        else:
            aggs[f"sketch_{f.column}"] = F.hll_sketch_agg(f.column)
    return (
        events.groupBy(key, F.window(ts, "1 hour").alias("hour"))
        .agg(*[agg.alias(name) for name, agg in aggs.items()])
        .withColumn("hour", F.col("hour.start"))
    )


def merge_tiles(tiles: DataFrame, key: str) -> DataFrame:
    """One tile per key and hour from tiles that cover different events of it."""
    columns = []
    for name in tiles.columns:
        if name.startswith("sketch_"):
            columns.append(F.hll_union_agg(name).alias(name))
        elif name.startswith(("count_", "sum_")):
            columns.append(F.sum(name).alias(name))
    return tiles.groupBy(key, "hour").agg(*columns)


def roll_up(
    tiles: DataFrame, as_of: Column, key: str, features: Sequence[Feature] = VELOCITY_FEATURES
) -> DataFrame:
    """Features per key from its hour tiles, at tile grain.

    A window of h hours takes the tile that holds ``as_of`` and the h - 1 tiles before it.
    """
    age = F.floor((F.unix_timestamp(F.date_trunc("hour", as_of)) - F.unix_timestamp("hour")) / HOUR)
    aged = tiles.withColumn("_age", age).where(F.col("_age") >= 0)
    longest = max(f.hours for f in features)
    columns = []
    for f in features:
        inside = F.col("_age") < f.hours
        if f.agg == "count":
            value = F.coalesce(F.sum(F.when(inside, F.col(f"count_{f.column}"))), F.lit(0))
        elif f.agg == "sum":
            value = F.sum(F.when(inside, F.col(f"sum_{f.column}")))
        else:
            union = F.hll_union_agg(F.when(inside, F.col(f"sketch_{f.column}")))
            value = F.coalesce(F.hll_sketch_estimate(union), F.lit(0))
        columns.append(value.alias(f.alias))
    return aged.where(F.col("_age") < longest).groupBy(key).agg(*columns)


#: Levels of tile nodes: a node of level k covers 2^k hours. A longer window takes more nodes of the highest level's size.
LEVELS = 6


def _hour_number(at: Column) -> Column:
    return F.floor(F.unix_timestamp(at.cast("timestamp")) / HOUR).cast("long")


def _covering(first: Column, end: Column) -> Column:
    """The nodes (level, place) that cover the hours from ``first`` up to, not including, ``end``: two a level at most."""
    node = lambda level, place: F.struct(F.lit(level).alias("level"), place.alias("place"))
    # What lower levels leave open begins and ends at whole nodes of this one.
    at = lambda level: (F.shiftright(first + (2**level - 1), level), F.shiftright(end, level))
    found = []
    for level in range(LEVELS):
        left, right = at(level)
        odd = left % 2 == 1
        found.append(F.when((left < right) & odd, F.array(node(level, left))))
        found.append(F.when((right % 2 == 1) & (F.when(odd, left + 1).otherwise(left) < right), F.array(node(level, right - 1))))
    left, right = at(LEVELS)
    rest = F.when(left < right, F.transform(F.sequence(left, right - 1), lambda p: node(LEVELS, p)))
    none = F.array().cast("array<struct<level:int,place:bigint>>")
    return F.concat(*[F.coalesce(part, none) for part in (*found, rest)])


def roll_up_at(
    tiles: DataFrame, spine: DataFrame, key: str, at: str, features: Sequence[Feature] = VELOCITY_FEATURES
) -> DataFrame:
    """The rows of ``spine`` with their features at tile grain, each as of its own moment ``at``.

    As ``roll_up``, a window of h hours takes the tile that holds the moment and the h - 1 tiles before it. Tiles are
    merged per key into nodes of 1, 2, 4, ... hours, and each different key and hour of the spine asks for the
    few nodes that cover its windows; so a long window costs the logarithm of its length, and no range is joined.
    A row without a key or time, or without tiles, has counts of 0 and null sums.
    """
    hours = sorted({f.hours for f in features})
    hour = _hour_number(F.col("hour"))
    base = tiles.withColumn("place", hour).withColumn("level", F.lit(0)).drop("hour")
    nodes = base
    for level in range(1, LEVELS + 1):
        nodes = nodes.unionByName(base.withColumns({"level": F.lit(level), "place": F.shiftright("place", level)}))
    merged = []
    for name in tiles.columns:
        if name.startswith("sketch_"):
            merged.append(F.hll_union_agg(name).alias(name))
        elif name.startswith(("count_", "sum_")):
            merged.append(F.sum(name).alias(name))
    nodes = nodes.groupBy(F.col(key).alias("_key"), "level", "place").agg(*merged)
    asked = (
        spine.where(F.col(key).isNotNull() & F.col(at).isNotNull())
        .select(F.col(key).alias("_asker"), _hour_number(F.col(at)).alias("_hour"))
        .distinct()
    )
    parts = F.array(
        *[
            F.struct(F.lit(h).alias("_hours"), _covering(F.col("_hour") - (h - 1), F.col("_hour") + 1).alias("_nodes"))
            for h in hours
        ]
    )
    wanted = asked.select("_asker", "_hour", F.inline(parts)).select("_asker", "_hour", "_hours", F.inline("_nodes"))
    met = wanted.join(nodes, (F.col("_asker") == F.col("_key")) & (wanted["level"] == nodes["level"]) & (wanted["place"] == nodes["place"]))
    columns = []
    for f in features:
        inside = F.col("_hours") == f.hours
        if f.agg == "count":
            value = F.sum(F.when(inside, F.col(f"count_{f.column}")))
        elif f.agg == "sum":
            value = F.sum(F.when(inside, F.col(f"sum_{f.column}")))
        else:
            value = F.hll_sketch_estimate(F.hll_union_agg(F.when(inside, F.col(f"sketch_{f.column}"))))
        columns.append(value.alias(f.alias))
    answers = met.groupBy(F.col("_asker").alias(key), F.col("_hour").alias("_at")).agg(*columns)
    stamped = spine.withColumn("_at", _hour_number(F.col(at)))
    heavy = heavy_keys(key_counts(stamped, [key, "_at"]), [key, "_at"])
    joined = left_join_by_key(stamped, [answers], [key, "_at"], heavy)
    whole = [
        (F.col(f.alias) if f.agg == "sum" else F.coalesce(f.alias, F.lit(0)).cast("long")).alias(f.alias) for f in features
    ]
    return joined.select(*spine.columns, *whole)
