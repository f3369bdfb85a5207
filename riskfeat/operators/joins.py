"""Equi-joins that stay balanced when one key owns a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
#: A key with less than this part of all rows needs no salt, so that no list of keys is longer.
MOST_HEAVY = 10_000
ROWS_PER_SALT = 1_000_000
_SALT = "_salt"


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure a candidate broadcast side; every field counts 16 bytes plus its text."""
    fixed = 16 * len(df.columns)
    texts = [
        F.coalesce(F.octet_length(f.name), F.lit(0))
        for f in df.schema.fields
        if f.dataType.typeName() == "string"
    ]
    width = reduce(Column.__add__, texts, F.lit(fixed))
    size = df.agg(F.sum(width.cast("long")).alias("size")).first()["size"]
    return (size or 0) <= max_bytes


def _names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def heavy_keys(
    counts: DataFrame,
    key: str | Sequence[str],
    rows: str = "n_rows",
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Keys too large for one task, and the number of salts each needs.

    ``counts`` holds one row per key. Listed is every key with more than ``rows_per_salt`` rows and more
    than one part in ``MOST_HEAVY`` of all rows: fewer than ``MOST_HEAVY`` keys can have that
    many, which bounds the list.
    """
    names = _names(key)
    least = counts.agg((F.sum(rows) / MOST_HEAVY).alias("least")).select("least").scalar()
    return counts.where((F.col(rows) > rows_per_salt) & (F.col(rows) > least)).select(
        *names, F.ceil(F.col(rows) / rows_per_salt).cast("int").alias("_salts")
    )


def key_counts(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    return df.groupBy(*_names(key)).agg(F.count(F.lit(1)).alias("n_rows"))


def _null_safe(left: DataFrame, right: DataFrame, names: Sequence[str], suffix: str) -> Column:
    return reduce(Column.__and__, [left[n].eqNullSafe(right[n + suffix]) for n in names])


def _with_salts(df: DataFrame, heavy: DataFrame, names: Sequence[str]) -> DataFrame:
    marks = heavy.withColumnsRenamed({n: f"{n}_heavy" for n in names})
    return (
        df.join(F.broadcast(marks), _null_safe(df, marks, names, "_heavy"), "left")
        .drop(*[f"{n}_heavy" for n in names])
        .withColumn("_salts", F.coalesce("_salts", F.lit(1)))
    )


def left_join_by_key(
    left: DataFrame,
    rights: Sequence[DataFrame],
    key: str | Sequence[str],
    heavy: DataFrame,
    null_safe: bool = False,
) -> DataFrame:
    """``left`` joined with several sides that hold one row per key.

    Rows of a heavy key spread over as many salts as its size calls for, and the one
    matching row of each right side is repeated per salt. The salt is a hash of
    the row, so a lost task recomputes the same one; rows should differ in
    some column, such as a row key. All joins share one shuffle of ``left``. NULL keys are
    spread in the same way; they match each other only when ``null_safe``.
    """
    names = _names(key)
    salted = (
        _with_salts(left, heavy, names)
        .withColumn(_SALT, F.pmod(F.xxhash64(*left.columns), F.col("_salts")).cast("int"))
        .drop("_salts")
    )
    for right in rights:
        copies = (
            _with_salts(right, heavy, names)
            .withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
            .drop("_salts")
        )
        if null_safe:
            copies = copies.withColumnsRenamed({n: f"{n}_right" for n in [*names, _SALT]})
            matches = _null_safe(salted, copies, [*names, _SALT], "_right")
            salted = salted.join(copies, matches, "left").drop(*[f"{n}_right" for n in [*names, _SALT]])
        else:
            salted = salted.join(copies, [*names, _SALT], "left")
    return salted.drop(_SALT)


def join_dimension(left: DataFrame, dim: DataFrame, key: str, small: bool | None = None) -> DataFrame:
    """Left join with a dimension: broadcast when measured small, else salted."""
    if fits_broadcast(dim) if small is None else small:
        return left.join(F.broadcast(dim), key, "left")
    return left_join_by_key(left, [dim], key, heavy_keys(key_counts(left, key), key))


def latest_by_key(df: DataFrame, key: str, ts: str) -> DataFrame:
    """The row with the greatest time per key; ties go to the greatest remaining values."""
    rest = [c for c in df.columns if c not in (key, ts)]
    row = F.max(F.struct(ts, *rest)).alias("row")
    return (
        df.where(F.col(ts).isNotNull()).groupBy(key).agg(row).select(key, "row.*").select(df.columns)
    )


def lookup(latest: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """One row per requested key from a latest-by-key table; unknown keys have NULLs."""
    return keys.select(key).distinct().join(latest, key, "left")


def asof_join(
    spine: DataFrame,
    features: DataFrame,
    key: str,
    ts: str,
    strict: bool = False,
    tile: str = "day",
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """For each spine row the last feature row of its key at or before its time.

    ``strict`` asks for strictly before. Spine rows are merged with the feature rows by key and
    calendar tile, instead of by key alone: what a tile inherits from earlier ones comes in as a
    single carry row, found over one row per key and tile. Spine rows move once. Those of a large
    tile spread over salts, and its feature rows are repeated per salt.
    """
    values = [c for c in features.columns if c not in (key, ts)]
    names = {*spine.columns, *values}

    def free(name: str) -> str:
        while name in names:
            name = f"_{name}"
        return name

    at, rank, fact, mine = map(free, ("_tile", "_rank", "_fact", "_mine"))
    tile_of = F.date_trunc(tile, F.col(ts)).cast("timestamp_ntz")
    point_rank, fact_rank = (1, 2) if strict else (2, 1)

    points = spine.withColumns({at: tile_of, rank: F.lit(point_rank), mine: F.lit(True)})
    facts = (
        features.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
        .groupBy(key, ts)
        .agg(F.max(F.struct(ts, *values)).alias(fact))
        .withColumn(at, tile_of)
    )
    asked = points.groupBy(key, at).agg(F.count(F.lit(1)).alias(mine))
    last_facts = facts.groupBy(key, at).agg(F.max(fact).alias(fact))
    # A tile asks before its own facts are known. No fact is before a missing tile, or has a missing key.
    earlier = (
        Window.partitionBy(key).orderBy(at, F.asc_nulls_last(mine)).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        last_facts.unionByName(asked, allowMissingColumns=True)
        .withColumn(fact, F.last(fact, ignorenulls=True).over(earlier))
        .where(F.col(mine).isNotNull() & F.col(fact).isNotNull())
        .select(key, at, F.col(at).alias(ts), F.lit(0).alias(rank), fact)
    )
    heavy = heavy_keys(asked, [key, at], mine, rows_per_salt)
    salted = _with_salts(points, heavy, [key, at])
    salted = salted.withColumn(_SALT, F.pmod(F.xxhash64(*spine.columns), F.col("_salts")).cast("int")).drop("_salts")
    known = facts.withColumn(rank, F.lit(fact_rank)).unionByName(carried)
    known = _with_salts(known, heavy, [key, at])
    known = known.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    in_order = (
        Window.partitionBy(key, at, _SALT).orderBy(ts, rank).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    answered = (
        salted.unionByName(known, allowMissingColumns=True)
        .withColumn(fact, F.last(fact, ignorenulls=True).over(in_order))
        .where(F.col(mine))
    )
    kinds = {f.name: f.dataType for f in spine.schema.fields}
    return answered.select(
        *[F.col(c).cast(kinds[c]).alias(c) if c in (key, ts) else c for c in spine.columns],
        *[F.col(f"{fact}.{c}").alias(c) for c in values],
    )
