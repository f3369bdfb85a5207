"""Order statistics and running totals that never sort all rows in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

HASH_PREFIX = 4
#: Rows that one task orders at the edge of a sample.
ORDERED_ROWS = 100_000
#: Distinct values that one task orders.
VALUES_PER_BUCKET = 500_000


def percentiles(df: DataFrame, value: str, wanted: Mapping[str, float], width: int) -> DataFrame:
    """Exact interpolated percentiles of a whole-number column, as one row.

    Rows are counted per value, values per bucket of ``width`` units. Only the bucket
    totals are ordered together, so the one-task step is bounded by the value
    range over ``width``; the buckets that hold a wanted rank are then opened.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(F.col(value).alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("b", F.floor(F.col("v") / width))
    )
    everything = Window.partitionBy()
    totals = (
        counts.groupBy("b")
        .agg(F.sum("n").alias("n"))
        .select(
            "b",
            "n",
            (F.sum("n").over(everything.orderBy("b")) - F.col("n")).alias("before"),
            F.sum("n").over(everything).alias("total"),
        )
    )
    ranks = []
    for name, fraction in wanted.items():
        position = F.lit(fraction) * (F.col("total") - 1)
        weight = position - F.floor(position)
        ranks += [
            F.struct(F.lit(name).alias("name"), F.floor(position).alias("rank"), (1 - weight).alias("w")),
            F.struct(F.lit(name).alias("name"), F.ceil(position).alias("rank"), weight.alias("w")),
        ]
    targets = (
        totals.withColumn("t", F.explode(F.array(*ranks)))
        .where((F.col("t.rank") >= F.col("before")) & (F.col("t.rank") < F.col("before") + F.col("n")))
        .select("b", "before", "t.*")
    )
    # At most two ranks per wanted percentile, hence a safe broadcast.
    opened = counts.join(F.broadcast(targets), "b")
    upto = F.col("before") + F.sum("n").over(
        Window.partitionBy("b", "name", "rank", "w").orderBy("v")
    )
    at_rank = opened.withColumn("upto", upto).where(
        (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n"))
    )
    return at_rank.agg(
        *[
            F.sum(F.when(F.col("name") == name, F.col("v") * F.col("w"))).alias(name)
            for name in wanted
        ]
    )


def _key_hash(key: str) -> Column:
    return F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))


def _prefix_counts(rows: DataFrame, digits: Column) -> DataFrame:
    """Rows per value of the digits, and those up to it."""
    return (
        rows.groupBy(digits.alias("digits"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("upto", F.sum("rows").over(Window.partitionBy().orderBy("digits")))
    )


def near_first(df: DataFrame, key: str, n: int) -> Column:
    """Whether a row can be among the ``first_by_hash`` of ``df``: its key's hash starts no later than the n-th does.

    All rows of the last prefix are in, so that the choice among these rows is that among all, whatever other columns say.
    """
    digits = F.substring(_key_hash(key), 1, HASH_PREFIX)
    last = _prefix_counts(df, digits).where(F.col("upto") >= n).agg(F.min("digits")).first()[0]
    return F.lit(True) if last is None else digits <= last


def first_by_hash(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest MD5 of ``key``: a repeatable random choice.

    Rows of one key, or without a key, go by the MD5 of the whole row. The two hashes are read four
    digits at a time: rows are counted per value (65,536 of them), all values below the one where the count
    crosses ``n`` are kept whole, and the next digits split that one, until it has few enough rows
    to be ordered in one task. So no key, however many rows it has, is ordered as a whole.
    """
    by_key = _key_hash(key)
    by_row = F.md5(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    kept, rest, missing = df.limit(0), df, n
    for hashed, start in [(h, at) for h in (by_key, by_row) for at in range(1, 33, HASH_PREFIX)]:
        digits = F.substring(hashed, start, HASH_PREFIX)
        before = F.col("upto") - F.col("rows")
        counts = _prefix_counts(rest, digits)
        crossing = counts.where((F.col("upto") > missing) & (before <= missing)).select(
            "digits", "rows", (F.lit(missing) - before).alias("missing")
        )
        edge = crossing.first()
        if edge is None:
            return kept.unionByName(rest)
        kept = kept.unionByName(rest.where(digits < edge["digits"]))
        rest, missing = rest.where(digits == edge["digits"]), edge["missing"]
        if edge["rows"] <= ORDERED_ROWS:
            break
    # Equal rows are counted, not ordered one by one, and the wanted number is repeated.
    order = Window.partitionBy().orderBy(by_key, by_row, *df.columns)
    taken = F.least("copies", missing - F.col("upto") + F.col("copies"))
    part = (
        rest.groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("upto", F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("taken", taken)
        .where(F.col("taken") > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("taken"))))
    )
    return kept.unionByName(part.select(df.columns))


def range_boundaries(df: DataFrame, value: str, buckets: int | None = None) -> list[float]:
    """At most ``buckets - 1`` cut points that split the values about evenly.

    Without ``buckets`` their number follows from that of the distinct values, and is no less than that of
    the shuffle partitions. The cuts come to the driver as literals, so every branch of the plan that
    follows, and every recomputed task, uses the same ones.
    """
    if buckets is None:
        distinct = df.agg(F.approx_count_distinct(value).alias("n")).first()["n"]
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(tasks, -(-distinct // VALUES_PER_BUCKET))
    if buckets == 1:
        return []
    cuts = df.agg(
        F.percentile_approx(value, [i / buckets for i in range(1, buckets)], 20 * buckets).alias("cuts")
    ).first()["cuts"]
    return sorted({float(c) for c in cuts or []})


def running_totals(
    df: DataFrame, value: str, sums: Sequence[str], boundaries: Sequence[float]
) -> DataFrame:
    """Adds ``<sum>_upto``, summed over rows with a value at or above, and ``<sum>_total``.

    ``df`` holds one row per value. Each range bucket is summed on its own and then
    lifted by the total of the buckets above it, a table with one row per bucket.
    """
    inf = float("inf")
    cutter = Bucketizer(splits=[-inf, *(boundaries or [0.0]), inf], inputCol=value, outputCol="_bucket")
    bucketed = cutter.transform(df.withColumn(value, F.col(value).cast("double")))
    all_buckets = Window.partitionBy()
    above = all_buckets.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    lifts = (
        bucketed.groupBy("_bucket")
        .agg(*[F.sum(c).alias(c) for c in sums])
        .select(
            "_bucket",
            *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in sums],
            *[F.sum(c).over(all_buckets).alias(f"{c}_total") for c in sums],
        )
    )
    inside = Window.partitionBy("_bucket").orderBy(F.desc(value))
    return (
        bucketed.withColumns({f"{c}_upto": F.sum(c).over(inside) for c in sums})
        .join(F.broadcast(lifts), "_bucket")
        .withColumns({f"{c}_upto": F.col(f"{c}_upto") + F.col(f"{c}_above") for c in sums})
        .select(*df.columns, *[f"{c}_{part}" for part in ("upto", "total") for c in sums])
    )
