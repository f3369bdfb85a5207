"""Account history kept up to date by loads, without reading earlier events again.

Two tables hold what statistics of different loads need to be merged exactly: per account counts, mean, sum of squared deviations,
maximum and sums of flags; and per account the different values whose number is asked for. The first has as many rows as
accounts. The second lies in parts: each load adds one that has its own values once, and ``FAN`` parts of a level merge into one of the
next. So a value moves once per level, not with every load, and there are as many parts as the logarithm of the loads.
"""

from __future__ import annotations

from functools import reduce
from itertools import takewhile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskfeat.sources import files

#: Columns whose different values are counted, and the feature that they give.
DISTINCT = {
    "receiver_account_id": "hist_distinct_receivers",
    "receiver_bank": "hist_distinct_receiver_banks",
    "to_country": "hist_distinct_countries",
}
FLAGS = {"is_cross_currency": "hist_foreign_ccy_share", "is_high_risk_format": "hist_high_risk_share"}
STATE, VALUES = "history_state", "history_values"
#: Parts of a level that merge into one of the next.
FAN = 8
LEVEL = "level_"


def stats_of(events: DataFrame) -> DataFrame:
    """Mergeable statistics per account. A null account is an account; null amounts and flags do not count."""
    n = F.count("amount_paid")
    return events.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        n.alias("n_amounts"),
        F.coalesce(F.avg("amount_paid"), F.lit(0.0)).alias("mean"),
        (F.coalesce(F.var_pop("amount_paid"), F.lit(0.0)) * n).alias("squares"),
        F.max("amount_paid").alias("largest"),
        *[F.count(c).alias(f"n_{c}") for c in FLAGS],
        *[F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0)).alias(f"sum_{c}") for c in FLAGS],
        F.max("event_ts").alias("last"),
    )


def values_of(events: DataFrame) -> DataFrame:
    """(account_id, kind, value): each value of an account once."""
    pairs = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("value")) for c in DISTINCT])
    found = events.select("account_id", F.inline(pairs)).where(F.col("value").isNotNull())
    return found.distinct()


def merged_stats(old: DataFrame, new: DataFrame) -> DataFrame:
    """Statistics of both; means and squares merge pairwise, so nothing large is subtracted."""
    both = old.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))

    def side(column: str, is_new: bool) -> Column:
        return F.coalesce(F.max(F.when(F.col("_new") == is_new, F.col(column))), F.lit(0))

    n, m = side("n_amounts", False).cast("double"), side("n_amounts", True).cast("double")
    apart = side("mean", True) - side("mean", False)
    whole = F.greatest(n + m, F.lit(1.0))
    summed = ["n_rows", "n_amounts", *[f"{kind}_{c}" for c in FLAGS for kind in ("n", "sum")]]
    return both.groupBy("account_id").agg(
        *[F.sum(c).alias(c) for c in summed],
        (side("mean", False) + apart * m / whole).alias("mean"),
        (F.sum("squares") + apart * apart * n * m / whole).alias("squares"),
        *[F.max(c).alias(c) for c in ("largest", "last")],
    ).select(new.columns)


def merged_values(*some: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, some).distinct()


def _newest(parts: list[tuple[int, int]], level: int) -> list[tuple[int, int]]:
    """The last parts, as far as they are of a level."""
    return list(takewhile(lambda part: part[1] == level, reversed(parts)))


def parts_of(spark: SparkSession, root: str) -> list[tuple[int, int]]:
    """(version, level) of the parts that hold the values. A version without a level is the whole table."""
    live: list[tuple[int, int]] = []
    for entry in files.versions(spark, root, VALUES):
        levels = [int(name.removeprefix(LEVEL)) for name in entry["seen"] if name.startswith(LEVEL)]
        merged = len(_newest(live, levels[0] - 1)) if levels else len(live)
        live = [*live[: len(live) - merged], (entry["number"], *(levels or [0]))]
    return live


def read_values(spark: SparkSession, root: str) -> DataFrame:
    """(account_id, kind, value): each value of an account once, over all loads."""
    return merged_values(*[files.read_version(spark, root, VALUES, number) for number, _ in parts_of(spark, root)])


def add_values(spark: SparkSession, root: str, fresh: DataFrame) -> None:
    """Add a part; a level that is full then merges into one part of the next."""

    def write(df: DataFrame, level: int) -> None:
        # The name of the statistic tells the level, also of a part without rows.
        files.write_version(df, root, VALUES, (), {f"{LEVEL}{level}": F.count(F.lit(1))})

    write(fresh, 0)
    level = 0
    while len(full := _newest(parts_of(spark, root), level)) >= FAN:
        level += 1
        write(merged_values(*[files.read_version(spark, root, VALUES, number) for number, _ in full]), level)


def history_of(stats: DataFrame, values: DataFrame, accounts: DataFrame) -> DataFrame:
    """The account history that ``account_history`` gives for all events that went into the tables."""
    kinds = [F.count(F.when(F.col("kind") == c, 1)).alias(name) for c, name in DISTINCT.items()]
    counts = values.groupBy(F.col("account_id").alias("_account")).agg(*kinds)
    owners = accounts.groupBy("account_id").agg(
        F.min("entity_type").alias("entity_type"), F.min("bank_country").alias("home_country")
    )
    n = F.col("n_amounts")
    spread = F.when(n > 1, F.sqrt(F.col("squares") / F.nullif(n - 1, F.lit(0)))).otherwise(0.0)
    share = {name: F.col(f"sum_{c}") / F.nullif(F.col(f"n_{c}"), F.lit(0)) for c, name in FLAGS.items()}
    described = stats.join(counts, F.col("account_id").eqNullSafe(F.col("_account")), "left").select(
        "account_id",
        F.col("n_rows").alias("hist_txn_count"),
        F.when(n > 0, F.col("mean")).alias("hist_avg_amount"),
        spread.alias("hist_std_amount"),
        F.col("largest").alias("hist_max_amount"),
        *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in DISTINCT.values()],
        *[column.alias(name) for name, column in share.items()],
        F.col("last").alias("last_activity_ts"),
    )
    return described.join(owners, "account_id", "left")


def add_load(spark: SparkSession, root: str, events: DataFrame) -> None:
    """Bring the events of one load into the tables below ``root``; earlier events are not read.

    Values go first: to add the same ones again changes nothing. So a load that died before its statistics were
    committed can be added again. One writer at a time.
    """
    add_values(spark, root, values_of(events))
    fresh, have = stats_of(events), files.current_version(spark, root, STATE)
    files.write_version(merged_stats(files.read_version(spark, root, STATE, have), fresh) if have else fresh, root, STATE)


def current(spark: SparkSession, root: str, accounts: DataFrame) -> DataFrame:
    return history_of(files.read_version(spark, root, STATE), read_values(spark, root), accounts)
