"""The labelled base table: events with request context and a chronological split."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from riskfeat import schemas as S
from riskfeat.functions import columns as C
from riskfeat.operators.joins import heavy_keys, left_join_by_key
from riskfeat.operators.ordering import percentiles

DAY_SECONDS = 86_400
ABT_COLUMNS = [
    "account_id",
    "event_ts",
    "amount_paid",
    "payment_currency",
    "receiving_currency",
    "payment_format",
    "is_cross_currency",
    "is_cross_border",
    "is_high_risk_format",
    "to_country",
    "amount_to_avg_ratio",
    "is_laundering",
    "split",
]


def split_thresholds(
    events: DataFrame, train: float = S.TRAIN_FRACTION, val: float = S.VAL_FRACTION
) -> DataFrame:
    """One row with the epoch seconds that end the train and the validation period."""
    seconds = events.select(F.unix_timestamp("event_ts").alias("epoch"))
    return percentiles(seconds, "epoch", {"p_train": train, "p_val": train + val}, DAY_SECONDS)


def split_of(ts: Column, cuts: Column) -> Column:
    """TRAIN, VAL or TEST; a missing time counts as TEST."""
    p_train, p_val = (C.epoch_to_ntz(cuts[name]) for name in ("p_train", "p_val"))
    return F.when(ts <= p_train, "TRAIN").when(ts <= p_val, "VAL").otherwise("TEST")


def with_split(events: DataFrame, thresholds: DataFrame) -> DataFrame:
    cuts = thresholds.select(F.struct("p_train", "p_val").alias("cuts")).scalar()
    return events.withColumn("_cuts", cuts).withColumn("split", split_of(F.col("event_ts"), F.col("_cuts"))).drop("_cuts")


def heavy_accounts(history: DataFrame) -> DataFrame:
    """Accounts whose events need salting; the history already holds their counts."""
    return heavy_keys(history.select("account_id", "hist_txn_count"), "account_id", "hist_txn_count")


def build_abt(
    events: DataFrame,
    history: DataFrame,
    thresholds: DataFrame,
    heavy: DataFrame | None = None,
    features: DataFrame | None = None,
) -> DataFrame:
    """ABT rows, one per event; columns the ABT does not know, such as a row key, are kept.

    The same function builds the table for any environment. ``features``, one row per account with its
    mean amount among them, come along in the same join.
    """
    known = {
        "receiver_account_id",
        "receiver_bank",
        "is_cross_bank",
        "from_country",
        "amount_received",
        *ABT_COLUMNS,
    }
    extra = [c for c in events.columns if c not in known]
    needed = [c for c in ABT_COLUMNS if c in events.columns] + extra
    side = history.select("account_id", "hist_avg_amount") if features is None else features
    added = [] if features is None else [c for c in features.columns if c != "account_id"]
    heavy = heavy_accounts(history) if heavy is None else heavy
    joined = left_join_by_key(events.select(needed), [side], "account_id", heavy)
    ratio = C.safe_div(F.col("amount_paid"), F.col("hist_avg_amount"))
    return with_split(joined.withColumn("amount_to_avg_ratio", ratio), thresholds).select(
        *ABT_COLUMNS, *extra, *added
    )


def last_days(df: DataFrame, ts: str, days: int = 1, newest: str | None = None) -> DataFrame:
    """Rows no older than ``days`` before the newest one; of a table by month only the months they are in.

    Where the newest time is known, as from the commit of a written table, ``newest`` saves the pass that looks for it,
    and months and row groups are chosen by constants.
    """
    if newest is None:
        found = df.agg(F.max(ts).alias("newest")).select("newest")
        oldest = found.select((F.col("newest") - F.make_dt_interval(days=F.lit(days))).alias("oldest")).scalar()
    else:
        # A constant, so that it reaches the scan.
        oldest = F.lit(dt.datetime.fromisoformat(newest) - dt.timedelta(days=days)).cast(df.schema[ts].dataType)
    recent = df.where(F.col(ts) >= oldest)
    if "event_month" not in df.columns:
        return recent
    return recent.where(F.col("event_month") >= F.date_format(oldest, "yyyy-MM")).drop("event_month")
