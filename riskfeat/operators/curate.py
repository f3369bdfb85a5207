"""Raw payments and accounts to dimensions, events and account history."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskfeat import schemas as S
from riskfeat.functions import columns as C
from riskfeat.operators.joins import fits_broadcast, join_dimension

EVENT_COLUMNS = [
    "account_id",
    "receiver_account_id",
    "receiver_bank",
    "event_ts",
    "amount_paid",
    "payment_currency",
    "receiving_currency",
    "payment_format",
    "is_cross_currency",
    "is_cross_bank",
    "is_high_risk_format",
    "from_country",
    "to_country",
    "is_cross_border",
    "is_laundering",
]


def bank_dim(accounts: DataFrame) -> DataFrame:
    """One row per bank. Of several names the smallest is taken, so reruns agree."""
    return (
        accounts.groupBy("bank_id")
        .agg(F.min("bank_name").alias("bank_name"))
        .withColumn("bank_country", C.bank_country(F.col("bank_name")))
    )


def account_dim(accounts: DataFrame, banks: DataFrame) -> DataFrame:
    return join_dimension(accounts, banks.select("bank_id", "bank_country"), "bank_id").select(
        C.account_id(F.col("bank_id"), F.col("account_number")).alias("account_id"),
        "bank_id",
        "bank_country",
        "entity_id",
        C.entity_type(F.col("entity_name")).alias("entity_type"),
    )


def txn_events(txns: DataFrame, banks: DataFrame, cutoff: str = S.TAIL_CUTOFF_DATE) -> DataFrame:
    """Sender-side events before the cutoff; columns beyond the landing ones pass through."""
    extra = [c for c in txns.columns if c not in S.TXN_SCHEMA.names]
    # No filter moves below a generator, where it would parse every time once more.
    parsed = txns.select("*", F.explode(F.array(C.parse_event_ts(F.col("txn_timestamp")))).alias("event_ts"))
    in_window = parsed.where(F.col("event_ts") < F.lit(cutoff).cast("timestamp_ntz"))
    sender = banks.select(
        F.col("bank_id").alias("from_bank"), F.col("bank_country").alias("from_country")
    )
    receiver = banks.select(
        F.col("bank_id").alias("to_bank"), F.col("bank_country").alias("to_country")
    )
    small = fits_broadcast(sender)
    located = join_dimension(in_window, sender, "from_bank", small)
    located = join_dimension(located, receiver, "to_bank", small)
    home = F.coalesce("from_country", F.lit(S.DEFAULT_COUNTRY))
    away = F.coalesce("to_country", F.lit(S.DEFAULT_COUNTRY))
    return (
        located.withColumn("account_id", C.account_id(F.col("from_bank"), F.col("from_account")))
        .withColumn("receiver_account_id", C.account_id(F.col("to_bank"), F.col("to_account")))
        .withColumn("receiver_bank", F.col("to_bank"))
        .withColumn("is_cross_currency", C.flag(F.col("receiving_currency") != F.col("payment_currency")))
        .withColumn("is_cross_bank", C.flag(F.col("from_bank") != F.col("to_bank")))
        .withColumn("is_high_risk_format", C.flag(F.col("payment_format").isin(S.HIGH_RISK_FORMATS)))
        .withColumn("is_cross_border", C.flag(home != away))
        .select(*EVENT_COLUMNS, *extra)
    )


def account_history(events: DataFrame, accounts: DataFrame, approx: bool = False) -> DataFrame:
    """Lifetime statistics per sending account.

    Both sides shrink to one row per account before they meet, so a repeated
    account row cannot inflate the counts and a busy account is combined on the
    map side. ``approx`` trades the exact distinct counts for sketches.
    """
    distinct = F.approx_count_distinct if approx else F.count_distinct
    stats = events.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("hist_txn_count"),
        F.avg("amount_paid").alias("hist_avg_amount"),
        F.coalesce(F.stddev_samp("amount_paid"), F.lit(0.0)).alias("hist_std_amount"),
        F.max("amount_paid").alias("hist_max_amount"),
        distinct("receiver_account_id").alias("hist_distinct_receivers"),
        distinct("receiver_bank").alias("hist_distinct_receiver_banks"),
        distinct("to_country").alias("hist_distinct_countries"),
        F.avg("is_cross_currency").alias("hist_foreign_ccy_share"),
        F.avg("is_high_risk_format").alias("hist_high_risk_share"),
        F.max("event_ts").alias("last_activity_ts"),
    )
    owners = accounts.groupBy("account_id").agg(
        F.min("entity_type").alias("entity_type"), F.min("bank_country").alias("home_country")
    )
    return stats.join(owners, "account_id", "left")
