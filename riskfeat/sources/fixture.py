"""The order tables seen as payments: one line item is one transaction.

Payer is the customer, payee the supplier, and nations stand in for banks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskfeat.operators.joins import fits_broadcast
from riskfeat.schemas import TXN_TIMESTAMP_FORMAT
from riskfeat.sources.files import spread

CUTOFF = "2001-07-01"

FORMAT_BY_PRIORITY = {
    "1-URGENT": "Wire",
    "2-HIGH": "Credit Card",
    "3-MEDIUM": "ACH",
    "4-NOT SPECIFIED": "Cash",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _payment_format(priority: Column) -> Column:
    chosen = F.lit("Bitcoin")
    for value, payment_format in FORMAT_BY_PRIORITY.items():
        chosen = F.when(priority == value, payment_format).otherwise(chosen)
    return chosen


def transactions(spark: SparkSession, sf_dir: str, keep: Sequence[str] = ()) -> DataFrame:
    """Landing-shaped transactions plus ``event_key``, the unique row identity, and ``keep`` as it is.

    Lines meet their orders once, and these their customers before, so lines are shuffled by one key only.
    """
    nation = table(spark, sf_dir, "nation")
    payer_region = nation.select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("c_regionkey")
    )
    payee_region = nation.select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").alias("s_regionkey")
    )
    lines = spread(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber", "l_partkey")
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    payees = supplier.join(F.broadcast(payee_region), "s_nationkey")
    payees = F.broadcast(payees) if fits_broadcast(payees) else payees
    paid = orders.join(
        customer.join(F.broadcast(payer_region), "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
    )
    joined = lines.join(paid, F.col("l_orderkey") == F.col("o_orderkey")).join(
        payees, F.col("l_suppkey") == F.col("s_suppkey")
    )
    minute = F.pmod(F.col("l_linenumber") * 7 + F.col("l_suppkey"), F.lit(60))
    stamp = F.col("o_orderdate") + F.make_dt_interval(
        hours=F.pmod("l_orderkey", F.lit(24)).cast("int"), mins=minute.cast("int")
    )
    suspicious = (
        (F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.10) & (F.col("l_quantity") >= 45)
    )
    return joined.select(
        F.date_format(stamp, TXN_TIMESTAMP_FORMAT).alias("txn_timestamp"),
        F.col("c_nationkey").cast("string").alias("from_bank"),
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("from_account"),
        F.col("s_nationkey").cast("string").alias("to_bank"),
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("to_account"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount_received"),
        F.col("s_regionkey").cast("string").alias("receiving_currency"),
        F.col("l_extendedprice").alias("amount_paid"),
        F.col("c_regionkey").cast("string").alias("payment_currency"),
        _payment_format(F.col("o_orderpriority")).alias("payment_format"),
        F.when(suspicious, 1).otherwise(0).alias("is_laundering"),
        F.concat_ws(
            "-",
            *[
                F.col(c).cast("string")
                for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
            ],
        ).alias("event_key"),
        *keep,
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers as account rows, with one misspelt bank name."""
    nation = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    bank_name = (
        F.when(key == 7, "Crytpo Bank #7")
        .when(key % 5 == 0, "First Community Bank")
        .otherwise(F.concat("n_name", F.lit(" Bank #"), key.cast("string")))
    )

    def rows(name: str, prefix: str, nation_key: str, entity_key: str, label: Column) -> DataFrame:
        entity = F.col(entity_key).cast("string")
        return (
            table(spark, sf_dir, name)
            .join(nation, F.col(nation_key) == key)
            .select(
                bank_name.alias("bank_name"),
                key.cast("string").alias("bank_id"),
                F.concat(F.lit(prefix), entity).alias("account_number"),
                entity.alias("entity_id"),
                F.concat(label, F.lit(" #"), entity).alias("entity_name"),
            )
        )

    payers = rows("customer", "C", "c_nationkey", "c_custkey", F.col("c_mktsegment"))
    payees = rows("supplier", "S", "s_nationkey", "s_suppkey", F.lit("Supplier"))
    return payers.unionByName(payees)


def payment_events(events: DataFrame) -> DataFrame:
    """The ``events`` table, batch or stream, in the shape of the payment stream.

    ``event_id`` is kept as the row identity; ``event_ts`` keeps the type it had.
    """
    kind = F.col("event_type")
    return events.select(
        "event_id",
        F.col("user_id").cast("string").alias("account_id"),
        F.col("ts").alias("event_ts"),
        F.col("value").alias("amount_paid"),
        F.get_json_object("props", "$.k").alias("receiver_account_id"),
        kind.alias("receiver_bank"),
        F.when(kind == "error", 1).otherwise(0).cast("long").alias("is_cross_currency"),
        F.when(kind == "purchase", 1).otherwise(0).cast("long").alias("is_high_risk_format"),
    )
