"""Report queries over events, the base table and predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _share_pct(label: str, digits: int) -> Column:
    return F.round(100.0 * F.sum(label) / F.count(F.lit(1)), digits)


def class_balance(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count(F.lit(1)).alias("n_txns"),
        F.sum("is_laundering").alias("n_laundering"),
        _share_pct("is_laundering", 3).alias("laundering_pct"),
        F.min("event_ts").alias("first_ts"),
        F.max("event_ts").alias("last_ts"),
    )


def rate_by(events: DataFrame, column: str) -> DataFrame:
    return (
        events.groupBy(column)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("is_laundering").alias("fraud"),
            _share_pct("is_laundering", 4).alias("fraud_pct"),
        )
        .orderBy(F.desc("n"), column)
    )


def split_summary(abt: DataFrame) -> DataFrame:
    """Rows and positives per split, in time order."""
    return (
        abt.groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("is_laundering").alias("positives"),
            F.min("event_ts").alias("first_ts"),
        )
        .orderBy("first_ts")
        .drop("first_ts")
    )


def abt_totals(abt: DataFrame) -> DataFrame:
    return abt.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("is_laundering").alias("positives"),
        _share_pct("is_laundering", 3).alias("positive_pct"),
        F.count_distinct("split").alias("n_splits"),
    )


def score_separation(predictions: DataFrame, wide: bool = False) -> DataFrame:
    """Mean score of fraud and normal rows, one row per class or one row in all."""
    is_fraud = F.col("label") == 1
    if wide:
        return predictions.agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.avg(F.when(is_fraud, F.col("fraud_score"))), 3).alias("avg_fraud"),
            F.round(F.avg(F.when(F.col("label") == 0, F.col("fraud_score"))), 3).alias("avg_normal"),
        )
    return (
        predictions.groupBy(F.when(is_fraud, "fraud").otherwise("normal").alias("class"))
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("fraud_score"), 3).alias("avg_score"))
        .orderBy("class")
    )


def top_risk(predictions: DataFrame, k: int = 10, tie: str = "event_key") -> DataFrame:
    """The ``k`` highest scores; ties in the order of the row key."""
    return predictions.orderBy(F.desc("fraud_score"), tie).limit(k)
