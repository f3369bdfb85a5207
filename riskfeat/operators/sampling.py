"""Class imbalance: a repeatable sample of negatives and row weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskfeat import schemas as S
from riskfeat.operators.ordering import first_by_hash, near_first


def train_sample(abt: DataFrame, n_neg: int = S.TRAIN_NEGATIVES, key: str = "event_key") -> DataFrame:
    """All positives and ``n_neg`` negatives of all splits, or every negative if there are fewer."""
    positives = abt.where(F.col("is_laundering") == 1)
    negatives = first_by_hash(abt.where(F.col("is_laundering") == 0), key, n_neg)
    return positives.unionByName(negatives)


def sample_candidates(events: DataFrame, n_neg: int = S.TRAIN_NEGATIVES, key: str = "event_key") -> DataFrame:
    """Few rows of which ``train_sample`` is that of all, so that only they need the columns of the base table."""
    negative = F.col("is_laundering") == 0
    near = near_first(events.where(negative), key, n_neg)
    return events.where((F.col("is_laundering") == 1) | (negative & near))


def class_weights(train: DataFrame) -> DataFrame:
    """Class counts, and the weight that evens them out, as one row."""
    counts = train.agg(
        F.count_if(F.col("is_laundering") == 1).alias("n_pos"),
        F.count_if(F.col("is_laundering") != 1).alias("n_neg"),
    )
    return counts.withColumn(
        "pos_weight", F.col("n_neg") / F.greatest(F.lit(1), F.col("n_pos")).cast("double")
    )


def with_weight(df: DataFrame, weights: DataFrame) -> DataFrame:
    weight = weights.select("pos_weight").scalar()
    return df.withColumn("weight", F.when(F.col("is_laundering") == 1, weight).otherwise(F.lit(1.0)))
