"""The model matrix: one expression per feature name, used by training and scoring alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskfeat import schemas as S
from riskfeat.functions import columns as C
from riskfeat.operators.features import risk_columns
from riskfeat.operators.joins import left_join_by_key


def format_categories(df: DataFrame) -> list[str]:
    """One-hot names of the payment formats in the data, in order.

    They are part of a model's signature, a list of names kept with the model, of any length.
    """
    found = (
        df.where(F.col("payment_format").isNotNull())
        .select(C.format_code(F.col("payment_format")).alias("code"))
        .distinct()
        .collect()
    )
    return [S.ONE_HOT_PREFIX + code for code in sorted(row["code"] for row in found)]


def signature(df: DataFrame, with_risk: bool = False) -> list[str]:
    """The ordered feature names of a model trained on ``df``."""
    risk = S.RISK_FEATURES if with_risk else []
    return [*S.REQUEST_FEATURES, *S.PROFILE_FEATURES, *risk, *format_categories(df)]


def feature_column(name: str) -> Column:
    """Missing values, unseen formats and unknown names all become 0."""
    if name.startswith(S.ONE_HOT_PREFIX):
        code = name.removeprefix(S.ONE_HOT_PREFIX)
        return C.flag(C.format_code(F.col("payment_format")) == code).cast("double")
    if name in {*S.REQUEST_FEATURES, *S.PROFILE_FEATURES, *S.RISK_FEATURES}:
        return C.or_zero(F.col(name))
    return F.lit(0.0)


def history_features(history: DataFrame) -> DataFrame:
    """Every history feature a signature may ask for, by account."""
    return history.select("account_id", *S.PROFILE_FEATURES, *risk_columns())


def with_history(abt: DataFrame, history: DataFrame, heavy: DataFrame) -> DataFrame:
    return left_join_by_key(abt, [history_features(history)], "account_id", heavy)


def assemble(df: DataFrame, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep`` as it is and one double column per feature, in signature order.

    A kept column that is a feature too moves to ``<name>_raw``.
    """
    kept = [F.col(c).alias(f"{c}_raw") if c in names else F.col(c) for c in keep]
    return df.select(*kept, *[feature_column(n).alias(n) for n in names])
