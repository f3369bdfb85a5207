"""Column expressions shared by every job. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from riskfeat import schemas as S


def account_id(bank: Column, account: Column) -> Column:
    """Composite id; NULL when either part is NULL."""
    return F.concat(bank, F.lit("_"), account)


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it is false or NULL."""
    return F.when(condition, 1).otherwise(0)


def safe_div(numerator: Column, denominator: Column) -> Column:
    """Ratio as double; NULL for a zero or NULL denominator."""
    bottom = denominator.cast("double")
    return numerator.cast("double") / F.nullif(bottom, F.lit(0.0))


def or_zero(value: Column) -> Column:
    return F.coalesce(value.cast("double"), F.lit(0.0))


def bank_country(bank_name: Column) -> Column:
    prefix = F.upper(F.regexp_extract(bank_name, S.BANK_COUNTRY_PATTERN, 1))
    typo, repaired = S.COUNTRY_TYPO
    return (
        F.when(~F.coalesce(bank_name.rlike(S.BANK_NAME_PATTERN), F.lit(False)), S.DEFAULT_COUNTRY)
        .when(prefix == typo, repaired)
        .when(prefix == "", S.DEFAULT_COUNTRY)
        .otherwise(prefix)
    )


def entity_type(entity_name: Column) -> Column:
    return F.trim(F.regexp_replace(entity_name, S.ENTITY_SUFFIX_PATTERN, ""))


def parse_event_ts(text: Column) -> Column:
    """Raises on text that does not follow the format, as the load must abort."""
    return F.to_timestamp_ntz(text, F.lit(S.TXN_TIMESTAMP_FORMAT))


def format_code(payment_format: Column) -> Column:
    """The part of a one-hot column name that a payment format maps to."""
    return F.lower(F.replace(payment_format, F.lit(" "), F.lit("_")))


def to_number(text: Column) -> Column:
    """Text as double, with anything that is not a number turned into 0.

    The cast alone would read Java literals such as ``1d`` as numbers.
    """
    number = F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), text.try_cast("double"))
    return F.coalesce(F.nanvl(number, F.lit(0.0)), F.lit(0.0))


def json_number(text: Column, path: str) -> Column:
    return F.try_variant_get(F.try_parse_json(text), path, "double")


def epoch_to_ntz(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")
