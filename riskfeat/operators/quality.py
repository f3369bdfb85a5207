"""Checks that gate a load."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskfeat import schemas as S


CHECKS = ("tail_trimmed", "rows_expected", "rows_kept", "splits_complete")


class QualityError(AssertionError):
    """A load that must not be used."""


def quality_report(
    events: DataFrame, abt: DataFrame, cutoff: str = S.TAIL_CUTOFF_DATE, expected: int = 1
) -> DataFrame:
    """One row: sizes, time range and whether the tail is trimmed and rows and splits are complete.

    ``expected`` is the least number of events that a whole load has.
    """
    seen = events.agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum("is_laundering").alias("n_positives"),
        F.min("event_ts").alias("first_ts"),
        F.max("event_ts").alias("last_ts"),
    )
    built = abt.agg(
        F.struct(
            F.count(F.lit(1)).alias("n_abt"), F.count_distinct("split").alias("n_splits")
        ).alias("built")
    ).scalar()
    return (
        seen.withColumn("n_abt", built["n_abt"])
        .withColumn("n_splits", built["n_splits"])
        .withColumn("tail_trimmed", F.col("last_ts") < F.lit(cutoff).cast("timestamp_ntz"))
        .withColumn("n_expected", F.lit(expected).cast("long"))
        .withColumn("rows_expected", F.col("n_events") >= F.col("n_expected"))
        .withColumn("rows_kept", F.col("n_abt") == F.col("n_events"))
        .withColumn("splits_complete", F.col("n_splits") == 3)
    )


def split_stats() -> dict[str, Column]:
    """Statistics of a base table that its writing pass can see."""
    count = lambda name: F.count(F.when(F.col("split") == name, 1))
    return {
        "last_ts": F.max("event_ts"),
        "n_positives": F.sum("is_laundering"),
        **{f"n_{name.lower()}": count(name) for name in ("TRAIN", "VAL", "TEST")},
    }


def written_checks(events: Mapping, abt: Mapping, cutoff: str = S.TAIL_CUTOFF_DATE, expected: int = 1) -> dict:
    """The checks of ``quality_report`` from what the writing passes of both tables saw: nothing is read again."""
    last, limit = abt["last_ts"], dt.datetime.fromisoformat(cutoff)
    splits = [int(abt[f"n_{name}"] or 0) for name in ("train", "val", "test")]
    return {
        "n_events": events["rows"],
        "n_abt": abt["rows"],
        "last_ts": last,
        "n_expected": expected,
        "tail_trimmed": last is not None and dt.datetime.fromisoformat(last) < limit,
        "rows_expected": events["rows"] >= expected,
        "rows_kept": abt["rows"] == events["rows"],
        "splits_complete": all(splits),
    }


def require(report: DataFrame | Mapping) -> None:
    """Raise unless every check of a one-row report holds."""
    row = report.first().asDict() if isinstance(report, DataFrame) else report
    failed = [name for name, value in row.items() if value is False or value is None and name in CHECKS]
    if failed:
        raise QualityError(f"failed checks: {failed} in {row}")


def dup_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where(F.col("n_rows") > 1)
