"""Feature views over the account history, and training sets joined from them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from riskfeat import schemas as S
from riskfeat.functions import columns as C
from riskfeat.operators.joins import asof_join, heavy_keys, key_counts, left_join_by_key


@dataclass(frozen=True)
class Entity:
    name: str
    keys: tuple[str, ...]


ACCOUNT = Entity("ACCOUNT", ("account_id",))


@dataclass(frozen=True)
class FeatureView:
    """A named, versioned query: ``build`` maps its source to one row per entity.

    ``ts`` names the time column of views that hold one row per entity and time.
    """

    name: str
    version: str
    entity: Entity
    build: Callable[[DataFrame], DataFrame]
    ts: str | None = None
    refresh: str = "1 day"

    def rows(self, source: DataFrame) -> DataFrame:
        df = self.build(source)
        missing = [c for c in (*self.entity.keys, self.ts) if c and c not in df.columns]
        if missing:
            raise ValueError(f"{self.name}/{self.version} has no column {missing}")
        return df


def account_profile(history: DataFrame) -> DataFrame:
    return history.select("account_id", *S.PROFILE_FEATURES)


def risk_columns() -> list[Column]:
    """Spread of amounts against their mean, and distinct receivers per payment."""
    spread = C.safe_div(F.col("hist_std_amount"), F.col("hist_avg_amount"))
    fanout = C.safe_div(F.col("hist_distinct_receivers"), F.col("hist_txn_count"))
    return [spread.alias("hist_amount_cv"), fanout.alias("hist_receiver_fanout")]


def account_risk(history: DataFrame) -> DataFrame:
    return history.select("account_id", *risk_columns())


def online_profile(history: DataFrame) -> DataFrame:
    return history.select("account_id", *S.PROFILE_FEATURES, "last_activity_ts")


def daily_activity(events: DataFrame) -> DataFrame:
    """Per account and day its activity, stamped with the last event of that day."""
    return (
        events.groupBy("account_id", F.to_date("event_ts").alias("day"))
        .agg(
            F.max("event_ts").alias("event_ts"),
            F.count(F.lit(1)).alias("day_txn_count"),
            F.max("amount_paid").alias("day_max_amount"),
        )
        .drop("day")
    )


PROFILE_VIEW = FeatureView("ACCOUNT_PROFILE", "V1", ACCOUNT, account_profile)
RISK_VIEW = FeatureView("ACCOUNT_RISK", "V1", ACCOUNT, account_risk)
ONLINE_PROFILE_VIEW = FeatureView(
    "ACCOUNT_PROFILE", "V1", ACCOUNT, online_profile, ts="last_activity_ts", refresh="1 minute"
)
ACTIVITY_VIEW = FeatureView("ACCOUNT_ACTIVITY", "V1", ACCOUNT, daily_activity, ts="event_ts")


def _check_names(spine: DataFrame, views: Sequence[DataFrame], shared: Sequence[str]) -> None:
    seen = set(spine.columns)
    for view in views:
        clash = [c for c in view.columns if c in seen and c not in shared]
        if clash:
            raise ValueError(f"feature columns appear twice: {clash}")
        seen.update(view.columns)


def training_set(
    spine: DataFrame,
    views: Sequence[DataFrame],
    label_cols: Sequence[str],
    key: str = "account_id",
    heavy: DataFrame | None = None,
) -> DataFrame:
    """The spine with the current features of every view; labels come last.

    Every spine row stays exactly once when views hold one row per key.
    """
    _check_names(spine, views, [key])
    heavy = heavy_keys(key_counts(spine, key), key) if heavy is None else heavy
    joined = left_join_by_key(spine, views, key, heavy)
    return joined.select([c for c in joined.columns if c not in label_cols] + list(label_cols))


def asof_training_set(
    spine: DataFrame, view: DataFrame, key: str, ts: str, strict: bool = False, tile: str = "day"
) -> DataFrame:
    """The spine with features as they stood at each row's own time.

    ``tile`` is the calendar unit by which a key's points are dealt out; smaller ones split busy keys.
    """
    _check_names(spine, [view], [key, ts])
    return asof_join(spine, view, key, ts, strict, tile)
