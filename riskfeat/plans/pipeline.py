"""The jobs: load, base table, training, promotion and daily scoring.

Each stage writes a table that the next one reads, so that a lost executor or a failed
job costs one stage, and joins meet plain scans with known sizes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskfeat import schemas as S
from riskfeat.operators import abt as A
from riskfeat.operators import curate, quality
from riskfeat.operators.features import PROFILE_VIEW, RISK_VIEW, FeatureView, training_set
from riskfeat.operators.joins import heavy_keys, key_counts
from riskfeat.operators.matrix import signature, with_history
from riskfeat.operators.metrics import model_metrics
from riskfeat.operators.sampling import class_weights, train_sample
from riskfeat.plans.model import GBT_PARAMS, TREE_PARAMS, scored_rows, train
from riskfeat.plans.registry import Registry
from riskfeat.sources import files
from riskfeat.sources.patterns import parse_patterns

MODEL = "LAUNDERING_RISK"
#: Least transactions and accounts of the whole data set.
EXPECTED_ROWS = (S.EXPECTED_MIN_TRANSACTIONS, S.EXPECTED_MIN_ACCOUNTS)


def load(
    spark: SparkSession,
    transactions: str,
    accounts: str,
    root: str,
    cutoff: str = S.TAIL_CUTOFF_DATE,
    pattern_text: str | None = None,
    expected: tuple[int, int] = (1, 1),
) -> None:
    """Landing files that are new to raw tables, then all to the curated tables of an environment.

    With fewer transactions or accounts than ``expected`` the curated tables stay as they are and the load fails;
    ``EXPECTED_ROWS`` are the counts of the whole data set. Rows are counted while they are written.
    """
    raw_txns, raw_accounts = f"{root}/raw/transactions", f"{root}/raw/accounts"
    files.load_new(
        spark,
        transactions,
        raw_txns,
        lambda new, load: files.with_row_key(files.read_transactions(spark, new), load),
    )
    files.load_new(spark, accounts, raw_accounts, lambda new, load: files.read_accounts(spark, new))
    for name, path, least in zip(("transactions", "accounts"), (raw_txns, raw_accounts), expected):
        rows = files.loaded_rows(spark, path)
        if rows < least:
            raise quality.QualityError(f"{rows} {name} were loaded, {least} are expected")
    curated(spark, files.loaded(spark, raw_txns), files.loaded(spark, raw_accounts), root, cutoff)
    if pattern_text is not None:
        files.write_version(parse_patterns(spark, pattern_text), root, "laundering_patterns")


def curated(
    spark: SparkSession, txns: DataFrame, accounts: DataFrame, root: str, cutoff: str
) -> None:
    files.write_version(curate.bank_dim(accounts), root, "bank_dim")
    banks = files.read_version(spark, root, "bank_dim")
    files.write_version(curate.account_dim(accounts, banks), root, "account_dim")
    files.write_version(curate.txn_events(txns, banks, cutoff), root, "txn_events")
    events = files.read_version(spark, root, "txn_events")
    owners = files.read_version(spark, root, "account_dim")
    files.write_version(curate.account_history(events, owners), root, "account_history")


def build_abt(spark: SparkSession, src_root: str, dst_root: str, cutoff: str, expected: int = 1) -> DataFrame:
    """The base table of one environment from the curated tables of another, checked by what the writing passes saw.

    ``expected`` is the least number of events that a whole load has.
    """
    events = files.read_version(spark, src_root, "txn_events")
    history = files.read_version(spark, src_root, "account_history")
    built = A.build_abt(events, history, A.split_thresholds(events))
    # Rows are written before they are put in order: the join's shuffle is gone by then, and is not made again for a sample of times.
    with files.held(built, "abt") as rows:
        # Months are folders, and days stay together in a file, so a slice of days reads little else.
        by_month = rows.repartitionByRange("event_ts").withColumn("event_month", F.date_format("event_ts", "yyyy-MM"))
        ordered = by_month.sortWithinPartitions("event_month", "event_ts")
        files.write_version(ordered, dst_root, "abt", by=["event_month"], stats=quality.split_stats())
    seen = [files.version_stats(spark, *where) for where in ((src_root, "txn_events"), (dst_root, "abt"))]
    quality.require(quality.written_checks(*seen, cutoff, expected))
    return files.read_version(spark, dst_root, "abt")


def _metrics(scored: DataFrame, purpose: str) -> dict[str, float]:
    """Metrics of scores that are read several times; they are on disk only meanwhile."""
    with files.held(scored.select("event_key", "label", "fraud_score"), purpose) as kept:
        return model_metrics(kept).first().asDict()


def train_version(
    spark: SparkSession,
    src_root: str,
    root: str,
    version: str,
    views: Sequence[FeatureView] = (PROFILE_VIEW,),
    kind: str = "monotone_gbt",
    params: Mapping[str, object] | None = None,
    n_neg: int = S.TRAIN_NEGATIVES,
) -> dict[str, float]:
    """Register views, train on the sample, log the run and the version; returns its metrics.

    Metrics are of the down-sampled TEST rows, which training leaves out; those named ``full_*`` are of
    all TEST rows of the base table.
    """
    registry = Registry(spark, root)
    history = files.read_version(spark, src_root, "account_history")
    rows = [registry.refresh(view, history) for view in views]
    files.write_version(train_sample(files.read_version(spark, root, "abt").drop("event_month"), n_neg), root, "abt_sample")
    sample = files.read_version(spark, root, "abt_sample")
    names = signature(sample, with_risk=RISK_VIEW in views)
    with files.held(training_set(sample, rows, ["is_laundering"]), "training-set") as frame:
        model = train(frame, names, kind, params)
        metrics = _metrics(scored_rows(frame.where(F.col("split") == "TEST"), names, model), "scored-test")
    whole = files.read_version(spark, root, "abt").where(F.col("split") == "TEST").drop("event_month")
    full = _metrics(scored_rows(training_set(whole, rows, ["is_laundering"]), names, model), "scored-full")
    metrics |= {f"full_{name}": value for name, value in full.items()}
    metrics = {name: float("nan") if value is None else value for name, value in metrics.items()}
    weights = class_weights(sample.where(F.col("split") == "TRAIN")).first()
    settings = {
        **({"gbt": GBT_PARAMS, "monotone_gbt": TREE_PARAMS}.get(kind, {})),
        **(params or {}),
        "kind": kind,
        "pos_weight": round(weights["pos_weight"], 2),
        "n_features": len(names),
        "neg_sample": n_neg,
        "monotone_features": sum(n in S.MONOTONE_FEATURES for n in names),
        "views": ",".join(v.name for v in views),
    }
    registry.log_run(f"train_{version}", settings, metrics)
    registry.log_model(model, MODEL, version, names, metrics)
    registry.set_default(MODEL, version)
    return metrics


def daily_scores(
    abt: DataFrame, history: DataFrame, names: Sequence[str], model, days: int = 1, newest: str | None = None
) -> DataFrame:
    """Scores of the newest ``days`` of the base table, up to ``newest`` where that is known.

    Only the history of accounts in the slice meets its rows.
    """
    recent = A.last_days(abt, "event_ts", days, newest)
    counts = key_counts(recent, "account_id")
    asked = history.join(counts.select("account_id"), "account_id", "left_semi")
    return scored_rows(with_history(recent, asked, heavy_keys(counts, "account_id")), names, model)


def score_batch(spark: SparkSession, root: str, version: str, as_of: str, days: int = 1) -> DataFrame:
    """Write the predictions of the newest days; a rerun replaces its own. The newest of every event."""
    model, names, _ = Registry(spark, root).model(MODEL, version)
    abt = files.read_version(spark, root, "abt")
    history = files.read_version(spark, root, "account_history")
    path = f"{root}/predictions"
    newest = files.version_stats(spark, root, "abt").get("last_ts")
    files.write_predictions(daily_scores(abt, history, names, model, days, newest), path, as_of)
    return files.read_predictions(spark, path)


def promote(
    spark: SparkSession,
    dev_root: str,
    prod_root: str,
    as_of: str,
    version: str | None = None,
    cutoff: str = S.TAIL_CUTOFF_DATE,
) -> str:
    """Bring a dev version to prod: same base table, same views, the same fitted model, then score.

    A version that is in prod already is not copied again.
    """
    dev, prod = Registry(spark, dev_root), Registry(spark, prod_root)
    version = dev.resolve(MODEL, version or dev.default(MODEL))
    build_abt(spark, prod_root, prod_root, cutoff)
    history = files.read_version(spark, prod_root, "account_history")
    for view in (PROFILE_VIEW, RISK_VIEW):
        prod.refresh(view, history)
    if not prod.has_version(MODEL, version):
        model, names, metrics = dev.model(MODEL, version)
        prod.log_model(model, MODEL, version, names, metrics)
    prod.set_default(MODEL, version)
    score_batch(spark, prod_root, version, as_of)
    return version
