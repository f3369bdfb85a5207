"""From landing files to promoted predictions, and the registry behind them."""

import pytest

from riskfeat import schemas as S
from riskfeat.operators import abt as A
from riskfeat.operators import features as V
from riskfeat.operators import quality
from riskfeat.plans import pipeline as P
from riskfeat.plans.registry import Registry
from riskfeat.sources import files, fixture

SF = "/root/testdata/sf0.001"
FAST = {"maxIter": 20}
PATTERN = """BEGIN LAUNDERING ATTEMPT - FAN-OUT:  Max 1-degree Fan-Out
2022/09/01 00:20,010,A1,011,B1,10.00,US Dollar,10.00,US Dollar,ACH,1
END LAUNDERING ATTEMPT - FAN-OUT
"""


@pytest.fixture(scope="module")
def roots(spark, tmp_path_factory):
    """Prod data loaded from CSV, and two dev versions trained on it."""
    base = tmp_path_factory.mktemp("env")
    landing, dev, prod = (str(base / n) for n in ("landing", "dev", "prod"))
    txns = fixture.transactions(spark, SF).select(S.TXN_SCHEMA.names)
    txns.write.option("header", True).csv(f"{landing}/transactions")
    fixture.accounts(spark, SF).write.option("header", True).csv(f"{landing}/accounts")
    (base / "patterns.txt").write_text(PATTERN)
    for _ in range(2):  # the second load finds no new files
        P.load(spark, f"{landing}/transactions", f"{landing}/accounts", prod, fixture.CUTOFF, str(base / "patterns.txt"))
    P.build_abt(spark, prod, dev, fixture.CUTOFF)
    return dev, prod


def train(spark, roots, version, views):
    dev, prod = roots
    return P.train_version(
        spark, prod, dev, version, views, "monotone_lr", FAST, n_neg=1000
    )


@pytest.fixture(scope="module")
def trained(spark, roots):
    train(spark, roots, "V1", [V.PROFILE_VIEW])
    train(spark, roots, "V2", [V.PROFILE_VIEW, V.RISK_VIEW])
    return roots


def test_tables_of_the_load(spark, roots):
    dev, prod = roots
    events = files.read_version(spark, prod, "txn_events")
    assert files.read_version(spark, dev, "abt").count() == events.count() > 5000
    assert files.current_version(spark, prod, "txn_events") == 2
    raw = files.loaded(spark, f"{prod}/raw/transactions")
    assert files.read_version(spark, prod, "laundering_patterns").count() == 1
    assert raw.columns == [*S.TXN_SCHEMA.names, "event_key"]
    assert raw.select("event_key").distinct().count() == raw.count()


def test_the_newest_slice_is_chosen_by_what_the_commit_says(spark, roots):
    dev, prod = roots
    abt = files.read_version(spark, dev, "abt")
    newest = files.version_stats(spark, dev, "abt")["last_ts"]
    pruned = A.last_days(abt, "event_ts", 1, newest)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" not in plan and "event_month#" in plan.split("PartitionFilters")[1].split("]")[0]
    want = A.last_days(abt, "event_ts").collect()
    assert sorted(pruned.collect()) == sorted(want) and want
    # What a committed table holds was seen while it was written.
    assert files.version_stats(spark, dev, "abt")["rows"] == abt.count()
    assert files.loaded_rows(spark, f"{prod}/raw/transactions") == files.loaded(spark, f"{prod}/raw/transactions").count()


def test_a_short_load_is_refused_and_leaves_the_tables(spark, roots, tmp_path):
    _, prod = roots
    before = files.current_version(spark, prod, "txn_events")
    (tmp_path / "t").mkdir()
    (tmp_path / "a").mkdir()
    with pytest.raises(quality.QualityError, match="expected"):
        P.load(spark, str(tmp_path / "t"), str(tmp_path / "a"), prod, fixture.CUTOFF, expected=P.EXPECTED_ROWS)
    assert files.current_version(spark, prod, "txn_events") == before
    with pytest.raises(quality.QualityError, match="rows_expected"):
        P.build_abt(spark, prod, str(tmp_path / "dev"), fixture.CUTOFF, expected=10**9)


def test_runs_compare_and_repeat_in_place(spark, trained):
    dev, _ = trained
    registry = Registry(spark, dev)
    assert {r["run"] for r in registry.runs().collect()} == {"train_V1", "train_V2"}
    registry.log_run("scratch", {"a": 1}, {"pr_auc": 0.25})
    registry.log_run("scratch", {"a": 2}, {"pr_auc": 0.5})
    got = registry.runs().where("run = 'scratch'").collect()
    assert [(r["params"]["a"], r["metrics"]["pr_auc"]) for r in got] == [("2", 0.5)]
    from riskfeat.operators.metrics import compare_runs

    names = {r["metric"] for r in compare_runs(registry.runs(), "train_V1", "train_V2").collect()}
    sampled = {"pr_auc", "roc_auc", "recall_at_k", "base_rate"}
    assert names == sampled | {f"full_{n}" for n in sampled}
    v2 = registry.runs().where("run = 'train_V2'").first()
    assert v2["params"]["views"] == "ACCOUNT_PROFILE,ACCOUNT_RISK"
    assert v2["params"]["kind"] == "monotone_lr"


def test_promotion_copies_the_fitted_model_once_and_scores(spark, trained):
    dev, prod = trained
    as_of = "2001-07-01 06:00:00"
    assert P.promote(spark, dev, prod, as_of, cutoff=fixture.CUTOFF) == "V2"
    entries = lambda: Registry(spark, prod).entries("model").collect()
    first = entries()
    scores = files.read_predictions(spark, f"{prod}/predictions")
    once = sorted(tuple(r) for r in scores.collect())
    assert P.promote(spark, dev, prod, as_of, "v2", fixture.CUTOFF) == "V2"
    assert entries() == first
    again = sorted(tuple(r) for r in files.read_predictions(spark, f"{prod}/predictions").collect())
    assert again == once and once
    assert {"account_id", "event_ts", "payment_format", "label", "fraud_score", "scored_at"} <= set(scores.columns)
    model, names, metrics = Registry(spark, prod).model(P.MODEL, "V2")
    assert names == Registry(spark, dev).model(P.MODEL, "V2")[1]
    assert "hist_receiver_fanout" in names and "pr_auc" in metrics
    ready = Registry(spark, prod).missing([("ACCOUNT_RISK", "V1")], [(P.MODEL, "V2"), (P.MODEL, "V9")])
    assert ready == [f"model {P.MODEL}/V9"]


def test_reset_of_dev(spark, trained):
    dev, _ = trained
    registry = Registry(spark, dev)
    assert registry.versions(P.MODEL) == ["V1", "V2"]
    with pytest.raises(ValueError, match="default"):
        registry.delete_version(P.MODEL, registry.default(P.MODEL))
    registry.set_default(P.MODEL, "V1")
    registry.delete_version(P.MODEL, "V2")
    registry.delete_view("ACCOUNT_RISK", "V1")
    assert registry.versions(P.MODEL) == ["V1"]
    assert not registry.has_version(P.MODEL, "V2") and registry.has_version(P.MODEL, "v1")
    with pytest.raises(KeyError):
        registry.view("ACCOUNT_RISK", "V1")
    assert registry.view("ACCOUNT_PROFILE", "V1").columns == ["account_id", *S.PROFILE_FEATURES]
    registry.drop_model(P.MODEL)
    assert registry.versions(P.MODEL) == []
    with pytest.raises(KeyError):
        registry.default(P.MODEL)


def test_view_refresh_replaces_its_rows(spark, tmp_path):
    registry = Registry(spark, str(tmp_path))
    view = V.FeatureView("N", "V1", V.Entity("E", ("id",)), lambda df: df.select("id"))
    registry.register(view, spark.range(3))
    assert registry.refresh(view, spark.range(5)).count() == 5
    assert registry.view("N", "V1").count() == 5
    with pytest.raises(ValueError, match="exists"):
        registry.register(view, spark.range(1), overwrite=False)
