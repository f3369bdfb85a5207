import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskfeat import schemas as S
from riskfeat.operators import features as V
from riskfeat.operators import matrix
from riskfeat.operators.joins import heavy_keys, key_counts
from riskfeat.plans import model as M

TS = dt.datetime(2024, 1, 1)
ABT = (
    "event_key string, account_id string, event_ts timestamp_ntz, amount_paid double, payment_format string, "
    "is_cross_currency int, is_cross_border int, is_high_risk_format int, amount_to_avg_ratio double, "
    "is_laundering int, split string"
)
HISTORY = "account_id string, " + ", ".join(
    f"{n} {'long' if 'distinct' in n or 'count' in n else 'double'}" for n in S.PROFILE_FEATURES
)


@pytest.fixture
def abt(spark):
    return spark.createDataFrame(
        [
            ("e1", "a", TS, 10.0, "Credit Card", 1, 0, 0, 0.5, 1, "TRAIN"),
            ("e2", "new", TS, 20.0, "Teleport", 0, 1, 1, None, 0, "TEST"),
            ("e3", "z", TS, 30.0, None, 0, 0, 0, 1.0, 0, "TEST"),
        ],
        ABT,
    )


@pytest.fixture
def history(spark):
    return spark.createDataFrame(
        [("a", 4, 8.0, 2.0, 12.0, 3, 2, 1, 0.25, 0.5), ("z", 0, 0.0, 0.0, 0.0, 0, 0, 0, 0.0, 0.0)], HISTORY
    )


def test_risk_of_an_account_without_amounts_is_null(history, rows):
    assert rows(V.account_risk(history)) == [("a", 0.25, 0.75), ("z", None, None)]


def test_matrix_fills_every_gap_with_zero(abt, history):
    names = ["amount_to_avg_ratio", "hist_amount_cv", "hist_txn_count", "payment_format_credit_card",
             "payment_format_wire", "never_heard_of"]
    joined = matrix.with_history(abt, history, heavy_keys(key_counts(abt, "account_id"), "account_id"))
    got = {r["event_key"]: tuple(r)[1:] for r in matrix.assemble(joined, names, ["event_key"]).collect()}
    assert got == {
        "e1": (0.5, 0.25, 4.0, 1.0, 0.0, 0.0),
        "e2": (0.0, 0.0, 0.0, 0.0, 0.0, 0.0),
        "e3": (1.0, 0.0, 0.0, 0.0, 0.0, 0.0),
    }


def test_kept_columns_that_are_features_too_stay_readable(abt):
    got = matrix.assemble(abt, ["amount_paid"], ["amount_paid", "event_key"])
    assert got.columns == ["amount_paid_raw", "event_key", "amount_paid"]


def test_signature_orders_features_of_any_number_of_categories(abt, spark):
    names = matrix.signature(abt, with_risk=True)
    assert names == [*S.REQUEST_FEATURES, *S.PROFILE_FEATURES, *S.RISK_FEATURES,
                     "payment_format_credit_card", "payment_format_teleport"]
    many = spark.range(1500).select(F.concat(F.lit("Format "), "id").alias("payment_format"))
    assert len(matrix.format_categories(many)) == 1500


def test_training_set_keeps_the_spine_and_refuses_double_names(abt, history):
    views = [V.PROFILE_VIEW.rows(history), V.RISK_VIEW.rows(history)]
    spine = abt.select("event_key", "account_id", "is_laundering")
    got = V.training_set(spine, views, ["is_laundering"])
    assert got.columns == ["account_id", "event_key", *S.PROFILE_FEATURES, *S.RISK_FEATURES, "is_laundering"]
    assert got.count() == 3
    with pytest.raises(ValueError, match="twice"):
        V.training_set(spine, [views[0], views[0]], ["is_laundering"])


def test_view_must_hold_its_keys(history):
    broken = V.FeatureView("X", "V1", V.ACCOUNT, lambda df: df.select("hist_txn_count"))
    with pytest.raises(ValueError, match="account_id"):
        broken.rows(history)


@pytest.fixture(scope="module")
def frame(spark):
    """Amount drives the label; the ratio drives it the other way, against the constraint."""
    i = F.col("id")
    noise = F.pmod(F.xxhash64("id"), F.lit(100)) / 100.0
    amount = F.pmod(i, F.lit(50)).cast("double")
    ratio = F.pmod(i, F.lit(7)).cast("double")
    return spark.range(1200).select(
        F.concat(F.lit("e"), i).alias("event_key"),
        amount.alias("amount_paid"),
        ratio.alias("amount_to_avg_ratio"),
        F.lit("ACH").alias("payment_format"),
        F.when(amount / 50 - ratio / 14 + noise > 0.9, 1).otherwise(0).alias("is_laundering"),
        F.when(i % 5 == 0, "TEST").otherwise("TRAIN").alias("split"),
    )


NAMES = ["amount_paid", "amount_to_avg_ratio", "payment_format_ach"]


def test_constrained_model_never_drops_and_exports_to_sql(frame):
    model = M.train(frame, NAMES, "monotone_lr")
    weights, intercept = M.linear_terms(model)
    assert weights["amount_paid"] > 0
    assert weights["amount_to_avg_ratio"] == pytest.approx(0, abs=1e-9)
    test = frame.where("split = 'TEST'")
    fitted = M.scored_rows(test, NAMES, model)
    exported = M.scored_rows(test, NAMES, (weights, intercept)).withColumnRenamed("fraud_score", "sql_score")
    worst = fitted.join(exported, "event_key").agg(F.max(F.abs(F.col("fraud_score") - F.col("sql_score")))).first()[0]
    assert worst < 1e-9
    audit = M.monotone_audit(model, matrix.assemble(test, NAMES, []), NAMES, [1.0, 5.0])
    assert sorted(tuple(r) for r in audit.collect()) == [("amount_paid", 240, 0), ("amount_to_avg_ratio", 240, 0)]


def test_boosted_trees_separate_classes_and_the_audit_finds_decreases(frame):
    model = M.train(frame, NAMES, "gbt", {"maxIter": 5, "maxDepth": 3})
    test = frame.where("split = 'TEST'")
    means = {r["label"]: r["m"] for r in M.scored_rows(test, NAMES, model).groupBy("label").agg(F.avg("fraud_score").alias("m")).collect()}
    assert means[1] > means[0] + 0.2
    audit = {r["feature"]: r["n_decreases"] for r in M.monotone_audit(model, matrix.assemble(test, NAMES, []), NAMES, [3.0]).collect()}
    assert audit["amount_to_avg_ratio"] > 0


def test_unknown_kind_of_model(frame):
    with pytest.raises(ValueError, match="unknown kind"):
        M.train(frame, NAMES, "forest")
