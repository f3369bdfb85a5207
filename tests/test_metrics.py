import hashlib
import math
import random

import pytest

from riskfeat.operators import metrics, quality, sampling, summaries


def scored(spark, rows):
    return spark.createDataFrame(
        [(f"e{i}", label, score) for i, (label, score) in enumerate(rows)],
        "event_key string, label int, fraud_score double",
    )


def brute(rows, k):
    """Metrics from their definitions, quadratic in the rows."""
    pos = [s for label, s in rows if label == 1]
    neg = [s for label, s in rows if label == 0]
    ap, seen = 0.0, 0
    for cut in sorted({s for _, s in rows}, reverse=True):
        tp = sum(s >= cut for s in pos)
        ap += (tp - seen) / max(1, len(pos)) * tp / sum(s >= cut for _, s in rows)
        seen = tp
    auc = None
    if pos and neg:
        auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ranked = sorted(
        enumerate(rows), key=lambda e: (-e[1][1], hashlib.md5(f"e{e[0]}".encode()).hexdigest())
    )
    top = ranked[: max(1, int(len(rows) * k))]
    recall = sum(label for _, (label, _) in top) / len(pos) if pos else 0.0
    return ap, auc, recall, len(pos) / len(rows)


@pytest.mark.parametrize("seed,grain,k", [(1, 1000, 0.01), (2, 5, 0.1), (3, 1, 0.25), (4, 20, 0.5)])
def test_metrics_equal_brute_force_with_ties(spark, seed, grain, k):
    rng = random.Random(seed)
    rows = [(int(rng.random() < 0.2), round(rng.random() * grain) / grain) for _ in range(250)]
    got = metrics.model_metrics(scored(spark, rows), k).first()
    ap, auc, recall, base = brute(rows, k)
    assert got["pr_auc"] == pytest.approx(ap)
    assert got["roc_auc"] == pytest.approx(auc)
    assert got["recall_at_k"] == pytest.approx(recall)
    assert got["base_rate"] == pytest.approx(base)


def test_single_metrics_agree_with_the_joint_report(spark):
    df = scored(spark, [(1, 0.9), (0, 0.8), (1, 0.4), (0, 0.1)])
    joint = metrics.model_metrics(df, 0.5).first()
    assert metrics.average_precision(df).first()[0] == pytest.approx(joint["pr_auc"])
    assert metrics.roc_auc(df).first()[0] == pytest.approx(joint["roc_auc"])
    assert metrics.recall_at_k(df, 0.5).first()[0] == joint["recall_at_k"] == 0.5


def test_no_positives_and_no_rows(spark):
    none = metrics.model_metrics(scored(spark, [(0, 0.3), (0, 0.2)])).first().asDict()
    assert none == {"pr_auc": 0.0, "roc_auc": None, "base_rate": 0.0, "recall_at_k": 0.0}
    assert metrics.model_metrics(scored(spark, [])).first()["recall_at_k"] == 0.0


def test_compare_runs_marks_missing_metrics_as_nan(spark):
    runs = spark.createDataFrame(
        [("v1", {"x": 1.0, "y": 2.0}), ("v2", {"x": 1.5, "z": 3.0})], "run string, metrics map<string,double>"
    )
    got = {r["metric"]: r for r in metrics.compare_runs(runs, "v1", "v2").collect()}
    assert got["x"]["delta"] == 0.5
    assert math.isnan(got["y"]["b"]) and math.isnan(got["y"]["delta"])
    assert math.isnan(got["z"]["a"])


def labelled(spark, n_pos, n_neg):
    rows = [(f"p{i}", 1) for i in range(n_pos)] + [(f"n{i}", 0) for i in range(n_neg)]
    return spark.createDataFrame(rows, "event_key string, is_laundering int")


def test_sample_keeps_positives_and_repeats(spark, rows):
    abt = labelled(spark, 7, 200)
    first = rows(sampling.train_sample(abt, 50))
    assert sum(label for _, label in first) == 7
    assert len(first) == 57
    assert rows(sampling.train_sample(abt.repartition(5), 50)) == first
    assert len(rows(sampling.train_sample(abt, 500))) == 207


def test_class_weights(spark):
    weights = sampling.class_weights(labelled(spark, 4, 100))
    assert tuple(weights.first()) == (4, 100, 25.0)
    weighted = sampling.with_weight(labelled(spark, 1, 1), weights)
    assert {r["is_laundering"]: r["weight"] for r in weighted.collect()} == {1: 25.0, 0: 1.0}
    assert sampling.class_weights(labelled(spark, 0, 3)).first()["pos_weight"] == 3.0


def test_top_risk_breaks_ties_by_key(spark):
    df = scored(spark, [(0, 0.5)] * 12)
    assert [r["event_key"] for r in summaries.top_risk(df, 3).collect()] == ["e0", "e1", "e10"]


def test_quality_gate(spark):
    events = spark.sql(
        "SELECT timestamp_ntz'2022-09-01 00:00:00' AS event_ts, 1 AS is_laundering "
        "UNION ALL SELECT timestamp_ntz'2022-09-11 00:00:00', 0"
    )
    abt = spark.sql("SELECT explode(array('TRAIN', 'VAL')) AS split")
    report = quality.quality_report(events, abt)
    with pytest.raises(quality.QualityError, match="tail_trimmed.*splits_complete"):
        quality.require(report)
    full = spark.sql("SELECT explode(array('TRAIN', 'VAL', 'TEST')) AS split")
    trimmed = events.where("is_laundering = 1")
    with pytest.raises(quality.QualityError, match="rows_kept"):
        quality.require(quality.quality_report(trimmed, full))
    three = spark.sql(
        "SELECT explode(sequence(1, 3)) AS i, timestamp_ntz'2022-09-01 00:00:00' AS event_ts, 0 AS is_laundering"
    )
    quality.require(quality.quality_report(three, full))


def test_duplicate_keys(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "k string, v int")
    assert rows(quality.dup_keys(df, ["k"])) == [("a", 2)]


def test_rows_without_a_score_are_left_out(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.2), (0, 0.1)]
    more = [*rows, (1, None), (1, float("nan")), (0, float("nan"))]
    assert metrics.model_metrics(scored(spark, more)).first() == metrics.model_metrics(scored(spark, rows)).first()
    none = metrics.model_metrics(scored(spark, [(1, float("nan"))])).first()
    assert (none["pr_auc"], none["roc_auc"], none["recall_at_k"]) == (0.0, None, 0.0)


def test_checks_from_what_the_writing_passes_saw(spark):
    seen = {"rows": 5, "last_ts": "2024-01-31 23:59:59.5", "n_train": "3", "n_val": "1", "n_test": "1"}
    events = {"rows": 5}
    quality.require(quality.written_checks(events, seen, "2024-02-01", 5))
    for bad, name in (
        ({"rows": 4}, "rows_kept"), ({"last_ts": "2024-02-01 00:00:00"}, "tail_trimmed"), ({"last_ts": None}, "tail_trimmed"),
        ({"n_val": None}, "splits_complete"),
    ):
        with pytest.raises(quality.QualityError, match=name):
            quality.require(quality.written_checks(events, {**seen, **bad}, "2024-02-01", 5))
    with pytest.raises(quality.QualityError, match="rows_expected"):
        quality.require(quality.written_checks(events, seen, "2024-02-01", 6))


def test_scores_are_counted_once_and_written(spark):
    scored = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, None)], "label int, fraud_score double")
    found = metrics.score_steps(scored)
    assert found.count() == 2 and found.inputFiles() and all("score-steps" in f for f in found.inputFiles())
