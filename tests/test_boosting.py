"""Boosted trees against plain searches, and what their constraints promise."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskfeat.operators import matrix
from riskfeat.plans import boosting as B
from riskfeat.plans import model as M
from riskfeat.plans.registry import Registry

NAMES = ["x", "y", "flag"]
SETTINGS = B.Settings(trees=12, depth=3, least_rows=20, bins=16)


@pytest.fixture(scope="module")
def rows(spark):
    """2,000 rows; the label rises with x, falls with y, and the flag matters for large x alone."""
    i = F.col("id")
    noise = F.pmod(F.xxhash64("id"), F.lit(100)) / 100.0
    x, y = F.pmod(i * 7, F.lit(41)).cast("double"), F.pmod(i, F.lit(13)).cast("double")
    flag = F.pmod(i, F.lit(2)).cast("double")
    frame = spark.range(2000).select(
        x.alias("x"), y.alias("y"), flag.alias("flag"),
        F.when(x / 41 - y / 26 + F.when(x > 20, flag / 4).otherwise(0) + noise > 0.9, 1.0).otherwise(0.0).alias("label"),
        F.when(F.pmod(i, F.lit(3)) == 0, 2.5).otherwise(1.0).alias("weight"),
    )
    return frame.repartition(3)


def columns_of(frame):
    data = frame.select(*NAMES, "label", "weight").toPandas()
    return np.stack([data[n].to_numpy() for n in NAMES]), data["label"].to_numpy(), data["weight"].to_numpy()


def plain_best(x, g, h, low, high, rising, settings, edges):
    """Every feature and border tried on the rows themselves."""
    value = lambda m: min(max(-g[m].sum() / (h[m].sum() + settings.l2), low), high)
    cost = lambda m, v: g[m].sum() * v + 0.5 * (h[m].sum() + settings.l2) * v * v
    whole, best = np.ones(len(g), bool), None
    for f in range(len(x)):
        for k, edge in enumerate(edges[f]):
            left = x[f] <= edge
            if min(left.sum(), (~left).sum()) < settings.least_rows:
                continue
            a, b = value(left), value(~left)
            if rising[f] and a > b:
                continue
            gain = cost(whole, value(whole)) - cost(left, a) - cost(~left, b)
            if best is None or gain > best[0] + 1e-9:
                best = (gain, f, k, a, b)
    return best


@pytest.mark.parametrize("bounds", [(-np.inf, np.inf), (-0.2, 0.3)])
@pytest.mark.parametrize("rising", [(False, False, False), (True, True, False)])
def test_splits_equal_a_search_of_all_rows(spark, rows, rising, bounds):
    x, label, weight = columns_of(rows)
    edges = B.bin_edges(rows, NAMES, SETTINGS.bins)
    width, offset = sum(len(e) + 1 for e in edges), np.cumsum([0] + [len(e) + 1 for e in edges])[:-1]
    blocks = B._blocks(rows, NAMES, "label", "weight", edges, 0.3).rdd.map(B._opened)
    sums = sum(blocks.mapPartitions(B._level_sums([], B.Tree(), [0], offset, width)).collect())
    p = 1 / (1 + np.exp(-0.3))
    want = plain_best(x, weight * (p - label), weight * p * (1 - p), *bounds, rising, SETTINGS, edges)
    got = B.best_splits(sums, edges, rising, np.array([bounds]), SETTINGS)[0]
    assert got[1:3] == want[1:3]
    assert got[0] == pytest.approx(want[0]) and got[3:] == pytest.approx(want[3:])
    none = B.best_splits(sums, edges, rising, np.array([bounds]), B.Settings(least_rows=1500))
    assert none == [None]


def test_folding_scores_into_blocks_changes_nothing(rows, monkeypatch):
    whole = B.fit(rows, NAMES, "label", "weight", ["x"], SETTINGS)
    monkeypatch.setattr(B, "FOLD", 5)
    monkeypatch.setattr(B, "BLOCK_ROWS", 100)
    monkeypatch.setattr(B, "PART_ROWS", 300)
    monkeypatch.setattr(B, "TREE_REDUCE", 4)
    folded = B.fit(rows, NAMES, "label", "weight", ["x"], SETTINGS)
    assert [t.feature for t in folded.trees] == [t.feature for t in whole.trees]
    assert [t.threshold for t in folded.trees] == [t.threshold for t in whole.trees]
    assert np.allclose([v for t in folded.trees for v in t.value], [v for t in whole.trees for v in t.value])


def test_every_tree_lowers_the_loss_and_separates_classes(rows):
    x, label, weight = columns_of(rows)
    model = B.fit(rows, NAMES, "label", "weight", (), SETTINGS)
    losses = []
    for k in range(len(model.trees) + 1):
        margin = B.BoostedTrees(NAMES, model.start, model.trees[:k]).margins(x)
        losses.append((weight * np.log1p(np.exp(np.where(label == 1, -margin, margin)))).sum())
    assert len(model.trees) == 12 and all(b < a for a, b in zip(losses, losses[1:]))
    scored = model.transform(rows).groupBy("label").agg(F.avg("fraud_score").alias("s")).collect()
    means = {r["label"]: r["s"] for r in scored}
    assert means[1.0] > means[0.0] + 0.2


def test_scores_never_fall_along_rising_features(rows):
    """y lowers the label, so the constraint has to hold against the data."""
    free = B.fit(rows, NAMES, "label", "weight", (), SETTINGS)
    bound = B.fit(rows, NAMES, "label", "weight", ["x", "y"], SETTINGS)
    grid = np.array(np.meshgrid(np.arange(-1, 43, 1.0), np.arange(-1, 15, 1.0), [0.0, 1.0], indexing="ij"))
    surface = lambda m: m.margins(grid.reshape(3, -1)).reshape(grid.shape[1:])
    assert (np.diff(surface(free), axis=1) < -1e-9).any()
    assert (np.diff(surface(bound), axis=0) >= -1e-12).all() and (np.diff(surface(bound), axis=1) >= -1e-12).all()


def test_saved_trees_score_the_same(spark, rows, tmp_path):
    model = B.fit(rows, NAMES, "label", "weight", ["x"], B.Settings(trees=3, depth=2))
    registry = Registry(spark, str(tmp_path))
    registry.log_model(model, "M", "V1", NAMES, {"pr_auc": 0.5})
    loaded, names, metrics = registry.model("M", "v1")
    x, *_ = columns_of(rows)
    assert names == NAMES and metrics == {"pr_auc": 0.5} and np.array_equal(loaded.margins(x), model.margins(x))


def test_one_class_one_value_and_no_rows(spark, rows):
    flat = rows.where("label = 1").withColumns({n: F.lit(1.0) for n in NAMES})
    model = B.fit(flat, NAMES, "label", "weight", ["x"], SETTINGS)
    assert model.trees == [] and model.transform(flat).agg(F.min("fraud_score")).first()[0] > 0.99
    with pytest.raises(ValueError, match="no rows"):
        B.fit(rows.limit(0), NAMES, "label", "weight", (), SETTINGS)


def test_the_audit_finds_no_decrease_in_constrained_trees(spark):
    i = F.col("id")
    amount, ratio = F.pmod(i, F.lit(50)).cast("double"), F.pmod(i, F.lit(7)).cast("double")
    noise = F.pmod(F.xxhash64("id"), F.lit(100)) / 100.0
    frame = spark.range(1200).select(
        F.concat(F.lit("e"), i).alias("event_key"), amount.alias("amount_paid"), ratio.alias("amount_to_avg_ratio"),
        F.lit("ACH").alias("payment_format"),
        F.when(amount / 50 - ratio / 14 + noise > 0.9, 1).otherwise(0).alias("is_laundering"),
        F.when(i % 5 == 0, "TEST").otherwise("TRAIN").alias("split"),
    )
    names = ["amount_paid", "amount_to_avg_ratio", "payment_format_ach"]
    model = M.train(frame, names, params={"trees": 10, "depth": 4, "least_rows": 10})
    audit = M.monotone_audit(model, matrix.assemble(frame.where("split = 'TEST'"), names, []), names, [1.0, 5.0])
    assert sorted(tuple(r) for r in audit.collect()) == [("amount_paid", 240, 0), ("amount_to_avg_ratio", 240, 0)]


def test_leaves_by_what_borders_rule_out(rows):
    """Against a walk through every tree; deeper trees than 64 leaves go by the walk."""
    model = B.fit(rows, NAMES, "label", "weight", ["x"], B.Settings(trees=9, depth=6, least_rows=5, bins=40))
    x = np.random.default_rng(1).uniform(-2, 45, (3, 700))
    x[:, :300] = np.round(x[:, :300])  # on the borders
    x[0, 300], x[1, 301] = np.nan, np.inf
    walked = model.start + sum(np.asarray(t.value)[t.nodes(x, t.threshold)] for t in model.trees)
    assert model.leaves and np.allclose(model.margins(x), walked, rtol=0, atol=1e-12)
    steps = [0.0, 0.5, 3.0, 100.0]
    raised = np.stack([np.stack([model.margins(B._raised(x, f, s)) for s in steps]) for f in (1, 2)])
    want = (np.diff(1 / (1 + np.exp(-raised)), axis=1) < -1e-12).sum(axis=1)
    assert want.sum() > 100 and np.array_equal(model.decreases(x, [1, 2], steps), want)
    deep = B.fit(rows, NAMES, "label", "weight", (), B.Settings(trees=2, depth=9, least_rows=1, bins=60))
    assert not deep.leaves and not np.array_equal(deep.margins(x), np.full(700, deep.start))
    assert deep.decreases(x, [1], steps).shape == (1, 700)


def test_the_audit_of_trees_is_one_python_step(rows):
    """It scored every raised copy in a step of its own, each with its own workers."""
    model = B.fit(rows, NAMES, "label", "weight", (), B.Settings(trees=2, depth=2))
    model.names = ["amount_paid", "amount_to_avg_ratio", "flag"]
    frame = rows.select(F.col("x").alias("amount_paid"), F.col("y").alias("amount_to_avg_ratio"), "flag")
    audit = M.monotone_audit(model, frame, model.names, [0.5, 1.0, 10.0, 1000.0])
    assert audit._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert {r["feature"]: r["n_rows"] for r in audit.collect()} == {"amount_paid": 2000, "amount_to_avg_ratio": 2000}
