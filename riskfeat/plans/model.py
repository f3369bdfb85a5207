"""Training, scoring and the monotone audit of a laundering model."""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix
from pyspark.sql import Column, DataFrame, functions as F

from riskfeat import schemas as S
from riskfeat.operators.matrix import assemble
from riskfeat.operators.sampling import class_weights, with_weight
from riskfeat.plans.boosting import BoostedTrees, Settings, fit

# --- fixed values: training parameters ---
GBT_PARAMS = {"maxIter": 300, "maxDepth": 6, "stepSize": 0.1, "minInstancesPerNode": 50, "seed": 42}
TREE_PARAMS = {"trees": 300, "depth": 6, "rate": 0.1, "l2": 1.0, "least_rows": 50}
# --- end of fixed values ---


def train(
    frame: DataFrame,
    names: Sequence[str],
    kind: str = "monotone_gbt",
    params: Mapping[str, object] | None = None,
) -> PipelineModel | BoostedTrees:
    """Fit on the TRAIN rows of a training set, positives weighted up to the negatives.

    ``monotone_gbt`` are boosted trees with an L2 term whose risk-increasing features cannot lower the score, and
    ``monotone_lr`` is a logistic model with the same constraint. ``gbt`` are Spark ML's boosted trees, which have neither.
    """
    rows = frame.where(F.col("split") == "TRAIN")
    matrix = with_weight(
        assemble(rows, names, ["is_laundering"]).withColumn(
            "is_laundering", F.col("is_laundering").cast("double")
        ),
        class_weights(rows),
    )
    if kind == "monotone_gbt":
        rising = [n for n in names if n in S.MONOTONE_FEATURES]
        return fit(matrix, names, "is_laundering", "weight", rising, Settings(**{**TREE_PARAMS, **(params or {})}))
    assembler = VectorAssembler(inputCols=list(names), outputCol="features")
    shared = {"featuresCol": "features", "labelCol": "is_laundering", "weightCol": "weight"}
    if kind == "gbt":
        estimator = GBTClassifier(**shared, **{**GBT_PARAMS, **(params or {})})
    elif kind == "monotone_lr":
        # A saved model cannot hold an infinite bound.
        free = -sys.float_info.max
        floor = [0.0 if n in S.MONOTONE_FEATURES else free for n in names]
        estimator = LogisticRegression(**shared, **{"maxIter": 100, **(params or {})})
        estimator = estimator.setLowerBoundsOnCoefficients(DenseMatrix(1, len(names), floor))
    else:
        raise ValueError(f"unknown kind of model: {kind}")
    model = Pipeline(stages=[assembler, estimator]).fit(matrix)
    if kind == "monotone_lr":
        # The summary of the fit holds the session, which can't go to tasks once it has observed a write.
        model.stages[-1]._java_obj.setSummary(matrix.sparkSession._jvm.scala.Option.empty())
    return model


def linear_terms(model: PipelineModel) -> tuple[dict[str, float], float]:
    """Coefficients by feature and the intercept of a ``monotone_lr`` model."""
    names = model.stages[0].getInputCols()
    fitted = model.stages[-1]
    return dict(zip(names, map(float, fitted.coefficients))), float(fitted.intercept)


def linear_score(weights: Mapping[str, float], intercept: float) -> Column:
    """A logistic model as one column expression over assembled features."""
    z = F.lit(intercept)
    for name, weight in weights.items():
        z = z + F.col(name) * F.lit(weight)
    return 1.0 / (1.0 + F.exp(-z))


def predict(matrix: DataFrame, model: PipelineModel | BoostedTrees) -> DataFrame:
    """Adds ``fraud_score``, the probability of the positive class."""
    if isinstance(model, BoostedTrees):
        return model.transform(matrix)
    scored = model.transform(matrix)
    score = vector_to_array("probability")[1]
    return scored.withColumn("fraud_score", score).select(*matrix.columns, "fraud_score")


def scored_rows(
    rows: DataFrame, names: Sequence[str], model: PipelineModel | BoostedTrees | tuple[Mapping[str, float], float]
) -> DataFrame:
    """Score ABT rows that carry their history: key, time, format, label and score."""
    keys = [c for c in ("event_key", "account_id", "event_ts", "payment_format") if c in rows.columns]
    matrix = assemble(
        rows.withColumn("label", F.col("is_laundering")), names, [*keys, "label"]
    )
    if isinstance(model, (PipelineModel, BoostedTrees)):
        scored = predict(matrix, model)
    else:
        scored = matrix.withColumn("fraud_score", linear_score(*model))
    return scored.select(*keys, "label", "fraud_score")


def monotone_audit(
    model: PipelineModel | BoostedTrees, matrix: DataFrame, names: Sequence[str], steps: Sequence[float]
) -> DataFrame:
    """Per risk-increasing feature, how often adding to it lowers the score of a row.

    Each row is scored again with the feature raised by every one of ``steps``.
    """
    audited = [n for n in names if n in S.MONOTONE_FEATURES]
    if audited and isinstance(model, BoostedTrees):
        counts = model.audited(matrix, audited, sorted((0.0, *map(float, steps))))
        return counts.agg(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("feature"),
                        F.count(F.lit(1)).alias("n_rows"),
                        F.coalesce(F.sum(F.col("decreases")[k]), F.lit(0)).alias("n_decreases"),
                    )
                    for k, name in enumerate(audited)
                ]
            ).alias("found")
        ).select(F.inline("found"))
    # All raised copies of a row stay beside it: the vectors are an array of the row, and scoring
    # them needs no key to bring them together again.
    grid = [(n, float(step)) for n in audited for step in sorted((0.0, *steps))]
    probes = matrix.select(F.struct(*names).alias("row"), *names)
    scored = None
    for k, (name, step) in enumerate(grid):
        raised = (probes if scored is None else scored).withColumns({n: F.col(f"row.{n}") for n in names}).withColumn(
            name, F.col(f"row.{name}") + F.lit(step)
        )
        scored = predict(raised, model).withColumnRenamed("fraud_score", f"_score_{k}")
    if scored is None:
        return matrix.sparkSession.createDataFrame([], "feature string, n_rows long, n_decreases long")
    per_feature = []
    for name in audited:
        at = [k for k, (n, _) in enumerate(grid) if n == name]
        drops = [(F.col(f"_score_{b}") < F.col(f"_score_{a}") - 1e-12).cast("long") for a, b in zip(at, at[1:])]
        per_feature.append(
            F.struct(
                F.lit(name).alias("feature"),
                F.count(F.lit(1)).alias("n_rows"),
                F.coalesce(F.sum(reduce(Column.__add__, drops)), F.lit(0)).alias("n_decreases"),
            )
        )
    return scored.agg(F.array(*per_feature).alias("found")).select(F.inline("found"))
