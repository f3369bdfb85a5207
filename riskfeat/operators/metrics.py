"""Exact ranking metrics over (label, score) rows, without a global sort.

Rows collapse to one row per distinct score; running totals over scores are
taken per range bucket (see ``ordering.running_totals``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskfeat import schemas as S
from riskfeat.functions import columns as C
from riskfeat.operators.ordering import first_by_hash, range_boundaries, running_totals
from riskfeat.sources.files import held, staged


def _score_counts(scored: DataFrame, label: str, score: str) -> DataFrame:
    rows = scored.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    return rows.groupBy(F.col(score).alias("score")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("pos")
    )


def _steps(counts: DataFrame) -> DataFrame:
    return running_totals(counts, "score", ["n", "pos"], range_boundaries(counts, "score"))


def score_steps(scored: DataFrame, label: str = "label", score: str = "fraud_score") -> DataFrame:
    """Per distinct score its rows and positives, and those at or above it.

    Rows without a score, null or NaN, are left out, as if they were not there. The scores are counted once and written,
    since cuts, bucket totals and running totals all read them.
    """
    return _steps(staged(_score_counts(scored, label, score), "score-steps"))


def _curve_sums() -> list[Column]:
    """Sums over the steps that the curve metrics need.

    The precision of a step counts once per positive in it. A negative is beaten by the
    positives above it, and half beaten by those of its own score.
    """
    beaten = (F.col("n") - F.col("pos")) * (F.col("pos_upto") - F.col("pos") / 2.0)
    return [
        F.sum("n").alias("n"),
        F.sum("pos").alias("pos"),
        F.sum(F.col("pos") * F.col("pos_upto") / F.col("n_upto")).alias("precision_sum"),
        F.sum(beaten).alias("beaten_sum"),
    ]


def _curve_metrics(n: Column, pos: Column, precision_sum: Column, beaten_sum: Column) -> list[Column]:
    return [
        F.coalesce(C.safe_div(precision_sum, pos), F.lit(0.0)).alias("pr_auc"),
        C.safe_div(beaten_sum, pos.cast("double") * (n - pos)).alias("roc_auc"),
        C.safe_div(pos, n).alias("base_rate"),
    ]


def _curve(scored: DataFrame, label: str, score: str) -> DataFrame:
    sums = score_steps(scored, label, score).agg(*_curve_sums())
    return sums.select(_curve_metrics(*[F.col(c) for c in sums.columns]))


def average_precision(scored: DataFrame, label: str = "label", score: str = "fraud_score") -> DataFrame:
    """0 when there are no positives."""
    return _curve(scored, label, score).select("pr_auc")


def roc_auc(scored: DataFrame, label: str = "label", score: str = "fraud_score") -> DataFrame:
    """NULL when one of the classes is missing."""
    return _curve(scored, label, score).select("roc_auc")


def model_metrics(
    scored: DataFrame,
    k: float = S.RECALL_FRACTION,
    tie: str = "event_key",
    label: str = "label",
    score: str = "fraud_score",
) -> DataFrame:
    """All metrics as one row.

    Recall is the share of positives among the top ``max(1, floor(n * k))`` scores. The
    steps give the score at the cut; of the rows tied there, those with the smallest MD5 of
    their key fill the remaining places. ``scored`` is read several times:
    pass a table, not a long plan.
    """
    wanted = F.greatest(F.lit(1), F.floor(F.col("n_total") * F.lit(k)))
    above = F.col("n_upto") - F.col("n")
    at_cut = (F.col("n_upto") >= wanted) & (above < wanted)
    cut = F.struct(
        F.col("score"), (wanted - above).alias("missing"), (F.col("pos_upto") - F.col("pos")).alias("found")
    )
    with held(_score_counts(scored, label, score), "score-steps") as counts:
        summary = _steps(counts).agg(*_curve_sums(), F.max(F.when(at_cut, cut)).alias("cut")).first()
    at, missing, found = summary["cut"] or (None, 0, 0)
    tied = scored.where(F.col(score) == F.lit(at).cast("double")).select(tie, label)
    hits = first_by_hash(tied, tie, missing).agg(
        (F.coalesce(F.sum(label), F.lit(0)) + F.lit(found)).alias("hits")
    )
    known = [F.lit(summary[c]) for c in ("n", "pos", "precision_sum", "beaten_sum")]
    recall = F.coalesce(C.safe_div(F.col("hits"), F.lit(summary["pos"])), F.lit(0.0))
    return hits.select(*_curve_metrics(*known), recall.alias("recall_at_k"))


def recall_at_k(
    scored: DataFrame,
    k: float = S.RECALL_FRACTION,
    tie: str = "event_key",
    label: str = "label",
    score: str = "fraud_score",
) -> DataFrame:
    return model_metrics(scored, k, tie, label, score).select("recall_at_k")


def compare_runs(runs: DataFrame, a: str, b: str) -> DataFrame:
    """Metric by metric the values of two runs and their difference; NaN where one lacks it."""

    def metrics_of(run: str, alias: str) -> DataFrame:
        return runs.where(F.col("run") == run).select(F.explode("metrics").alias("metric", alias))

    nan = F.lit(float("nan"))
    both = metrics_of(a, "a").join(metrics_of(b, "b"), "metric", "full")
    return both.select(
        "metric", F.coalesce("a", nan).alias("a"), F.coalesce("b", nan).alias("b")
    ).withColumn("delta", F.col("b") - F.col("a"))
