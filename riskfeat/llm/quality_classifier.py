"""Quality classifier: text evidence combined with what is known of a document's site.

A logistic model on telling words and on the shape of a text gives each document its evidence, a log
likelihood ratio. Sites form a hierarchy, host above path; labelled documents are counted per site,
and each site's share of good ones is shrunk towards its host's, and a host's towards the
global one, the more so the fewer labels it has. How strong the pull is comes from the spread
among the sites themselves. Evidence and site add up as log odds.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskfeat.llm.common import Stages, few_by_hash, plain

#: Words the model looks for: those that tell the classes apart best among the fitted texts.
VOCABULARY = 512
#: Fitted texts that a word must occur in.
LEAST_TEXTS = 5
#: Labelled texts on which the model is fitted, of each class; the bound on what the driver holds.
FIT_TEXTS = 1500
STEPS = 400
RATE = 0.05
DECAY = 1e-4
#: Evidence beyond this counts no more; no model is surer.
MOST_EVIDENCE = 8.0
#: A site level whose sites do not differ pulls with at most this many pseudo-labels.
MOST_PULL = 1e4

_KIND = np.zeros(256, np.int64)  # classes of bytes: 0 other
for _k, _chars in enumerate(
    (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\r\x0b\x0c",
     b".,;:?'\"()-", b"!", b"|", b"#*$%&<>", b"/\\@=_+~^`[]{}"), start=1,
):
    _KIND[list(_chars)] = _k
SHAPES = 16


def features(text: str) -> tuple[set[str], np.ndarray]:
    """The distinct words, and numbers on the text's shape."""
    data = text.encode("utf-8", "replace")
    found = plain(text).split()
    distinct = set(found)
    kinds = np.bincount(_KIND, weights=np.bincount(np.frombuffer(data, np.uint8), minlength=256), minlength=10)
    lines = [x for x in data.split(b"\n") if x.strip()]
    n, size = max(1, len(found)), max(1, len(data))
    shape = np.array(
        [
            *(kinds[:10] / size * 4),
            math.log1p(len(found)) / 8,
            len(distinct) / n,
            size / n / 10,
            1 - len(set(lines)) / max(1, len(lines)),
            len(lines) / n,
            1.0,
        ]
    )
    return distinct, shape


@dataclass(frozen=True)
class Model:
    """Weights of words and shapes, and the log odds of good among the fitted texts."""

    words: dict[str, float]
    shapes: np.ndarray
    prior: float

    def evidence(self, text: str | None) -> float:
        if not text or not text.strip():
            return 0.0
        distinct, shape = features(text)
        odds = sum(self.words[w] for w in self.words.keys() & distinct) + float(self.shapes @ shape)
        return float(np.clip(odds - self.prior, -MOST_EVIDENCE, MOST_EVIDENCE))


def telling_words(texts: list[set[str]], good: np.ndarray) -> list[str]:
    """The words whose presence differs most between the classes, by the chi-squared statistic."""
    seen = Counter(w for words in texts for w in words)
    seen_good = Counter(w for words, g in zip(texts, good) if g for w in words)
    n, n_good = len(good), good.sum()

    def chi2(word: str) -> float:
        a, b = seen_good[word], seen[word] - seen_good[word]
        c, d = n_good - a, n - n_good - b
        return n * (a * d - b * c) ** 2 / max(1e-9, (a + b) * (c + d) * n_good * (n - n_good))

    often = [w for w, k in seen.items() if k >= LEAST_TEXTS]
    return sorted(often, key=lambda w: (-chi2(w), w))[:VOCABULARY]


def fit(texts: list[str], good: np.ndarray) -> Model:
    """Logistic regression on a bounded sample, by full steps with momentum scaled per weight."""
    if not len(good) or good.all() or not good.any():
        return Model({}, np.zeros(SHAPES), 0.0)
    both = [features(t) for t in texts]
    vocabulary = telling_words([w for w, _ in both], good)
    x = np.array([[*(w in words for w in vocabulary), *shape] for words, shape in both], float)
    w, speed, scale = np.zeros(x.shape[1]), 0.0, 0.0
    for step in range(1, STEPS + 1):
        slope = x.T @ (1 / (1 + np.exp(-(x @ w))) - good) / len(good) + DECAY * w
        speed = 0.9 * speed + 0.1 * slope
        scale = 0.99 * scale + 0.01 * slope * slope
        w -= RATE * (speed / (1 - 0.9**step)) / (np.sqrt(scale / (1 - 0.99**step)) + 1e-8)
    k = len(vocabulary)
    return Model(
        dict(zip(vocabulary, w[:k].tolist())), w[k:], math.log(good.sum() / (len(good) - good.sum()))
    )


def document_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, good) with one row per labelled document: good (1) only if all its labels say so, else 0."""
    good = F.min((F.col("good") > 0).cast("int")).alias("good")
    return labels.where("doc_id IS NOT NULL AND good IS NOT NULL").groupBy("doc_id").agg(good)


def fit_on(docs: DataFrame, labels: DataFrame, texts: int = FIT_TEXTS) -> Model:
    """Fit on at most ``texts`` of each class, the smallest by hash.

    Labels are sampled before any text moves, so the join is with a bounded table.
    """

    h = F.xxhash64("doc_id")
    sample = few_by_hash(labels, "good", h, texts, 2)
    rows = (
        docs.select("doc_id", "text")
        .where("length(text) > 0")
        .join(F.broadcast(sample), "doc_id")
        .groupBy("good", "doc_id")
        .agg(F.min("text").alias("text"))
        .withColumn("place", F.row_number().over(Window.partitionBy("good").orderBy(h, "doc_id")))
        .where(F.col("place") <= texts)
        .orderBy("good", "place")
        .collect()
    )
    return fit([r["text"] for r in rows], np.array([float(r["good"]) for r in rows]))


def _pull(sites: DataFrame) -> tuple[float, float]:
    """(mean, pseudo-labels) of a level, by the moments of its sites' (n, good)."""
    row = sites.agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("n"),
        F.sum("good").alias("good"),
        F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.col("good") * F.col("good") / F.col("n")).alias("gg"),
    ).first()
    n, good = row["n"] or 0, row["good"] or 0
    mean = (good + 1) / (n + 2)
    if (row["k"] or 0) < 2 or n <= 1:
        return mean, MOST_PULL
    spread = row["gg"] - good * good / n  # sum of n (p - mean)^2
    between = (spread - (row["k"] - 1) * mean * (1 - mean)) / max(1e-9, n - row["nn"] / n)
    return mean, min(MOST_PULL, max(1.0, mean * (1 - mean) / between - 1)) if between > 0 else MOST_PULL


def site_posteriors(labelled: DataFrame) -> tuple[DataFrame, DataFrame, float]:
    """Shares of good documents: per (host, path), per host, and overall.

    ``labelled`` has (host, path, good). Sparse paths lean on their host, sparse hosts on the mean.
    """
    paths = (
        labelled.groupBy("host", "path")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"))
    )
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    mean, host_pull = _pull(hosts)
    _, path_pull = _pull(paths)
    hosts = hosts.select(
        F.col("host").alias("h"), ((F.col("good") + host_pull * mean) / (F.col("n") + host_pull)).alias("host_share")
    )
    paths = paths.join(hosts, F.col("host").eqNullSafe(F.col("h"))).select(
        "host",
        "path",
        ((F.col("good") + path_pull * F.col("host_share")) / (F.col("n") + path_pull)).alias("path_share"),
    )
    return paths, hosts.withColumnRenamed("h", "host"), mean


def _log_odds(share: Column) -> Column:
    return F.log(share / (1 - share))


def classify(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column, fit_texts: int = FIT_TEXTS, least: float = 0.5
) -> DataFrame:
    """doc_id, evidence, site_share, score (0 to 1) and ``good`` (score of ``least`` or more), per row.

    ``labels`` has (doc_id, good): 1 or 0; nulls count for nothing, and of several labels of a
    document the lowest does. host and path are expressions on the columns; null is a site of its own. A document
    of an unknown path has its host's share, of an unknown host the global one. Null, empty and blank
    texts have no evidence and go by their site. Without labels of both classes no text has any;
    without labels at all the score is a half. Repeated rows get equal results.
    """
    stages = Stages(docs.sparkSession, "quality-classifier")
    labels = stages(document_labels(labels), "labels")
    fitted = fit_on(docs, labels, fit_texts)
    shipped = docs.sparkSession.sparkContext.broadcast((fitted.words, fitted.shapes, fitted.prior))
    sites = docs.select("doc_id", host.alias("host"), path.alias("path")).join(labels, "doc_id")
    paths, hosts, mean = site_posteriors(stages(sites, "sites"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    slim = docs.select("doc_id", "text", host.alias("host"), path.alias("path"))
    types = ", ".join(f"{c} {slim.schema[c].dataType.simpleString()}" for c in ("host", "path"))

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shipped.value)
        for batch in batches:
            found = [model.evidence(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "host", "path")], pa.array(found, pa.float64())],
                ["doc_id", "host", "path", "evidence"],
            )

    evidence = slim.mapInArrow(weighed, f"doc_id {id_type}, {types}, evidence double")
    by_path = paths.select(F.col("host").alias("_h"), F.col("path").alias("_p"), "path_share")
    by_host = hosts.select(F.col("host").alias("_hh"), "host_share")
    share = F.coalesce("path_share", "host_share", F.lit(mean))
    score = 1 / (1 + F.exp(-(F.col("evidence") + _log_odds(F.col("site_share")))))
    return (
        evidence.join(
            by_path, F.col("host").eqNullSafe(F.col("_h")) & F.col("path").eqNullSafe(F.col("_p")), "left"
        )
        .join(by_host, F.col("host").eqNullSafe(F.col("_hh")), "left")
        .withColumn("site_share", share)
        .withColumn("score", score)
        .select("doc_id", "evidence", "site_share", "score", (F.col("score") >= least).alias("good"))
    )
