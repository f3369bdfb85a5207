"""Boosted trees with monotone constraints and an L2 term, fitted on histograms.

Features are cut into bins once. For each level of a tree every task sums gradients, hessians and rows per
(node, bin) over its own rows; only these histograms are added up and reach the driver, whose size is that of the
model and not of the data. The driver chooses the splits. A split on a constrained feature must not put the larger value on the lower
side, and the middle between both values bounds all values below it, so no path can break the constraint.

Rows travel as blocks of bins with their score so far. Trees since the last fold are applied where the blocks lie, so a task needs
nothing but its blocks and the trees, and a lost executor costs the reading of its blocks.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskfeat.session import scratch_dir

# Executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows in a block, rows in a partition, and trees after which scores are written into the blocks.
BLOCK_ROWS = 1 << 16
PART_ROWS = 1 << 16
FOLD = 16
#: From this number of partitions on, histograms are added up in two steps.
TREE_REDUCE = 16


@dataclass(frozen=True)
class Settings:
    trees: int = 300
    depth: int = 6
    rate: float = 0.1
    l2: float = 1.0
    least_rows: int = 50
    bins: int = 255


@dataclass
class Tree:
    """Nodes in the order of their making; a leaf has no feature. Rows up to ``threshold`` go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, bin_: int, threshold: float, values: Sequence[float]) -> tuple[int, int]:
        self.feature[node], self.bin[node], self.threshold[node] = feature, bin_, threshold
        self.left[node], self.right[node] = len(self.value), len(self.value) + 1
        for v in values:
            for column, x in zip((self.feature, self.bin, self.threshold, self.left, self.right, self.value), (-1, 0, 0.0, 0, 0, v)):
                column.append(x)
        return self.left[node], self.right[node]

    def nodes(self, columns: Sequence[np.ndarray] | np.ndarray, cut: Sequence) -> np.ndarray:
        """The leaf of every row; ``columns`` has a row for each feature, ``cut`` the border of each node."""
        columns, cut = np.asarray(columns), np.asarray(cut)
        feature, left, right = (np.asarray(x) for x in (self.feature, self.left, self.right))
        at, rows = np.zeros(columns.shape[1], np.int64), np.arange(columns.shape[1])
        while (inner := feature[at] >= 0).any():
            down = columns[feature[at], rows] <= cut[at]
            at = np.where(inner, np.where(down, left[at], right[at]), at)
        return at


class Leaves:
    """Trees of at most 64 leaves each, by what every border rules out.

    A leaf is a bit, the leftmost one the lowest. A row that goes right at a node can't end in the leaves on its left,
    whatever the nodes above it say. So each value of a feature, by its place among the borders, leaves some
    bits of every tree; of those that all features leave the lowest is the row's leaf.
    """

    MOST = 64
    #: Rows that are looked up at a time, so that what belongs to them stays in the cache.
    ROWS = 256

    def __init__(self, trees: Sequence[Tree], cuts: Sequence[Sequence], width: int):
        """``cuts`` holds every node's border, ``width`` is the number of features."""
        self.value = np.zeros((len(trees), self.MOST))
        nodes: list[list[tuple]] = [[] for _ in range(width)]
        for t, (tree, cut) in enumerate(zip(trees, cuts)):
            found = 0

            def below(node: int) -> int:
                nonlocal found
                if tree.feature[node] < 0:
                    self.value[t, found] = tree.value[node]
                    found += 1
                    return 1 << (found - 1)
                left, right = below(tree.left[node]), below(tree.right[node])
                nodes[tree.feature[node]].append((cut[node], t, left))
                return left | right

            below(0)
        self.borders = [np.unique(np.array([cut for cut, *_ in of], float)) for of in nodes]
        self.left = []
        for of, borders in zip(nodes, self.borders):
            kept = np.full((len(borders) + 1, len(trees)), ~np.uint64(0))
            for cut, t, ruled_out in of:
                kept[np.searchsorted(borders, cut) + 1 :, t] &= ~np.uint64(ruled_out)
            self.left.append(kept)
        self.flat, self.first = self.value.reshape(-1), np.arange(len(trees)) * self.MOST
        self.used = [f for f, of in enumerate(nodes) if of]

    @classmethod
    def fit(cls, trees: Sequence[Tree]) -> bool:
        return all(2 * cls.MOST > len(tree.value) for tree in trees)

    def possible(self, feature: int, column: np.ndarray) -> np.ndarray:
        """Per row and tree the leaves that a feature leaves."""
        return self.left[feature].take(np.searchsorted(self.borders[feature], column), axis=0)

    def sums(self, possible: np.ndarray) -> np.ndarray:
        """Per row the values of the lowest leaves, added up tree by tree."""
        lowest = possible & (~possible + np.uint64(1))
        at = np.frexp(lowest.astype(float))[1] - 1
        return self.flat.take(at + self.first).sum(axis=1)

    def __call__(self, columns: np.ndarray) -> np.ndarray:
        total = np.empty(columns.shape[1])
        for at in range(0, len(total), self.ROWS):
            part = columns[:, at : at + self.ROWS]
            possible = np.full((part.shape[1], len(self.value)), ~np.uint64(0))
            for f in self.used:
                possible &= self.possible(f, part[f])
            total[at : at + self.ROWS] = self.sums(possible)
        return total

    def raised(self, columns: np.ndarray, feature: int, steps: Sequence[float], rest: np.ndarray) -> np.ndarray:
        """Per step and row the sum with a feature raised; ``rest`` is what all other features leave."""
        return np.stack([self.sums(rest & self.possible(feature, columns[feature] + step)) for step in steps])

    def without(self, columns: np.ndarray, features: Sequence[int]) -> Iterator[np.ndarray]:
        """For each of some features the leaves that all others leave."""
        shared = np.full((columns.shape[1], len(self.value)), ~np.uint64(0))
        for f in self.used:
            if f not in features:
                shared &= self.possible(f, columns[f])
        own = [self.possible(f, columns[f]) for f in features]
        for k in range(len(own)):
            rest = shared.copy()
            for j, possible in enumerate(own):
                if j != k:
                    rest &= possible
            yield rest


@dataclass
class BoostedTrees:
    """A fitted model; scores are probabilities of the positive class."""

    names: list[str]
    start: float
    trees: list[Tree]

    @cached_property
    def leaves(self) -> Leaves | None:
        return Leaves(self.trees, [t.threshold for t in self.trees], len(self.names)) if Leaves.fit(self.trees) else None

    def margins(self, columns: np.ndarray) -> np.ndarray:
        if self.leaves:
            return self.start + self.leaves(columns)
        total = np.full(columns.shape[1], self.start)
        for tree in self.trees:
            total += np.asarray(tree.value)[tree.nodes(columns, tree.threshold)]
        return total

    def decreases(self, columns: np.ndarray, features: Sequence[int], steps: Sequence[float]) -> np.ndarray:
        """Per feature and row how often a score is lower than at the step before; ``steps`` rise from 0."""
        found = np.zeros((len(features), columns.shape[1]), np.int64)
        score = lambda margins: 1 / (1 + np.exp(-margins))
        for at in range(0, columns.shape[1], Leaves.ROWS):
            part = columns[:, at : at + Leaves.ROWS]
            rests = self.leaves.without(part, features) if self.leaves else [None] * len(features)
            for k, (f, rest) in enumerate(zip(features, rests)):
                if rest is not None:
                    margins = self.start + self.leaves.raised(part, f, steps, rest)
                else:
                    margins = np.stack([self.margins(_raised(part, f, step)) for step in steps])
                found[k, at : at + Leaves.ROWS] = (np.diff(score(margins), axis=0) < -1e-12).sum(axis=0)
        return found

    def audited(self, matrix: DataFrame, audited: Sequence[str], steps: Sequence[float]) -> DataFrame:
        """One array column: per audited feature how often raising it from step to step lowers a row's score.

        All raised copies of a row are scored in one Arrow batch function, whatever their number.
        """
        features = [self.names.index(n) for n in audited]
        shared = self._sent(matrix.sparkSession)

        @F.pandas_udf("array<long>")
        def count(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            model = BoostedTrees.received(shared.value)
            for batch in batches:
                yield pd.Series(list(model.decreases(np.stack([c.to_numpy(float) for c in batch]), features, steps).T))

        return matrix.select(count(*[F.col(n) for n in self.names]).alias("decreases"))

    def _sent(self, spark: SparkSession):
        return spark.sparkContext.broadcast((list(self.names), self.start, [asdict(t) for t in self.trees]))

    @staticmethod
    def received(parts: tuple) -> BoostedTrees:
        names, start, trees = parts
        return BoostedTrees(names, start, [Tree(**t) for t in trees])

    def transform(self, matrix: DataFrame) -> DataFrame:
        """Adds ``fraud_score``; rows are scored in Arrow batches."""
        shared = self._sent(matrix.sparkSession)

        @F.pandas_udf("double")
        def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            model = BoostedTrees.received(shared.value)
            for batch in batches:
                yield pd.Series(1 / (1 + np.exp(-model.margins(np.stack([c.to_numpy(float) for c in batch])))))

        return matrix.withColumn("fraud_score", score(*[F.col(n) for n in self.names]))

    def save(self, spark: SparkSession, path: str) -> None:
        lines = [json.dumps({"names": self.names, "start": self.start})] + [json.dumps(asdict(t)) for t in self.trees]
        rows = spark.createDataFrame(list(enumerate(lines)), "place long, line string")
        rows.coalesce(1).write.parquet(f"{path}/trees")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        head, *trees = [json.loads(r["line"]) for r in spark.read.parquet(f"{path}/trees").orderBy("place").collect()]
        return BoostedTrees(head["names"], head["start"], [Tree(**t) for t in trees])


def _raised(columns: np.ndarray, feature: int, step: float) -> np.ndarray:
    columns = columns.copy()
    columns[feature] += step
    return columns


# -- splits, on the driver --


def bin_edges(matrix: DataFrame, names: Sequence[str], bins: int) -> list[np.ndarray]:
    """Borders between the bins of every feature: quantiles, each once, without the largest value."""
    share = [i / bins for i in range(bins + 1)]
    found = matrix.approxQuantile(list(names), share, 0.25 / bins)
    return [np.unique(q)[:-1] for q in found]


def best_splits(
    sums: np.ndarray, edges: Sequence[np.ndarray], rising: Sequence[bool], bounds: np.ndarray, settings: Settings
) -> list[tuple | None]:
    """Per node (gain, feature, bin, left value, right value), or None.

    ``sums`` has gradient, hessian and rows per (node, bin), the bins of all features side by side, one more than
    each has edges. Values lie within the node's ``bounds``; a rising feature's left value is not above the right one.
    """
    counts = np.array([len(e) + 1 for e in edges])
    offset = np.cumsum(counts) - counts
    feature = np.repeat(np.arange(len(edges)), counts)
    upto = np.cumsum(sums, axis=1)
    first = np.concatenate([np.zeros_like(upto[:, :1]), upto], axis=1)[:, offset]
    left = upto - first[:, feature]
    total = left[:, offset[0] + counts[0] - 1][:, None]
    right = total - left
    low, high = bounds[:, 0, None], bounds[:, 1, None]
    value = lambda s: np.clip(-s[..., 0] / (s[..., 1] + settings.l2), low, high)
    cost = lambda s, v: s[..., 0] * v + 0.5 * (s[..., 1] + settings.l2) * v * v
    a, b = value(left), value(right)
    gain = cost(total, value(total)) - cost(left, a) - cost(right, b)
    allowed = (left[..., 2] >= settings.least_rows) & (right[..., 2] >= settings.least_rows)
    allowed &= ~(np.array(rising, bool)[feature] & (a > b))
    gain = np.where(allowed, gain, -np.inf)
    found = []
    for node, k in enumerate(gain.argmax(axis=1)):
        if not gain[node, k] > 1e-9:
            found.append(None)
            continue
        f = feature[k]
        found.append((gain[node, k], int(f), int(k - offset[f]), a[node, k], b[node, k]))
    return found


# -- histograms, in tasks --


def _blocks(matrix: DataFrame, names: Sequence[str], label: str, weight: str, edges: list[np.ndarray], start: float) -> DataFrame:
    """Rows as blocks: bins by feature, label, weight and score so far."""

    def blocked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK_ROWS):
                part = batch.iloc[at : at + BLOCK_ROWS]
                bins = np.stack([np.searchsorted(e, part[n].to_numpy(float)) for n, e in zip(names, edges)])
                yield pd.DataFrame(
                    {
                        "bins": [bins.astype(np.uint8).tobytes()],
                        "label": [part[label].to_numpy(float).tobytes()],
                        "weight": [part[weight].to_numpy(float).tobytes()],
                        "margin": [np.full(len(part), start).tobytes()],
                    }
                )

    rows = matrix.select(*names, label, weight)
    return rows.mapInPandas(blocked, "bins binary, label binary, weight binary, margin binary")


def _opened(row) -> tuple[np.ndarray, ...]:
    label, weight, margin = (np.frombuffer(row[c], float) for c in ("label", "weight", "margin"))
    return np.frombuffer(row["bins"], np.uint8).reshape(-1, len(label)), label, weight, margin


def _advanced(bins: np.ndarray, margin: np.ndarray, trees: Sequence[Tree]) -> np.ndarray:
    if trees and Leaves.fit(trees):
        return margin + Leaves(trees, [t.bin for t in trees], len(bins))(bins)
    for tree in trees:
        margin = margin + np.asarray(tree.value)[tree.nodes(bins, tree.bin)]
    return margin


def _level_sums(trees: Sequence[Tree], growing: Tree, open_nodes: Sequence[int], offset: np.ndarray, width: int):
    """Sums per open node of the growing tree and bin, over the blocks of a partition."""

    def summed(blocks: Iterator[tuple[np.ndarray, ...]]) -> Iterator[np.ndarray]:
        total = np.zeros((len(open_nodes), width, 3))
        place = np.full(len(growing.value), -1)
        place[list(open_nodes)] = np.arange(len(open_nodes))
        for bins, label, weight, margin in blocks:
            p = 1 / (1 + np.exp(-_advanced(bins, margin, trees)))
            node = place[growing.nodes(bins, growing.bin)]
            mine = np.flatnonzero(node >= 0)
            cell = (node[mine] * width + offset[:, None] + bins[:, mine]).reshape(-1)
            parts = (weight * (p - label), weight * p * (1 - p), np.ones(len(label)))
            for k, part in enumerate(parts):
                added = np.bincount(cell, np.tile(part[mine], len(offset)), total.shape[0] * width)
                total[:, :, k] += added.reshape(total.shape[:2])
        yield total

    return summed


def fit(
    matrix: DataFrame,
    names: Sequence[str],
    label: str,
    weight: str,
    rising: Sequence[str] = (),
    settings: Settings = Settings(),
) -> BoostedTrees:
    """Fit on the rows of a matrix without gaps; scores never fall along the features of ``rising``."""
    spark = matrix.sparkSession
    root = scratch_dir(spark, "boosting")
    edges = bin_edges(matrix, names, settings.bins)
    width, offset = sum(len(e) + 1 for e in edges), np.cumsum([0, *[len(e) + 1 for e in edges]])[:-1]
    n, positive, whole = matrix.agg(F.count(F.lit(1)), F.sum(F.col(label) * F.col(weight)), F.sum(weight)).first()
    if not n:
        raise ValueError("no rows to fit on")
    share = min(max(positive / whole, 1e-6), 1 - 1e-6)
    start = float(np.log(share / (1 - share)))
    parts = -(-n // PART_ROWS)
    _blocks(matrix.repartition(parts), names, label, weight, edges, start).write.parquet(f"{root}/0")
    blocks = spark.read.parquet(f"{root}/0").rdd.coalesce(parts).map(_opened).persist()
    limits = [name in set(rising) for name in names]
    done: list[Tree] = []
    folded = 0
    while len(done) < settings.trees:
        tree, bounds = Tree(), {0: (-np.inf, np.inf)}
        for _ in range(settings.depth):
            summed = blocks.mapPartitions(_level_sums(done[folded:], tree, list(bounds), offset, width))
            sums = summed.treeReduce(np.add) if parts >= TREE_REDUCE else sum(summed.collect())
            splits = best_splits(sums, edges, limits, np.array(list(bounds.values())), settings)
            below: dict[int, tuple[float, float]] = {}
            for (node, (low, high)), found in zip(bounds.items(), splits):
                if found is None:
                    continue
                _, f, at, a, b = found
                left, right = tree.split(node, f, at, float(edges[f][at]), (a * settings.rate, b * settings.rate))
                middle = (a + b) / 2
                below[left] = (low, min(high, middle) if limits[f] else high)
                below[right] = (max(low, middle) if limits[f] else low, high)
            bounds = below
            if not bounds:
                break
        if len(tree.value) == 1:
            break  # no split helps any more
        done.append(tree)
        if len(done) - folded >= FOLD and len(done) < settings.trees:
            recent, before, folded = done[folded:], blocks, len(done)
            names_of = ("bins", "label", "weight", "margin")
            moved = blocks.map(
                lambda b, recent=recent: tuple(map(bytes, (x.tobytes() for x in (*b[:3], _advanced(b[0], b[3], recent)))))
            )
            spark.createDataFrame(moved, ", ".join(f"{c} binary" for c in names_of)).write.parquet(f"{root}/{folded}")
            blocks = spark.read.parquet(f"{root}/{folded}").rdd.coalesce(parts).map(_opened).persist()
            before.unpersist()
    blocks.unpersist()
    return BoostedTrees(list(names), start, done)
