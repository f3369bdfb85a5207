"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskfeat.llm.common import Stages


def _size(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(stages: Stages, links: DataFrame, name: str) -> DataFrame:
    """(node, comp) for every node that a link (x, y) touches; comp is the smallest node.

    Each node's larger neighbours move to its smallest one, then its smaller neighbours do,
    until every component is a star; the number of rounds grows with the logarithm of the longest
    path. Edges are written in every round, and no step sees more than one row of a
    node and its neighbour at a time.
    """
    edges = stages(
        links.where("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(),
        f"{name}-0",
    )
    before, done = _size(edges), 0
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        done += 1
        edges = stages(small, f"{name}-{done}")
        stages.drop(f"{name}-{done - 1}")
        after = _size(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(roots)
