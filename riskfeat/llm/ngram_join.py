"""Jaccard join of word n-gram sets, filtered under several global token orders.

Two sets of similarity t or more share a token among their first n - ceil(t n) + 1 tokens, under
any order of all tokens. Three orders are used, and a pair must pass all of them:

* by hash, ascending. With prefixes l tokens longer, l shared ones are due; a document whose
  prefix shares too few with anyone else drops out before its full set is ever moved;
* by number of documents, rarest first, among the documents left. It makes the candidates;
* by hash, descending, checked with the first one before a pair's sets are intersected.

Equal sets are one node. In a list of nodes that share a token not all pairs are formed: first each
node meets one hub of the list, and what links becomes one component; then only nodes of different
components meet. A pair inside a component could add nothing to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskfeat.llm.common import Stages, small, text_key
from riskfeat.llm.components import components
from riskfeat.llm.hashing import list_column, parts, shingles, word_hashes

WIDTH = 5
#: Least similarity in percent.
SIMILAR = 80
#: Hub rounds before nodes of different components meet in full.
HUB_ROUNDS = 2


def _word_sets(part: pa.RecordBatch, width: int) -> tuple[list[np.ndarray], list[tuple[int, int]]]:
    """Every text's set and its fingerprint."""
    hashes, first = word_hashes(part.column("text").to_pylist(), fold=True)
    found = [shingles(hashes[:, a:b], width) for a, b in zip(first, first[1:])]
    return [s for s, _ in found], [p for _, p in found]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    return list_column(np.concatenate([np.empty(0, np.int64), *arrays]), [len(a) for a in arrays], pa.int64())


def ceil_share(n, similar: int):
    """ceil(similar / 100 * n), in whole numbers."""
    return (similar * n + 99) // 100


def long_prefix(n: int, similar: int) -> int:
    return min(n, n - ceil_share(n, similar) + n // 10 + 1)


def _digests(docs: DataFrame, width: int, similar: int, keyed: bool) -> DataFrame:
    """doc_id, a hash of the text, set size, two fingerprints, and the long prefix by ascending hash.

    With ``keyed`` the key of the text as well.
    """
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("h"), *[text_key(F.col("text")).alias("t")] * keyed)
    others = [c for c in docs.columns if c != "text"]
    types = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in others)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            sets, prints = _word_sets(part, width)
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(c) for c in others],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([a for a, _ in prints], pa.int64()),
                    pa.array([b for _, b in prints], pa.int64()),
                    _lists([s[: long_prefix(len(s), similar)] for s in sets]),
                ],
                [*others, "n", "a", "b", "prefix"],
            )

    return docs.mapInArrow(digest, f"{types}n long, a long, b long, prefix array<long>")


def _full_sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, n, tokens) for the wanted nodes, tokens by ascending hash."""

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            wanted = zip(part.column("a").to_pylist(), part.column("b").to_pylist())
            sets, prints = _word_sets(part, width)
            mine = [i for i, (p, w) in enumerate(zip(prints, wanted)) if p == w]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("node").take(pa.array(mine, pa.int64())),
                    pa.array([len(sets[i]) for i in mine], pa.int64()),
                    _lists([sets[i] for i in mine]),
                ],
                ["node", "n", "tokens"],
            )

    texts = docs.select("doc_id", "text").join(
        small(nodes.select("node", "a", "b", "doc", "h")),
        (F.xxhash64("text") == F.col("h")) & F.col("doc_id").eqNullSafe(F.col("doc")),
    )
    return (
        texts.select("node", "a", "b", "text")
        .mapInArrow(full, "node long, n long, tokens array<long>")
        .dropDuplicates(["node"])
    )


def _share(n: Column, similar: int) -> Column:
    return F.floor((F.lit(similar) * n + 99) / 100).cast("long")


def _sharers(stages: Stages, nodes: DataFrame, similar: int) -> DataFrame:
    """Nodes whose long prefix holds as many tokens of other nodes as a link needs.

    A partner may have the smaller set, down to the similarity's share, and then a shorter prefix; the
    number due is that of the smallest partner.
    """
    postings = nodes.select("node", F.explode("prefix").alias("token"))
    shared = (
        postings.groupBy("token")
        .agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
        .where("lo <> hi")
        .select("token")
    )
    found = postings.join(shared, "token").groupBy("node").agg(F.count(F.lit(1)).alias("found"))
    due = F.floor(_share(F.col("n"), similar) / 10) + 1
    return stages(
        nodes.drop("prefix").join(found, "node").where(F.col("found") >= due).drop("found"),
        "sharers",
    )


def _rare_prefixes(full: DataFrame, similar: int) -> DataFrame:
    """(token, node, n, own, at) for the rarest-first prefixes; ``own`` tokens occur in this node alone.

    Tokens of one document come first in the order and match nothing, so they only use up places.
    ``at`` is a token's place in the whole order, from 0.
    """
    postings = full.select("node", "n", F.explode("tokens").alias("token"))
    common = postings.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ranked = (
        postings.join(common, "token")
        .groupBy("node", "n")
        .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("common"))
        .withColumn("own", F.col("n") - F.size("common"))
    )
    places = F.col("n") - _share(F.col("n"), similar) + 1 - F.col("own")
    return ranked.where(places > 0).select(
        F.posexplode(F.slice("common", F.lit(1), places.cast("int"))["token"]).alias("at", "token"), "node", "n", "own"
    ).withColumn("at", F.col("own") + F.col("at"))


def _may_link(x: str, y: str, similar: int) -> Column:
    """Sizes allow the similarity, if this token is the first that the two share.

    Then only it and what comes after it in both can be shared. For a pair that links this holds at its first
    shared token, which is all it needs to become a candidate.
    """
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    most = F.least(n - F.col(f"{x}at"), m - F.col(f"{y}at"))
    return (100 * F.least(n, m) >= similar * F.greatest(n, m)) & ((100 + similar) * most >= similar * (n + m))


def _pair(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("x"), F.greatest(x, y).alias("y")]


def _hub_pairs(lists: DataFrame, turn: int, similar: int) -> DataFrame:
    """Every node of a list with the list's hub, where their components differ."""
    # The first hub is the node with the least of its own: the source of a group of edited copies.
    order = F.col("own") / F.col("n") if turn == 0 else F.lit(0.0)
    hub = F.min(F.struct(order.alias("o"), F.xxhash64("node", F.lit(turn)).alias("h"), "node", "n", "at", "comp"))
    hubs = (
        lists.groupBy("token")
        .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), hub.alias("hub"))
        .where("lo <> hi")
        .select("token", *[F.col(f"hub.{c}").alias(f"hub_{c}") for c in ("node", "n", "at", "comp")])
    )
    met = lists.join(hubs, "token").where(
        (F.col("comp") != F.col("hub_comp")) & _may_link("", "hub_", similar)
    )
    return met.select(*_pair(F.col("node"), F.col("hub_node"))).distinct()


def _cross_pairs(lists: DataFrame, similar: int) -> DataFrame:
    """All pairs of nodes that share a list and not a component.

    Members of a list's largest component meet the others, never each other.
    """
    sizes = lists.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("c"))
    mixed = (
        sizes.groupBy("token")
        .agg(F.max(F.struct("c", "comp")).alias("top"), F.count(F.lit(1)).alias("comps"))
        .where("comps > 1")
        .select("token", F.col("top.comp").alias("top"))
    )
    left = lists.join(mixed, "token").where("comp <> top")
    right = lists.select(*[F.col(c).alias(c if c == "token" else f"o_{c}") for c in lists.columns])
    return (
        left.join(right, "token")
        .where(
            (F.col("comp") != F.col("o_comp"))
            & ((F.col("o_comp") == F.col("top")) | (F.col("node") < F.col("o_node")))
            & _may_link("", "o_", similar)
        )
        .select(*_pair(F.col("node"), F.col("o_node")))
        .distinct()
    )


def _links(pairs: DataFrame, full: DataFrame, similar: int) -> DataFrame:
    """The pairs that pass both hash orders and then the comparison of their sets."""
    x = full.select(F.col("node").alias("x"), F.col("n").alias("nx"), F.col("tokens").alias("tx"))
    y = full.select(F.col("node").alias("y"), F.col("n").alias("ny"), F.col("tokens").alias("ty"))
    head = lambda t, n: F.slice(t, F.lit(1), (n - _share(n, similar) + 1).cast("int"))
    tail = lambda t, n: F.slice(
        t, _share(n, similar).cast("int"), (n - _share(n, similar) + 1).cast("int")
    )
    tx, ty, nx, ny = F.col("tx"), F.col("ty"), F.col("nx"), F.col("ny")
    passes = F.arrays_overlap(head(tx, nx), head(ty, ny)) & F.arrays_overlap(tail(tx, nx), tail(ty, ny))
    common = F.size(F.array_intersect(tx, ty))
    # Nodes are different sets, by 128 bits, so they can't share all; a few shingles that seem to have equal halves.
    similar_sets = ((100 + similar) * common >= similar * (nx + ny)) & (common < F.greatest(nx, ny))
    return (
        pairs.join(x, "x")
        .join(y, "y")
        .where(F.when(passes, similar_sets).otherwise(False))
        .select("x", "y")
    )


def similar_groups(docs: DataFrame, width: int = WIDTH, similar: int = SIMILAR, keyed: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Texts lower A-Z and split at white space; a document's set holds its distinct runs of
    ``width`` words, or all its words as one run if it has fewer. Two documents link when their sets'
    Jaccard similarity is ``similar`` percent or more; the component is the smallest doc_id
    reachable by links, the document's own included (nulls last; null if all are).
    Documents without words, and null texts, have the empty set and link with nothing, not even
    with each other. Repeated rows and equal texts are copies of one set. Other columns are
    ignored; an empty table gives an empty one. 128 bits stand for words and sets; of a run's, 64 are compared with
    another document's, where sets that differ share four runs at least before they can link.

    A component is more than its component_id where texts share an id or have none. With ``keyed``
    there are also ``text_key``, and ``first``: whether no other (doc_id, text_key) of the row's component
    is smaller, nulls last. A document without words is first.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "ngram-join")
    digests = stages(_digests(docs, width, similar, keyed), "digests")
    key = ["t"] * keyed
    members = stages(digests.drop("prefix", "h"), "members")
    nodes = stages(
        digests.where("n > 0")
        .groupBy("a", "b")
        .agg(
            F.first("n").alias("n"),
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h", *key)).alias("first"),
            F.first("prefix").alias("prefix"),
        )
        .select("n", "a", "b", F.col("first.doc_id").alias("doc"), F.col("first.h").alias("h"), *[f"first.{c}" for c in key], "prefix")
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    stages.drop("digests")
    sharers = _sharers(stages, nodes, similar)
    node_docs = stages(nodes.select("node", "a", "b", "doc", *key), "node-docs")
    stages.drop("nodes")
    full = stages(_full_sets(docs, sharers, width), "full")
    lists = stages(_rare_prefixes(full, similar), "lists")
    labels = stages(lists.select("node", F.col("node").alias("comp")).distinct(), "labels")
    tried = None
    for turn in range(HUB_ROUNDS + 1):
        labelled = lists.join(labels, "node")
        pairs = _hub_pairs(labelled, turn, similar) if turn < HUB_ROUNDS else _cross_pairs(labelled, similar)
        pairs = stages(pairs if tried is None else pairs.join(tried, ["x", "y"], "left_anti"), f"pairs-{turn}")
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = stages(_links(pairs, full, similar), f"links-{turn}")
        ends = [labels.select(F.col("node").alias(e), F.col("comp").alias(f"c{e}")) for e in ("x", "y")]
        merged = links.join(ends[0], "x").join(ends[1], "y").select(F.col("cx").alias("x"), F.col("cy").alias("y"))
        into = components(stages, merged, f"merge-{turn}").select(
            F.col("node").alias("comp"), F.col("comp").alias("root")
        )
        labels = stages(
            labels.join(into, "comp", "left").select("node", F.coalesce("root", "comp").alias("comp")),
            f"labels-{turn}",
        )
    # Only nodes that share tokens with others have a label; the rest are alone.
    placed = node_docs.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = F.min(F.struct(F.col("doc").isNull(), "doc", "t")) if keyed else F.min("doc")
    smallest = placed.groupBy("comp").agg(least.alias("component_id"))
    classes = stages(placed.join(smallest, "comp").select("a", "b", "component_id"), "classes")
    if keyed:
        classes = classes.select("a", "b", F.col("component_id.doc").alias("component_id"), F.col("component_id.t").alias("least_t"))
    stages.drop("full", "lists", "node-docs", "sharers")
    alone = F.when(F.col("n") == 0, F.col("doc_id"))
    is_least = F.col("doc_id").eqNullSafe(F.col("component_id")) & F.col("t").eqNullSafe(F.col("least_t"))
    more = [F.col("t").alias("text_key"), ((F.col("n") == 0) | is_least).alias("first")] if keyed else []
    return members.join(classes, ["a", "b"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce(alone, "component_id").alias("component_id"), *more
    )
