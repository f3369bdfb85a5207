"""Ranked lexical search, reversed: documents stream through an index of the items.

The items are few and the documents many, so it is the items' terms that are indexed: term to
(item, occurrences). The index goes to every task. A document's term counts pass through it once
and score it for all items that share a term; each task keeps a bounded heap of the best documents
per item, and the heaps of all tasks merge, first within groups of tasks, then over all.

Items are searched in blocks whose index has a bounded size, however many there are.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructField, StructType, LongType

from riskfeat.llm.common import Stages
from riskfeat.llm.hashing import list_column, parts

BEST = 10
#: Most (term, item) entries of an index that goes to the tasks; one item alone may have more.
INDEX_ENTRIES = 500_000
#: (document, item) scores that a task holds at a time.
CELLS = 1 << 20
#: Every ASCII character but letters and digits separates terms; A-Z become a-z, other bytes stay.
FOLD = bytes(
    b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256)
)


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return (text or b"").translate(FOLD).split()


class Index:
    """Term to (item, occurrences), as arrays: a term's entries stand between its start and the next one's."""

    def __init__(self, rows: list):
        self.items = sorted({r["item"] for r in rows})
        number = {item: i for i, item in enumerate(self.items)}
        rows = sorted(rows, key=lambda r: r["term"])
        self.vocabulary: dict[bytes, int] = {}
        ids = [self.vocabulary.setdefault(bytes(r["term"]), len(self.vocabulary)) for r in rows]
        self.start = np.searchsorted(ids, np.arange(len(self.vocabulary) + 1))
        self.item = np.array([number[r["item"]] for r in rows], np.int64)
        self.times = np.array([r["times"] for r in rows], np.int64)


class Entry:
    """A document in an item's heap; the least of all is the first to leave."""

    __slots__ = ("score", "place")

    def __init__(self, score: int, doc_id):
        self.score, self.place = score, (doc_id is None, doc_id)

    def __lt__(self, other: Entry) -> bool:
        return (self.score, other.place) < (other.score, self.place)


class Heaps:
    """The best documents per item so far."""

    def __init__(self, n_items: int, best: int):
        self.best = best
        self.heaps: list[list[Entry]] = [[] for _ in range(n_items)]
        #: What a document must reach to enter; above 0 in any case.
        self.least = np.ones(n_items, np.int64)

    def offer(self, scores: np.ndarray, ids: list) -> None:
        """Scores of some documents, one row each, for all items."""
        # Of equal scores the smaller id counts, and nulls come last.
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i]))
        item, at = np.nonzero((scores[order] >= self.least).T)
        cuts = np.searchsorted(item, np.arange(len(self.heaps) + 1))
        for i in np.flatnonzero(np.diff(cuts)):
            found = at[cuts[i] : cuts[i + 1]]
            values = scores[order, i][found]
            # No more than ``best`` of them can enter.
            heap = self.heaps[i]
            for k in np.argsort(-values, kind="stable")[: self.best]:
                entry = Entry(int(values[k]), ids[order[found[k]]])
                if len(heap) < self.best:
                    heapq.heappush(heap, entry)
                elif heap[0] < entry:
                    heapq.heapreplace(heap, entry)
            if len(heap) == self.best:
                self.least[i] = heap[0].score


def _item_terms(items: DataFrame) -> DataFrame:
    """(item, term, times)."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            rows = [
                (item, term, times)
                for item, text in zip(part.column("item").to_pylist(), part.column("text").to_pylist())
                for term, times in Counter(terms(text)).items()
            ]
            columns = zip(*rows) if rows else ([], [], [])
            kinds = (pa.int64(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)], ["item", "term", "times"]
            )

    return items.select("item", F.col("text").cast("binary").alias("text")).mapInArrow(
        listed, "item long, term binary, times long"
    )


def _blocks(stages: Stages, postings: DataFrame, most: int) -> tuple[DataFrame, int]:
    """Postings with the ``block`` of their item, and how many there are; none is larger than ``most`` or one item."""
    sizes = stages(postings.groupBy("item").agg(F.count(F.lit(1)).alias("entries")), "sizes")
    total, items = sizes.agg(F.sum("entries"), F.count(F.lit(1))).first()
    n, block = 1, F.lit(0)
    while items and total > most:
        n *= 2
        block = F.pmod(F.xxhash64("item"), F.lit(n)).cast("int")
        # Items that are too large alone can't be split further: a score is a sum over the whole item.
        crowded = sizes.groupBy(block.alias("b")).agg(F.sum("entries").alias("e"), F.count(F.lit(1)).alias("c"))
        if crowded.where((F.col("e") > most) & (F.col("c") > 1)).isEmpty():
            break
    return postings.withColumn("block", block), n


def _term_counts(docs: DataFrame, index) -> DataFrame:
    """(doc_id, n, ids, times): all terms of a document, and how often it has those of the index."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = index.value["vocabulary"].get
        for part in parts(batches):
            n, found = [], []
            for text in part.column("text").to_pylist():
                listed = terms(text)
                counts = Counter(map(number, listed))
                counts.pop(None, None)
                n.append(len(listed))
                found.append(counts)
            sizes = [len(c) for c in found]
            flat = [np.fromiter((x for c in found for x in pick(c)), np.int64, sum(sizes)) for pick in (dict.keys, dict.values)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(n, pa.int64()),
                    list_column(flat[0].astype(np.int32), sizes, pa.int32()),
                    list_column(flat[1], sizes, pa.int64()),
                ],
                ["doc_id", "n", "ids", "times"],
            )

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        counted, f"doc_id {kind}, n long, ids array<int>, times array<long>"
    )


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _scored(counts: DataFrame, index, weights: np.ndarray, n_docs: int, n_terms: int, best: int) -> DataFrame:
    """(item, doc_id, score, slot): each task's best; ``slot`` deals the tasks into groups."""
    schema = StructType(
        [StructField("item", LongType()), counts.schema["doc_id"], StructField("score", LongType())]
    )
    tasks = counts.rdd.getNumPartitions()

    def heaped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = SimpleNamespace(**index.value)
        degree = np.diff(own.start)
        heaps = Heaps(len(own.items), best)
        kind = None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            ids = batch.column("doc_id").to_pylist()
            length = [100 - 75 + 75 * n * n_docs // n_terms for n in batch.column("n").to_pylist()]
            length = np.array(length, np.int64)
            ends = batch.column("ids").offsets.to_numpy()
            term = batch.column("ids").values.to_numpy()
            times = batch.column("times").values.to_numpy()
            step = max(1, CELLS // len(own.items))
            # A slice has few (document, item) cells and few entries; one document may have more.
            entries = np.concatenate([[0], np.cumsum(degree[term])])[ends]
            at = 0
            while at < len(ids):
                end = max(at + 1, min(at + step, int(np.searchsorted(entries, entries[at] + CELLS, "right")) - 1))
                mine = slice(ends[at], ends[end])
                doc = np.repeat(np.arange(end - at), np.diff(ends[at : end + 1]))
                part = 1_000_000_000 * times[mine] // (1000 * times[mine] + 8 * length[at + doc])
                value, each = part * weights[term[mine]], degree[term[mine]]
                # Every term of a document with every item that has it.
                first = np.cumsum(each) - each
                entry = np.arange(each.sum()) + np.repeat(own.start[term[mine]] - first, each)
                scores = np.zeros((end - at, len(own.items)), np.int64)
                cell = np.repeat(doc * len(own.items), each) + own.item[entry]
                np.add.at(scores.reshape(-1), cell, np.repeat(value, each) * own.times[entry])
                heaps.offer(scores, ids[at:end])
                at = end
        rows = [(own.items[i], e.place[1], e.score) for i, heap in enumerate(heaps.heaps) for e in heap]
        if rows:
            columns = zip(*rows)
            kinds = (pa.int64(), kind, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["item", "doc_id", "score"]
            )

    group = max(1, math.isqrt(tasks))
    return counts.mapInArrow(heaped, schema).withColumn("slot", F.spark_partition_id() % group)


def _best(rows: DataFrame, best: int, *group: str) -> DataFrame:
    """Rows with their ``rank`` among a group, the first ones only."""
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def search(docs: DataFrame, items: DataFrame, best: int = BEST, entries: int = INDEX_ENTRIES) -> DataFrame:
    """The ``best`` documents for every item: item_id, rank, doc_id, score.

    Terms are runs of letters, digits and all that is not ASCII, A-Z lowered. With N documents that
    have a term, L terms in all, n in the document, df documents with the term and tf of it in this one, all
    in whole numbers: w = floor(1000 ln((2N + 2) / (2df + 1))), m = 25 + 75nN div L, and the score sums
    w (10^9 tf div (1000 tf + 8m)) over the item's terms, repeats included. Only scores above 0 count; equal
    scores go by doc_id, nulls last.

    Null and empty texts have no terms, and match nothing. Repeated rows of documents are documents of
    their own, and are all listed. Rows of items that agree in item_id and text are one item; different texts
    of one item_id are ranked apart. Other columns are ignored; an empty table gives an empty result.

    An index has at most ``entries`` (term, item) pairs, or those of one item; more items are searched in
    several blocks, each with a pass over the documents.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "search")
    known = stages(
        items.select("item_id", "text").distinct().withColumn("item", F.monotonically_increasing_id()), "items"
    )
    postings, blocks = _blocks(stages, stages(_item_terms(known), "terms"), entries)
    found = []
    for block in range(blocks):
        rows = postings.where(F.col("block") == block).collect()
        if not rows:
            continue
        index = Index(rows)
        shared = spark.sparkContext.broadcast(vars(index))  # plain values, which executors can read without this package
        counts = stages(_term_counts(docs, shared), f"counts-{block}")
        n_docs, n_terms = counts.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
        if n_docs:
            with_term = counts.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("df"))
            weights = np.zeros(len(index.vocabulary), np.int64)
            for row in with_term.collect():
                weights[row["id"]] = weight(n_docs, row["df"])
            tasks = _scored(counts.where("size(ids) > 0"), shared, weights, n_docs, n_terms, best)
            found.append(stages(_best(tasks, best, "item", "slot"), f"heaps-{block}"))
        stages.drop(f"counts-{block}")
        shared.unpersist()
    if not found:
        schema = StructType([StructField("item", LongType()), docs.schema["doc_id"], StructField("score", LongType())])
        found = [spark.createDataFrame([], schema)]
    merged = found[0].select("item", "doc_id", "score")
    for more in found[1:]:
        merged = merged.unionByName(more.select("item", "doc_id", "score"))
    ranked = _best(merged, best, "item")
    return ranked.join(known.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
