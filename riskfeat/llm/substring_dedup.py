"""Substring dedup on prefix-partitioned suffix trees.

A text's suffixes start at its words. In the tree of all suffixes a node is the set of those that
share a prefix, and a node ``window`` words deep with two leaves is a repeat. The tree is
never built whole: suffixes are dealt out by digests of their prefixes, as many parts as
there are tasks, each with whole subtrees, and cut where a subtree has one leaf. Prefixes have
variable length:

* short ones first, and sparse: of the starts in a run of ``window`` words only that enters whose short
  prefix has the smallest hash, so equal runs enter at equal places. A short prefix that occurs
  once is a leaf, and the runs that entered there are unique;
* then all that the runs of such a place span, to both sides. A suffix with this long context is a
  copy if an earlier document has one, and all its runs repeat. Only the first stays;
* then prefixes of ``window`` words at every start that is left. These are the deep nodes.

Each level asks nodes for their first and last document alone, which aggregates combine on the map
side: a passage in a third of all documents weighs no more than any other. Runs that overlap
in a document merge into maximal repeats when their words are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskfeat.llm.common import Stages
from riskfeat.llm.hashing import MIX_A, list_column, mixed, parts, runs, word_hashes

WINDOW = 20
#: Words of a short prefix.
SHORT = 8


def sparse_places(prefixes: np.ndarray, span: int) -> np.ndarray:
    """For every ``span`` consecutive hashes the place of the smallest by its upper half, the first of equals."""
    low = np.uint64(0xFFFFFFFF)
    least = (prefixes & ~low) | np.arange(len(prefixes), dtype=np.uint64)
    have = 1
    while have < span and len(least):
        step = min(have, span - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return (least & low).astype(np.int64)


class Suffixes:
    """Digests of the suffixes of several texts.

    Runs that cross the border of two texts are left out. ``places`` are those that enter, as numbers of
    words among all; ``entry`` has for each whole run of ``window`` words its start and its place.
    """

    def __init__(self, texts: list[str | None], window: int, short: int):
        self.window = window
        self.hashes, self.first = word_hashes(texts)
        n_words = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), n_words)
        ends = self.first[1:][self.doc]
        prefixes = runs(self.hashes[0], short)
        places = sparse_places(prefixes, window - short + 1)
        self.starts = np.flatnonzero(np.arange(len(places)) + window <= ends[: len(places)])
        entry = places[self.starts]
        # Places never go back, so equal ones stand together.
        new = np.ones(len(entry), bool)
        new[1:] = entry[1:] != entry[:-1]
        self.entry = np.cumsum(new) - 1
        self.places = entry[new]
        self.place_doc = self.doc[self.places]
        self.prefix = prefixes[self.places]
        # Texts with room for the context on both sides, filled with what is no word.
        side = window - short
        padded = np.zeros((2, len(self.doc) + 2 * side * len(texts)), np.uint64)
        padded[:, np.arange(len(self.doc)) + side * (2 * self.doc + 1)] = self.hashes
        at = self.places + 2 * side * self.place_doc
        self.context, self.context2 = (runs(half, window + side)[at] for half in padded)

    def counts(self, docs: np.ndarray) -> np.ndarray:
        return np.bincount(docs, minlength=len(self.first) - 1)

    def _in_text(self, values: np.ndarray, docs: np.ndarray) -> np.ndarray:
        return mixed(values ^ (docs.astype(np.uint64) * MIX_A))

    def first_level(self) -> tuple[np.ndarray, ...]:
        """Each text's short prefixes with context, once, and whether it has that prefix twice."""
        own = self._in_text(self.prefix, self.place_doc)
        _, at, counts = np.unique(own, return_inverse=True, return_counts=True)
        twice = counts[at] > 1
        _, once = np.unique(own ^ mixed(self.context ^ mixed(self.context2.copy())), return_index=True)
        once.sort()
        columns = self.prefix.view(np.int64), self.context.view(np.int64), self.context2.view(np.int64), twice
        return self.place_doc[once], *[c[once] for c in columns]

    def second_level(
        self, doc: np.ndarray, prefix: np.ndarray, context: np.ndarray, context2: np.ndarray, copied: np.ndarray
    ) -> tuple[np.ndarray, ...]:
        """For marked places: text, two digests and start of each run to look up; text and start of the known repeats.

        A run repeats for sure if its place is a copy, or if its text has the run before.
        """
        join = lambda p, c, d: self._in_text(p ^ mixed(c.copy()), d)
        marked = join(prefix.view(np.uint64), context.view(np.uint64), doc)
        order = np.argsort(marked)
        marked, copied, second = marked[order], copied[order], context2.view(np.uint64)[order]
        mine = join(self.prefix, self.context, self.place_doc)
        at = np.minimum(np.searchsorted(marked, mine), max(0, len(marked) - 1))
        alive = marked[at] == mine if len(marked) else np.zeros(len(mine), bool)
        known = alive & copied[at] & (second[at] == self.context2) if len(marked) else alive
        live = np.flatnonzero(alive[self.entry])
        starts, copy = self.starts[live], known[self.entry][live]
        docs = self.doc[starts]
        a, b = (runs(half, self.window)[starts] for half in self.hashes)
        own = self._in_text(a, docs)
        order = np.argsort(own, kind="stable")
        later = np.zeros(len(own), bool)
        later[order[1:]] = (own[order[1:]] == own[order[:-1]]) & (b[order[1:]] == b[order[:-1]])
        ask, sure = ~later & ~copy, later | copy
        places = starts - self.first[docs]
        return docs[ask], a[ask].view(np.int64), b[ask].view(np.int64), places[ask], docs[sure], places[sure]


def stretches(docs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first and last of every row of consecutive starts."""
    new = np.ones(len(starts), bool)
    new[1:] = (starts[1:] != starts[:-1] + 1) | (docs[1:] != docs[:-1])
    begin = np.flatnonzero(new)
    end = np.concatenate([begin[1:], [len(starts)]]) - 1 if len(starts) else begin
    return docs[begin], starts[begin], starts[end]


def _id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def _first_level(docs: DataFrame, window: int, short: int) -> DataFrame:
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            found = Suffixes(part.column("text").to_pylist(), window, short)
            docs_of, *columns = found.first_level()
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            lists = [list_column(c, found.counts(docs_of), kind) for c, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("k"), *lists],
                ["doc_id", "k", "prefix", "context", "context2", "twice"],
            )

    return docs.select("doc_id", "k", "text").mapInArrow(
        listed,
        f"doc_id {_id_type(docs)}, k long, prefix array<long>, context array<long>, "
        "context2 array<long>, twice array<boolean>",
    )


def _second_level(docs: DataFrame, window: int, short: int) -> DataFrame:
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            marks = part.column("marks")
            fields = marks.flatten()
            doc = np.repeat(np.arange(len(part)), np.diff(marks.offsets.to_numpy()))
            found_at = [fields.field(c).to_numpy() for c in ("prefix", "context", "context2")]
            copied = fields.field("copied").to_numpy(zero_copy_only=False)
            found = Suffixes(part.column("text").to_pylist(), window, short)
            ask, a, b, start, sure, known = found.second_level(doc, *found_at, copied)
            sure, first, last = stretches(sure, known)
            lists = [list_column(c, found.counts(ask), pa.int64()) for c in (a, b, start)]
            lists += [list_column(c, found.counts(sure), pa.int64()) for c in (first, last)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("k"), *lists],
                ["doc_id", "k", "a", "b", "start", "first", "last"],
            )

    return docs.select("doc_id", "k", "text", "marks").mapInArrow(
        listed,
        f"doc_id {_id_type(docs)}, k long, a array<long>, b array<long>, start array<long>, "
        "first array<long>, last array<long>",
    )


def _me() -> Column:
    return F.struct("doc_id", "k")


def _later_copies(rows: DataFrame, node: list[str]) -> DataFrame:
    """Adds ``copied``: whether an earlier document has the same node."""
    first = (
        rows.groupBy(*node)
        .agg(F.min(_me()).alias("_first"), F.max(_me()).alias("_last"))
        .where("_first <> _last")
        .drop("_last")
    )
    return rows.join(first, node, "left").withColumn(
        "copied", F.coalesce(F.col("_first") != _me(), F.lit(False))
    ).drop("_first")


def _beside(docs: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """Joins what was found for a document, by its id and a hash of id and text."""
    named = other.withColumnsRenamed({"doc_id": "_id", "k": "_k"})
    on = (F.col("k") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    return docs.join(named, on, how).drop("_id", "_k")


def repeats(docs: DataFrame, window: int = WINDOW, short: int = SHORT) -> DataFrame:
    """(doc_id, k, spans): for each document that loses words, spans of them as (first, end) word numbers.

    ``docs`` has (doc_id, k, text), where k is a hash of id and text.
    """
    stages = Stages(docs.sparkSession, "substring-dedup")
    entered = stages(_first_level(docs, window, short), "entered")
    suffixes = entered.select(
        "doc_id", "k", F.explode(F.arrays_zip("prefix", "context", "context2", "twice")).alias("s")
    ).select("doc_id", "k", "s.prefix", "s.context", "s.context2", "s.twice")
    inner = (
        suffixes.groupBy("prefix")
        .agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.bool_or("twice").alias("twice"))
        .where("lo <> hi OR twice")
        .select("prefix")
    )
    alive = stages(suffixes.drop("twice").join(inner, "prefix"), "alive")
    stages.drop("entered")
    marks = stages(
        _later_copies(alive, ["prefix", "context", "context2"])
        .groupBy("doc_id", "k")
        .agg(F.collect_set(F.struct("prefix", "context", "context2", "copied")).alias("marks")),
        "marks",
    )
    stages.drop("alive")
    deep = stages(_second_level(_beside(docs, marks, "inner"), window, short), "deep")
    stages.drop("marks")
    asked = deep.select("doc_id", "k", F.explode(F.arrays_zip("a", "b", "start")).alias("s")).select(
        "doc_id", "k", "s.a", "s.b", "s.start"
    )
    found = _later_copies(asked, ["a", "b"]).where("copied").select(
        "doc_id", "k", F.col("start").alias("first"), (F.col("start") + window).alias("end")
    )
    sure = deep.select("doc_id", "k", F.explode(F.arrays_zip("first", "last")).alias("s")).select(
        "doc_id", "k", "s.first", (F.col("s.last") + window).alias("end")
    )
    spans = found.unionByName(sure).groupBy("doc_id", "k").agg(
        F.collect_set(F.struct("first", "end")).alias("spans")
    )
    result = stages(spans, "spans")
    stages.drop("deep")
    return result


def dedup_substrings(docs: DataFrame, window: int = WINDOW, short: int = SHORT) -> DataFrame:
    """Remove every word in a run of ``window`` words whose word sequence also starts earlier.

    Earlier means a smaller doc_id (null first; then by a hash of the text), or the same document and
    an earlier word. Words are compared unchanged; runs are judged on the input, not on what is left.
    Rows that agree in doc_id and text are one document: they get equal results, and
    lose nothing to each other. Null texts and texts of fewer than ``window`` words lose nothing.

    Returns one row per row of ``docs``: doc_id, n_words, n_removed, kept (the words left, joined
    by one space), kept_sha256. An empty table gives an empty one. 128 bits stand for a word and
    for a run.
    """
    docs = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            rows = []
            for text, spans in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                words = (text or "").encode("utf-8", "replace").split()
                kept = words
                if spans:
                    edges = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edges, [s["first"] for s in spans], 1)
                    np.add.at(edges, [s["end"] for s in spans], -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]
                left = b" ".join(kept)
                rows.append((len(words), len(words) - len(kept), left.decode(), hashlib.sha256(left).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id")]
                + [
                    pa.array([r[i] for r in rows], kind)
                    for i, kind in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string()))
                ],
                ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"],
            )

    return _beside(docs, repeats(docs, window, short), "left").select("doc_id", "text", "spans").mapInArrow(
        cut, f"doc_id {_id_type(docs)}, n_words long, n_removed long, kept string, kept_sha256 string"
    )
