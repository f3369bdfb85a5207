"""Phrase collocations by set-oriented mining: occurrence relations, extended length by length.

The relation of length k holds where every phrase of k words occurs, sorted by piece and position. It is
extended by a merge join with itself: a phrase of k words at one place and one at the next place of the
same piece make one of k + 1. Phrases are then grouped and counted over all texts, and a semi-join keeps
the occurrences of frequent ones alone before the next length. A part of a frequent phrase is
frequent, so nothing is lost.

A relation is stored in chunks of consecutive pieces, sorted, one row each; so its merge join stays within a row.
What leaves a task is one row per different phrase with its count: grouping and semi-joins shuffle
those, never occurrences. A phrase is known by the numbers of the two phrases that made it, and a word
by its language and letters, so no hash stands for a phrase.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskfeat.llm.chunks import ROWS, chunk_rows, first_number
from riskfeat.llm.common import SMALL_ROWS, Stages, setting, slices
from riskfeat.llm.hashing import parts

UNKNOWN = "und"
LONGEST = 4
LEAST = 30
#: A phrase goes if a longer candidate that holds it has this percentage of its occurrences.
COVERED = 80
BEST = 2000
SCALE = 2_000_000
#: Chunks that a task takes at a time, and words and borders in a chunk of frequent words.
ARROW_ROWS, CHUNKS_AT_ONCE = "spark.sql.execution.arrow.maxRecordsPerBatch", "4"
PLACES = 1 << 16
#: A reader holds this many chunks.
READ_ROWS, CHUNKS_READ = "spark.sql.parquet.columnarReaderBatchSize", "16"
#: Words and borders of pieces in a chunk; one piece may have more.
CHUNK = 1 << 19
#: Bytes of a text that are split at a time.
SLICE = 1 << 20

#: Ends of pieces become full stops, a tab a space, A-Z small letters.
ENDS = b".,;:!?\n\x0b\x0c\r"
FOLD = bytes(46 if b in ENDS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
BORDER = b"."


def folded(text: bytes | None) -> Iterator[list[bytes]]:
    """Words of a text in order, with a full stop between pieces, some at a time; cuts stand between pieces."""
    data = (text or b"").translate(FOLD)
    at = 0
    while at < len(data):
        end = data.find(BORDER, at + SLICE) if at + SLICE < len(data) else -1
        end = len(data) if end < 0 else end + 1
        yield data[at:end].replace(BORDER, b" . ").split()
        at = end


class Chunk:
    """Words as numbers of a vocabulary of this chunk, in order; -1 stands between pieces."""

    def __init__(self):
        self.next = itertools.count()
        self.by_lang: dict[str, dict[bytes, int]] = {}
        self.ids: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, words: list[bytes]) -> None:
        numbers = self.by_lang.get(lang)
        if numbers is None:
            numbers = self.by_lang[lang] = defaultdict(self.next.__next__, {BORDER: -1})
        ids = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
        self.ids += [ids, np.full(1, -1, np.int32)]
        self.size += len(words) + 1

    def rows(self, number: int) -> Iterator[pa.RecordBatch]:
        ids = np.concatenate(self.ids)
        size = next(self.next)
        langs, words = [""] * size, [b""] * size
        for lang, numbers in self.by_lang.items():
            for w, i in numbers.items():
                if i >= 0:
                    langs[i], words[i] = lang, w
        counts = np.bincount(ids[ids >= 0], minlength=size)
        narrow = {"lang": pa.array(langs, pa.string()), "word": pa.array(words, pa.binary()), "n": pa.array(counts, pa.int64())}
        yield from chunk_rows(number, {"ids": pa.array(ids, pa.int32())}, narrow)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("binary").alias("text"))


def _words(docs: DataFrame, most: int) -> DataFrame:
    """The relation of single words: per chunk its occurrences in order, and its vocabulary with counts."""

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, number = Chunk(), first_number(TaskContext.get().partitionId())
        for part in parts(batches):
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                for words in folded(text):
                    chunk.add(lang, words)
                    if chunk.size >= most:
                        yield from chunk.rows(number)
                        chunk, number = Chunk(), number + 1
        if chunk.size:
            yield from chunk.rows(number)

    return _texts(docs).mapInArrow(
        chunked, "chunk long, size int, ids array<int>, local int, lang string, word binary, n long"
    )


def _located_words(docs: DataFrame, frequent: DataFrame, most: int) -> DataFrame:
    """The relation of frequent words, looked up in every task."""
    by_lang: dict[str, dict[bytes, int]] = {}
    for row in frequent.select("lang", "word", "id").toLocalIterator():
        by_lang.setdefault(row["lang"], {})[bytes(row["word"])] = row["id"]
    shared = docs.sparkSession.sparkContext.broadcast(by_lang)

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = shared.value, first_number(TaskContext.get().partitionId())
        waiting: list[np.ndarray] = []
        size = 0
        border = np.full(1, -1, np.int64)

        def done() -> pa.RecordBatch:
            ids = np.concatenate(waiting)
            places = np.flatnonzero(ids >= 0)
            return _chunk(number, places, ids[places])

        for part in parts(batches):
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                find = known.get(lang, {}).get
                for words in folded(text):
                    # Other words have no number, and borders have none.
                    ids = np.fromiter(map(find, words, itertools.repeat(-1)), np.int64, len(words))
                    waiting += [ids, border]
                    size += len(words) + 1
                    if size >= most:
                        yield done()
                        waiting.clear()
                        size, number = 0, number + 1
        if waiting:
            yield done()

    return _texts(docs).mapInArrow(located, RELATION)


def adjacent(places: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge join of a sorted relation with itself at the next place: places, and both phrases there."""
    met = np.flatnonzero(places[1:] == places[:-1] + 1)
    return places[met], ids[met], ids[met + 1]


def distinct_pairs(a: np.ndarray, b: np.ndarray, **more) -> tuple[np.ndarray, ...]:
    """The different pairs, in order, and what numpy's unique gives with ``more``."""
    known, dense = np.unique(np.concatenate([a, b]), return_inverse=True)
    pairs, *rest = np.unique(dense[: len(a)] * len(known) + dense[len(a) :], **more)
    return known[pairs // max(1, len(known))], known[pairs % max(1, len(known))], *rest


def _relation(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for i in range(len(batch)):
        lists = [batch.column(c)[i].values.to_numpy() for c in ("places", "ids")]
        yield batch.column("chunk")[i].as_py(), *lists


def _chunk(chunk: int, places: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    lists = [
        pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, kind))
        for v, kind in ((places, pa.int32()), (ids, pa.int64()))
    ]
    return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), *lists], ["chunk", "places", "ids"])


RELATION = "chunk long, places array<int>, ids array<long>"


def _known_words(rows: DataFrame) -> DataFrame:
    """The relation of frequent words from chunks and, beside them, the words that are frequent."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                marks = batch.column("alive")[i].values
                known = np.full(batch.column("size")[i].as_py() + 1, -1, np.int64)  # the last one answers for borders
                known[marks.field("local").to_numpy()] = marks.field("id").to_numpy()
                ids = known[batch.column("ids")[i].values.to_numpy()]
                places = np.flatnonzero(ids >= 0)
                yield _chunk(batch.column("chunk")[i].as_py(), places, ids[places])

    return rows.mapInArrow(kept, RELATION)


def _counted(relation: DataFrame, most: int) -> DataFrame:
    """(a, b, n): adjacent phrases, counted over some chunks of a task at a time."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def done() -> Iterator[pa.RecordBatch]:
            a, b = (np.concatenate(c) for c in zip(*waiting))
            columns = distinct_pairs(a, b, return_counts=True)
            for at in range(0, len(columns[0]), ROWS):
                some = [pa.array(c[at : at + ROWS], pa.int64()) for c in columns]
                yield pa.RecordBatch.from_arrays(some, ["a", "b", "n"])

        for batch in batches:
            for _, places, ids in _relation(batch):
                waiting.append(adjacent(places, ids)[1:])
                if sum(len(a) for a, _ in waiting) >= most:
                    yield from done()
                    waiting.clear()
        if waiting:
            yield from done()

    return relation.mapInArrow(counted, "a long, b long, n long")


def _extended(stages: Stages, relation: DataFrame, frequent: DataFrame, k: int, few: int) -> DataFrame:
    """Occurrences of frequent phrases one word longer."""
    if frequent.count() <= few:
        rows = frequent.select("a", "b", "id").toArrow().sort_by([("a", "ascending"), ("b", "ascending")])
        shared = frequent.sparkSession.sparkContext.broadcast([rows.column(c).to_numpy() for c in ("a", "b", "id")])

        def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first, second, number = shared.value
            numbers, starts = np.unique(first, return_index=True)
            place_of = np.append(starts, len(first))
            for batch in batches:
                for chunk, places, ids in _relation(batch):
                    places, a, b = adjacent(places, ids)
                    # The second one, within the entries that have this first one.
                    at = np.searchsorted(numbers, a)
                    at[at == len(numbers)] = 0
                    is_first = numbers[at] == a if len(numbers) else np.zeros(len(a), bool)
                    places, a, b, at = places[is_first], a[is_first], b[is_first], at[is_first]
                    low, high = place_of[at], place_of[at + 1]
                    while (open_ := low < high).any():
                        middle = (low + high) // 2
                        less = open_ & (second[np.minimum(middle, len(second) - 1)] < b)
                        low, high = np.where(less, middle + 1, low), np.where(open_ & ~less, middle, high)
                    fits = (low < place_of[at + 1]) & (second[np.minimum(low, max(0, len(second) - 1))] == b)
                    yield _chunk(chunk, places[fits], number[low[fits]])

        longer = stages(relation.mapInArrow(looked_up, RELATION), f"relation-{k}")
        shared.unpersist()
        return longer

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, places, ids in _relation(batch):
                a, b, _ = distinct_pairs(*adjacent(places, ids)[1:], return_counts=True)
                columns = np.full(len(a), chunk), np.arange(len(a)), a, b
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], ["chunk", "local", "a", "b"]
                )

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (chunk, places, ids) in enumerate(_relation(batch)):
                places, a, b = adjacent(places, ids)
                *pair, local = distinct_pairs(a, b, return_inverse=True)
                marks = batch.column("alive")[i].values
                known = np.full(len(pair[0]), -1, np.int64)
                known[marks.field("local").to_numpy()] = marks.field("id").to_numpy()
                found = known[local]
                yield _chunk(chunk, places[found >= 0], found[found >= 0])

    grams = relation.mapInArrow(asked, "chunk long, local long, a long, b long")
    alive = _alive(grams, frequent, ("a", "b"))
    longer = stages(relation.join(alive, "chunk").mapInArrow(kept, RELATION), f"relation-{k}")
    return longer


def _alive(grams: DataFrame, frequent: DataFrame, key: Sequence[str]) -> DataFrame:
    """Semi-join with the frequent phrases: per chunk, their local and global numbers."""
    kept = grams.select("chunk", "local", *key).join(frequent.select("id", *key), list(key))
    return kept.groupBy("chunk").agg(F.collect_list(F.struct("local", "id")).alias("alive"))


def frequent_phrases(
    stages: Stages, docs: DataFrame, longest: int, least: int, chunk: int, few: int
) -> tuple[list[DataFrame], DataFrame]:
    """Per length the phrases with ``least`` occurrences, and (lang, total): all word occurrences.

    Words are (id, lang, word, n); longer phrases (id, a, b, n), with the ids of their first and last k - 1 words.
    """
    spark = docs.sparkSession

    def numbered(counts: DataFrame, k: int) -> DataFrame:
        often = counts.where(F.col("n") >= least)
        return stages(often.withColumn("id", F.monotonically_increasing_id()), f"frequent-{k}")

    words = ["lang", "word"]
    each = _words(docs, chunk).where("local IS NOT NULL")
    counts = stages(each.groupBy(*words).agg(F.sum("n").alias("n")), "words")
    totals = stages(counts.groupBy("lang").agg(F.sum("n").alias("total")), "totals")
    found = [numbered(counts, 1)]
    if found[0].count() <= few:
        relation = stages(_located_words(docs, found[0], min(chunk, PLACES)), "relation-1")
    else:
        chunks = stages(_words(docs, chunk), "chunks")
        alive = _alive(chunks.where("local IS NOT NULL"), found[0], words)
        with setting(spark, ARROW_ROWS, CHUNKS_AT_ONCE), setting(spark, READ_ROWS, CHUNKS_READ):
            rows = chunks.where("size > 0").select("chunk", "size", "ids").join(alive, "chunk")
            relation = stages(_known_words(rows), "relation-1")
        stages.drop("chunks")
    stages.drop("words")
    with setting(spark, ARROW_ROWS, CHUNKS_AT_ONCE), setting(spark, READ_ROWS, CHUNKS_READ):
        for k in range(2, longest + 1):
            counts = _counted(relation, chunk).groupBy("a", "b").agg(F.sum("n").alias("n"))
            found.append(numbered(counts, k))
            if k < longest:
                relation = _extended(stages, relation, found[-1], k, few)
            stages.drop(f"relation-{k - 1}")
    return found, totals


def _described(found: list[DataFrame]) -> list[DataFrame]:
    """Phrases of every length with their words, and the counts of what they begin and end with."""
    words = found[0].select(
        "id", "lang", F.col("word").cast("string").alias("phrase"), "n",
        F.col("word").cast("string").alias("last"),
        *[F.array().cast("array<long>").alias(c) for c in ("firsts", "lasts")],
    )
    out = [words]
    for frequent in found[1:]:
        a = out[-1].select(
            F.col("id").alias("a"), "lang", F.col("phrase").alias("head"),
            F.concat("firsts", F.array("n")).alias("firsts"),
        )
        b = out[-1].select(F.col("id").alias("b"), "last", F.concat("lasts", F.array("n")).alias("lasts"))
        out.append(
            frequent.join(a, "a").join(b, "b").select(
                "id", "lang", F.concat_ws(" ", "head", "last").alias("phrase"), "n", "last", "firsts", "lasts"
            )
        )
    return out


def _weakest_cut(k: int) -> Column:
    """The cut of a phrase of k words with the lowest score, the first of equals."""
    whole = F.col("n").cast("decimal(38,0)") * F.lit(SCALE).cast("decimal(8,0)")

    def cut(j: int) -> Column:
        l, r = F.col("firsts")[j - 1], F.col("lasts")[k - j - 1]
        score = F.call_function("div", whole.cast("decimal(38,0)"), l.cast("decimal(38,0)") + r)
        return F.struct(score.alias("score"), F.lit(j).alias("k"), l.alias("l"), r.alias("r"))

    cuts = [cut(j) for j in range(1, k)]
    return F.least(*cuts) if len(cuts) > 1 else cuts[0]


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    covered: int = COVERED,
    best: int = BEST,
    chunk: int = CHUNK,
    few: int = SMALL_ROWS,
) -> DataFrame:
    """The ``best`` phrases per lang: lang, rank, phrase, a, l, r, n, score.

    Texts lower A-Z, are cut into pieces at ``.,;:!?`` and line ends, and those into words at spaces and tabs. A phrase of
    2 to ``longest`` words with ``least`` occurrences a in pieces of its lang, overlaps included, is a candidate.
    Cut into two parts with l and r occurrences it scores 2,000,000 a div (l + r); the lowest-scoring cut counts, of
    equals the earliest. A candidate goes if a longer one, itself kept or not, holds its words in a row and has
    ``covered`` percent of its occurrences. Ranks go by score and a, both descending, then by
    phrase in byte order; n is the number of words in the lang.

    Up to ``few`` frequent phrases of a length are looked up in every task, more are joined by shuffle; the result is the same.
    Null texts are empty; a null lang is ``und``. Every row counts, repeated ones too. Other columns are ignored; an
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "collocations")
    found, totals = frequent_phrases(stages, docs, longest, least, chunk, few)
    described = _described(found)
    candidates = []
    for k in range(2, longest + 1):
        rows = described[k - 1].withColumn("cut", _weakest_cut(k)).select(
            "id", "lang", "phrase", F.col("n").alias("a"), "cut.l", "cut.r", "cut.score"
        )
        if k < longest:
            # A candidate two words longer is held by one between them, which occurs as often or more.
            longer = found[k].select(F.explode(F.array("a", "b")).alias("id"), "n")
            most = longer.groupBy("id").agg(F.max("n").alias("most"))
            goes = F.coalesce(F.col("most").cast("decimal(38,0)") * 100 >= F.col("a").cast("decimal(38,0)") * covered, F.lit(False))
            rows = rows.join(most, "id", "left").where(~goes).drop("most")
        candidates.append(rows.drop("id"))
    every = candidates[0]
    for more in candidates[1:]:
        every = every.unionByName(more)
    every = stages(every, "candidates")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The first of each slice, then the first of those: no task sees all of a lang.
    slot = F.pmod(F.xxhash64("phrase"), F.lit(slices(spark)))
    place = F.row_number().over(Window.partitionBy("lang", slot).orderBy(*order))
    leading = every.withColumn("place", place).where(F.col("place") <= best)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ranked = leading.withColumn("rank", rank).where(F.col("rank") <= best)
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )
