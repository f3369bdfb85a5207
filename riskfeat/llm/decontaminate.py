"""Benchmark decontamination: MinHash containment search by size partitions, then an exact check.

A document that holds at least t of an item's n shingles holds one of any n - ceil(t n) + 1
of them. So the item's sketch, its shingles of smallest hash, can be that short and no leak
is lost. Items are partitioned by size; one partition's items have sketches of one length,
made for the largest size in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskfeat.llm.common import Stages, nested, of_row, small, text_key, words

WIDTH = 5
#: Least share of an item's shingles, in percent, that makes a leak.
CONTAINED = 80


def _runs(w: Column, width: int, run) -> Column:
    """``run`` of every ``width`` consecutive words; shorter texts have none."""
    places = F.sequence(F.lit(0), F.size(w) - width)
    return F.when(
        F.size(w) >= width, F.transform(places, lambda i: run(*[F.get(w, i + k) for k in range(width)]))
    )


def _shingle_text(*ws: Column) -> Column:
    return F.concat_ws(" ", *ws)


def _worded(df: DataFrame, key: Column) -> DataFrame:
    return df.select(key.alias("key"), words(F.lower("text")).alias("w"))


def sketches(items: DataFrame, width: int, contained: int) -> DataFrame:
    """(key, h) of every item's sketch. ``items`` has (key, w)."""
    hashes = items.select("key", F.explode(F.array_distinct(_runs(F.col("w"), width, F.xxhash64))).alias("h"))
    of_item = Window.partitionBy("key")
    sized = hashes.withColumn("n", F.count(F.lit(1)).over(of_item)).withColumn(
        "place", F.row_number().over(of_item.orderBy("h"))
    )
    # Sizes 1, 2-3, 4-7, 8-15, ... are a partition each.
    largest = F.pow(F.lit(2), F.length(F.bin("n"))).cast("long") - 1
    return sized.where(F.col("place") <= largest - F.ceil(contained * largest / 100) + 1).select("key", "h")


def find_leaks(
    docs: DataFrame, items: DataFrame, width: int = WIDTH, contained: int = CONTAINED, stages: Stages | None = None
) -> DataFrame:
    """The items that documents hold: doc_key, doc_id, item_id, n_item, n_shared, containment.

    Words are lowered and split at white space; an item's shingles are its distinct runs of ``width``
    words, and an item of fewer words is one shingle. A document holds an item if it has ``contained`` percent of its
    shingles or more, anywhere and in any order; a short item if its words stand there in a row. Items and
    documents without words, and null texts, hold nothing and are found nowhere. Rows that agree in id and text are one document
    or one item; ids may be null or repeat with other texts. Empty tables give an empty result.
    """
    stages = stages or Stages(docs.sparkSession, "decontaminate")
    doc_key = F.struct("doc_id", text_key(F.col("text")).alias("t"))
    item_key = F.struct("item_id", text_key(F.col("text")).alias("t"))
    worded = stages(_worded(items, item_key).where(F.size("w") > 0).dropDuplicates(["key"]), "items")
    items, short = worded.where(F.size("w") >= width), worded.where(F.size("w") < width)
    sketch = stages(sketches(items, width, contained), "sketches").select(F.col("key").alias("item"), "h")
    seen = (
        _worded(docs, doc_key)
        .select("key", F.explode(_runs(F.col("w"), width, F.xxhash64)).alias("h"))
        .join(small(sketch), "h")
    )
    candidates = stages(seen.select("key", "item").distinct(), "candidates")

    suspects = stages(candidates.select(F.col("key").alias("suspect")).distinct(), "suspects")
    texts = docs.select("doc_id", "text").join(small(suspects), doc_key == F.col("suspect"), "left_semi")
    held = (
        _worded(texts, doc_key)
        .dropDuplicates(["key"])
        .select("key", F.explode(F.array_distinct(_runs(F.col("w"), width, _shingle_text))).alias("s"))
    )
    wanted = items.select(
        F.col("key").alias("item"), F.array_distinct(_runs(F.col("w"), width, _shingle_text)).alias("all")
    ).select("item", F.size("all").alias("n_item"), F.explode("all").alias("s"))
    # Only the shingles of a document's own candidates meet it.
    found = (
        candidates.join(wanted, "item")
        .join(held, ["key", "s"])
        .groupBy("key", "item", "n_item")
        .agg(F.count(F.lit(1)).alias("n_shared"))
        .where(100 * F.col("n_shared") >= contained * F.col("n_item"))
    )
    for k in sorted(row["k"] for row in short.select(F.size("w").alias("k")).distinct().collect()):  # fewer than ``width``
        found = found.unionByName(_held_whole(stages, docs, short, doc_key, k))
    return found.select(
        F.col("key").alias("doc_key"),
        F.col("key.doc_id").alias("doc_id"),
        F.col("item.item_id").alias("item_id"),
        F.col("n_item").cast("long").alias("n_item"),
        "n_shared",
        (F.col("n_shared") / F.col("n_item")).alias("containment"),
    )


def _held_whole(stages: Stages, docs: DataFrame, short: DataFrame, doc_key: Column, width: int) -> DataFrame:
    """The documents that hold items of ``width`` words, each item as one shingle."""
    wanted = stages(
        short.where(F.size("w") == width).select(F.col("key").alias("item"), F.concat_ws(" ", "w").alias("s")), f"short-{width}"
    )
    # Runs are compared as text; each document's wanted ones leave it once.
    texts = stages(wanted.select("s").distinct(), f"short-texts-{width}")
    runs = _worded(docs, doc_key).select("key", F.explode(_runs(F.col("w"), width, _shingle_text)).alias("s"))
    held = runs.join(small(texts), "s", "left_semi").distinct()
    return held.join(wanted, "s").select("key", "item", F.lit(1).alias("n_item"), F.lit(1).cast("long").alias("n_shared"))


def decontaminate(docs: DataFrame, items: DataFrame, width: int = WIDTH, contained: int = CONTAINED) -> DataFrame:
    """The documents that hold no item, with all rows and columns of theirs."""
    stages = Stages(docs.sparkSession, "decontaminate")
    leaks = find_leaks(docs, items, width, contained, stages)
    dirty = stages(leaks.select(F.col("doc_key").alias("dirty")).distinct(), "dirty")
    doc_key = F.struct("doc_id", text_key(F.col("text")).alias("t"))
    left = nested(docs, doc_key.alias("key")).join(small(dirty), F.col("key") == F.col("dirty"), "left_anti")
    return left.select(of_row(docs.columns, docs.columns))
