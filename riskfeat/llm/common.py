"""Words, document keys, staged tables and even splits, shared by the corpus operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from riskfeat.session import SHUFFLE_CLEANUP, scratch_dir, setting

#: White space that separates words: space and the control characters tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

NOT_LETTERS = re.compile(r"[\W\d_]+")


def words(text: Column) -> Column:
    """The words of a text in order; no text has none."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(
        F.coalesce(trimmed, F.lit("")) == "", F.array().cast("array<string>")
    ).otherwise(F.split(trimmed, BLANK_RUN))


def plain(text: str) -> str:
    """Small letters, and one space for everything between letters; for use inside tasks."""
    return NOT_LETTERS.sub(" ", text).lower()


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_key(text: Column) -> Column:
    """128 bits that stand for a text; null stands apart from the empty text."""
    return F.struct(
        text.isNull().alias("n"), F.xxhash64(text).alias("a"), F.xxhash64(F.lit(7), text).alias("b")
    )


def row_name(columns: list[str]) -> str:
    """A name that none of the columns has."""
    name = "row"
    while name in columns:
        name += "_"
    return name


def nested(docs: DataFrame, *more: Column) -> DataFrame:
    """Rows as one struct, so that no column of theirs meets a helper's name, and ``more`` beside it."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row_name(docs.columns)), *more)


def of_row(columns: list[str], every: list[str]) -> list[Column]:
    """Some columns of a nested row that has ``every`` column."""
    return [F.col(row_name(every)).getField(c).alias(c) for c in columns]


class Stages:
    """Tables written between the steps of one operator, in the shared scratch folder.

    Each cuts the lineage: a lost executor costs a reread, never a step already done. Shuffle
    files of a step go when its table is written. ``drop`` removes tables that no later step reads;
    what the operator's result still reads stays.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.root = scratch_dir(spark, purpose)

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        with setting(self.spark, SHUFFLE_CLEANUP, "true"):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of a few numbers each, some tens of MB, that may go to every executor.
SMALL_ROWS = 500_000


def small(keys: DataFrame, most: int = SMALL_ROWS) -> DataFrame:
    """Marks a staged table of keys for broadcast if it has few rows; beyond that it is shuffled."""
    return F.broadcast(keys) if keys.count() <= most else keys


def _counts(rows: DataFrame, group: str, most_groups: int, *more: Column) -> list:
    """A row with group, ``n`` and ``more`` per group, on the driver; more than ``most_groups`` are an error."""
    counts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"), *more).limit(most_groups + 1).collect()
    if len(counts) > most_groups:
        raise ValueError(f"more than {most_groups} values of {group}")
    return counts


def distinct_counts(rows: DataFrame, group: str, h: Column, size: Column, most_groups: int) -> list:
    """Group, ``n`` different hashes and the ``total`` of their sizes, per group.

    Copies count once, and are merged before they are shuffled.
    """
    merged = rows.groupBy(group, h.alias("_h")).agg(F.min(size.cast("long")).alias("_size"))
    return _counts(merged, group, most_groups, F.sum("_size").alias("total"))


def few_by_hash(rows: DataFrame, group: str, h: Column, wanted: int, most_groups: int) -> DataFrame:
    """Rows whose 64-bit hash is among the smallest of their group: some three times ``wanted``, or all there are.

    How much of the hash range that takes follows from the group's number of rows, so what is left is
    as little for any input. No two rows may have equal hashes: with copies, use ``distinct_counts`` and
    ``hash_share``. Groups are counted on the driver; more than ``most_groups`` are an error.
    """
    counts = _counts(rows, group, most_groups)
    return hash_share(rows, group, h, {row[group]: 3 * wanted / row["n"] for row in counts}) if counts else rows


def hash_share(rows: DataFrame, group: str, h: Column, shares: dict) -> DataFrame:
    """Rows in the lowest share of the hash range, by group; groups without a share have none."""
    parts = F.create_map(*[F.lit(x) for g, share in shares.items() for x in (g, min(1.0, share))])
    return rows.where(h / F.lit(2.0**64) + 0.5 <= F.try_element_at(parts, F.col(group)))


def slices(spark: SparkSession) -> int:
    """Into how many parts the rows of one step are cut: a few for each shuffle partition."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def shares(rows: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """One row per key with ``n`` rows and ``salts``: its part of ``parts``, at least one.

    With that many salts no key puts more than one part of all rows into a task.
    """
    part = max(1.0, rows.count() / parts)
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("salts", F.ceil(F.col("n") / part).cast("int"))


def ordinals(stages: Stages, df: DataFrame, name: str, order: list[Column], result: str) -> DataFrame:
    """Number the rows 0, 1, ... in an order, without one task that sees them all.

    Range partitions are written with their number; a table with one row per partition gives
    each its offset.
    """
    ranged = stages(
        df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), name
    )
    upto = Window.partitionBy().orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    )
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    # One row per shuffle partition, so the broadcast is bounded.
    return (
        ranged.join(F.broadcast(offsets), "_part")
        .withColumn(result, F.col("_before") + place - 1)
        .drop("_part", "_before")
    )
