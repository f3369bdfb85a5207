"""Line dedup on overlapping windows of three lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskfeat.llm.common import Stages, nested, of_row, row_name, text_key

WINDOW = 3


def _windows(lines: Column, width: int) -> Column:
    """(a, b, start) for every run of ``width`` lines; 128 bits stand for its text."""
    starts = F.sequence(F.lit(0), F.size(lines) - width)
    return F.when(
        F.size(lines) >= width,
        F.transform(
            starts,
            lambda i: F.struct(
                F.xxhash64(*[lines[i + k] for k in range(width)]).alias("a"),
                F.xxhash64(F.lit(7), *[lines[i + k] for k in range(width)]).alias("b"),
                i.alias("start"),
            ),
        ),
    )


def dedup_lines(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """Drop the lines of every window of ``width`` lines that also starts earlier.

    Earlier means a smaller doc_id (null first), or the same document and an earlier line. Lines
    are split at \\n and compared exactly; windows are judged on the input, not on what is
    left, and a line goes if any repeated window covers it. Documents of fewer lines have no
    window and stay as they are, as do null texts. A text that loses all lines becomes empty.
    Rows that agree in doc_id and text are one document and get the same result, so none of
    them loses lines to the other; different texts of one doc_id go by a hash of the text.

    Returns all rows and columns with the new ``text``, and ``n_lines`` and ``n_removed`` (longs,
    replaced if present). An empty table gives an empty one.
    """
    stages = Stages(docs.sparkSession, "line-dedup")
    me = F.struct("doc_id", text_key(F.col("text")).alias("t"))
    windows = (
        docs.select(me.alias("me"), F.split("text", "\n").alias("lines"))
        .select("me", F.explode(_windows(F.col("lines"), width)).alias("w"))
        .select(F.col("w.a").alias("a"), F.col("w.b").alias("b"), "me", F.col("w.start").alias("start"))
    )
    first = (
        windows.groupBy("a", "b")
        .agg(F.min(F.struct("me", "start")).alias("first"), F.max(F.struct("me", "start")).alias("last"))
        .where("first <> last")
    )
    covered = (
        windows.join(first, ["a", "b"])
        .where(F.struct("me", "start") != F.col("first"))
        .groupBy("me")
        .agg(F.collect_set("start").alias("starts"))
    )
    covered = stages(covered, "covered").select(
        "me",
        F.array_distinct(
            F.flatten(F.transform("starts", lambda s: F.sequence(s, s + width - 1)))
        ).alias("gone"),
    )
    text = F.col(row_name(docs.columns)).getField("text")
    lines = F.split(text, "\n")
    places = F.sequence(F.lit(0), F.size(lines) - 1)
    kept = F.array_join(F.transform(F.array_except(places, "gone"), lambda i: F.get(lines, i)), "\n")
    others = [c for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    return (
        nested(docs, me.alias("me"))
        # Both sides grow with the documents, so neither is ever broadcast.
        .join(covered.hint("merge"), "me", "left")
        .select(
            *of_row(others, docs.columns),
            F.when(F.col("gone").isNull(), text).otherwise(kept).alias("text"),
            F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
            F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        )
    )
