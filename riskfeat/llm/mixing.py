"""Mixing sources to target weights along a curriculum.

Every source has a weight, which sets how many words it gives, and a schedule, which sets when. The
schedule's integral up to time t is the share of the source's words due by then; inverted at
a document's place in its source, it gives the document's training position. Positions run
from 0 to 1, and range-sorting by them makes the mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskfeat.llm.common import BLANKS, BLANK_RUN, n_words, nested, of_row, ordinals, row_name, slices, Stages

#: Weights and schedules of the sources in order, repeating. A schedule lists (time, weight) knots.
WEIGHTS = (1, 2, 3)
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (1.0, 1.5)),
)
MOST_REPEATS = 3
#: Copies of a row that are made at a time.
COPIES = 10_000

Schedule = Sequence[tuple[float, float]]


def segments(schedule: Schedule) -> list[tuple[float, float, float, float, float]]:
    """(from, length, weight at its start, weight at its end, integral before), of integral 1."""
    if len(schedule) < 2 or any(w < 0 for _, w in schedule):
        raise ValueError("a schedule needs two knots or more, of weight 0 or more")
    pairs = list(zip(schedule, schedule[1:]))
    total = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in pairs)
    if total <= 0 or any(b[0] <= a[0] for a, b in pairs):
        raise ValueError("knots must rise in time and weigh something")
    out, before = [], 0.0
    for (t0, w0), (t1, w1) in pairs:
        out.append((t0, t1 - t0, w0 / total, w1 / total, before))
        before += (t1 - t0) * (w0 + w1) / 2 / total
    return out


def invert(schedule: Schedule, share: Column) -> Column:
    """The time by which the share of a source's words is due."""
    result = F.lit(None).cast("double")
    for start, length, w0, w1, before in segments(schedule):
        y = share - F.lit(before)
        slope = (w1 - w0) / length
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + F.lit(2 * slope) * y))
        at = F.lit(start) + F.when(y <= 0, F.lit(0.0)).otherwise(F.lit(2.0) * y / (F.lit(w0) + root))
        result = F.when(share >= F.lit(before), F.least(at, F.lit(start + length))).otherwise(result)
    return result


def source_targets(stages: Stages, sizes: DataFrame, weights: Sequence[float], most: int) -> DataFrame:
    """One row per source: ``source_size``, ``place`` in code point order, ``weight``, ``target``.

    Targets share all words by weight; none is above ``most`` times its source's size, and
    what is over goes to the others by weight until none is above. Each round is one
    aggregate over the sources.
    """
    sources = sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    order = [F.col("source").isNull(), F.col("source")]
    numbered = ordinals(stages, sources, "source-parts", order, "place")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sources = stages(
        numbered.withColumn("weight", F.get(cycle, (F.col("place") % len(weights)).cast("int"))), "sources"
    )
    stages.drop("source-parts")
    cap = (F.lit(most) * F.col("source_size")).cast("double")
    above = F.lit(False)
    n_above = -1
    while True:
        now = sources.agg(
            F.count_if(above).alias("n"),
            F.sum("source_size").cast("double").alias("total"),
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)).alias("capped"),
            F.sum(F.when(~above, F.col("weight"))).alias("open"),
        ).first()
        fair = F.lit((now["total"] or 0.0) - now["capped"]) * F.col("weight") / F.lit(now["open"])
        if now["n"] == n_above or not now["open"]:
            break
        n_above, above = now["n"], fair > cap
    return sources.withColumn("target", F.when(above, cap).otherwise(fair))


def _key(docs: DataFrame) -> DataFrame:
    """doc_id, source and text with the whole ``row``, ``_h``, which orders documents, and ``_k``, which rows share if they
    agree in all columns."""
    every = [F.col(f"`{c}`") for c in docs.columns]
    order = F.md5(F.concat_ws("\n", F.col("doc_id").cast("string"), "text"))
    same = F.struct(order.alias("_h"), F.xxhash64(*every).alias("a"), F.xxhash64(F.lit(7), *every).alias("b"))
    return nested(docs, "doc_id", "source", "text", order.alias("_h"), same.alias("_k"))


def _places(
    stages: Stages, docs: DataFrame, weights: Sequence[float], most: int
) -> DataFrame:
    """One row per distinct row of ``docs``, with its ``copies`` and where its words start."""
    sizes = stages(
        _key(docs)
        .select("doc_id", "source", n_words(F.col("text")).alias("size"), "_h", "_k")
        .groupBy("doc_id", "source", "size", "_h", "_k")
        .agg(F.count(F.lit(1)).alias("copies")),
        "sizes",
    )
    part = max(1.0, sizes.count() / slices(docs.sparkSession))
    sources = stages(
        source_targets(stages, sizes, weights, most)
        .withColumn("cuts", F.ceil(F.col("n_docs") / part))
        .withColumnRenamed("source", "of"),
        "targets",
    )
    stages.drop("sources")
    # The hash is even, so equal ranges of it hold about equal parts of a source.
    cut = F.floor(F.conv(F.substring("_h", 1, 8), 16, 10).cast("long") * F.col("cuts") / 4294967296)
    placed = stages(
        sizes.join(sources, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("cut", cut),
        "placed",
    )
    stages.drop("sizes", "targets")
    by_source = Window.partitionBy("source").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    held = F.col("size") * F.col("copies")
    before = (
        placed.groupBy("source", "cut")
        .agg(F.sum(held).alias("s"))
        .select(
            F.col("source").alias("s_source"),
            F.col("cut").alias("s_cut"),
            F.coalesce(F.sum("s").over(by_source), F.lit(0)).alias("before"),
        )
    )
    inside = Window.partitionBy("source", "cut").orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumn("upto", F.sum(held).over(inside))
        .join(before, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("cut") == F.col("s_cut")))
        .withColumn("start", F.col("before") + F.col("upto") - held)
        .withColumn("wanted", F.floor("target").cast("long"))
        # Copies in two steps, so that no list is longer than COPIES, however often a row is repeated.
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {COPIES}"))))
        .withColumn("_first", F.col("_block") * COPIES)
        .withColumn("copy", F.explode(F.sequence("_first", F.least(F.col("_first") + COPIES, F.col("copies")) - 1)))
        .drop("_block", "_first")
        .withColumn("start", F.col("start") + F.col("copy") * F.col("size"))
    )


def _passes(schedules: Sequence[Schedule], most: int) -> Column:
    laps = F.transform(
        F.sequence(F.lit(0), F.lit(most - 1)), lambda k: F.col("start") + k * F.col("source_size")
    )

    def position(at: Column) -> Column:
        share = F.least(F.lit(1.0), at / F.col("target"))
        out = F.lit(None).cast("double")
        for k, schedule in enumerate(schedules):
            mine = F.col("place") % len(schedules) == k
            out = F.when(mine, invert(schedule, share)).otherwise(out)
        return out

    return F.transform(
        F.filter(laps, lambda at: (at < F.col("wanted")) & (F.col("size") > 0)),
        lambda at: F.struct(
            position(at).alias("position"), F.least(F.col("size"), F.col("wanted") - at).alias("words")
        ),
    )


def assign(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    schedules: Sequence[Schedule] = SCHEDULES,
    most: int = MOST_REPEATS,
) -> DataFrame:
    """What the mix takes of each document: one row per row of ``docs``, without its other columns.

    doc_id, source, size, source_size, target, taken (words, repeats counted), and ``passes``: for
    each time the document is taken its ``position`` in training (0 to 1) and its ``words``. A
    source's documents lie end to end in a pseudo-random order by the MD5 of doc_id and
    text, again and again up to its target; only the document at the end is cut, after the words that
    still fit, so a source's taken words are its target without the fraction.

    A null text has size 0 and is never taken; a null source is a source, last in order. Rows that
    agree in all columns lie side by side. An empty table gives an empty one.
    """
    stages = Stages(docs.sparkSession, "mixing")
    return _places(stages, docs, weights, most).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.aggregate(
            _passes(schedules, most), F.lit(0).cast("long"), lambda n, p: n + p["words"]
        ).alias("taken"),
        _passes(schedules, most).alias("passes"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    schedules: Sequence[Schedule] = SCHEDULES,
    most: int = MOST_REPEATS,
) -> DataFrame:
    """The documents in training order: one row per pass, range-sorted by ``position``.

    All columns, and ``position`` and ``pass_words`` (replaced if present). A document cut at the
    end of its source's target keeps its first ``pass_words`` words and what stands between them.
    Nulls, ties, repeated rows and empty tables are as for ``assign``.
    """
    docs = docs.select([c for c in docs.columns if c not in ("position", "pass_words")])
    stages = Stages(docs.sparkSession, "mix")
    taken = stages(
        _places(stages, docs, weights, most)
        .select(F.col("_k").alias("_of"), "size", F.explode(_passes(schedules, most)).alias("_pass"))
        .select("_of", "_pass", (F.col("_pass.words") < F.col("size")).alias("_cut")),
        "taken",
    )
    stages.drop("placed")
    row = row_name(docs.columns)
    text, doc_id = F.col(row).getField("text"), F.col(row).getField("doc_id")
    trimmed = F.btrim(text, F.lit(BLANKS))
    # The piece after the last word that still fits; what stands before it stays.
    rest = F.element_at(F.split(trimmed, BLANK_RUN, F.col("pass_words").cast("int") + 1), -1)
    head = F.rtrim(F.substring(trimmed, F.lit(1), F.length(trimmed) - F.length(rest)), F.lit(BLANKS))
    return (
        _key(docs)
        .select(row, "_k")
        .dropDuplicates(["_k"])
        .join(taken, F.col("_k") == F.col("_of"))
        .withColumn("position", F.col("_pass.position"))
        .withColumn("pass_words", F.col("_pass.words"))
        .withColumn("_text", F.when(F.col("_cut"), head).otherwise(text))
        .repartitionByRange(F.col("position"), doc_id)
        .sortWithinPartitions(F.col("position"), doc_id)
        .select(*[F.col("_text").alias(c.name) if c.name == "text" else of_row([c.name], docs.columns)[0] for c in docs.schema], "position", "pass_words")
    )
