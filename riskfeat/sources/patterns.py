"""Text files of labelled payment patterns, read as typed edges.

A pattern is a BEGIN line, payment lines and an END line. The files of a folder form
one document in file order. Lines are read as rows, so a pattern may be of
any length; what a file split inherits from the ones before it (the pattern
number and the open pattern) is worked out over one row per split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from riskfeat import schemas as S
from riskfeat.functions import columns as C
from riskfeat.session import shuffles_dropped
from riskfeat.sources.files import held

# Names that end in a running number sort in that order when shorter ones come first.
FILE_ORDER = ["path_length", "path", "start"]


def parse_patterns(spark: SparkSession, path: str) -> DataFrame:
    """One row per payment line with at least the landing fields, in an open pattern."""
    line = F.trim(F.regexp_replace("value", r"^\s+|\s+$", ""))
    named = F.regexp_extract("line", S.PATTERN_TYPE_PATTERN, 1)
    kind = F.when(
        F.col("begins"),
        F.when(F.col("line").rlike(S.PATTERN_TYPE_PATTERN), F.upper(F.trim(named))).otherwise(
            S.PATTERN_TYPE_UNKNOWN
        ),
    ).when(F.col("ends"), "")
    lines = (
        spark.read.text(path)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.length("_metadata.file_path").alias("path_length"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("row"),
            line.alias("line"),
        )
        .withColumn("begins", F.col("line").startswith(S.PATTERN_BEGIN))
        .withColumn("ends", F.col("line").startswith(S.PATTERN_END))
        .withColumn("opened", kind)
    )
    f = F.split("line", ",")
    payment = F.when(
        ~F.col("begins") & ~F.col("ends") & (F.size(f) >= S.PATTERN_MIN_FIELDS),
        F.struct(
            f[0].alias("event_ts"),
            C.account_id(f[1], f[2]).alias("from_account_id"),
            C.account_id(f[3], f[4]).alias("to_account_id"),
            f[7].alias("amount_paid"),
            f[8].alias("payment_currency"),
        ),
    )
    number = F.sum(F.col("begins").cast("long"))
    per_split = lines.groupBy(*FILE_ORDER).agg(
        number.alias("begins"),
        F.max_by("opened", F.when(F.col("opened").isNotNull(), F.col("row"))).alias("opened"),
    )
    earlier = (
        Window.partitionBy().orderBy(*FILE_ORDER).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = per_split.select(
        "path",
        "start",
        F.coalesce(F.sum("begins").over(earlier), F.lit(0)).alias("number_before"),
        F.last("opened", ignorenulls=True).over(earlier).alias("open_before"),
    )
    in_split = Window.partitionBy("path", "start").orderBy("row")
    # Lines are read as payments before they move: only what the result needs is shuffled, and no line that is neither.
    numbered = (
        lines.select("path", "start", "row", "begins", "opened", payment.alias("payment"))
        .where(F.col("opened").isNotNull() | F.col("payment").isNotNull())
        .withColumn("number_here", number.over(in_split))
        .withColumn("open_here", F.last("opened", ignorenulls=True).over(in_split))
        .join(carried, ["path", "start"])
    )
    return (
        numbered.withColumn("pattern_type", F.coalesce("open_here", "open_before"))
        .where(F.col("payment").isNotNull() & (F.col("pattern_type") != ""))
        .select((F.col("number_before") + F.col("number_here")).alias("pattern_id"), "pattern_type", "payment.*")
        .withColumn("amount_paid", F.col("amount_paid").cast("double"))
    )


def write_patterns(payments: DataFrame, path: str, block: str, order: str, kind: str, least: int = 1) -> None:
    """Render landing-shaped payments as pattern text, one pattern per ``block`` value of at least ``least`` payments.

    ``kind`` names the column with the pattern type, ``order`` ranks lines within a block. With ``least`` above 1 payments
    without a block are left out. Payments move as they are and become text where they are written; the files are compressed.
    All lines are written before they are put in order: what moved to find the blocks is gone by then, and is not made again for
    a sample of the order.
    """
    fields = [F.col(c).cast("string") for c in S.TXN_SCHEMA.names]
    heads = payments.groupBy(block).agg(
        F.max(kind).alias("_kind"), F.min(order).alias(order), F.count(F.lit(1)).alias("_rows")
    )
    body = payments.select(*dict.fromkeys((block, order, *S.TXN_SCHEMA.names)))
    if least > 1:
        heads = heads.where((F.col("_rows") >= least) & F.col(block).isNotNull())
        body = body.join(heads.select(block), block, "left_semi")
    heads = heads.drop("_rows")
    marks = heads.withColumn("part", F.explode(F.array(F.lit(0), F.lit(2))))
    keys = [block, "part", order]
    begin = F.format_string(f"{S.PATTERN_BEGIN} - %s:", "_kind")
    end = F.format_string(f"{S.PATTERN_END} - %s", "_kind")
    value = F.when(F.col("part") == 0, begin).when(F.col("part") == 2, end).otherwise(F.concat_ws(",", *fields))
    lines = body.withColumn("part", F.lit(1)).unionByName(marks, allowMissingColumns=True)
    with held(lines, "pattern-lines") as kept, shuffles_dropped(payments.sparkSession):
        text = kept.repartitionByRange(*keys).sortWithinPartitions(*keys).select(value.alias("value"))
        text.write.mode("overwrite").option("compression", "gzip").text(path)
