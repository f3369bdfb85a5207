"""The corpus pipeline: documents in, a training mix in order out.

Each stage reads what its predecessor wrote and returns what it keeps; the last one returns
the mix, one row per pass over a document, in training order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskfeat.llm import decontaminate, language_id, line_dedup, mixing, ngram_join
from riskfeat.llm.common import Stages, nested, of_row, small, text_key


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; ``lang`` becomes what the text shows."""
    learned = docs.where(~language_id.held_out(F.col("doc_id"))).select("text", "lang")
    judged = language_id.identify(docs, language_id.learn_dictionaries(learned))
    return judged.where("accepted").withColumn("lang", F.col("lang_pred")).select(docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated runs of three lines; one with nothing left goes."""
    kept = line_dedup.dedup_lines(docs)
    return (
        kept.where("n_removed = 0 OR length(text) > 0")
        .withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
        .select(docs.columns)
    )


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest doc_id, nulls last.

    Under one doc_id, or without one, the text with the smallest key stays. Another text of a dropped one's
    doc_id stays if its own group has nothing smaller. Rows that agree in doc_id and text are
    one document: they stay or go together. Documents without words stay.
    """
    groups = ngram_join.similar_groups(docs, keyed=True)
    dropped = Stages(spark, "similar")(
        groups.where(~F.col("first")).select(F.col("doc_id").alias("dropped"), F.col("text_key").alias("dropped_text")).distinct(),
        "dropped",
    )
    mine = F.col("id").eqNullSafe(F.col("dropped")) & F.col("key").eqNullSafe(F.col("dropped_text"))
    rows = nested(docs, F.col("doc_id").alias("id"), text_key(F.col("text")).alias("key"))
    return rows.join(small(dropped), mine, "left_anti").select(of_row(docs.columns, docs.columns))


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminate(docs, items)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in training order, repeated or cut as their source's target asks."""
    return mixing.mix(docs)


STAGES = [
    ("language ID", identify_language),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", one_of_similar),
    ("benchmark decontamination", remove_leaks),
    ("mixing sources", mix_sources),
]

#: Compression, connected components and hashes of Spark's own have no SQL twin.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again."""
    stages = Stages(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stages(stage(spark, docs, sf_dir), f"{k}")
        if k:
            stages.drop(f"{k - 1}")
    return docs
