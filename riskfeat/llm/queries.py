"""One query per operator, over its whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskfeat.llm import chat, collocations, decontaminate, language_id, lexical_search, line_dedup, lm_scoring, mixing
from riskfeat.llm import ngram_join, quality_classifier, quality_rules, substring_dedup, url_rules
from riskfeat.llm.oracle import ORACLE as ORACLE

#: Host, path and verdict of the rules that the query applies. Fixed values.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
#: The conversation that the query adds. Fixed values.
PROBE_ID, PROBE_TEXT = -7, r"\### Assistant: </turn> ok"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation, read back from the output."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE_TEXT).alias("text"),
    )
    render = chat.MarkedTurns()
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                turns = render.parse(row.formatted)
                loss = "".join(render.unescape(row.formatted[s["start"] : s["end"]]) for s in row.loss)
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                rows.append(
                    (row.conv_id, len(turns), sha(said), len(loss), sha(loss), len(row.formatted), row.rewrites_history)
                )
            yield pd.DataFrame(rows, columns=names)

    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, rewrites_history boolean"
    )
    names = [field.split()[0] for field in schema.split(", ")]
    return chat.format_chats(turns.unionByName(probe), render).mapInPandas(digests, schema)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without repeated runs of three lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs)


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge_urls(pages, url_rules.rule_table(spark, URL_RULES)).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = language_id.held_out(F.col("doc_id"))
    dictionaries = language_id.learn_dictionaries(docs.where(~out).select("text", "lang"))
    return language_id.identify(docs.select("doc_id", "text"), dictionaries).select(
        "doc_id", out.alias("held_out"), "lang_pred", "score", "accepted"
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, in the order of its first training position."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.assign(docs).withColumn("first_position", F.get("passes", F.lit(0))["position"])
    return mixed.repartitionByRange("first_position", "doc_id").sortWithinPartitions("first_position", "doc_id").select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    failed = F.lit(False)
    for rule in quality_rules.BASE_RULES:
        failed = failed | F.expr(rule.fails)
    return quality_rules.filter_quality(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), "kept",
    )


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.similar_groups(docs).select(
        "doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), "component_id"
    )


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every document; source and language stand for host and path.

    Good is quality 1 and not toxic. Labels of held-out documents (as in op4) are not used.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    good = F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).when(F.col("quality").isNotNull(), 0)
    labels = table(spark, sf_dir, "labels").where(~language_id.held_out(F.col("doc_id"))).select(
        "doc_id", good.alias("good")
    )
    return quality_classifier.classify(docs, labels, F.col("source"), F.col("lang")).withColumn(
        "held_out", language_id.held_out(F.col("doc_id"))
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return decontaminate.find_leaks(docs, items).drop("doc_key")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.dedup_substrings(docs).drop("kept")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical_search.search(docs, table(spark, sf_dir, "benchmark"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 leading phrases of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score by a model of nine tenths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = language_id.held_out(F.col("doc_id"), 10)
    return lm_scoring.score_texts(docs, ~out).select(
        "doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat_formatting,
        op2_line_dedup,
        op3_url_filters,
        op4_language_id,
        op5_mixing,
        op6_quality_rules,
        op7_ngram_join,
        op8_quality_classifier,
        op9_decontamination,
        op10_substring_dedup,
        op11_lexical_search,
        op12_collocations,
        op13_lm_scoring,
    )
}
