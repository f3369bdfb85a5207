"""Every corpus query with SQL against DuckDB, at the scale the driver compares, and the pipeline."""

from collections import Counter

import corpus_pipeline
import brute
import pytest
from compare import connect, differences
from pyspark.sql import functions as F
from riskfeat.llm import language_id, mixing
from riskfeat.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(name, spark):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) == []


def test_queries_without_sql_are_known():
    assert set(QUERIES) - set(ORACLE) == {"op4_language_id", "op8_quality_classifier", "op13_lm_scoring"}


def test_pipeline_against_brute_force(spark):
    """Each stage on the rows that the one before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    rows = [r.asDict() for r in docs.collect()]
    learned = language_id.learn_dictionaries(docs.where(~language_id.held_out(F.col("doc_id"))))
    judges = language_id.Compressors(learned)
    judged = [(r, judges.judge(r["text"], language_id.MARGIN)) for r in rows]
    rows = [{**r, "lang": lang} for r, (lang, _, accepted) in judged if accepted]
    lines = {d: (text, gone) for d, text, _, gone in brute.line_dedup(rows)}
    rows = [{**r, "text": lines[r["doc_id"]][0]} for r in rows if not lines[r["doc_id"]][1] or lines[r["doc_id"]][0]]
    groups = {d: c for d, _, c in brute.similar_groups(rows)}
    rows = [r for r in rows if groups[r["doc_id"]] == r["doc_id"]]
    leaky = {d for d, *_ in brute.leaks(rows, [i.asDict() for i in items])}
    assert leaky
    rows = [r for r in rows if r["doc_id"] not in leaky]
    left = spark.createDataFrame([(r["doc_id"], r["text"], r["source"]) for r in rows], "doc_id long, text string, source string")
    want = Counter(
        (r["doc_id"], round(p["position"], 9), p["words"]) for r in mixing.assign(left).collect() for p in r["passes"]
    )
    got = corpus_pipeline.run(spark, SF)
    assert set(docs.columns) <= set(got.columns)
    assert Counter((r["doc_id"], round(r["position"], 9), r["pass_words"]) for r in got.collect()) == want


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages_take_odd_rows_and_empty_tables(stage, spark, make_docs, odd_rows):
    docs = make_docs([{"doc_id": d, "text": t, "source": "s", "lang": "en"} for d, t in odd_rows]).withColumn(
        "n_chars", F.length("text").cast("long")
    )
    got = stage[1](spark, docs, "/root/testdata/sf0.001")
    assert set(docs.columns) <= set(got.columns) and got.count() > 0
    empty = spark.createDataFrame([], docs.schema)
    assert stage[1](spark, empty, "/root/testdata/sf0.001").count() == 0


def test_one_of_similar_where_ids_repeat_or_lack(spark, make_docs):
    text = lambda name, change=None: " ".join(f"{name}{i}" if i != change else "changed" for i in range(60))
    rows = [
        (1, text("a")), (None, text("a")), (None, text("a", 30)), (4, text("a", 0)),
        (2, text("b")), (2, text("b", 30)), (2, text("b")),
        (3, text("c")), (3, text("a", 59)),
        (None, text("d")), (None, text("d", 30)), (None, text("e")),
        (None, None), (5, ""), (5, None), (6, ""),
    ]
    got = corpus_pipeline.one_of_similar(spark, make_docs(rows), SF)
    left = Counter((r["doc_id"], r["text"]) for r in got.collect())
    b = {t: left.pop((2, t), 0) for t in (text("b"), text("b", 30))}
    d = [left.pop((None, t), 0) for t in (text("d"), text("d", 30))]
    assert sorted(d) == [0, 1] and b in ({text("b"): 2, text("b", 30): 0}, {text("b"): 0, text("b", 30): 1})
    assert left == Counter([(1, text("a")), (3, text("c")), (None, text("e")), (None, None), (5, ""), (5, None), (6, "")])
