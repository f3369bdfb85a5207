"""Quality rules as a short-circuit cascade, ordered by rejection per cost.

A rule is an SQL expression that is true where a document fails. Its cost and selectivity are
measured on a sample; a cheap rule that rejects much goes first, so that most rejected
documents never reach the expensive ones. The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from riskfeat.llm.common import BLANKS, words

SYMBOLS = "[#*$%&|<>]"
#: Documents on which costs and selectivities are estimated.
SAMPLE_ROWS = 2000


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    cost: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / max(self.cost, 1e-9)


#: Rules on the counts of ``text_counts``; the first two are the base.
BASE_RULES = (
    Rule("too_few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", "5 * n_symbols > n_words"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > size(split(text, '\\n'))"),
    Rule("shouting", "2 * regexp_count(text, '\\\\p{Lu}') > regexp_count(text, '\\\\p{L}')"),
    Rule("marks", "3 * regexp_count(text, '!!') > n_words"),
)


def _repeat_words(w: Column, width: int = 3) -> Column:
    """Words in windows of ``width`` words that the text holds twice or more.

    64 bits stand for a window within its text. Sorted windows show whether any is there twice; only
    then are they sorted once more with their places.
    """
    places = F.sequence(F.lit(0), F.size(w) - width)
    window = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)])
    hashes = F.transform(places, window)
    placed = F.sort_array(F.transform(places, lambda i: F.struct(window(i).alias("h"), i.alias("i"))))

    def again(s: Column) -> Column:
        def is_twin(x: Column, k: Column) -> Column:
            return (F.get(s, k - 1)["h"] == x["h"]) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))

        return F.transform(F.filter(s, lambda x, k: F.coalesce(is_twin(x, k), F.lit(False))), lambda x: x["i"])

    # The sorted array is an element of a one-element array, so it is made once.
    covered = F.transform(
        F.array(placed),
        lambda s: F.size(
            F.array_distinct(F.flatten(F.transform(again(s), lambda i: F.sequence(i, i + width - 1))))
        ),
    )[0]
    some = F.size(w) > width
    return F.when(some & (F.size(F.array_distinct(hashes)) < F.size(hashes)), covered).otherwise(0)


def text_counts(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (longs).

    Null texts have none of anything. The columns replace any of that name.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    others = [c for c in docs.columns if c not in names]
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    dup_lines = F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0]
    w = F.col("_words")
    return (
        docs.select(*others)
        .withColumn("_words", words(F.col("text")))
        .select(
            *others,
            F.size(w).cast("long").alias("n_words"),
            F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            dup_lines.cast("long").alias("n_dup_lines"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
        )
    )


def sampled(docs: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` of the documents."""
    total = docs.count()
    return docs.sample(min(1.0, rows / total), seed=7) if total else docs


def estimate(sample: DataFrame, rules: Sequence[Rule]) -> list[Estimate]:
    """Seconds and rejected share of each rule on a sample, best rejection per cost first.

    The time of a pass without any rule is taken off. Rules of equal worth keep their order.
    """
    sample = sample.cache()
    n = max(1, sample.count())

    def run(condition: str) -> tuple[float, int]:
        start = time.perf_counter()
        rejected = sample.agg(F.count_if(F.expr(condition)).alias("n")).first()["n"]
        return time.perf_counter() - start, rejected

    idle = min(run("false")[0] for _ in range(2))
    found = []
    for rule in rules:
        seconds, rejected = run(rule.fails)
        found.append(Estimate(rule, max(seconds - idle, 1e-4), rejected / n))
    sample.unpersist()
    return sorted(found, key=lambda e: -e.worth)


def cascade(docs: DataFrame, ordered: Sequence[Rule]) -> DataFrame:
    """Adds ``kept`` and ``failed_rule`` (the first that fails), replacing such columns.

    CASE tries a rule only where all before it passed. A rule that is null for a document
    passes it. No rules keep everything; repeated rows get equal results.
    """
    failed = F.lit(None).cast("string")
    for rule in reversed(ordered):
        failed = F.when(F.expr(rule.fails), F.lit(rule.name)).otherwise(failed)
    others = [c for c in docs.columns if c not in ("kept", "failed_rule")]
    return docs.select(*others, failed.alias("failed_rule")).withColumn("kept", F.col("failed_rule").isNull())


def filter_quality(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """All rows with their counts, ``failed_rule`` and ``kept``, by the cascade in its best order.

    ``failed_rule`` depends on the measured order where several rules fail; ``kept`` does not.
    """
    ordered = [e.rule for e in estimate(text_counts(sampled(docs, sample_rows)), rules)]
    return cascade(text_counts(docs), ordered)
