"""Ranked search against a plain version of its contract."""

import math
import re
from collections import Counter

import pytest
from riskfeat.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def ranked(docs, items, best):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for (doc, c), size in zip(counts, sizes):
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                * (10**9 * c[t] // (1000 * c[t] + 8 * (25 + 75 * size * n // total)))
                for t in terms(text)
                if c[t]
            )
            if score > 0:
                scored.append((-score, doc is None, doc))
        scored.sort(key=lambda s: (s[0], s[1], s[2] if s[2] is not None else 0))
        out += [(item, r, doc, -score) for r, (score, _, doc) in enumerate(scored[:best], 1)]
    return Counter(out)


ITEMS = [
    (1, "w1 W2 w2 w3 changed"), (2, None), (2, ""), (3, "... !"), (4, "é x a5b5, a6B6"), (4, "three two"), (4, "three two"),
    (None, "line of it"), (5, "nothing-shares thisterm"), (6, "x"), (7, "  é  "), (8, "w" * 300 + " w0 " * 500),
]


@pytest.mark.parametrize("entries, cells", [(500_000, 1 << 20), (6, 50)])
def test_search_of_odd_rows(spark, make_docs, odd_rows, entries, cells, monkeypatch):
    monkeypatch.setattr(lexical_search, "CELLS", cells)
    items = spark.createDataFrame([(*i, 1, "x") for i in ITEMS], "item_id long, text string, doc_id long, score string")
    got = lexical_search.search(make_docs(odd_rows), items, best=3, entries=entries)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == ranked(odd_rows, ITEMS, 3)


def test_ties_go_by_id_over_many_tasks(spark):
    docs = [(i * 7919 % 500, "same words here") for i in range(400)] + [(None, "same words here"), (3, "other")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    items = spark.createDataFrame([("q", "words other"), ("r", "same same")], "item_id string, text string")
    got = lexical_search.search(frame, items)
    assert Counter(map(tuple, got.collect())) == ranked(docs, [("q", "words other"), ("r", "same same")], 10)


def test_string_ids_and_empty_tables(spark, make_docs):
    docs = spark.createDataFrame([("b", "one two"), ("a", "one two"), ("é", "one")], "doc_id string, text string")
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    got = lexical_search.search(docs, items).collect()
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["rank"])] == ["é", "a", "b"]
    assert lexical_search.search(docs.limit(0), items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0
