"""Phrase mining against a plain version of its contract."""

import re
from collections import Counter, defaultdict

import pytest
from riskfeat.llm import collocations


def plain(rows, longest=4, least=30, covered=80, best=2000):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", text):
            w = re.findall(r"[^ \t]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    candidates = {p: a for p, a in f.items() if a >= least and len(p[1]) > 1}
    most = defaultdict(int)
    for (lang, p), a in candidates.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                most[lang, p[i : i + k]] = max(most[lang, p[i : i + k]], a)
    by_lang = defaultdict(list)
    for (lang, p), a in candidates.items():
        if 100 * most[lang, p] < covered * a:
            cuts = [(f[lang, p[:j]], f[lang, p[j:]]) for j in range(1, len(p))]
            score, _, l, r = min((2_000_000 * a // (l + r), j, l, r) for j, (l, r) in enumerate(cuts, 1))
            by_lang[lang].append((-score, -a, " ".join(p).encode(), l, r))
    out = []
    for lang, found in by_lang.items():
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:best], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def rows_of(spark, rows, **more):
    docs = spark.createDataFrame(
        [(lang, text, 1, "x", 2, 3) for lang, text in rows], "lang string, text string, n long, word string, chunk long, id long"
    )
    got = collocations.collocations(docs, **more)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, got.collect()))


ODD = (
    [("en", "In spite of. In SPITE of the rain, in spite\tof it all; a b a b a b a b"), (None, "und a b.c d"), ("und", "a b c d")] * 3
    + [("en", None), ("en", ""), (None, None), ("fr", " .;\n\t "), ("fr", "été à é à é à é"), ("en", "x " * 40), ("en", "a b a\x0bb\x00c d")]
    + [("de", "one two three four five"), ("de", "one two three four"), ("de", "two three"), ("de", "Three Four")] * 2
)


@pytest.mark.parametrize("chunk, few", [(1, 500_000), (7, 0), (1 << 21, 0)])
def test_odd_rows(spark, chunk, few, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE", 8)
    for least, best in ((2, 2000), (3, 2)):
        got = rows_of(spark, ODD, least=least, best=best, chunk=chunk, few=few)
        assert got == plain(ODD, least=least, best=best) and got


def test_documents(spark, documents):
    rows = [(r["lang"], r["text"]) for r in documents.collect()]
    want = plain(rows, least=8)
    for few in (0, 500_000):
        assert rows_of(spark, rows, least=8, few=few) == want


def test_empty_and_infrequent(spark):
    assert rows_of(spark, []) == []
    assert rows_of(spark, [("en", "nothing here is frequent")]) == []
    assert rows_of(spark, [("en", "only. words. alone.")] * 40) == []
