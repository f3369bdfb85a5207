"""Line, substring and near-duplicate operators against brute force."""

import random
from collections import Counter

import brute
import pytest
from riskfeat.llm import line_dedup, ngram_join, substring_dedup
from riskfeat.llm.common import Stages
from riskfeat.llm.components import components

COLUMNS = {
    "lines": ["doc_id", "text", "n_lines", "n_removed"],
    "substrings": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "groups": ["doc_id", "n_shingles", "component_id"],
}
OPERATORS = {
    "lines": (line_dedup.dedup_lines, brute.line_dedup),
    "substrings": (substring_dedup.dedup_substrings, brute.substring_dedup),
    "groups": (ngram_join.similar_groups, brute.similar_groups),
}


def agree(name, docs):
    operator, plain = OPERATORS[name]
    rows = [{"doc_id": r["doc_id"], "text": r["text"]} for r in docs.select("doc_id", "text").collect()]
    got = Counter(tuple(r) for r in operator(docs).select(COLUMNS[name]).collect())
    want = Counter(plain(rows))
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])


@pytest.mark.parametrize("name", OPERATORS)
def test_whole_table(name, documents):
    agree(name, documents)


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(name, make_docs, odd_rows):
    # Different texts of one id have an order of their own, which brute force does not know.
    rows = [r for r in odd_rows if r[1] != "another text of the same id" and r[0] is not None]
    agree(name, make_docs(rows))


@pytest.mark.parametrize("name", OPERATORS)
def test_nulls_and_repeated_ids_run(name, make_docs, odd_rows):
    operator, _ = OPERATORS[name]
    got = operator(make_docs(odd_rows)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in odd_rows)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(name, make_docs):
    operator, _ = OPERATORS[name]
    assert operator(make_docs([])).select(COLUMNS[name]).collect() == []


def thue_morse(n):
    """Two words of 2^n letters whose polynomials modulo 2^64 agree for any odd base if n is 10 or more."""
    word = "a"
    for _ in range(n):
        word += word.translate({97: 98, 98: 97})
    return word, word.translate({97: 98, 98: 97})


@pytest.mark.parametrize("n", [10, 12])
def test_words_that_polynomials_confuse_stay_apart(make_docs, n):
    rest = " ".join(f"w{i}" for i in range(19))
    one, other = thue_morse(n)
    docs = make_docs([(1, f"{one} z"), (2, f"{other} z"), (3, f"{one} {rest}"), (4, f"{other} {rest}"), (5, one), (6, other)])
    groups = {r["doc_id"]: r["component_id"] for r in ngram_join.similar_groups(docs).collect()}
    assert groups == {1: 1, 2: 2, 3: 3, 4: 3, 5: 5, 6: 6}  # 3 and 4 share 15 of 17 runs
    assert {r["n_removed"] for r in substring_dedup.dedup_substrings(docs).collect()} == {0}


def passages(seed, n=120):
    """Texts that share passages of all lengths, some edited, some inside one text."""
    rng = random.Random(seed)
    word = lambda: f"v{rng.randrange(40)}"
    stock = [[word() for _ in range(rng.randrange(15, 60))] for _ in range(8)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(rng.randrange(1, 5)):
            part = list(rng.choice(stock)) if rng.random() < 0.6 else [word() for _ in range(rng.randrange(30))]
            for _ in range(rng.randrange(3)):
                if part:
                    part[rng.randrange(len(part))] = word()
            text += part
        rows.append((i, rng.choice([" ", "  ", "\n"]).join(text)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_substrings_of_shared_passages(seed, make_docs):
    agree("substrings", make_docs(passages(seed)))


def edited_copies(seed):
    """Groups of copies with ever more edits, around the similarity that links."""
    rng = random.Random(seed)
    rows = []
    for g in range(6):
        base = [f"g{g}w{rng.randrange(900)}" for _ in range(rng.randrange(6, 150))]
        for _ in range(25):
            text = list(base)
            for _ in range(rng.randrange(1 + len(base) // 12)):
                text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
            rows.append(" ".join(text[: rng.randrange(len(text) * 3 // 4, len(text)) + 1]))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", range(3))
def test_groups_around_the_limit(seed, make_docs):
    agree("groups", make_docs(edited_copies(seed)))


def test_copies_in_lines_leave_the_first(make_docs):
    text = "a\nb\nc\nd"
    got = line_dedup.dedup_lines(make_docs([(2, text), (1, text), (3, "x\n" + text)])).collect()
    assert {r["doc_id"]: (r["text"], r["n_removed"]) for r in got} == {1: (text, 0), 2: ("", 4), 3: ("x", 4)}
    assert "key" in got[0].asDict()


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, 100 + i) for i in range(1, 300)]
    links = spark.createDataFrame(chain + star + [(500, 500)], "x long, y long")
    got = dict(tuple(r) for r in components(Stages(spark, "t"), links, "c").collect())
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(300)}}
