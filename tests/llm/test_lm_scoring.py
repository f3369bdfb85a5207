"""The language model against a plain, sequential version of it."""

import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from riskfeat.llm import lm_scoring
from riskfeat.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def tokens(text):
    return [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())] + [None]


def base_scores(rows):
    counts = Counter(t for text, learn in rows if learn for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    share = lambda t: math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1)))
    return n, [
        (len(tokens(text)), sum(counts[t] > 0 for t in tokens(text)), sum(map(share, tokens(text)))) for text, _ in rows
    ]


def contexts(data):
    """What the predictors see before every symbol, as bytes; the word starts after a control character or space."""
    for i in range(len(data) + 1):
        padded = b"\0" * 4 + data[:i]
        yield padded[-2:], padded[-4:], re.search(rb"[^\x00-\x20]*\Z", data[:i])[0]


def plain_scores(rows, code):
    """log10 probabilities; slots are kept by context and node, so nothing collides."""
    path = lambda s: range(code.start[s], code.start[s] + code.length[s])
    symbols = lambda text: [*(text or "").encode(), lm_scoring.END]
    seen = Counter()
    for text, learn in rows:
        if learn:
            for s, found in zip(symbols(text), contexts((text or "").encode())):
                for step in path(s):
                    for k, c in enumerate(found):
                        seen[k, c, code.node[step], code.way[step]] += 1
    out = []
    for text, _ in rows:
        by_depth = defaultdict(list)
        for place, (s, found) in enumerate(zip(symbols(text), contexts((text or "").encode()))):
            for depth, step in enumerate(path(s)):
                node, way = code.node[step], code.way[step]
                odds = []
                for k, c in enumerate(found):
                    o = math.log((seen[k, c, node, 1] + lm_scoring.PRIOR) / (seen[k, c, node, 0] + lm_scoring.PRIOR))
                    o = max(-127, min(127, round(lm_scoring.ODDS_STEP * o))) / lm_scoring.ODDS_STEP
                    odds.append(o if way else -o)
                by_depth[depth].append((place, odds))
        total = 0.0
        for decisions in by_depth.values():
            weights, begin = list(lm_scoring.START), 0
            while begin <= decisions[-1][0]:
                end = begin + max(lm_scoring.FIRST_BLOCK, begin // lm_scoring.GROWTH)
                block = [odds for place, odds in decisions if begin <= place < end]
                move = [0.0] * len(weights)
                for odds in block:
                    p = 1 / (1 + math.exp(-sum(w * o for w, o in zip(weights, odds))))
                    total += math.log10(p)
                    move = [m + o * (1 - p) for m, o in zip(move, odds)]
                weights = [w + lm_scoring.RATE * m / math.sqrt(len(block) or 1) for w, m in zip(weights, move)]
                begin = end
        out.append(total)
    return out


def code_of(rows):
    counts = np.zeros(lm_scoring.SYMBOLS, np.int64)
    for text, learn in rows:
        if learn:
            counts[lm_scoring.END] += 1
            for b in (text or "").encode():
                counts[b] += 1
    return lm_scoring.Code.of(counts)


ROWS = [
    ("the cat sat on the mat " * 9, True), ("The cat\tsat\non a mat.", False), (None, True), ("", False), (" \n", True),
    ("été à la mer, quelque part " * 20, False), ("é à ü " * 5, True), ("zzzz qqqq", False), ("the the the", True), ("the the the", True), ("\x00\x01  x", False),
]


@pytest.mark.parametrize("chunk", [1, 1 << 21])
def test_scores_of_odd_rows(spark, chunk):
    docs = spark.createDataFrame(
        [(i if i else None, t, learn, "x", 1, 2) for i, (t, learn) in enumerate(ROWS)],
        "doc_id long, text string, use boolean, a string, b long, cost long",
    )
    docs = docs.unionByName(docs.where("doc_id = 7"))
    rows = [*ROWS, ROWS[7]]
    got = lm_scoring.score_texts(docs, F.when(F.col("use"), True), bits=22, chunk=chunk).collect()
    n, base = base_scores(rows)
    want = plain_scores(rows, code_of(rows))
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for i, (text, learn) in enumerate(ROWS):
        r = by_id[i if i else None]
        assert (r["learn"], r["n_bytes"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            learn, len((text or "").encode()), *base[i][:2], n,
        )
        assert r["base_score"] == pytest.approx(base[i][2], abs=1e-9)
        assert r["score"] == pytest.approx(want[i], rel=1e-4)
        bits = None if not text else -r["score"] / math.log10(2) / len(text.encode())
        assert r["bits_per_byte"] == (bits and pytest.approx(bits))
    assert sum(r["doc_id"] == 7 for r in got) == 2


def test_every_byte_has_a_path_and_they_fill_the_tree():
    for counts in (np.zeros(257, np.int64), np.arange(257) ** 3, 2 ** np.minimum(np.arange(257), 50)):
        code = lm_scoring.Code.of(counts)
        assert sum(0.5 ** int(n) for n in code.length) == 1 and len(code.node) == code.length.sum()


def test_long_texts_go_by_stretches(monkeypatch):
    monkeypatch.setattr(lm_scoring, "STRETCH", 100)
    text = bytes(range(97, 123)) * 13
    cut = lm_scoring.stretches(text)
    assert b"".join(own for _, own, _ in cut) == text and [e for *_, e in cut] == [False] * 3 + [True]
    assert lm_scoring.stretches(None) == [(b"", b"", True)] == lm_scoring.stretches(b"")
    whole = lm_scoring.Piece([(b"", text, True)])
    parts = [lm_scoring.Piece([c]) for c in cut]
    for k in range(len(lm_scoring.ORDERS)):
        assert np.array_equal(whole.contexts[k], np.concatenate([p.contexts[k] for p in parts]))
    assert np.array_equal(whole.symbols, np.concatenate([p.symbols for p in parts]))


def test_nothing_to_learn_from(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows[:4])
    got = lm_scoring.score_texts(docs, F.lit(None).cast("boolean")).collect()
    assert {(r["train_tokens"], r["n_known"], r["base_score"]) for r in got} == {(0, 0, 0.0)}
    assert all(r["score"] < 0 for r in got)
    assert lm_scoring.score_texts(docs.limit(0), F.lit(True)).count() == 0


def test_query_on_held_out_documents(spark, documents):
    """The base by a plain count; the model beats single bytes on what it has not seen."""
    got = {r["doc_id"]: r for r in QUERIES["op13_lm_scoring"](spark, SF).collect()}
    rows = documents.collect()
    out = [zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 for r in rows]
    n, base = base_scores([(r["text"], not o) for r, o in zip(rows, out)])
    for r, o, (n_tokens, n_known, score) in zip(rows, out, base):
        g = got[r["doc_id"]]
        assert (g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"]) == (o, n_tokens, n_known, n)
        assert g["base_score"] == pytest.approx(score, rel=1e-12)
    code = code_of([(r["text"], not o) for r, o in zip(rows, out)])
    used = sum(-got[r["doc_id"]]["score"] for r, o in zip(rows, out) if o) / math.log10(2)
    single = sum(int(code.length[b]) for r, o in zip(rows, out) if o for b in (r["text"] or "").encode())
    assert used < 0.75 * single


def test_weights_move_after_every_decision():
    """They moved after blocks that grew with the text, by the mean of a block."""
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 105, n, dtype=np.uint8)) for n in (700, 3, 0, 90, 700, 1)]
    counts = np.zeros(lm_scoring.SYMBOLS, np.int64)
    counts[97:105], counts[lm_scoring.END] = 200, 6
    code, bits = lm_scoring.Code.of(counts), 12
    odds = [rng.integers(-60, 60, 1 << bits, dtype=np.int8) for _ in range(lm_scoring.PREDICTORS)]
    keys, want = lm_scoring.node_keys(), []
    for text in texts:
        piece, total = lm_scoring.Piece([(b"", text, True)]), 0.0
        weights = defaultdict(lambda: np.array(lm_scoring.START))
        for i, s in enumerate(piece.symbols):
            for depth in range(code.length[s]):
                step = code.start[s] + depth
                cells = [lm_scoring.slots(c[i : i + 1], keys[code.node[step]], bits)[0] for c in piece.contexts]
                x = np.array([t[c] for t, c in zip(odds, cells)]) / lm_scoring.ODDS_STEP * (1 if code.way[step] else -1)
                p = 1 / (1 + math.exp(-max(-60.0, float(weights[depth] @ x))))
                total += math.log(p)
                weights[depth] = weights[depth] + lm_scoring.RATE * (1 - p) * x
        want.append(total)
    got = lm_scoring.code_lengths(lm_scoring.Piece([(b"", t, True) for t in texts]), code, odds, bits)
    assert got == pytest.approx(want, rel=1e-4)


def test_no_text_is_left_to_be_scored_alone(monkeypatch):
    monkeypatch.setattr(lm_scoring, "TOGETHER", 1000)
    texts = pa.array([b"x" * n for n in range(40, 100)], pa.binary())
    pieces = [piece for *_, piece in lm_scoring._pieces(iter([pa.RecordBatch.from_arrays([texts], ["text"])]))]
    assert sum(len(p.ends) for p in pieces) == len(texts)
    assert min(len(p.ends) for p in pieces) > 1


def test_a_task_takes_few_texts_and_one_chunk_at_a_time(spark, monkeypatch):
    seen, write = {}, lm_scoring.Stages.__call__

    def watched(stages, df, name):
        seen[name] = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
        return write(stages, df, name)

    monkeypatch.setattr(lm_scoring.Stages, "__call__", watched)
    docs = spark.createDataFrame([(i, f"some text {i}") for i in range(20)], "doc_id long, text string")
    assert lm_scoring.score_texts(docs, F.col("doc_id") % 2 == 0, bits=12, chunk=20).count() == 20
    assert seen["base"] == 1 and max(seen["chunks"], seen["model"]) <= 1000


def test_counts_do_not_depend_on_the_batches_that_texts_come_in():
    texts = [b"some words " * (i % 7 * 50) + bytes([i]) for i in range(60)]
    code = lm_scoring.Code.of(np.bincount(np.frombuffer(b"".join(texts), np.uint8), minlength=lm_scoring.SYMBOLS))
    found = []
    for rows in (7, 60):
        tables = np.zeros((lm_scoring.PREDICTORS, 2 << 12), np.uint32)
        batches = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
        for *_, piece in lm_scoring._pieces(batches.slice(at, rows) for at in range(0, 60, rows)):
            lm_scoring.count_slots(piece, code, tables, 12)
        found.append(tables)
    assert found[0].any() and (found[0] == found[1]).all()


def test_steps_are_weighed_in_few_blocks():
    """Every step at which a chain ended began a block of its own."""
    lasting = np.arange(2000, 0, -1)
    blocks = lm_scoring._blocks(lasting)
    assert [b for b, *_ in blocks] == [0, *[e for _, e, _ in blocks[:-1]]] and blocks[-1][1] == 2000
    assert len(blocks) < 200
    for begin, end, n in blocks:
        assert n == np.count_nonzero(lasting > begin)
        assert np.count_nonzero(lasting > end - 1) >= n - n / lm_scoring.SPARE
    assert lm_scoring._blocks(np.empty(0, np.int64)) == []


def test_a_text_costs_the_same_alone_and_among_others(monkeypatch):
    """Chains that have ended stay in their block, and texts cross the parts that are looked up; neither may cost anything."""
    rng = np.random.default_rng(5)
    texts = [bytes(rng.integers(97, 117, n, dtype=np.uint8)) for n in (0, 1, 5, 64, 300, 301, 310, 900)]
    code = lm_scoring.Code.of(np.bincount(np.frombuffer(b"".join(texts), np.uint8), minlength=lm_scoring.SYMBOLS))
    odds = [rng.integers(-60, 60, 1 << 12, dtype=np.int8) for _ in range(lm_scoring.PREDICTORS)]
    score = lambda some: lm_scoring.code_lengths(lm_scoring.Piece([(b"", t, True) for t in some]), code, odds, 12)
    alone = np.concatenate([score([t]) for t in texts])
    assert score(texts) == pytest.approx(alone, rel=1e-12)
    monkeypatch.setattr(lm_scoring, "LOOKED", 100)
    monkeypatch.setattr(lm_scoring, "WEIGHED", 500)
    assert score(texts) == pytest.approx(alone, rel=1e-12)


@pytest.mark.parametrize("size", [8, 1 << 20])
def test_words_of_a_chunk(monkeypatch, size):
    """Words of a part of texts are split and numbered together, those of long texts by slices."""
    monkeypatch.setattr(lm_scoring, "SLICE", size)
    texts = [b" A b\x1cC\xff ", None, b"", b" \t ", b"a\x00B  c\x0b\x0c\rd\x1f\xe3\x80\x80e\xc3\x89", b"one Two one two " * 9, b"x" * 50]
    learn = [True, True, False, True, False, True, False]
    n = len(texts)
    columns = [pa.array(range(n)), pa.array([0] * n), pa.array([0] * n), pa.array(learn), pa.array(texts, pa.binary())]
    rows = pa.RecordBatch.from_arrays(columns, [*lm_scoring.KEY, "text"])
    chunk = lm_scoring.Chunk()
    for part in (rows.slice(0, 3), rows.slice(3)):
        chunk.add(part)
    got = chunk.table(7).to_pylist()[0]
    words = [(t or b"").lower().split() for t in texts]
    vocabulary = [w["word"] for w in got["vocabulary"]]
    assert (got["chunk"], got["size"], got["doc_id"], got["learn"]) == (7, len(set(sum(words, []))), list(range(n)), learn)
    assert got["words"] == [len(w) for w in words] and [vocabulary[i] for i in got["ids"]] == sum(words, [])
    counts = Counter(w for some, use in zip(words, learn) if use for w in some)
    assert {w["word"]: w["n"] for w in got["vocabulary"]} == {w: counts[w] for w in set(sum(words, []))}
    read = b"".join(t or b"" for t, use in zip(texts, learn) if use)
    assert got["bytes"] == [*np.bincount(np.frombuffer(read, np.uint8), minlength=256).tolist(), sum(learn)]


def test_words_meet_their_counts_without_a_sort(spark, monkeypatch):
    plans, write = {}, lm_scoring.Stages.__call__

    def watched(stages, df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(stages, df, name)

    monkeypatch.setattr(lm_scoring.Stages, "__call__", watched)
    docs = spark.createDataFrame([(i, f"some text {i}") for i in range(20)], "doc_id long, text string")
    assert lm_scoring.score_texts(docs, F.col("doc_id") % 2 == 0, bits=12, chunk=20).count() == 20
    assert "ShuffledHashJoin [word" in plans["base"]


@pytest.mark.parametrize("size", [1, 3, 64, 1000])
def test_contexts_do_not_depend_on_slices(monkeypatch, size):
    """A word may begin slices before, and a stretch may see only the end of what was before it."""
    monkeypatch.setattr(lm_scoring, "STRETCH", 150)
    texts = [b"", b"a few words \x00 of\ttext", b"x" * 400, bytes(range(256)) * 2, b" ", b"y" * 70 + b" " + b"z" * 90]
    piece = lm_scoring.Piece([c for t in texts for c in lm_scoring.stretches(t)])
    found, at = [[] for _ in range(lm_scoring.PREDICTORS)], 0
    for first, contexts in piece.slices(size):
        assert first == at and len({len(c) for c in contexts}) == 1
        at += len(contexts[0])
        for some, c in zip(found, contexts):
            some.append(c)
    assert at == len(piece.symbols)
    # A word's hash is a polynomial of its bytes so far, in plain numbers here.
    words, so_far, own = [], [], iter(piece.own)
    for byte, mine in zip(piece.raw.tolist(), own):
        if mine:
            words.append(sum(int(lm_scoring.LETTERS[b]) * lm_scoring.BASE**i for i, b in enumerate(so_far)) % 2**32)
        so_far = [*so_far, byte] if byte > 32 else []
    words = np.array(words, np.uint32)
    words = (words ^ (words >> np.uint32(15))) * lm_scoring.FACTORS[0]
    assert np.array_equal(np.concatenate(found[-1]), words)
    for some, whole in zip(found, piece.contexts):
        assert np.array_equal(np.concatenate(some), whole)


def test_working_memory_is_a_few_times_the_text():
    """Contexts of a whole piece, and what they were made from, took some 50 bytes for every byte of it."""
    rng = np.random.default_rng(7)
    texts = [bytes(rng.choice(np.frombuffer(b"eeetaoin shrdlu", np.uint8), 4000)) for _ in range(500)]
    size = sum(map(len, texts))
    code = lm_scoring.Code.of(np.bincount(np.frombuffer(b"".join(texts), np.uint8), minlength=lm_scoring.SYMBOLS))
    odds = [rng.integers(-60, 60, 1 << 12, dtype=np.int8) for _ in range(lm_scoring.PREDICTORS)]
    tables = np.zeros((lm_scoring.PREDICTORS, 2 << 12), np.uint32)
    tracemalloc.start()
    try:
        piece = lm_scoring.Piece([(b"", t, True) for t in texts])
        lm_scoring.count_slots(piece, code, tables, 12)
        lm_scoring.code_lengths(piece, code, odds, 12)
        assert tracemalloc.get_traced_memory()[1] < 35 * size
    finally:
        tracemalloc.stop()


def test_a_batch_is_sorted_part_by_part():
    """Parts of one length stand together, hold every text once and are no copy of the batch."""
    texts = [b"x" * (i * 37 % 5000) for i in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000)), pa.array(texts, pa.binary())], ["row", "text"])
    found = list(lm_scoring._by_size(iter([batch])))
    lengths = [len(t) for p in found for t in p.column("text").to_pylist()]
    assert lengths == sorted(map(len, texts)) and sorted(r for p in found for r in p.column("row").to_pylist()) == list(range(2000))
    assert len(found) > 1 and all(p.column("text").nbytes <= lm_scoring.TOGETHER + 40_000 for p in found)
