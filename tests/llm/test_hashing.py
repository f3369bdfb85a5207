"""Word and run hashes against plain splitting."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from riskfeat.llm import hashing

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\x0b\x0c\r\x1c aAbBé🙂#", max_size=40)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.sampled_from([3, 17, 1 << 18]), st.booleans())
def test_words_hash_alike_exactly_when_they_are_alike(texts, piece, fold):
    old, hashing.PIECE = hashing.PIECE, piece
    try:
        hashes, first = hashing.word_hashes(texts, fold)
    finally:
        hashing.PIECE = old
    plain = [(t or "").encode().lower().split() if fold else (t or "").encode().split() for t in texts]
    assert np.diff(first).tolist() == [len(p) for p in plain]
    flat = [w for p in plain for w in p]
    for half in hashes:
        pairs = set(zip(flat, half.tolist()))
        assert len(pairs) == len(set(flat)) == len({h for _, h in pairs})


@pytest.mark.parametrize("piece", [7, 1 << 18])
@pytest.mark.parametrize("width", [1, 2, 5, 8, 20, 32])
def test_runs_hash_alike_exactly_when_they_are_alike(width, piece, monkeypatch):
    monkeypatch.setattr(hashing, "PIECE", piece)
    rng = random.Random(width)
    words = [rng.choice("abc") for _ in range(3000)]
    hashes, _ = hashing.word_hashes([" ".join(words)])
    runs = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
    for half in hashes:
        got = hashing.runs(half, width).tolist()
        assert len(got) == len(runs)
        assert len(set(zip(runs, got))) == len(set(runs)) == len(set(got))
    assert hashing.runs(hashes[0][:width - 1], width).tolist() == []


def test_batches_are_cut_by_bytes_and_keep_all_rows():
    texts = ["x" * n for n in (10, 500_000, 1, 0, 300_000, 300_000)] + [None] * 3
    batch = pa.RecordBatch.from_pydict({"text": texts, "i": list(range(9))})
    cut = list(hashing.parts(iter([batch, batch.slice(0, 0)])))
    assert [i for part in cut for i in part.column("i").to_pylist()] == list(range(9))
    assert len(cut) > 2
