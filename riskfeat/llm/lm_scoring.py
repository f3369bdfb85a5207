"""Scoring texts with a language model that mixes contexts online.

The model codes a text byte by byte, then an end. A byte is a path in a binary tree, a Huffman code of the
training texts, so it is a few yes-or-no decisions. Several predictors give each decision a probability, each
from what followed another context in all training texts: the two or four bytes before, or the word so far.
Context and tree node are hashed to a slot, and a slot holds how often either way was taken.

The predictions are mixed in the logistic domain: a weighted sum of their log odds. The depth in the tree
gates which set of weights counts. Every text starts from the same weights and refines its own ones online, by the
gradient of its code length, after every decision. Costs add up to the text's length in bits.

Slots are counted in every task over its own texts, as dense blocks, and summed as streams of blocks: the model has a
fixed size, whatever the size of the corpus. Beside it stands a word model: counts of all words of all training
texts, looked up by a shuffle of the different words of each chunk of texts.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from riskfeat.llm.chunks import first_number
from riskfeat.llm.common import Stages, setting
from riskfeat.llm.hashing import byte_sizes, cuts, list_column, mixed, parts

# -- the word model --

#: Words and texts in a chunk, which ends with a part of texts; one text may have more.
CHUNK = 1 << 20
#: Bytes of text that are split at a time.
SLICE = 1 << 20
BLANKS = b" \t\n\x0b\x0c\r"
SMOOTH = 0.1

# -- the mixing model --

END = 256
SYMBOLS = 257
ORDERS = (2, 4)
PREDICTORS = len(ORDERS) + 1
#: Slots of a predictor: two to this power.
SLOT_BITS = 20
#: Pairs of counts that travel in a row.
BLOCK = 1 << 11
#: Added to both counts of a slot.
PRIOR = 0.4
#: Log odds travel as bytes, in steps of this part.
ODDS_STEP = 16
#: Weights every text starts from, and how far a decision moves them.
START = (0.35, 0.5, 0.5)
RATE = 0.02
#: Weights move after blocks of one symbol, that is after every decision of a depth; blocks never grow.
FIRST_BLOCK = 1
GROWTH = 1 << 62
#: Bytes of shorter texts that are counted or scored together, and decisions that are weighed at a time.
TOGETHER = 1 << 21
WEIGHED = 1 << 16
#: Symbols whose slots are looked up at a time, so that what is worked on stays in the processor's cache.
LOOKED = 1 << 17
#: A block of steps ends before more than one in so many of its chains have ended.
SPARE = 8
#: Texts, and chunks, that enter a task at a time. Scoring takes as many texts as Spark's setting allows, as it sorts them by length.
TEXTS, CHUNKS = 1000, 1
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Different symbols in contexts that are counted at a time, and symbols whose contexts are compared.
COUNTED = 1 << 14
COMPARED = 1 << 19
#: Bytes of text in a task's arrays at a time. Longer texts are scored in stretches of this size, which see the
#: bytes before them; their weights start anew.
STRETCH = 1 << 21
#: Bytes that a stretch sees of what was before it.
BEHIND = 64
FACTORS = np.array([0x9E3779B1, 0x85EBCA6B], np.uint32)
#: Base of the polynomial that hashes a word so far, modulo 2^32, and a value for every byte.
BASE = 0x01000193
LETTERS = (mixed(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
KEY = ["doc_id", "a", "b", "learn"]


@dataclass
class Code:
    """Paths of all symbols: node and direction of each decision."""

    start: np.ndarray
    length: np.ndarray
    node: np.ndarray
    way: np.ndarray

    @staticmethod
    def of(counts: np.ndarray) -> Code:
        """Huffman code of symbol counts, each raised by one so that every byte has a path."""
        heap = [(int(n) + 1, s, s) for s, n in enumerate(counts)]
        heapq.heapify(heap)
        children: list[tuple] = []
        while len(heap) > 1:
            (n, _, a), (m, _, b) = heapq.heappop(heap), heapq.heappop(heap)
            children.append((a, b))
            heapq.heappush(heap, (n + m, len(counts) + len(children), len(counts) + len(children) - 1))
        paths: list[list[tuple[int, int]]] = [[] for _ in counts]
        walk = [(len(counts) + len(children) - 1, [])]
        while walk:
            at, path = walk.pop()
            if at < len(counts):
                paths[at] = path
                continue
            node = at - len(counts)
            walk += [(child, [*path, (node, way)]) for way, child in enumerate(children[node])]
        length = np.array([len(p) for p in paths], np.int32)
        flat = [step for p in paths for step in p]
        return Code(
            (np.cumsum(length) - length).astype(np.int32),
            length,
            np.array([node for node, _ in flat], np.int32),
            np.array([way for _, way in flat], np.uint32),
        )


class Powers:
    """Powers of the base and of its inverse, as many as were needed so far; a slice of a piece needs one more than its bytes."""

    known = np.ones((2, 1), np.uint32)

    @classmethod
    def up_to(cls, n: int) -> np.ndarray:
        if cls.known.shape[1] < n:
            factors = np.empty((2, n), np.uint32)
            factors[0], factors[1] = BASE, pow(BASE, -1, 1 << 32)
            factors[:, 0] = 1
            cls.known = np.cumprod(factors, axis=1, dtype=np.uint32)
        return cls.known[:, :n]


class Piece:
    """Symbols of several stretches of text; the hashes of their contexts are made slice by slice, as they would be many times the text."""

    def __init__(self, stretches: list[tuple[bytes, bytes, bool]]):
        """Each stretch is what stands before it, its own bytes, and whether the text ends with it."""
        sizes = [len(own) + ends for _, own, ends in stretches]
        self.ends = np.cumsum(sizes)
        before = [back[-BEHIND:].rjust(4, b"\0") for back, _, _ in stretches]
        self.raw = np.frombuffer(b"".join(b + own + b"\0" * ends for b, (_, own, ends) in zip(before, stretches)), np.uint8)
        self.own = np.ones(len(self.raw), bool)
        at = 0
        for back, size in zip(before, sizes):
            self.own[at : at + len(back)] = False
            at += len(back) + size
        self.symbols = self.raw[self.own].astype(np.uint16)
        self.symbols[self.ends[[e for _, _, e in stretches]] - 1] = END

    def slices(self, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
        """The first symbol and the contexts of every slice of ``size`` bytes, in order."""
        first = 0
        # The word that a slice begins in: its polynomial so far, and the power for its next byte.
        begun, power = np.zeros(1, np.uint32), np.ones(1, np.uint32)
        for at in range(0, len(self.raw), size):
            raw, own = self.raw[at : at + size], self.own[at : at + size]
            back = min(at, max(ORDERS))
            wide = self.raw[at - back : at + size].astype(np.uint32)
            past, contexts = np.zeros(len(wide), np.uint32), []
            for order in range(1, max(ORDERS) + 1):
                past[order:] |= wide[:-order] << np.uint32(8 * (order - 1))
                if order in ORDERS:
                    contexts.append((past * FACTORS[len(contexts)])[back:][own])
            # Polynomials of all beginnings; a word so far is the difference of two, moved to the first place.
            up, down = Powers.up_to(len(raw) + 1)
            sums = np.zeros(len(raw) + 1, np.uint32)
            np.cumsum(LETTERS[raw] * up[:-1], out=sums[1:])
            start = np.zeros(len(raw) + 1, np.int32)
            np.multiply(np.arange(1, len(raw) + 1, dtype=np.int32), raw <= 32, out=start[1:])
            start = np.maximum.accumulate(start, out=start)
            word = sums - sums.take(start, mode="wrap")
            word *= down.take(start, mode="wrap")
            mine = start == 0
            word[mine] = begun + power * sums[mine]
            begun, power = word[-1:].copy(), up[len(raw) - start[-1:]] * (power if mine[-1] else np.ones(1, np.uint32))
            word = word[:-1][own]
            word ^= word >> np.uint32(15)
            contexts.append(word * FACTORS[0])
            if len(word):
                yield first, contexts
            first += len(word)

    @property
    def contexts(self) -> list[np.ndarray]:
        """Of all symbols at once."""
        found = [contexts for _, contexts in self.slices(max(1, len(self.raw)))]
        return found[0] if found else [np.empty(0, np.uint32)] * PREDICTORS


def slots(context: np.ndarray, key: np.ndarray, bits: int) -> np.ndarray:
    cell = context ^ key
    cell *= np.uint32(0x2C1B3C6D)
    cell >>= np.uint32(32 - bits)
    return cell


def node_keys() -> np.ndarray:
    return (mixed(np.arange(1, SYMBOLS, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def stretches(text: bytes | None, size: int = 0) -> list[tuple[bytes, bytes, bool]]:
    size = size or STRETCH
    data = text or b""
    starts = range(0, max(1, len(data)), size)
    return [(data[max(0, s - BEHIND) : s], data[s : s + size], s + size >= len(data)) for s in starts]


def count_slots(piece: Piece, code: Code, tables: np.ndarray, bits: int) -> None:
    """Add what every context was followed by to the tables (predictor, slot and way)."""
    keys = node_keys()[code.node]
    for at, contexts in piece.slices(COMPARED):
        _count_slice(piece.symbols[at : at + len(contexts[0])], contexts, code, keys, tables, bits)


def _count_slice(
    symbols: np.ndarray, contexts: list[np.ndarray], code: Code, keys: np.ndarray, tables: np.ndarray, bits: int
) -> None:
    for table, context in zip(tables, contexts):
        # Equal symbols in equal contexts go the same ways.
        pairs = context.astype(np.int64)
        pairs <<= 9
        pairs |= symbols
        pairs.sort()
        begin = np.flatnonzero(np.diff(pairs, prepend=-1))
        pairs, times = pairs[begin], np.diff(begin, append=len(pairs))
        for at in range(0, len(pairs), COUNTED):
            some, n = pairs[at : at + COUNTED], times[at : at + COUNTED]
            symbol = some & 511
            length = code.length[symbol]
            first = np.cumsum(length) - length
            step = np.arange(length.sum()) + np.repeat(code.start[symbol] - first, length)
            cell = slots(np.repeat((some >> 9).astype(np.uint32), length), keys[step], bits)
            np.add.at(table, cell * np.uint32(2) + code.way[step], np.repeat(n.astype(np.uint32), length))


def code_lengths(piece: Piece, code: Code, odds: list[np.ndarray], bits: int) -> np.ndarray:
    """Natural logarithm of the probability of every stretch.

    Weights move after every single decision. The decisions of one stretch at one depth are a chain, each weighed by what
    the ones before it left; chains know nothing of each other, so a step takes the next decision of all of them.
    """
    sizes = np.diff(piece.ends, prepend=0)
    deepest = int(code.length.max())
    lengths = np.zeros((deepest, len(sizes)), np.int64)
    for k, (begin, end) in enumerate(zip(piece.ends - sizes, piece.ends)):
        # How many symbols have a path of each length, and so go at least as deep.
        paths = np.bincount(code.length.take(piece.symbols[begin:end]), minlength=deepest + 1)
        lengths[:, k] = np.cumsum(paths[::-1])[::-1][1:]
    # Longer chains first, so that those still running are the first ones.
    chains = np.argsort(-lengths.reshape(-1), kind="stable")[: np.count_nonzero(lengths)]
    rank = np.empty(lengths.size, np.int64)
    rank[chains] = np.arange(len(chains))
    lasting = lengths.reshape(-1)[chains]
    blocks = _blocks(lasting)
    inputs = _inputs(piece, code, odds, bits, rank.reshape(lengths.shape), blocks)
    costs = np.zeros(len(chains))
    # Odds stay whole steps and weights are divided instead; by powers of two, so nothing else is rounded.
    weights = np.repeat(np.array(START, np.float32)[:, None] / np.float32(ODDS_STEP), len(chains), axis=1)
    rate, one = np.array(RATE / ODDS_STEP**2, np.float32), np.ones((), np.float32)
    multiply, add, exp, divide = np.multiply, np.add, np.exp, np.divide
    room = max(((end - begin) * n for begin, end, n in blocks), default=0)
    whole, all_x, all_z = np.empty(room, np.int32), np.empty(PREDICTORS * room, np.float32), np.empty(room, np.float32)
    at = 0
    with np.errstate(over="ignore"):
        for begin, end, n in blocks:
            size = (end - begin) * n
            x = all_x[: PREDICTORS * size].reshape(end - begin, PREDICTORS, n)
            for k in range(PREDICTORS):
                # The k-th byte with its sign.
                np.left_shift(inputs[at : at + size], 24 - 8 * k, out=whole[:size])
                np.right_shift(whole[:size], 24, out=whole[:size])
                x[:, k] = whole[:size].reshape(end - begin, n)
            at += size
            z, e = all_z[:size].reshape(end - begin, n), np.empty(n, np.float32)
            w = weights[:, :n].copy()
            move = np.empty_like(w)
            first, second, *others = move
            flat_w, flat_move = w.reshape(-1), move.reshape(-1)
            # Arrays without gaps, in one dimension where it can be, cost the least for each call.
            for flat_x, mine, total in zip(x.reshape(end - begin, -1), x, z):
                multiply(flat_w, flat_x, flat_move)
                add(first, second, total)
                for other in others:
                    add(total, other, total)
                exp(total, e)
                add(e, one, e)
                divide(rate, e, e)  # the rate times what the probability lacks to one
                multiply(mine, e, move)
                add(flat_w, flat_move, flat_w)
            weights[:, :n] = w
            np.maximum(z, -60, out=z)
            np.exp(np.negative(z, out=z), out=z)
            z += 1  # one over the probability
            costs[:n] += np.log(z, out=z).sum(axis=0, dtype=np.float64)
            # Steps after a chain's last one have odds of one to one, which move no weight; they are no cost.
            costs[:n] -= np.maximum(end - np.maximum(lasting[:n], begin), 0) * float(np.log(np.float32(2)))
    return -np.bincount(chains % len(sizes), costs, len(sizes))


def _blocks(lasting: np.ndarray) -> list[tuple[int, int, int]]:
    """First step, step after the last, and chains, of blocks of steps that are weighed together, from what steps chains take, longest first."""
    steps = int(lasting.max(initial=0))
    ended = -(len(lasting) - np.cumsum(np.bincount(lasting, minlength=steps + 1))[:steps])
    blocks, begin = [], 0
    while begin < steps:
        n = -int(ended[begin])
        end = int(np.searchsorted(ended, n // SPARE - n, "right"))
        end = min(end, begin + max(1, WEIGHED // n))
        blocks.append((begin, end, n))
        begin = end
    return blocks


def _inputs(
    piece: Piece, code: Code, odds: list[np.ndarray], bits: int, rank: np.ndarray, blocks: list[tuple[int, int, int]]
) -> np.ndarray:
    """Log odds of the way that was taken, by step and chain; those of all predictors are one word, which is placed once."""
    widths = np.repeat([n for *_, n in blocks], [end - begin for begin, end, _ in blocks]).astype(np.int64)
    starts = np.cumsum(widths) - widths
    inputs = np.zeros(int(widths.sum()), np.uint32)
    words = np.zeros((LOOKED, 4), np.int8)
    done = np.zeros_like(rank)
    keys, deepest = node_keys(), len(rank)
    deep = np.arange(deepest)[:, None] < code.length
    steps = np.where(deep, code.start + np.arange(deepest)[:, None], 0)
    keys, signs = keys[code.node[steps]], code.way[steps].astype(np.int8) * 2 - 1
    for at, contexts in piece.slices(LOOKED):
        symbols = piece.symbols[at : at + len(contexts[0])].astype(np.intp)
        # Stretches in this part, and where in it they end.
        first, last = np.searchsorted(piece.ends, [at, at + len(symbols) - 1], "right")
        some = slice(first, last + 1)
        ends = np.minimum(piece.ends[some] - at, len(symbols))
        for depth in range(deepest):
            # Symbols whose path goes this deep, and what it does there.
            mine = np.flatnonzero(deep[depth].take(symbols, mode="wrap"))
            if not len(mine):
                break
            if len(mine) < len(symbols):
                symbols = symbols.take(mine, mode="wrap")
                contexts = [c.take(mine, mode="wrap") for c in contexts]
                ends = np.searchsorted(mine, ends)
            here = np.diff(ends, prepend=0)
            place = np.arange(len(symbols))
            place += np.repeat(done[depth, some] + here - ends, here)
            place = starts.take(place, mode="wrap")
            place += np.repeat(rank[depth, some], here)
            done[depth, some] += here
            key, sign = keys[depth].take(symbols, mode="wrap"), signs[depth].take(symbols, mode="wrap")
            word = words[: len(symbols)]
            for k, (table, context) in enumerate(zip(odds, contexts)):
                # Whole-word indices that need no check are the fastest to look up.
                np.multiply(table.take(slots(context, key, bits).astype(np.intp), mode="wrap"), sign, out=word[:, k])
            inputs[place] = word.view(np.uint32)[:, 0]
    return inputs.view(np.int32)


# -- the work on Spark --


def _keyed(docs: DataFrame, learn: Column) -> DataFrame:
    """Rows that agree in doc_id, text and learn are one text; two hashes stand for the text."""
    return docs.select(
        "doc_id",
        F.xxhash64("text").alias("a"),
        F.xxhash64(F.lit(7), "text").alias("b"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
        F.col("text").cast("binary").alias("text"),
    )


def _kind(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def _slices(texts: pa.Array) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Texts by row. Those of a part with a long text come one by one and in slices, which end after white space."""
    import pyarrow.compute as pc

    if (pc.sum(pc.binary_length(texts)).as_py() or 0) <= 2 * SLICE:
        yield np.arange(len(texts)), texts.cast(pa.binary())
        return
    for row, text in enumerate(texts.to_pylist()):
        data, at = text or b"", 0
        while at < len(data):
            end = min(len(data), at + SLICE)
            while end < len(data) and data[end - 1] not in BLANKS:
                end += 1
            yield np.array([row]), pa.array([data[at:end]], pa.binary())
            at = end


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts in order, and how many each text has."""
    import pyarrow.compute as pc

    # Arrow folds and splits by single bytes; that they are UTF-8 does not matter.
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    words = lists.flatten()
    full = pc.not_equal(words, "")
    upto = np.concatenate([[0], np.cumsum(np.asarray(full))])
    ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0)), dtype=np.int64)
    return words.filter(full), np.diff(upto[ends], prepend=0)


class Chunk:
    """Texts as numbers of a vocabulary of this chunk, how often texts to learn from have its words, and their bytes."""

    def __init__(self):
        self.rows: list[pa.RecordBatch] = []
        self.sizes: list[np.ndarray] = []
        self.words: list[pa.DictionaryArray] = []
        self.learnt: list[np.ndarray] = []
        self.bytes = np.zeros(SYMBOLS, np.int64)
        self.size = 0

    def add(self, part: pa.RecordBatch) -> None:
        learn = np.asarray(part.column("learn"))
        sizes = np.zeros(len(part), np.int64)
        for rows, texts in _slices(part.column("text")):
            words, of = _words(texts)
            sizes[rows] += of
            self.words.append(words.dictionary_encode())
            self.learnt.append(np.repeat(learn[rows], of))
            read = b"".join(t for t in texts.filter(pa.array(learn[rows])).to_pylist() if t)
            self.bytes[:END] += np.bincount(np.frombuffer(read, np.uint8), minlength=END)
        self.bytes[END] += np.count_nonzero(learn)
        self.rows.append(part.select(KEY))
        self.sizes.append(sizes)
        self.size += int(sizes.sum()) + len(part)

    def table(self, number: int) -> pa.RecordBatch:
        none = pa.array([], pa.string()).dictionary_encode()
        parts = pa.chunked_array([none, *self.words]).unify_dictionaries().chunks
        words = parts[0].dictionary
        ids = np.concatenate([np.asarray(p.indices) for p in parts])
        learnt = np.bincount(ids[np.concatenate([np.empty(0, bool), *self.learnt])], minlength=len(words))
        vocabulary = [words.view(pa.binary()), pa.array(learnt, pa.int64())]
        lists = [
            *[pa.concat_arrays([r.column(c) for r in self.rows]) for c in KEY],
            pa.array(np.concatenate(self.sizes)),
            pa.array(ids, pa.int32()),
            pa.array(self.bytes, pa.int64()),
            pa.StructArray.from_arrays(vocabulary, ["word", "n"]),
        ]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([len(words)], pa.int32()),
                *[pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists],
            ],
            ["chunk", "size", *KEY, "words", "ids", "bytes", "vocabulary"],
        )


def _chunks(docs: DataFrame, most: int) -> DataFrame:
    """One row per chunk of texts: the texts as word numbers, and the words by number."""

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, number = Chunk(), first_number(TaskContext.get().partitionId())
        for part in parts(batches, piece=min(SLICE, most)):
            chunk.add(part)
            if chunk.size >= most:
                yield chunk.table(number)
                chunk, number = Chunk(), number + 1
        if chunk.rows:
            yield chunk.table(number)

    schema = (
        f"chunk long, size int, doc_id array<{_kind(docs)}>, a array<long>, b array<long>, learn array<boolean>, "
        "words array<long>, ids array<int>, bytes array<long>, vocabulary array<struct<word binary, n long>>"
    )
    return docs.mapInArrow(chunked, schema)


def _word_scores(stages: Stages, chunks: DataFrame, kind: str) -> tuple[DataFrame, int]:
    """Per text the word model's score, and the number of tokens that it learnt from."""
    words = chunks.select("chunk", F.posexplode("vocabulary").alias("local", "of")).select("chunk", "local", "of.*")
    counts = stages(words.where("n > 0").groupBy("word").agg(F.sum("n").alias("c")), "counts")
    n_words, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    texts = chunks.select(F.sum(F.element_at("bytes", -1))).first()[0] or 0
    tokens, kinds = n_words + texts, distinct + (texts > 0)
    # Words differ, so no part of their counts is large, and neither side needs to be sorted. A chunk's words meet before
    # they are collected: as lists of every part they would only be sorted and copied once more.
    found = words.select("chunk", "local", "word").join(counts.hint("shuffle_hash"), "word").select("chunk", "local", "c")
    # Two lists of numbers, which take rows in the same order, are half as large in memory as one of pairs.
    known = found.repartition("chunk").groupBy("chunk").agg(F.collect_list("local").alias("local"), F.collect_list("c").alias("c"))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share = lambda c: np.log10((c + SMOOTH) / (tokens + SMOOTH * (kinds + 1)))
        for batch in batches:
            for i in range(len(batch)):
                values = {c: batch.column(c)[i].values for c in (*KEY, "words", "ids")}
                c = np.zeros(batch.column("size")[i].as_py())
                local, found = batch.column("local")[i].values, batch.column("c")[i].values
                if local is not None:
                    c[local.to_numpy()] = found.to_numpy()
                ids, size = values["ids"].to_numpy(), values["words"].to_numpy()
                text = np.repeat(np.arange(len(size)), size)
                add_up = lambda x: np.bincount(text, x[ids], minlength=len(size))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[values[k] for k in KEY],
                        pa.array(size + 1),
                        pa.array(add_up(c > 0).astype(np.int64) + (texts > 0)),
                        pa.array(add_up(share(c)) + share(texts)),
                    ],
                    [*KEY, "n_tokens", "n_known", "base_score"],
                )

    rows = chunks.select("chunk", "size", *KEY, "words", "ids").join(known, "chunk", "left")
    schema = f"doc_id {kind}, a long, b long, learn boolean, n_tokens long, n_known long, base_score double"
    return rows.drop("chunk").mapInArrow(judged, schema), tokens


def _by_size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of batches in which texts of about one length stand together, so that few of them outlast the others of their piece."""
    for batch in batches:
        sizes = byte_sizes(batch.column("text"))
        order = np.argsort(sizes, kind="stable")
        for start, end in cuts(sizes[order], TOGETHER):
            yield batch.take(pa.array(order[start:end]))


def _pieces(batches: Iterator[pa.RecordBatch], by_size: bool = False) -> Iterator[tuple[pa.RecordBatch, list[int], Piece]]:
    """Rows, the row of every stretch, and the stretches together; a long text is spread over several pieces."""
    for part in _by_size(batches) if by_size else parts(batches, piece=TOGETHER):
        row_of: list[int] = []
        waiting: list[tuple[bytes, bytes, bool]] = []
        size = 0
        for i, text in enumerate(part.column("text").to_pylist()):
            for stretch in stretches(text):
                # A part may pass the limit by its last text, which is not left to be scored alone.
                if size + len(stretch[1]) >= TOGETHER + TOGETHER // 4 and waiting:
                    yield part, row_of, Piece(waiting)
                    row_of, waiting, size = [], [], 0
                row_of.append(i)
                waiting.append(stretch)
                size += len(stretch[1]) + 1
        if waiting:
            yield part, row_of, Piece(waiting)


def _learn(stages: Stages, docs: DataFrame, code: Code, bits: int) -> list[np.ndarray]:
    """Log odds of all slots, in steps."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.zeros((PREDICTORS, 2 << bits), np.uint32)
        for _, _, piece in _pieces(batches):
            count_slots(piece, code, tables, bits)
        for k, table in enumerate(tables):
            blocks = table.reshape(-1, 2 * BLOCK)
            full = np.flatnonzero(blocks.any(axis=1))
            for at in range(0, len(full), 64):
                some = full[at : at + 64]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(some), k, np.int32)),
                        pa.array(some.astype(np.int32)),
                        list_column(blocks[some].view(np.int32).reshape(-1), [2 * BLOCK] * len(some), pa.int32()),
                    ],
                    ["predictor", "block", "counts"],
                )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A block at a time is added to the sums; they have the size of the model at most.
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for k, block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                counts = counts.values.to_numpy().view(np.uint32).astype(np.int64)
                sums[k, block] = sums[k, block] + counts if (k, block) in sums else counts
        for (k, block), counts in sums.items():
            odds = np.log((counts[1::2] + PRIOR) / (counts[0::2] + PRIOR))
            steps = np.clip(np.rint(ODDS_STEP * odds), -127, 127).astype(np.int8)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([block], pa.int32()), pa.array([steps.tobytes()], pa.binary())],
                ["predictor", "block", "odds"],
            )

    blocks = docs.where("learn").select("text").mapInArrow(counted, "predictor int, block int, counts array<int>")
    sums = blocks.repartition("predictor", "block").mapInArrow(summed, "predictor int, block int, odds binary")
    with setting(docs.sparkSession, BATCH, str(TEXTS)):
        model = stages(sums, "model")
    odds = [np.zeros(1 << bits, np.int8) for _ in range(PREDICTORS)]
    for row in model.toLocalIterator():  # as many rows as the model has blocks
        at = row["block"] * BLOCK
        odds[row["predictor"]][at : at + BLOCK] = np.frombuffer(row["odds"], np.int8)
    return odds


def score_texts(docs: DataFrame, learn: Column, bits: int = SLOT_BITS, chunk: int = CHUNK) -> DataFrame:
    """Score every text with a model of the rows where ``learn`` is true.

    Returns one row per row of ``docs``: doc_id, learn, n_bytes, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte (null for a text without bytes).

    ``score`` is the mixing model's log10 probability of the text's bytes in UTF-8 and its end. ``base_score`` is that
    of the word model: tokens are runs without ASCII white space, A-Z lowered, and one end; with c the count of a token,
    N that of all (``train_tokens``) and V that of different ones in the rows learnt from, it sums
    log10((c + 0.1) / (N + 0.1 (V + 1))). ``n_known`` counts tokens with c > 0.

    A null text is empty; a null ``learn`` is false. With nothing to learn from, N and V are 0 and all ways equally
    likely. Repeated rows count as often in the model, and get equal scores. Other columns are ignored; an empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "lm-scoring")
    keyed, kind = _keyed(docs, learn), _kind(docs)
    with setting(spark, BATCH, str(TEXTS)):
        chunks = stages(_chunks(keyed, chunk), "chunks")
    base, tokens = _word_scores(stages, chunks, kind)
    with setting(spark, BATCH, str(CHUNKS)):
        base = stages(base, "base")
    histogram = np.zeros(SYMBOLS, np.int64)
    spread = chunks.select(F.posexplode("bytes").alias("symbol", "n"))
    for row in spread.groupBy("symbol").agg(F.sum("n").alias("n")).collect():
        histogram[row["symbol"]] = row["n"]
    stages.drop("chunks", "counts")
    code = Code.of(histogram)
    model = spark.sparkContext.broadcast((vars(code), _learn(stages, keyed, code, bits)))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, costs = None, np.empty(0)
        code, odds = Code(**model.value[0]), model.value[1]

        def done() -> pa.RecordBatch:
            size = pa.array(byte_sizes(rows.column("text")), pa.int64())
            return pa.RecordBatch.from_arrays([*[rows.column(k) for k in KEY], size, pa.array(costs)], [*KEY, "n_bytes", "cost"])

        for part, row_of, piece in _pieces(batches, by_size=True):
            if part is not rows:
                if rows is not None:
                    yield done()
                rows, costs = part, np.zeros(len(part))
            np.add.at(costs, row_of, code_lengths(piece, code, odds, bits))
        if rows is not None:
            yield done()

    schema = f"doc_id {kind}, a long, b long, learn boolean, n_bytes long, cost double"
    scored = stages(keyed.mapInArrow(judged, schema), "scored")
    model.unpersist()
    mine = [F.col(k).eqNullSafe(F.col(f"_{k}")) if k == "doc_id" else F.col(k) == F.col(f"_{k}") for k in KEY]
    same = base.groupBy(*[F.col(k).alias(f"_{k}") for k in KEY]).agg(
        *[F.min(c).alias(c) for c in ("n_tokens", "n_known", "base_score")]
    )
    on = mine[0]
    for more in mine[1:]:
        on = on & more
    bits_used = -F.col("cost") / F.lit(float(np.log(2)))
    return scored.join(same, on).select(
        "doc_id",
        "learn",
        "n_bytes",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        "base_score",
        (F.col("cost") / F.lit(float(np.log(10)))).alias("score"),
        F.when(F.col("n_bytes") > 0, bits_used / F.col("n_bytes")).alias("bits_per_byte"),
    )
