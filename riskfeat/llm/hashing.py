"""Hashes of words and of runs of words, for use inside tasks.

A word has 128 bits, as two halves. A run of words is hashed half by half, so runs keep all 128: two runs of
one length join to a longer one by a product, a sum and a mix, and a width is made of powers of two.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of text, or words, that are hashed at a time.
PIECE = 1 << 18
TWIST = np.uint64(0xD6E8FEB86659FD93)
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread every bit over all others, in place."""
    for shift, factor in ((30, MIX_A), (27, MIX_B)):
        values ^= values >> np.uint64(shift)
        values *= factor
    values ^= values >> np.uint64(31)
    return values


def _pieces(data: bytes) -> Iterator[bytes]:
    """Cuts between words, about every PIECE bytes."""
    at = 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data) and data[end - 1] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield data[at:end]
        at = end


def word_hashes(texts: Sequence[str | None], fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of the hashes of all words of all texts in order, and where each text's words start and the last's end.

    Words are separated by ASCII white space; ``fold`` takes A-Z for a-z.
    """
    numbers: dict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    ids, sizes = [np.empty(0, np.int64)], [0]
    for text in texts:
        data = (text or "").encode("utf-8", "replace")
        n = 0
        for piece in _pieces(data.lower() if fold else data):
            words = piece.split()
            ids.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
            n += len(words)
        sizes.append(n)
    digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, numbers)), np.uint64).reshape(-1, 2)
    return np.ascontiguousarray(digests[np.concatenate(ids)].T), np.cumsum(sizes)


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    both = a ^ TWIST
    both *= MIX_B
    both += b
    return mixed(both)


def runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash for every run of ``width`` words, from one half of theirs."""
    if len(hashes) < width:
        return np.empty(0, np.uint64)
    power, size = hashes, 1
    whole, have = None, 0
    while True:
        if width & size:
            n = len(hashes) - have - size + 1
            whole = power[:n] if whole is None else _joined(whole[:n], power[have : have + n])
            have += size
        if have == width:
            return mixed(whole.copy())
        power = _joined(power[:-size], power[size:])
        size *= 2


def shingles(hashes: np.ndarray, width: int) -> tuple[np.ndarray, tuple[int, int]]:
    """The distinct runs of ``width`` words by their first half, ascending, and 128 bits that stand for the set.

    A shorter text is one run of all its words; without words the set is empty.
    """
    width = min(width, max(1, hashes.shape[1]))
    first, second = (np.unique(runs(half, width).view(np.int64)) for half in hashes)
    return first, fingerprint(np.concatenate([first, second]))


def fingerprint(values: np.ndarray) -> tuple[int, int]:
    """Two 64-bit numbers that stand for an array."""
    both = np.frombuffer(xxhash.xxh3_128_digest(values.tobytes()), np.int64)
    return int(both[0]), int(both[1])


def list_column(flat: np.ndarray, counts: Sequence[int], kind: pa.DataType) -> pa.ListArray:
    """A list of numbers for each row, from all of them in order."""
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


def byte_sizes(texts: pa.Array) -> np.ndarray:
    """Bytes of every text; no text has none."""
    import pyarrow.compute as pc

    return np.asarray(pc.fill_null(pc.binary_length(texts), 0))


def cuts(sizes: np.ndarray, piece: int) -> Iterator[tuple[int, int]]:
    """Start and end of runs of texts with about ``piece`` bytes; a longer text is a run of its own."""
    group = np.cumsum(sizes, dtype=np.int64) // piece
    at = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
    yield from ((start, end) for start, end in zip(at, at[1:]) if end > start)


def parts(batches: Iterator[pa.RecordBatch], text: str = "text", piece: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Slices of batches with about ``piece`` bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        for start, end in cuts(byte_sizes(batch.column(text)), piece):
            yield batch.slice(start, end - start)
