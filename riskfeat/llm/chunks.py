"""Tables of chunks: per chunk one row with long lists, and many narrow ones for what its different words or phrases are.

Both kinds share a table, so that one pass over the texts writes them; a reader of one kind skips the columns of the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Narrow rows that leave a task together.
ROWS = 1 << 16


def first_number(partition: int) -> int:
    """Number of a task's first chunk; the next ones follow."""
    return partition << 32


def chunk_rows(chunk: int, lists: dict[str, pa.Array], narrow: dict[str, pa.Array]) -> Iterator[pa.RecordBatch]:
    """``lists`` in one row, with the number of the others as ``size``; then ``narrow``, numbered by ``local``."""
    count = len(next(iter(narrow.values())))
    wide = {name: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for name, v in lists.items()}
    yield pa.RecordBatch.from_pydict(
        {"chunk": pa.array([chunk], pa.int64()), "size": pa.array([count], pa.int32()), **wide, "local": pa.nulls(1, pa.int32())}
        | {name: pa.nulls(1, v.type) for name, v in narrow.items()}
    )
    for at in range(0, count, ROWS):
        n = min(ROWS, count - at)
        yield pa.RecordBatch.from_pydict(
            {"chunk": pa.array(np.full(n, chunk, np.int64)), "size": pa.nulls(n, pa.int32())}
            | {name: pa.nulls(n, v.type) for name, v in wide.items()}
            | {"local": pa.array(np.arange(at, at + n, dtype=np.int32))}
            | {name: v.slice(at, n) for name, v in narrow.items()}
        )
