import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs or dicts, with a column whose name may clash with ours."""

    def make(rows, **more):
        rows = [r if isinstance(r, dict) else {"doc_id": r[0], "text": r[1]} for r in rows]
        full = [
            (r["doc_id"], r["text"], r.get("lang"), r.get("source"), 1, "x", "y", 5) for r in rows
        ]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n long, key string, start string, size long"
        )

    return make


FILL = " ".join(f"w{i}" for i in range(400))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, blank and long texts, repeated rows, repeated ids, exact and near copies."""
    long = " ".join(f"a{i % 997}b{i % 13}" for i in range(60_000))
    base = [f"w{i}" for i in range(60)]
    near = base[:30] + ["changed"] + base[31:]
    lines = "\n".join(f"line {i} of it" for i in range(9))
    return [
        (None, None), (None, "alone with no id but words enough to see"), (1, None), (2, ""), (3, " \n\t "),
        (4, long), (5, long), (6, " ".join(base)), (6, " ".join(base)), (6, "another text of the same id"),
        (7, " ".join(near)), (8, " ".join(base)), (9, FILL), (10, "x " * 500), (11, lines), (12, "start\n" + lines + "\nend"),
        (13, lines + "\n" + lines), (14, "one two three"), (15, "ONE two\tthree"), (16, "one two"), (17, "\n\n\n\n"),
        (18, "é " * 30 + "\u00a0 \u2028"), (19, " ".join(base[5:45]) + " tail"), (20, "A" * 200_000), (21, "\x00 \x1f"),
    ]
