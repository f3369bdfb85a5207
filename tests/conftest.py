import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from riskfeat.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Collect a frame as a sorted list of plain tuples."""

    def collect(df, *columns):
        out = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))

    return collect
