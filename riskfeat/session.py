"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

#: Shuffle files of a query go when it ends, not when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


_writing = threading.Lock()
_writers: dict[str, list] = {}


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """``SHUFFLE_CLEANUP`` for writers of several threads: the first one sets it, and the last one puts back what was there."""
    session = spark._jsparkSession.sessionUUID()
    with _writing:
        known = _writers.setdefault(session, [0, spark.conf.get(SHUFFLE_CLEANUP, None)])
        known[0] += 1
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _writing:
            known[0] -= 1
            if not known[0]:
                del _writers[session]
                spark.conf.unset(SHUFFLE_CLEANUP) if known[1] is None else spark.conf.set(SHUFFLE_CLEANUP, known[1])


def local_session(cores: int | str = "*", **extra: str) -> SparkSession:
    """A session for tests and timing runs; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("riskfeat")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _own_scratch() -> str:
    """A folder of this process, removed when it ends."""
    base = tempfile.mkdtemp(prefix="riskfeat-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, which every executor can reach.

    Only a local master may fall back to a folder of its own machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _own_scratch()
    return f"{base.rstrip('/')}/riskfeat/{purpose}-{uuid.uuid4().hex}"
