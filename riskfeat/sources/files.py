"""Landing files in, parquet tables out."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from riskfeat import schemas as S
from riskfeat.session import scratch_dir, shuffles_dropped
from riskfeat.sources.commits import CommitLog, Stale


def _read_csv(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """Columns go by position, the header is skipped, a malformed row fails the load."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_transactions(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _read_csv(spark, path, S.TXN_SCHEMA)


def with_row_key(df: DataFrame, load: int = 0) -> DataFrame:
    """Adds ``event_key`` to rows just read from files, which have no key of their own.

    It tells copies of a row apart, breaks ties and orders samples. Write the result before
    using it: the numbers follow the layout of the files. ``load`` tells loads apart.
    """
    return df.withColumn("event_key", F.concat(F.lit(f"{load}-"), F.monotonically_increasing_id()))


def read_accounts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _read_csv(spark, path, S.ACCOUNT_SCHEMA)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at ``path``, or None where nothing has been written."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def spread(df: DataFrame, *key: str) -> DataFrame:
    """Spread rows read from fewer file splits than there are cores; else ``df`` as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *key)


def _write(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """A new table, compressed with zstd; the shuffle files that its rows came by go when it is written."""
    with shuffles_dropped(df.sparkSession):
        df.write.mode("errorifexists").option("compression", "zstd").partitionBy(*by).parquet(path)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: a short plan over a
    plain scan for jobs that pass over the same rows several times."""
    path = scratch_dir(df.sparkSession, purpose)
    _write(df, path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def held(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """``staged`` for as long as the block lasts; what it returns must not read the table."""
    path = scratch_dir(df.sparkSession, purpose)
    try:
        _write(df, path)
        yield df.sparkSession.read.parquet(path)
    finally:
        remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever the session's file systems keep it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def landing_files(spark: SparkSession, landing: str) -> DataFrame:
    """(file, size, changed) of the files in a landing folder."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(landing)
        .select(F.col("path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("changed"))
        .where(~F.element_at(F.split("file", "/"), -1).rlike("^[._]"))
    )


def _paths(spark: SparkSession, path: str, folders: Sequence[str]) -> DataFrame:
    return spark.read.parquet(*[f"{path}/{folder}" for folder in folders])


def load_new(
    spark: SparkSession, landing: str, path: str, make: Callable[[list[str], int], DataFrame]
) -> bool:
    """Append the landing files that were not loaded yet; True when there were any.

    Path, size and time of every loaded file are kept, so a file that arrives later, or changes, is
    loaded then, and none is loaded twice. ``make(files, number)`` reads them. A load's rows and list of files have
    folders of their own, which count once its commit names them. Of two loaders at a time the slower one
    starts anew from what the other has left.
    """
    log = CommitLog(spark, f"{path}/loads")
    while True:
        before = log.entries()
        present = landing_files(spark, landing)
        if before:
            manifest = _paths(spark, path, [e["files"] for e in before])
            present = present.join(manifest, ["file", "size", "changed"], "left_anti")
        new = present.orderBy("file").collect()
        if not new:
            return False
        number = before[-1]["number"] if before else 0
        mine = uuid.uuid4().hex
        folders = {"rows": f"rows/{number}-{mine}", "files": f"files/{number}-{mine}"}
        folders["n_rows"] = written(make([row["file"] for row in new], number), f"{path}/{folders['rows']}")["rows"]
        spark.createDataFrame(new, present.schema).coalesce(1).write.parquet(f"{path}/{folders['files']}")

        def commit(now: list[dict]) -> dict:
            if len(now) != len(before):
                raise Stale
            return folders

        try:
            log.append(commit)
            return True
        except Stale:
            for kind in ("rows", "files"):
                remove(spark, f"{path}/{folders[kind]}")


def loaded(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all loads that were committed."""
    return _paths(spark, path, [e["rows"] for e in CommitLog(spark, f"{path}/loads").entries()])


def loaded_rows(spark: SparkSession, path: str) -> int:
    """How many rows all loads have, as their commits say."""
    return sum(e["n_rows"] for e in CommitLog(spark, f"{path}/loads").entries())


def _versions(spark: SparkSession, root: str, name: str) -> CommitLog:
    return CommitLog(spark, f"{root}/{name}/versions")


def versions(spark: SparkSession, root: str, name: str) -> list[dict]:
    """Commits of all versions of a table, oldest first, with their ``number`` and what was ``seen``."""
    return _versions(spark, root, name).entries()


def current_version(spark: SparkSession, root: str, name: str) -> int:
    """Number of the newest complete version, 0 before the first."""
    return _versions(spark, root, name).last()


def written(df: DataFrame, path: str, by: Sequence[str] = (), stats: Mapping[str, Column] | None = None) -> dict:
    """Write a table; what it holds is seen while it is written: its number of ``rows``, and ``stats`` over them.

    Statistics are aggregates without distinct, and come as whole numbers or text.
    """
    found = Observation()
    extra = {k: c.cast("string") for k, c in (stats or {}).items()}
    seen = df.observe(found, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in extra.items()])
    _write(seen, path, by)
    row = dict(found.get)
    if "rows" not in row:  # a plan that was found to be empty has not been run
        row = {"rows": 0, **dict.fromkeys(extra)}
    return row


def write_version(
    df: DataFrame, root: str, name: str, by: Sequence[str] = (), stats: Mapping[str, Column] | None = None
) -> int:
    """Write a new version beside the old ones, then make it the current one; returns its number.

    It takes effect with the last step, one commit: a job that dies before leaves the table as it was, and a job
    may read the table it replaces. Of two writers each gets a version of its own, the one that commits
    first the smaller number. ``by`` partitions the table. The commit keeps the number of rows, and ``stats``
    over them, as seen by the writing pass.
    """
    folder = f"v-{uuid.uuid4().hex}"
    seen = written(df, f"{root}/{name}/{folder}", by, stats)
    return _versions(df.sparkSession, root, name).append(lambda _: {"folder": folder, "seen": seen})["number"]


def version_stats(spark: SparkSession, root: str, name: str) -> dict:
    """What the writing pass of the current version saw: ``rows`` and its other statistics."""
    return _versions(spark, root, name).entries()[-1]["seen"]


def read_version(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """The table at a version, by default the current one."""
    entries = _versions(spark, root, name).entries()
    wanted = [e for e in entries if version is None or e["number"] == version]
    if not wanted:
        raise FileNotFoundError(f"{root}/{name} has no version {version or ''}".rstrip())
    return spark.read.parquet(f"{root}/{name}/{wanted[-1]['folder']}")


def write_partitioned(df: DataFrame, path: str, columns: list[str]) -> None:
    """Replace only the partitions that occur in ``df``, so a rerun leaves the same rows."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def write_predictions(df: DataFrame, path: str, as_of: str) -> None:
    """Scores in the folder of their run; a rerun replaces its own rows and no others."""
    run = F.lit(as_of).cast("timestamp_ntz")
    stamped = (
        df.withColumn("scored_at", run)
        .withColumn("event_date", F.to_date("event_ts"))
        .withColumn("run", F.date_format(run, "yyyy-MM-dd'T'HH-mm-ss"))
    )
    write_partitioned(stamped, path, ["run"])


def read_predictions(spark: SparkSession, path: str, key: str = "event_key") -> DataFrame:
    """The newest score of every event, over all runs."""
    runs = spark.read.parquet(path).drop("run")
    rest = [c for c in runs.columns if c not in (key, "scored_at")]
    newest = F.max(F.struct("scored_at", *rest)).alias("row")
    return runs.groupBy(key).agg(newest).select(key, "row.*").select(runs.columns)
