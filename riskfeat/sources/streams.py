"""The stream of payment events: files that land in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskfeat import schemas as S


def read_event_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A message-queue source can take its place; everything after it stays the same."""
    reader = spark.readStream.schema(S.EVENT_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def land_events(events: DataFrame, path: str) -> None:
    """Add a batch of events to the folder a stream reads."""
    columns = [F.col(f.name).cast(f.dataType) for f in S.EVENT_SCHEMA.fields]
    events.select(*columns).write.mode("append").parquet(path)
