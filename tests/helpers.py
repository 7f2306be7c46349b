"""Small inputs: literal envelope rows, and topics fed file by file."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.scratch import fresh_dir
from tidewatch.sources.envelope import ENVELOPE, from_directory


def records(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Envelope rows from ``(key, value, seconds[, partition[, offset]])``."""
    filled = [(r + (0, i))[:5] if len(r) == 3 else (r + (i,))[:5] for i, r in enumerate(rows)]
    plain = spark.createDataFrame(
        filled, "key string, value string, s double, partition int, offset bigint"
    )
    return plain.select(
        "key",
        "value",
        F.lit("test").alias("topic"),
        "partition",
        "offset",
        F.timestamp_seconds("s").alias("timestamp"),
    ).to(ENVELOPE)


def feed(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    """Add one file to a topic directory."""
    records(spark, rows).coalesce(1).write.mode("append").parquet(path)
    time.sleep(0.02)


def topic(spark: SparkSession, batches: list[list[tuple]]) -> DataFrame:
    """A streaming topic that delivers each list as one micro-batch."""
    path = fresh_dir(spark, "topic")
    at = 0
    for batch in batches:
        rows = [r if len(r) == 5 else (r + (0,))[:4] + (at + i,) for i, r in enumerate(batch)]
        at += len(batch)
        feed(spark, path, rows)
    return from_directory(spark, path, files_per_trigger=1)


def rows_of(df: DataFrame) -> list[tuple]:
    return sorted(tuple(r) for r in df.collect())


def unique(name: str) -> str:
    return f"{name}-{uuid.uuid4().hex}"
