"""Text files, one record per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def text_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Column ``value``, one row per line, empty lines included. Large files are split."""
    reader = spark.readStream if stream else spark.read
    return reader.text(path)
