"""Looking into the state of a query through its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def state_view(spark: SparkSession, checkpoint: str, operator_id: int = 0) -> DataFrame:
    """Columns ``key``, ``value`` and ``partition_id`` of one stateful operator."""
    reader = spark.read.format("statestore").option("operatorId", operator_id)
    return reader.load(checkpoint)
