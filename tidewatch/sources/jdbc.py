"""Reading a summary table over JDBC.

Thin use of Spark's own source. It needs a database and its driver, so tests cover only the
options built here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, user: str, password: str, **extra: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "user": user, "password": password, **extra}


def split_read_options(
    column: str, lower: int, upper: int, partitions: int, fetch_rows: int = 10_000
) -> dict[str, str]:
    """Read a large table in ``partitions`` ranges of a numeric column instead of one task."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_rows),
    }


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Filters such as ``id > mark`` and aggregates on top are pushed to the database by Spark."""
    return spark.read.format("jdbc").options(**options).load()
