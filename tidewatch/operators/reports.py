"""Totals over a summary table, as read by a periodic report."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, functions as F


def high_mark(table: DataFrame, id_column: str) -> DataFrame:
    """Highest id, 0 for an empty table."""
    return table.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("bigint").alias("latest_id"))


def sink_report(table: DataFrame, id_column: str, value_column: str, since: int) -> DataFrame:
    """Count and sum of the rows with an id above ``since``; the filter reaches the source."""
    return table.filter(F.col(id_column) > since).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.coalesce(F.sum(value_column), F.lit(0.0)).alias("total_value"),
    )


def live_report(
    read_table: Callable[[], DataFrame],
    id_column: str,
    value_column: str,
    emit: Callable[[Row], None],
    every_seconds: float = 5.0,
    reports: int = 1,
) -> None:
    """Report ``reports`` times what was added since the call, one aggregate row at a time."""
    since = high_mark(read_table(), id_column).first()["latest_id"]
    for _ in range(reports):
        time.sleep(every_seconds)
        emit(sink_report(read_table(), id_column, value_column, since).first())
