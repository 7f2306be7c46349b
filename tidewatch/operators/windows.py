"""Tumbling windows that publish one final result per window and key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

NEWEST = "_newest"


def tumbling_final(
    df: DataFrame,
    size: str,
    keys: Sequence[str],
    aggs: Sequence[Column],
    ts: str = "timestamp",
    grace: str = "0 seconds",
) -> DataFrame:
    """Aggregate per epoch-aligned window ``[start, end)`` and key; final results only.

    Rows without a key leave the aggregate. On a stream a window is published when the
    watermark reaches its end plus ``grace`` and rows that come later are dropped; the watermark
    moves between micro-batches. On a batch the windows that a stream would have published are
    returned: those that end, with grace, no later than the newest row. Only keys and partial
    aggregates are shuffled, so a hot key costs one row per window and input task.
    """
    rows = df
    for key in keys:
        rows = rows.filter(F.col(key).isNotNull())
    windows = F.window(ts, size).alias("window")
    if df.isStreaming:
        return rows.withWatermark(ts, grace).groupBy(windows, *keys).agg(*aggs)
    return closed_only(rows.groupBy(windows, *keys).agg(*aggs, F.max(ts).alias(NEWEST)), grace)


def closed_only(windowed: DataFrame, grace: str = "0 seconds") -> DataFrame:
    """Windows that are closed once all rows have been seen.

    ``windowed`` has a column ``_newest``, the newest time in each window and key. The newest of
    all is a scalar over the same aggregate. It is taken together with the other columns, and
    compared after the aggregate, so that both uses have one plan and the rows are read and
    shuffled once.
    """
    others = [c for c in windowed.columns if c != NEWEST]
    newest = windowed.agg(F.max(F.struct(NEWEST, *others)).alias("last")).select(
        F.col(f"last.{NEWEST}") - F.expr(f"INTERVAL {grace}")
    )
    last_needed = F.greatest(F.col("window.end"), F.col(NEWEST))
    return windowed.filter(last_needed <= newest.scalar()).drop(NEWEST)


def above(windowed: DataFrame, measure: str, threshold: int) -> DataFrame:
    """Threshold on a final result; strictly greater."""
    return windowed.filter(F.col(measure) > threshold)
