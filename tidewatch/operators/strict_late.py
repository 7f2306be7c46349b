"""Late records by the exact rule: record by record, per source partition.

The stream time of a source partition is the newest time among its records so far, in offset
order. A record is accepted if its window ends, with grace, after the stream time. Spark's own
watermark moves only between micro-batches, and follows the newest record of all partitions.

A source partition is cut into chunks of ``chunk_rows`` offsets, so that a partition that holds a
third of all records is spread over many tasks. What happens inside a chunk is decided locally;
from earlier chunks only their newest time (the carry) is needed. On a stream the newest times
of the micro-batches before are one more carry, see ``streaming/strict_windows.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

CHUNK_ROWS = 500_000


def _chunk(partition: str, offset: str, chunk_rows: int) -> Column:
    """The chunk of a row; the rule is defined by offsets, so a row without one is an error."""
    placed = F.col(partition).isNotNull() & F.col(offset).isNotNull()
    unplaced = F.raise_error(F.lit("the strict rule needs a partition and an offset for each record"))
    return F.when(placed, F.expr(f"`{offset}` div {chunk_rows}")).otherwise(unplaced.cast("bigint"))


def strict_flags(
    df: DataFrame,
    size: str,
    grace: str = "0 seconds",
    ts: str = "timestamp",
    partition: str = "partition",
    offset: str = "offset",
    chunk_rows: int = CHUNK_ROWS,
    carried: DataFrame | None = None,
) -> DataFrame:
    """Every row with its ``window``, ``stream_time`` and ``accepted``.

    ``carried`` has the newest time ``newest`` of each ``partition`` before these rows, if there were
    any. The rows are shuffled once, by (partition, chunk), for the running maximum, and meet
    the carries on the same partitioning. The window over carries sees one row per chunk.
    """
    rows = df.withColumn("_chunk", _chunk(partition, offset, chunk_rows))
    so_far = (
        Window.partitionBy(partition, "_chunk")
        .orderBy(offset)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    earlier = (
        Window.partitionBy(partition).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    newest = rows.groupBy(partition, "_chunk").agg(F.max(ts).alias("_newest"))
    if carried is not None:
        before = carried.select(
            F.col("partition").alias(partition), F.lit(-1).cast("bigint").alias("_chunk"), "newest"
        )
        newest = newest.union(before)
    carries = newest.select(partition, "_chunk", F.max("_newest").over(earlier).alias("_carry"))
    local = rows.withColumn("_local", F.max(ts).over(so_far))
    timed = local.join(carries, [partition, "_chunk"]).withColumn(
        "stream_time", F.greatest("_local", "_carry")
    )
    window = F.window(ts, size)
    limit = F.col("window.end") + F.expr(f"INTERVAL {grace}")
    return (
        timed.withColumn("window", window)
        .withColumn("accepted", limit > F.col("stream_time"))
        .select(*df.columns, "window", "stream_time", "accepted")
    )
