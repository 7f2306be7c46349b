"""Row numbers over a total order of a whole table, without putting it into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.scratch import written

# Fixed value: monotonically_increasing_id keeps the row index within a partition in 33 bits.
_INDEX_BITS = 33


def number_rows(
    df: DataFrame,
    order: list[Column],
    name: str = "position",
    start: int = 1,
    per: list[str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """Add ``name``: consecutive numbers in ``order``, restarting for each value of ``per``.

    ``order`` must be total. The rows are sorted by range partitioning and written once with
    their partition and index. The range bounds are sampled, so they must not be computed twice;
    the written table fixes them and survives lost executors. A run is the rows of one ``per``
    value in one range, and only the run sizes (about one per range and ``per`` value) go
    through a window. A hot ``per`` value spreads over many ranges. ``path`` is where the table
    goes, a fresh folder by default; give one to callers that number again and again.
    """
    per = per or []
    by = [*[F.col(c).asc() for c in per], *order]
    ordered = written(
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("_at", F.monotonically_increasing_id()),
        "numbered",
        path,
    )
    ordered = ordered.withColumn("_range", F.shiftright("_at", _INDEX_BITS))
    runs = ordered.groupBy("_range", *per).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    before = Window.partitionBy(*per).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        F.col("_range").alias("_run_range"),
        *[F.col(c).alias(f"_run_{c}") for c in per],
        "_first",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
    )
    # Without `per` there is one run per range; with it Spark chooses by size.
    if not per:
        offsets = F.broadcast(offsets)
    same_run = F.col("_range") == F.col("_run_range")
    for c in per:
        same_run = same_run & F.col(c).eqNullSafe(F.col(f"_run_{c}"))
    numbered = ordered.join(offsets, same_run)
    position = F.col("_at") - F.col("_first") + F.col("_before") + F.lit(start)
    return numbered.select(*df.columns, position.alias(name))
