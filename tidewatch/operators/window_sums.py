"""Windowed counts and sums with a choice of the rule for late records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.operators.strict_late import strict_flags
from tidewatch.operators.windows import NEWEST, closed_only, tumbling_final

WATERMARK = "watermark"
STRICT = "strict"


def tumbling_sums(
    df: DataFrame,
    size: str,
    keys: Sequence[str],
    sums: Mapping[str, Column],
    count: str | None = None,
    grace: str = "0 seconds",
    late: str = WATERMARK,
) -> DataFrame:
    """Final ``window``, keys, sums and row ``count`` of an envelope; batch or stream.

    Ask only for what is used: on a batch, a result that is left unused later keeps Spark from
    sharing the aggregate with the search for the newest time.

    ``late="watermark"`` is Spark's own rule: late rows are found per micro-batch, and a batch,
    which is complete, has none. ``late="strict"`` decides row by row within each source
    partition, in offset order. That needs the rows of a micro-batch together, so for a stream it
    is a sink, ``streaming.strict_windows``, with the same results.
    """
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    df = df.withColumns(dict(sums))
    totals = [F.sum(name).alias(name) for name in sums]
    if count:
        totals.append(F.count(F.lit(1)).alias(count))
    if late == WATERMARK:
        return tumbling_final(df, size, keys, totals, grace=grace)
    if late != STRICT:
        raise ValueError(f"late is {WATERMARK!r} or {STRICT!r}")
    if df.isStreaming:
        raise ValueError("on a stream the strict rule is a sink: streaming.strict_windows.StrictWindows")
    accepted = strict_flags(df, size, grace).filter("accepted")
    totals.append(F.max("timestamp").alias(NEWEST))
    return closed_only(accepted.groupBy("window", *keys).agg(*totals), grace)
