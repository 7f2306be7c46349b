"""Connected components of a table of links, by joins and minima over the whole cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewatch.scratch import written


def _stars(links: DataFrame, larger: bool) -> DataFrame:
    """Point the neighbours of each node to the smallest node around it: those above the node
    (``larger``), or those below it and the node itself."""
    if larger:
        around = links.union(links.select("high", "low")).toDF("node", "other")
    else:
        around = links.select(F.col("high").alias("node"), F.col("low").alias("other"))
    smallest = around.groupBy("node").agg(F.min("other").alias("_low"))
    smallest = smallest.select("node", F.least("_low", "node").alias("_low"))
    moved = around.join(smallest, "node")
    if larger:
        moved = moved.where(F.col("other") > F.col("node"))
        return moved.select(F.col("_low").alias("low"), F.col("other").alias("high")).distinct()
    moved = moved.select(F.col("_low").alias("low"), F.col("other").alias("high"))
    own = smallest.select(F.col("_low").alias("low"), F.col("node").alias("high"))
    return moved.union(own).where("low < high").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))
        ).first()
    )


def components(links: DataFrame, low: str, high: str) -> DataFrame:
    """``node, label`` for every node of a link; ``label`` is the smallest node of its component.

    Alternates two star operations until nothing changes. Only a count and a checksum come to
    the driver. Each round is written to the shared folder, so lineage stays short. Links of a
    node to itself and NULL ends are left out; no links give no rows.
    """
    links = links.select(F.least(low, high).alias("low"), F.greatest(low, high).alias("high"))
    links = written(links.where("low < high").distinct(), "links")
    before = _state(links)
    while before[0]:
        links = written(_stars(_stars(links, larger=True), larger=False), "links")
        after = _state(links)
        if after == before:
            break
        before = after
    tops = links.select("low").distinct()
    return links.select(F.col("high").alias("node"), F.col("low").alias("label")).union(
        tops.select("low", "low")
    )
