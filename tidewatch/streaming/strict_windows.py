"""Windowed sums of a stream under the strict late rule, as a branch of a committed store.

For each source partition the store holds the newest time so far, and for each open window and
key the sums so far. A micro-batch is decided by SQL expressions as on a batch, with the newest
times of before as a carry, and only its partial sums meet the open windows.

A window is final once no source partition can still add to it: the low water, the oldest of the
partitions' newest times, has reached its end plus grace. A partition that lags behind the newest
by more than ``idle`` does not hold the others back; without ``idle`` every known partition does.
Partitions are known from ``partitions``, or else from their first record. A micro-batch need not
have records of all of them, so without ``partitions`` the first one may publish too early.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewatch.operators.strict_late import CHUNK_ROWS, strict_flags
from tidewatch.streaming.store import Store

_NEVER = -(2**62)
_FRONTIER = "partition bigint, newest timestamp, n bigint, dropped bigint"


class StrictWindows:
    """``StrictWindows(...)(batch, store)`` takes a micro-batch into the store.

    ``sums`` are columns of the batch. Rows without a key leave before the rule, as on a batch. Rows for
    a window that has been published, which only ``idle`` or a partition that was not known makes
    possible, count as dropped. One of ``partitions`` without a record so far is taken to be where the
    first micro-batch was. ``then`` gets the windows that a micro-batch closes, before its commit.
    """

    def __init__(
        self,
        size: str,
        keys: Sequence[str],
        sums: Mapping[str, Column],
        grace: str = "0 seconds",
        idle: str | None = None,
        name: str = "windows",
        chunk_rows: int = CHUNK_ROWS,
        then: Callable[[DataFrame, Store], None] | None = None,
        partitions: Sequence[int] | None = None,
    ):
        self.size, self.keys, self.sums, self.grace = size, list(keys), dict(sums), grace
        self.idle, self.name, self.chunk_rows, self.then = idle, name, chunk_rows, then
        self.partitions = sorted(set(partitions or []))

    def __call__(self, batch: DataFrame, store: Store) -> dict:
        rows = batch
        for key in self.keys:
            rows = rows.where(F.col(key).isNotNull())
        rows = rows.withColumns(self.sums)
        before = store.version(f"{self.name}-frontier", _FRONTIER)
        published = self._published(store)
        flags = strict_flags(rows, self.size, self.grace, chunk_rows=self.chunk_rows, carried=before)
        accepted = F.coalesce(F.col("accepted") & (self._expiry() > published), F.lit(False))

        def if_accepted(column: str) -> Column:
            return F.when(F.col("_in"), F.col(column)).alias(column)

        # One pass over the rows; everything below reads their partial sums.
        partials = (
            flags.withColumn("_in", accepted)
            .groupBy(F.col("partition").cast("bigint").alias("partition"), F.col("_in"), *map(if_accepted, ["window", *self.keys]))
            .agg(
                F.count(F.lit(1)).alias("n"),
                *[F.sum(name).alias(name) for name in self.sums],
                F.max("timestamp").alias("newest"),
            )
        )
        partials = store.put(f"{self.name}-partials", partials.withColumnRenamed("_in", "is_in"))
        dropped = F.sum(F.when(F.col("is_in"), 0).otherwise(F.col("n")))
        here = partials.groupBy("partition").agg(
            F.max("newest").alias("newest"), F.sum("n").alias("n"), dropped.alias("dropped")
        )
        frontier = before.union(here).groupBy("partition").agg(
            F.max("newest").alias("newest"), F.sum("n").alias("n"), F.sum("dropped").alias("dropped")
        )
        frontier = store.put(f"{self.name}-frontier", frontier)
        low, since = self._low_water(frontier, (store.newest.notes.get(self.name) or {}).get("since"))
        limit = max(low, published)
        fresh = partials.where("is_in").select("window", *self.keys, "n", *self.sums)
        # Sums keep the type they have on a batch, however often they are added up again.
        kinds = {f.name: f.dataType for f in fresh.schema}
        open_before = self._open(store, fresh.schema)
        self._close(store, open_before.union(fresh), kinds, limit)
        self._forget(store)
        return {self.name: {"published": limit, "since": since, "schema": fresh.schema.json()}}

    def publish_rest(self, store: Store) -> None:
        """Say that every source partition is idle: all windows up to the newest time are final.

        For the end of an input, where a batch would publish them. Committed on its own.
        """
        known = store.newest.notes.get(self.name)
        if not known:
            return
        frontier = store.version(f"{self.name}-frontier", _FRONTIER)
        limit = frontier.agg(F.max(F.unix_micros("newest"))).first()[0]
        schema = T.StructType.fromJson(json.loads(known["schema"]))
        kinds = {f.name: f.dataType for f in schema}
        store.put(f"{self.name}-frontier", frontier)
        self._close(store, self._open(store, schema), kinds, max(limit, known["published"]))
        self._forget(store)
        store.commit(**{self.name: known | {"published": max(limit, known["published"])}})

    def results(self, store: Store) -> DataFrame:
        """``window``, keys, ``n`` and sums of the final windows so far."""
        known = store.newest.notes.get(self.name)
        if not known:
            raise ValueError("no micro-batch has been committed")
        schema = T.StructType.fromJson(json.loads(known["schema"]))
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        rows = store.read(self.name, f"{ddl}, closed boolean").where("closed")
        return rows.select(*schema.names)

    def counts(self, store: Store) -> DataFrame:
        """``partition, newest, n, dropped``: newest time, records and dropped ones of each partition."""
        return store.version(f"{self.name}-frontier", _FRONTIER)

    def _published(self, store: Store) -> int:
        known = store.newest.notes.get(self.name)
        return known["published"] if known else _NEVER

    def _expiry(self) -> Column:
        """When a window is final, in microseconds."""
        return F.unix_micros(F.col("window.end") + F.expr(f"INTERVAL {self.grace}"))

    def _low_water(self, frontier: DataFrame, since: int | None) -> tuple[int, int | None]:
        """The low water, and where it would have been after the first micro-batch (``since``, if known)."""
        newest = F.unix_micros("newest")
        told = frontier.where(F.col("newest").isNotNull())
        alive_from = F.unix_micros(F.max("newest") - F.expr(f"INTERVAL {self.idle or '0 seconds'}"))
        heard = F.count(F.when(F.col("partition").isin(self.partitions), 1))
        low, alive_from, heard = told.agg(F.min(newest), alive_from, heard).first()
        if low is None:
            return _NEVER, since
        since = low if since is None else since
        if heard < len(self.partitions) and (self.idle is None or since >= alive_from):
            return _NEVER, since
        if self.idle is not None:
            low = told.where(newest >= alive_from).agg(F.min(newest)).first()[0]
        return low, since

    def _open(self, store: Store, schema: T.StructType) -> DataFrame:
        return store.version(self.name, schema, part="closed=false")

    def _close(self, store: Store, sums: DataFrame, kinds: dict[str, T.DataType], limit: int) -> None:
        totals = sums.groupBy("window", *self.keys).agg(
            *[F.sum(name).cast(kinds[name]).alias(name) for name in ["n", *self.sums]]
        )
        totals = totals.select(*kinds, (self._expiry() <= limit).alias("closed"))
        written = store.put(self.name, totals, "closed")
        if self.then:
            self.then(written.where("closed").drop("closed"), store)

    def _forget(self, store: Store) -> None:
        """Tables that only the version before needed. The one under way needs the newest."""
        old = store.newest.version - 1
        store.forget(f"{self.name}-partials", old)
        store.forget(f"{self.name}-frontier", old)
        store.forget(self.name, old, "closed=false")
