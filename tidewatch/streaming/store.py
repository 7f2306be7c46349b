"""Tables that a streaming query writes one micro-batch at a time, each visible once committed.

A store is a shared folder. Every micro-batch is a version with a number of its own; its tables are
written first and its commit last. A version without a commit is never read, and the next attempt
replaces it. The commit names the run (the id in the query's checkpoint) and the micro-batch,
so a repeated micro-batch is known, while a fresh checkpoint on the same store goes on behind what
is there: micro-batch 0 of a new run is not taken for micro-batch 0 of the old one.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidewatch.scratch import exists, remove

WriteBatch = Callable[[DataFrame, int], None]

# The properties in which Spark names a query's checkpoint id, and the start of a query.
_QUERY_ID = "sql.streaming.queryId"
_START_ID = "spark.jobGroup.id"

# Commits that are kept; only the newest is ever read.
_KEPT_COMMITS = 2


@dataclass(frozen=True)
class Commit:
    version: int = -1
    #: Newest committed micro-batch of each run.
    batches: dict[str, int] = field(default_factory=dict)
    #: What the writer wants to know next time, for instance a watermark.
    notes: dict = field(default_factory=dict)


def run_id(batch: DataFrame) -> str:
    """The run that a micro-batch belongs to; batches written by hand share one without a name."""
    return batch.sparkSession.sparkContext.getLocalProperty(_QUERY_ID) or ""


class Store:
    """One writer at a time. The newest commit is looked up once, after a start."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._newest: Commit | None = None

    @property
    def newest(self) -> Commit:
        if self._newest is None:
            self._newest = self.refreshed()
        return self._newest

    def refreshed(self) -> Commit:
        """The newest commit as it is in the folder."""
        if not exists(self.spark, f"{self.path}/commits"):
            return Commit()
        rows = self.spark.read.schema("value string, version bigint").text(f"{self.path}/commits")
        last = rows.agg(F.max_by("value", "version").alias("value"), F.max("version").alias("version")).first()
        if last["version"] is None:
            return Commit()
        told = json.loads(last["value"])
        return Commit(last["version"], told["batches"], told["notes"])

    def is_committed(self, run: str, batch_id: int) -> bool:
        return batch_id <= self.newest.batches.get(run, -1)

    def folder(self, kind: str, version: int | None = None) -> str:
        return f"{self.path}/{kind}" + (f"/version={version}" if version is not None else "")

    def put(self, kind: str, rows: DataFrame, *partition_by: str) -> DataFrame:
        """Write a table of the version that is under way, and read it back."""
        folder = self.folder(kind, self.newest.version + 1)
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def commit(self, run: str | None = None, batch_id: int = -1, **notes) -> None:
        """Make the version under way visible, in one file."""
        before = self.newest
        batches = dict(before.batches)
        if run is not None:
            batches[run] = batch_id
        commit = Commit(before.version + 1, batches, before.notes | notes)
        told = json.dumps({"batches": commit.batches, "notes": commit.notes})
        row = self.spark.createDataFrame([(told,)], "value string").coalesce(1)
        row.write.mode("overwrite").text(self.folder("commits", commit.version))
        self._newest = commit
        self.forget("commits", commit.version - _KEPT_COMMITS)

    def version(self, kind: str, schema: str | T.StructType, version: int | None = None, part: str = "") -> DataFrame:
        """A table of one version, the newest by default, or the ``part`` of it in a folder below; empty
        if there is none."""
        version = self.newest.version if version is None else version
        folder = self.folder(kind, version) + (f"/{part}" if part else "")
        if version < 0 or not exists(self.spark, folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(folder)

    def read(self, kind: str, schema: str, after: int = -1) -> DataFrame:
        """The rows of all committed versions above ``after``, with their ``version``."""
        schema = f"{schema}, version bigint"
        if not exists(self.spark, self.folder(kind)):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(self.folder(kind))
        return rows.where((F.col("version") > after) & (F.col("version") <= self.newest.version))

    def forget(self, kind: str, version: int, part: str = "") -> None:
        """Remove a table of an old version, or the ``part`` of it in a folder below."""
        if version >= 0:
            remove(self.spark, self.folder(kind, version) + (f"/{part}" if part else ""))


class StoreOfStart:
    """The store at a path as a sink sees it: opened anew at each start of a query, so that what was
    done to the folder in between is seen."""

    def __init__(self, path: str):
        self.path = path
        self._start: str | None = None
        self._store: Store | None = None

    def open(self, batch: DataFrame) -> tuple[Store, bool]:
        """The store, and whether it has just been opened."""
        start = batch.sparkSession.sparkContext.getLocalProperty(_START_ID)
        if self._store is not None and self._start == start:
            return self._store, False
        self._start, self._store = start, Store(batch.sparkSession, self.path)
        return self._store, True

    def close(self) -> None:
        self._store = None


def committed(store: Store, *branches: Callable[[DataFrame, Store], dict | None]) -> WriteBatch:
    """A ``foreachBatch`` function that hands each micro-batch to all ``branches``, then commits.

    A branch writes with ``store.put`` and may return notes for the commit. The micro-batch is
    computed once for all of them. A repeated micro-batch is skipped if its commit was made, and
    written again if not.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        run = run_id(batch)
        if store.is_committed(run, batch_id):
            return
        batch = batch.persist()
        try:
            notes = {}
            for branch in branches:
                notes |= branch(batch, store) or {}
            store.commit(run, batch_id, **notes)
        finally:
            batch.unpersist()

    return write


def appended(kind: str = "rows", results: Callable[[DataFrame], DataFrame] | None = None):
    """A branch that appends the micro-batch, or ``results`` of it, as a table of the store."""

    def write(batch: DataFrame, store: Store) -> None:
        store.put(kind, results(batch) if results else batch)

    return write
