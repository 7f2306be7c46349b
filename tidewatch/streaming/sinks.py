"""Sinks that can be replayed: a micro-batch written twice leaves the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidewatch.operators.boards import rank_desc
from tidewatch.streaming.runner import NamedQuery
from tidewatch.streaming.store import Store, StoreOfStart, WriteBatch, appended, committed, run_id


def to_kafka(records: DataFrame, servers: str, topic: str) -> DataStreamWriter:
    """Publish key and value to a topic; the broker's partitioner keeps a key together.

    Needs the Kafka connector on the class path, so it is not covered by tests here.
    """
    writer = records.select("key", "value").writeStream.format("kafka").outputMode("append")
    return writer.option("kafka.bootstrap.servers", servers).option("topic", topic)


def to_directory(records: DataFrame, path: str) -> DataStreamWriter:
    """Stand-in for a topic: key and value files in a directory, each record once."""
    return records.select("key", "value").writeStream.format("parquet").option("path", path)


def to_console(df: DataFrame, mode: str = "append") -> DataStreamWriter:
    """Print results; for demonstrations."""
    return df.writeStream.format("console").option("truncate", False).outputMode(mode)


def batch_table(path: str) -> WriteBatch:
    """Table that holds each micro-batch of each run once, see ``streaming.store``."""
    held = StoreOfStart(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        committed(held.open(batch)[0], appended())(batch, batch_id)

    return write


def read_batch_table(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Table written by ``batch_table``, with the columns of ``like`` and the ``version``, which counts
    micro-batches over all runs."""
    return Store(spark, path).read("rows", _ddl(like))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)


def append_missing(
    commits: str,
    keys: list[str],
    rows_of_batch: Callable[[str, int], DataFrame],
    append: Callable[[DataFrame], None],
) -> WriteBatch:
    """Append sink for stores without transactions over a whole batch.

    Rows carry ``run_id`` and ``batch_id``. A micro-batch counts once it is committed in the folder
    ``commits``; a committed one is left out. Only the first micro-batch after a start can have left
    rows behind without a commit, so only then the store is asked for them, by run and batch, and
    those are left out by their keys. A fresh checkpoint is a new run, so its rows are appended.
    """
    held = StoreOfStart(commits)

    def write(batch: DataFrame, batch_id: int) -> None:
        run = run_id(batch)
        store, after_start = held.open(batch)
        if store.is_committed(run, batch_id):
            return
        rows = batch.withColumns(
            {"run_id": F.lit(run), "batch_id": F.lit(batch_id).cast("bigint")}
        )
        if after_start:
            there = rows_of_batch(run, batch_id).select(*keys)
            rows = rows.join(there, keys, "left_anti")
        try:
            append(rows)
        except Exception:
            # Whatever this attempt has left behind is looked up by the next one.
            held.close()
            raise
        store.commit(run, batch_id)

    return write


def to_jdbc(
    spark: SparkSession, options: dict[str, str], keys: list[str], commits: str, connections: int = 16
) -> WriteBatch:
    """Append to a JDBC table that has columns ``run_id`` and ``batch_id``; at most ``connections``
    writers. ``commits`` is a shared folder.

    Parameters are bound by Spark, no SQL text is put together from data. Needs a database, so
    only ``append_missing`` below it is covered by tests here.
    """

    def rows_of_batch(run: str, batch_id: int) -> DataFrame:
        table = spark.read.format("jdbc").options(**options).load()
        return table.filter((F.col("run_id") == run) & (F.col("batch_id") == batch_id))

    def append(rows: DataFrame) -> None:
        writer = rows.write.format("jdbc").options(**options, numPartitions=str(connections))
        writer.mode("append").save()

    return append_missing(commits, keys, rows_of_batch, append)


_BOARD = "member string, score double"


def board_table(path: str, fold_every: int = 20) -> WriteBatch:
    """Board for ``update`` mode: one score for each member, the newest that was written.

    Each micro-batch adds the absolute scores of the members that it changed, so a repeated one can't
    count twice. Every ``fold_every`` micro-batches all of them are folded into a snapshot and what
    the snapshot before held is removed, so the number of files is bounded.
    """
    held = StoreOfStart(path)

    def fold(batch: DataFrame, store: Store) -> dict:
        return fold_board(batch, store, fold_every)

    def write(batch: DataFrame, batch_id: int) -> None:
        committed(held.open(batch)[0], fold)(batch, batch_id)

    return write


def fold_board(changed: DataFrame, store: Store, fold_every: int = 20) -> dict:
    """The branch behind ``board_table``: ``member, score`` of changed members go into ``store``."""
    _forget_before(store)
    changes = store.put("changes", changed.select("member", F.col("score").cast("double").alias("score")))
    under_way = store.newest.version + 1
    snapshot = store.newest.notes.get("snapshot", -1)
    if under_way - snapshot < fold_every:
        return {}
    latest = board_of(store).select("member", "score", F.lit(0).alias("at"))
    latest = latest.union(changes.select("member", "score", F.lit(1)))
    store.put("snapshots", latest.groupBy("member").agg(F.max_by("score", "at").alias("score")))
    return {"snapshot": under_way, "snapshot_before": snapshot}


def running_board(member: str, score: Column, fold_every: int = 20):
    """A branch that adds ``score`` of each record to the board's score of its ``member``."""

    def write(batch: DataFrame, store: Store) -> dict:
        added = batch.select(F.col(member).alias("member"), score.cast("double").alias("score"))
        added = added.where(F.col("member").isNotNull()).groupBy("member").agg(F.sum("score").alias("score"))
        held = board_of(store).select("member", F.col("score").alias("_held"))
        total = F.col("score") + F.coalesce("_held", F.lit(0.0))
        return fold_board(added.join(held, "member", "left").select("member", total.alias("score")), store, fold_every)

    return write


def _forget_before(store: Store) -> None:
    """Remove what only the snapshot before the last one needed; readers may still use that one."""
    last = store.newest.notes.get("snapshot_before", -1)
    first = store.newest.notes.get("removed", -1) + 1
    for version in range(first, last + 1):
        store.forget("changes", version)
        if version < last:
            store.forget("snapshots", version)
    store.newest.notes["removed"] = last


def board_of(store: Store) -> DataFrame:
    """``member, score`` as of the newest commit."""
    snapshot = store.newest.notes.get("snapshot", -1)
    changes = store.read("changes", _BOARD, after=snapshot)
    held = store.version("snapshots", _BOARD, snapshot).withColumn("version", F.lit(-1).cast("bigint"))
    return held.union(changes).groupBy("member").agg(F.max_by("score", "version").alias("score"))


def read_board(spark: SparkSession, path: str) -> DataFrame:
    """``member, score`` of a board written by ``board_table``, as of its newest commit."""
    return board_of(Store(spark, path))


def reset_board(spark: SparkSession, path: str) -> None:
    """Empty a board; what is written later stays. Only while no query writes to it."""
    store = Store(spark, path)
    store.put("snapshots", spark.createDataFrame([], _BOARD))
    now = store.newest.version + 1
    store.commit(snapshot=now, snapshot_before=store.newest.notes.get("snapshot", -1))
    _forget_before(store)


def report_board(
    totals: DataFrame,
    progress: NamedQuery,
    report: Callable[[DataFrame, int], None],
    every: str | None = "5 seconds",
) -> StreamingQuery:
    """Rank a streaming board at every trigger and hand the ranking, a batch, to ``report``.

    The ranking is kept next to the checkpoint until two triggers later, so that a report may be
    read a little longer. A board is computed once a trigger, although the ranges of the ranking are
    sampled first.
    """

    def rank(board: DataFrame, batch_id: int) -> None:
        board = board.persist()
        try:
            ranking = rank_desc(board, f"{progress.checkpoint}-ranking-{batch_id % 3}")
        finally:
            board.unpersist()
        report(ranking, batch_id)

    writer = totals.writeStream.outputMode("complete").foreachBatch(rank)
    return progress.start(writer, totals.sparkSession, every)
