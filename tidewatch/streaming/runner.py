"""Starting, waiting for and stopping streaming queries."""

from __future__ import annotations

import contextlib
import io
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidewatch.scratch import fresh_dir

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# With a changelog, a state partition commits what a micro-batch changed instead of a snapshot of its files.
_CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


@contextlib.contextmanager
def _stream_settings(spark: SparkSession) -> Iterator[None]:
    """Settings a query takes over when it starts; the session gets its own back afterwards.

    State lives in RocksDB, off the heap and on disk. The number of state partitions is the
    session's number of shuffle partitions when a checkpoint is first used.
    """
    settings = {"spark.sql.streaming.stateStore.providerClass": STATE_PROVIDER, _CHANGELOG: "true"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@dataclass
class NamedQuery:
    """A named unit of progress. The same name and checkpoint resume where it stopped; a fresh
    checkpoint starts over."""

    name: str
    checkpoint: str

    @staticmethod
    def fresh(spark: SparkSession, name: str) -> NamedQuery:
        return NamedQuery(name, fresh_dir(spark, f"{name}-checkpoint"))

    def start(self, writer: DataStreamWriter, spark: SparkSession, every: str | None = None) -> StreamingQuery:
        """Start; ``every`` is the trigger interval, none means all that is available now."""
        trigger = {"processingTime": every} if every else {"availableNow": True}
        writer = writer.queryName(self.name).option("checkpointLocation", self.checkpoint)
        with _stream_settings(spark):
            return writer.trigger(**trigger).start()


def finish(query: StreamingQuery, timeout_seconds: float | None = None) -> StreamingQuery:
    """Wait for a query and stop it; raises its error, or if it did not end within a given time."""
    try:
        if timeout_seconds is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout_seconds):
            raise TimeoutError(f"query {query.name} did not end within {timeout_seconds} s")
        return query
    finally:
        query.stop()


def run_to_table(stream: DataFrame, name: str, progress: NamedQuery | None = None, path: str | None = None) -> DataFrame:
    """Run an append-mode stream over all that is available and return its output table.

    The file sink writes each result once, from the executors, into the shared folder.
    """
    spark = stream.sparkSession
    progress = progress or NamedQuery.fresh(spark, name)
    path = path or fresh_dir(spark, name)
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    finish(progress.start(writer, spark))
    return spark.read.schema(stream.schema).parquet(path)


def run_batches(
    stream: DataFrame,
    name: str,
    write: Callable[[DataFrame, int], None],
    mode: str = "append",
    progress: NamedQuery | None = None,
) -> StreamingQuery:
    """Run a stream over all that is available, handing each micro-batch to ``write``."""
    spark = stream.sparkSession
    progress = progress or NamedQuery.fresh(spark, name)
    writer = stream.writeStream.outputMode(mode).foreachBatch(write)
    return finish(progress.start(writer, spark))


def tap(df: DataFrame, name: str, *metrics: Column) -> DataFrame:
    """Observe a stream or batch without changing it: the number of records, or ``metrics``."""
    return df.observe(name, *(metrics or [F.count(F.lit(1)).alias("records")]))


def observed(query: StreamingQuery, name: str) -> list[Row]:
    """What a ``tap`` or the decoding has counted, for each of the last hundred triggers at most;
    ``counters.Counters`` has totals over all of them."""
    progress = [p["observedMetrics"] for p in query.recentProgress]
    return [metrics[name] for metrics in progress if name in metrics]


def describe(df: DataFrame, mode: str = "formatted") -> str:
    """The plan as text, before anything runs; ``mode`` as for ``DataFrame.explain``."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()
