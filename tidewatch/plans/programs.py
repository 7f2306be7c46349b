"""The five patterns as running programs: a source, a pattern, sinks and a checkpoint each.

Sources are envelope streams. ``publish`` makes a topic writer, for instance
``lambda records, topic: to_kafka(records, servers, topic)``; ``write`` is a micro-batch
sink such as ``to_jdbc`` or ``batch_table``. Programs return the started query; ``every`` is the
trigger interval, none processes what is available and ends. ``partitions`` names the partitions of
the topic, which the strict rule for late records waits for; see ``streaming.strict_windows``.

Programs with two outputs are one query: each micro-batch is read and decoded once, its outputs go
into one committed store, and a repeated micro-batch changes none of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidewatch.functions import codecs
from tidewatch.operators.dead_letters import good_records
from tidewatch.operators.window_sums import STRICT, WATERMARK
from tidewatch.plans import patterns
from tidewatch.streaming.runner import NamedQuery
from tidewatch.streaming.sinks import WriteBatch, board_table, running_board
from tidewatch.streaming.store import StoreOfStart, appended, committed
from tidewatch.streaming.strict_windows import StrictWindows

Publish = Callable[[DataFrame, str], DataStreamWriter]

# Tables of the stores that programs write.
MINUTES = "user-minutes"


def _to(results: DataFrame, write: WriteBatch, mode: str) -> DataStreamWriter:
    return results.writeStream.outputMode(mode).foreachBatch(write)


def into_store(records: DataFrame, path: str, progress: NamedQuery, every: str | None, *branches) -> StreamingQuery:
    """Start one query whose micro-batches go through all ``branches`` into the store at ``path``."""
    held = StoreOfStart(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        committed(held.open(batch)[0], *branches)(batch, batch_id)

    return progress.start(_to(records, write, "append"), records.sparkSession, every)


def order_analytics(
    orders: DataFrame,
    write: WriteBatch,
    progress: NamedQuery,
    every: str | None = None,
    size: str = patterns.ORDER_WINDOW,
    grace: str = "0 seconds",
    on_error: str = "dead_letter",
    late: str = WATERMARK,
    idle: str | None = None,
    partitions: Sequence[int] | None = None,
) -> StreamingQuery:
    """Order value per product and window into a table. With ``late="strict"`` open windows are kept
    in a store next to the checkpoint; ``idle`` and ``partitions`` are for that rule only."""
    if late != STRICT:
        summary = patterns.order_summary(orders, size, grace, on_error, late)
        return progress.start(_to(summary, write, "append"), orders.sparkSession, every)
    good = good_records(codecs.decode_orders(orders), on_error)

    def then(closed: DataFrame, store) -> None:
        write(patterns.as_order_summary(closed), store.newest.version + 1)

    windows = StrictWindows(size, ["product"], patterns.order_value(), grace, idle, then=then, partitions=partitions)
    return into_store(good, f"{progress.checkpoint}-windows", progress, every, windows)


def alerting(
    alerts: DataFrame,
    path: str,
    progress: NamedQuery,
    every: str | None = None,
    size: str = patterns.ALERT_WINDOW,
    threshold: int = patterns.HIGH_VOLUME,
    grace: str = "0 seconds",
    on_error: str = "dead_letter",
    idle: str | None = None,
    publish: Callable[[DataFrame, str], None] | None = None,
    partitions: Sequence[int] | None = None,
) -> StreamingQuery:
    """Critical alerts and high-volume codes, each a topic table of the store at ``path``.

    High volumes follow the strict rule for late records. ``publish(records, topic)`` sends the records
    of a micro-batch on as well, for instance with Spark's Kafka writer; it may see them twice.
    """
    good = good_records(codecs.decode_alerts(alerts), on_error)

    def put(records: DataFrame, topic: str, store) -> None:
        written = store.put(topic, records)
        if publish:
            publish(written, topic)

    def critical(batch: DataFrame, store) -> None:
        put(patterns.as_critical(batch), patterns.CRITICAL_TOPIC, store)

    def then(closed: DataFrame, store) -> None:
        put(patterns.as_high_volume(closed, threshold), patterns.HIGH_VOLUME_TOPIC, store)

    windows = StrictWindows(size, ["code"], {}, grace, idle, name="code-counts", then=then, partitions=partitions)
    return into_store(good, path, progress, every, critical, windows)


def leaderboard(
    scores: DataFrame,
    board_path: str,
    progress: NamedQuery,
    every: str | None = None,
    on_error: str = "dead_letter",
) -> StreamingQuery:
    """Running totals into a board; ``reset_board`` and a fresh checkpoint start over."""
    writer = _to(patterns.player_totals(scores, on_error), board_table(board_path), "update")
    return progress.start(writer, scores.sparkSession, every)


def prediction(
    reviews: DataFrame,
    scorer: Callable[[Column], Column],
    publish: Publish,
    progress: NamedQuery,
    every: str | None = None,
) -> StreamingQuery:
    """Labels of texts to a topic, under the keys of the texts."""
    labelled = publish(patterns.predictions(reviews, scorer), patterns.SENTIMENT_TOPIC)
    return progress.start(labelled, reviews.sparkSession, every)


def view_analytics(
    views: DataFrame,
    path: str,
    progress: NamedQuery,
    every: str | None = None,
    size: str = patterns.VIEW_WINDOW,
    grace: str = "0 seconds",
    on_error: str = "dead_letter",
    idle: str | None = None,
    partitions: Sequence[int] | None = None,
) -> StreamingQuery:
    """Minutes per user and window, and a board of the most viewed topics, in the store at ``path``:
    table ``MINUTES`` and ``sinks.read_board``. Windows follow the strict rule for late records."""
    good = good_records(codecs.decode_views(views), on_error)

    def then(closed: DataFrame, store) -> None:
        store.put(MINUTES, patterns.as_user_minutes(closed))

    windows = StrictWindows(size, ["user"], patterns.view_minutes(), grace, idle, then=then, partitions=partitions)
    return into_store(good, path, progress, every, windows, running_board("view_topic", F.lit(1)))
