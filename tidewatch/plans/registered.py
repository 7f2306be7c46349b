"""Every operator as a query ``(spark, sf_dir) -> DataFrame`` over the given tables.

Queries whose name ends in ``_batch`` are the batch twins of streaming ones and must give the
same rows. Streaming queries read the table's files as a stream, process all that is
available and return the table their sink wrote.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.functions import codecs, text_forms as tf
from tidewatch.operators import aggregates, boards, reports, scoring
from tidewatch.operators.dead_letters import split_good_bad
from tidewatch.operators.strict_late import strict_flags
from tidewatch.operators.window_sums import STRICT, tumbling_sums
from tidewatch.plans import patterns, programs
from tidewatch.scratch import fresh_dir
from tidewatch.sources import tables
from tidewatch.sources.envelope import assign_offsets, from_directory, publish_ranges
from tidewatch.sources.text_lines import text_lines
from tidewatch.streaming import sinks
from tidewatch.streaming.runner import NamedQuery, finish, run_batches, run_to_table
from tidewatch.streaming.state import state_view
from tidewatch.streaming.store import Store
from tidewatch.streaming.strict_windows import StrictWindows

Query = Callable[[SparkSession, str], DataFrame]

# The test lexicon, words that are frequent in the given texts.
TEST_LEXICON = {"the": 1, "is": 1, "it": 1, "of": -1, "to": -1, "a": -1}

REPORT_SINCE = 100


# Parts in which a topic is published for the queries over several micro-batches. The query is stopped
# after half of them and goes on from its checkpoint.
PARTS = 8
FILES_PER_TRIGGER = 2


def _in_parts(records: DataFrame, consume: Callable[[DataFrame, list[int]], None]) -> None:
    """Publish records in ranges of offsets; ``consume`` gets the topic and its partitions after half
    of them, and again after all."""
    spark = records.sparkSession
    first, last, partitions = records.agg(F.min("offset"), F.max("offset"), F.collect_set("partition")).first()
    first, last = first or 0, last or 0
    cuts = [first + (last + 1 - first) * i // PARTS for i in range(PARTS + 1)]
    ranges = list(itertools.pairwise(cuts))
    path = fresh_dir(spark, "topic")
    for part in (ranges[: PARTS // 2], ranges[PARTS // 2 :]):
        publish_ranges(records, path, F.col("offset"), part)
        consume(from_directory(spark, path, FILES_PER_TRIGGER), partitions)


# Topics derived from the tables


def _orders(spark: SparkSession, sf_dir: str, value: Column | None = None) -> DataFrame:
    product = tables.products(tables.table(spark, sf_dir, "part"))
    return tables.orders_topic(tables.table(spark, sf_dir, "lineitem"), product, value)


def _alerts(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    return tables.alerts_topic(tables.table(spark, sf_dir, "events", stream))


def _scores(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    return tables.scores_topic(tables.table(spark, sf_dir, "events", stream))


def _views(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    return tables.views_topic(tables.table(spark, sf_dir, "events", stream))


def _shifted_views(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    events = tables.table(spark, sf_dir, "events", stream)
    return tables.views_topic(events, tables.shifted_time())


def _reviews(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    documents = tables.table(spark, sf_dir, "documents", stream)
    return tables.reviews_topic(documents, F.col("doc_id"), F.col("doc_id"))


# Encoding and decoding


def order_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).select("key", "value")


def order_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = split_good_bad(codecs.decode_orders(_orders(spark, sf_dir)))
    return good.select("orderId", "product", "quantity", "price")


def order_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = split_good_bad(codecs.decode_orders(_orders(spark, sf_dir, tables.broken_order())))
    return bad


def order_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = assign_offsets(_orders(spark, sf_dir), ["key", "value"])
    return records.select("partition", "offset", "key", "value")


def alert_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(spark, sf_dir).select("key", "value")


def alert_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = split_good_bad(codecs.decode_alerts(_alerts(spark, sf_dir)))
    return good.select(tf.iso_instant(F.col("alert_ts")).alias("alert_ts"), "level", "code", "mesg")


def view_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _views(spark, sf_dir).select("key", "value")


def view_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = split_good_bad(codecs.decode_views(_views(spark, sf_dir)))
    return good.select(
        tf.iso_instant(F.col("view_ts")).alias("view_ts"), "user", "view_topic", "minutes"
    )


def score_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = split_good_bad(codecs.decode_scores(_scores(spark, sf_dir)))
    return good.select("offset", "key", "score")


def publish_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reviews(spark, sf_dir).select(
        "key", "value", "topic", tf.epoch_seconds(F.col("timestamp")).alias("seconds")
    )


def text_file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "text-lines")
    tables.table(spark, sf_dir, "documents").select("text").write.text(path)
    return text_lines(spark, path).select(F.col("value").alias("line"))


# Windows


def _rounded(summary: DataFrame) -> DataFrame:
    return summary.withColumn("total_value", F.round("total_value", 2))


def order_window_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = patterns.order_summary(tables.orders_stream(spark, sf_dir))
    return _rounded(run_to_table(summary, "order-window-summary"))


def order_window_summary_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(patterns.order_summary(_orders(spark, sf_dir)))


def order_summary_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the rows that a streaming summary has put into its table."""
    summary = patterns.order_summary(tables.orders_stream(spark, sf_dir))
    path = fresh_dir(spark, "order-summary-table")
    run_batches(summary, "order-summary-report", sinks.batch_table(path))
    stored = sinks.read_batch_table(spark, path, summary)
    report = reports.sink_report(stored, "version", "total_value", -1)
    return report.withColumn("total_value", F.round("total_value", 2))


def critical_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = patterns.critical_alerts(_alerts(spark, sf_dir, stream=True))
    path = fresh_dir(spark, patterns.CRITICAL_TOPIC)
    progress = NamedQuery.fresh(spark, "critical-alerts")
    finish(progress.start(sinks.to_directory(records, path), spark))
    return spark.read.schema(records.schema).parquet(path)


def critical_alerts_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.critical_alerts(_alerts(spark, sf_dir))


def high_volume_alerts_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = patterns.high_volume_alerts(_alerts(spark, sf_dir, stream=True), "1 hour")
    return run_to_table(records, "high-volume-alerts-1h")


def high_volume_alerts_1h_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.high_volume_alerts(_alerts(spark, sf_dir), "1 hour")


def code_counts_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threshold 0, so that the smallest data has results as well."""
    records = patterns.high_volume_alerts(_alerts(spark, sf_dir, stream=True), "1 hour", 0)
    return run_to_table(records, "code-counts-1h")


def high_volume_alerts_10s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The usual window size; threshold 0, since no such window holds three given events."""
    records = patterns.high_volume_alerts(_alerts(spark, sf_dir, stream=True), threshold=0)
    return run_to_table(records, "high-volume-alerts-10s")


def user_minutes_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = patterns.user_minutes(_views(spark, sf_dir, stream=True), "1 hour")
    return run_to_table(minutes, "user-minutes-1h")


def user_minutes_1h_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.user_minutes(_views(spark, sf_dir), "1 hour")


def user_minutes_1h_grace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two hours of grace hold back the windows that end in the last two hours."""
    minutes = patterns.user_minutes(_views(spark, sf_dir, stream=True), "1 hour", "2 hours")
    return run_to_table(minutes, "user-minutes-1h-grace")


def user_minutes_5s(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = patterns.user_minutes(_views(spark, sf_dir, stream=True))
    return run_to_table(minutes, "user-minutes-5s")


def open_windows_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows that a streaming query still holds open, read from its state."""
    minutes = patterns.user_minutes(_views(spark, sf_dir, stream=True), "1 day")
    progress = NamedQuery.fresh(spark, "open-windows-state")
    run_to_table(minutes, "open-windows-state", progress)
    held = state_view(spark, progress.checkpoint)
    return held.select(
        tf.iso_instant(F.col("key.window.start")).alias("interval_timestamp"),
        F.col("key.user").alias("user"),
        F.col("value.sum").alias("total_minutes"),
    )


# Late records


LATE_WINDOW = "6 hours"


def _late_counts(decided: DataFrame, records) -> DataFrame:
    return decided.groupBy("partition").agg(
        F.sum(records).cast("bigint").alias("n"),
        F.sum(F.when(F.col("accepted"), 0).otherwise(records)).cast("bigint").alias("dropped"),
    )


def _strict_store(spark: SparkSession, good: DataFrame, windows: StrictWindows, name: str) -> Store:
    path = fresh_dir(spark, name)
    finish(programs.into_store(good, path, NamedQuery.fresh(spark, name), None, windows))
    return Store(spark, path)


def _good_views(views: DataFrame) -> DataFrame:
    return split_good_bad(codecs.decode_views(views))[0]


def _strict_windows(partitions: list[int] | None = None) -> StrictWindows:
    return StrictWindows(LATE_WINDOW, ["user"], patterns.view_minutes(), partitions=partitions)


def _per_partition(windows: StrictWindows, store: Store) -> DataFrame:
    return windows.counts(store).select("partition", "n", "dropped")


def late_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    # All files make one micro-batch, so the given order of records does not depend on that of files.
    windows = _strict_windows()
    store = _strict_store(spark, _good_views(_shifted_views(spark, sf_dir, stream=True)), windows, "late-rejects")
    return _per_partition(windows, store)


def late_rejects_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = split_good_bad(codecs.decode_views(_shifted_views(spark, sf_dir)))
    return _late_counts(strict_flags(good, LATE_WINDOW), F.lit(1))


def _as_strict_minutes(totals: DataFrame) -> DataFrame:
    start = tf.iso_instant(F.col("window.start")).alias("interval_timestamp")
    return totals.select(start, "user", "n", "total_minutes")


def user_minutes_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = _strict_windows()
    store = _strict_store(spark, _good_views(_shifted_views(spark, sf_dir, stream=True)), windows, "user-minutes-strict")
    windows.publish_rest(store)
    return _as_strict_minutes(windows.results(store))


def user_minutes_strict_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = _good_views(_shifted_views(spark, sf_dir))
    totals = tumbling_sums(good, LATE_WINDOW, ["user"], patterns.view_minutes(), "n", late=STRICT)
    return _as_strict_minutes(totals)


def _strict_in_parts(spark: SparkSession, sf_dir: str, name: str) -> tuple[StrictWindows, Store]:
    """The strict rule over several micro-batches, with a stop half way."""
    path, progress = fresh_dir(spark, name), NamedQuery.fresh(spark, name)

    def consume(views: DataFrame, partitions: list[int]) -> None:
        finish(programs.into_store(_good_views(views), path, progress, None, _strict_windows(partitions)))

    _in_parts(_shifted_views(spark, sf_dir), consume)
    return _strict_windows(), Store(spark, path)


def late_rejects_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_partition(*_strict_in_parts(spark, sf_dir, "late-rejects-batches"))


def user_minutes_strict_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows, store = _strict_in_parts(spark, sf_dir, "user-minutes-strict-batches")
    windows.publish_rest(store)
    return _as_strict_minutes(windows.results(store))


def order_window_summary_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, progress = fresh_dir(spark, "order-parts"), NamedQuery.fresh(spark, "order-window-summary-batches")

    def windows(partitions: list[int] | None = None) -> StrictWindows:
        return StrictWindows(patterns.ORDER_WINDOW, ["product"], patterns.order_value(), partitions=partitions)

    def consume(orders: DataFrame, partitions: list[int]) -> None:
        good, _ = split_good_bad(codecs.decode_orders(orders))
        finish(programs.into_store(good, path, progress, None, windows(partitions)))

    _in_parts(assign_offsets(_orders(spark, sf_dir), ["key", "value"]), consume)
    store = Store(spark, path)
    windows().publish_rest(store)
    return _rounded(patterns.as_order_summary(windows().results(store)))


def append_sink_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Critical alerts appended to a table without transactions: the writer dies after half of a
    micro-batch, the query is started again, and every alert is there once."""
    path, commits = fresh_dir(spark, "alert-table"), fresh_dir(spark, "alert-commits")
    progress = NamedQuery.fresh(spark, "append-sink-replay")
    columns = "key string, value string, run_id string, batch_id bigint"
    spark.createDataFrame([], columns).write.parquet(path)
    appends = itertools.count()

    def there(run: str, batch_id: int) -> DataFrame:
        rows = spark.read.schema(columns).parquet(path)
        return rows.where((F.col("run_id") == run) & (F.col("batch_id") == batch_id))

    def append(rows: DataFrame) -> None:
        dies = next(appends) == 3
        if dies:
            rows = rows.where(F.crc32("key") % 2 == 0)
        rows.write.mode("append").parquet(path)
        if dies:
            raise OSError("the writer died")

    write = sinks.append_missing(commits, ["key"], there, append)

    def consume(alerts: DataFrame, _: list[int]) -> None:
        records = patterns.critical_alerts(alerts)
        for attempt in range(2):
            try:
                finish(progress.start(records.writeStream.foreachBatch(write), spark))
                return
            except Exception as error:
                if attempt or "the writer died" not in str(error):
                    raise

    _in_parts(_alerts(spark, sf_dir), consume)
    return spark.read.schema(columns).parquet(path).select("key", "value")


def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Critical alerts and codes of high volume, by one query over several micro-batches."""
    path, progress = fresh_dir(spark, "alerting"), NamedQuery.fresh(spark, "fan-out")

    def consume(alerts: DataFrame, partitions: list[int]) -> None:
        options = {"size": "1 hour", "threshold": 0, "partitions": partitions}
        finish(programs.alerting(alerts, path, progress, **options))

    _in_parts(_alerts(spark, sf_dir), consume)
    store = Store(spark, path)
    topics = [
        store.read(topic, "key string, value string").select(F.lit(topic).alias("topic"), "key", "value")
        for topic in (patterns.CRITICAL_TOPIC, patterns.HIGH_VOLUME_TOPIC)
    ]
    return topics[0].union(topics[1])


# Boards


def _streamed_board(spark: SparkSession, totals: DataFrame, name: str) -> DataFrame:
    path = fresh_dir(spark, name)
    run_batches(totals, name, sinks.board_table(path), mode="update")
    return sinks.read_board(spark, path)


def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = patterns.player_totals(_scores(spark, sf_dir, stream=True))
    return boards.rank_desc(_streamed_board(spark, totals, "leaderboard"))


def leaderboard_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The board over several micro-batches, with a stop half way; folded after every few of them."""
    path, progress = fresh_dir(spark, "leaderboard"), NamedQuery.fresh(spark, "leaderboard-batches")
    write = sinks.board_table(path, fold_every=3)

    def consume(scores: DataFrame, _: list[int]) -> None:
        run_batches(patterns.player_totals(scores), progress.name, write, "update", progress)

    _in_parts(_scores(spark, sf_dir), consume)
    return boards.rank_desc(sinks.read_board(spark, path))


def periodic_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last of the rankings that are reported at every trigger."""
    progress, path = NamedQuery.fresh(spark, "periodic-board"), fresh_dir(spark, "rankings")

    def keep(ranking: DataFrame, batch_id: int) -> None:
        ranking.write.mode("overwrite").parquet(path)

    def consume(scores: DataFrame, _: list[int]) -> None:
        finish(sinks.report_board(patterns.player_totals(scores), progress, keep, every=None))

    _in_parts(_scores(spark, sf_dir), consume)
    return spark.read.parquet(path)


def leaderboard_ranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boards.rank_desc(patterns.player_totals(_scores(spark, sf_dir)))


def leaderboard_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boards.top_k(patterns.player_totals(_scores(spark, sf_dir)), 3)


def leaderboard_last3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boards.rank_slice(patterns.player_totals(_scores(spark, sf_dir)), -3, -1)


def topic_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = patterns.topic_totals(_views(spark, sf_dir, stream=True))
    return boards.rank_desc(_streamed_board(spark, totals, "topic-leaderboard"))


def topic_leaderboard_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boards.rank_desc(patterns.topic_totals(_views(spark, sf_dir)))


# Scoring


def sentiment_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    scorer = scoring.lexicon_scorer(TEST_LEXICON)
    labelled = patterns.predictions(_reviews(spark, sf_dir, stream=True), scorer)
    return run_to_table(labelled, "sentiment-labels").withColumnRenamed("value", "label")


def sentiment_labels_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_stream(_reviews(spark, sf_dir), scoring.lexicon_scorer(TEST_LEXICON))


def sentiment_labels_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = tables.table(spark, sf_dir, "conversations")
    key = F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    records = tables.reviews_topic(turns, key, F.col("conv_id"))
    return scoring.score_stream(records, scoring.lexicon_scorer(TEST_LEXICON))


def remote_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in for the service picks a label by the length of the text."""
    labels = scoring.LABELS

    def connect():
        return lambda texts: [labels[len(text) % len(labels)] for text in texts]

    return scoring.remote_score(_reviews(spark, sf_dir), connect)


# Reports and user code


def sink_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = tables.table(spark, sf_dir, "orders")
    report = reports.sink_report(stored, "o_orderkey", "o_totalprice", REPORT_SINCE)
    return report.withColumn("total_value", F.round("total_value", 2))


def high_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.high_mark(tables.table(spark, sf_dir, "orders"), "o_orderkey")


def _minutes_accumulator() -> dict:
    """A user-supplied accumulator: the total of a column, from 0."""

    def add(total: int, rows: pd.DataFrame) -> int:
        return total + int(rows["minutes"].sum())

    return {
        "init": lambda: 0,
        "add": add,
        "merge": lambda left, right: left + right,
        "acc_type": "bigint",
        "result": "total_minutes",
    }


def custom_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = split_good_bad(codecs.decode_views(_views(spark, sf_dir)))
    return aggregates.custom_agg(good.select("user", "minutes"), "user", **_minutes_accumulator())


def custom_agg_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest text of each source; of texts of one length the greatest. No built-in twin."""

    def longer(left: str | None, right: str | None) -> str | None:
        texts = [text for text in (left, right) if text is not None]
        return max(texts, key=lambda text: (len(text), text), default=None)

    def add(acc: str | None, rows: pd.DataFrame) -> str | None:
        return functools.reduce(longer, rows["text"].dropna(), acc)

    docs = tables.table(spark, sf_dir, "documents").select("source", "text")
    return aggregates.custom_agg(docs, "source", lambda: None, add, longer, "string", result="longest")


def custom_agg_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = split_good_bad(codecs.decode_views(_views(spark, sf_dir, stream=True)))
    rows = good.select("user", "minutes")
    running = aggregates.custom_agg_stream(rows, "user", **_minutes_accumulator())
    path = fresh_dir(spark, "custom-agg-stream")
    run_batches(running, "custom-agg-stream", sinks.batch_table(path), mode="update")
    changes = sinks.read_batch_table(spark, path, running)
    latest = F.max_by("total_minutes", "version").alias("total_minutes")
    return changes.groupBy("user").agg(latest)


QUERIES: dict[str, Query] = {
    "order_encode": order_encode,
    "order_decode": order_decode,
    "order_dead_letters": order_dead_letters,
    "order_offsets": order_offsets,
    "alert_encode": alert_encode,
    "alert_decode": alert_decode,
    "view_encode": view_encode,
    "view_decode": view_decode,
    "score_decode": score_decode,
    "publish_reviews": publish_reviews,
    "text_lines": text_file_lines,
    "order_window_summary": order_window_summary,
    "order_window_summary_batch": order_window_summary_batch,
    "order_window_summary_batches": order_window_summary_batches,
    "order_summary_report": order_summary_report,
    "critical_alerts": critical_alerts,
    "critical_alerts_batch": critical_alerts_batch,
    "high_volume_alerts_1h": high_volume_alerts_1h,
    "high_volume_alerts_1h_batch": high_volume_alerts_1h_batch,
    "code_counts_1h": code_counts_1h,
    "high_volume_alerts_10s": high_volume_alerts_10s,
    "user_minutes_1h": user_minutes_1h,
    "user_minutes_1h_batch": user_minutes_1h_batch,
    "user_minutes_1h_grace": user_minutes_1h_grace,
    "user_minutes_5s": user_minutes_5s,
    "open_windows_state": open_windows_state,
    "late_rejects": late_rejects,
    "late_rejects_batch": late_rejects_batch,
    "user_minutes_strict": user_minutes_strict,
    "user_minutes_strict_batch": user_minutes_strict_batch,
    "user_minutes_strict_batches": user_minutes_strict_batches,
    "late_rejects_batches": late_rejects_batches,
    "append_sink_replay": append_sink_replay,
    "fan_out": fan_out,
    "leaderboard_batches": leaderboard_batches,
    "periodic_board": periodic_board,
    "leaderboard": leaderboard,
    "leaderboard_ranged": leaderboard_ranged,
    "leaderboard_top3": leaderboard_top3,
    "leaderboard_last3": leaderboard_last3,
    "topic_leaderboard": topic_leaderboard,
    "topic_leaderboard_batch": topic_leaderboard_batch,
    "sentiment_labels": sentiment_labels,
    "sentiment_labels_batch": sentiment_labels_batch,
    "sentiment_labels_conversations": sentiment_labels_conversations,
    "remote_score": remote_score,
    "sink_report": sink_report,
    "high_mark": high_mark,
    "custom_agg": custom_agg,
    "custom_agg_longest": custom_agg_longest,
    "custom_agg_stream": custom_agg_stream,
}
