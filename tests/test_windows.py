from __future__ import annotations

from pyspark.sql import functions as F

from tests.helpers import records, rows_of, topic
from tidewatch.operators.windows import above, tumbling_final
from tidewatch.streaming.runner import run_to_table

LATE_A = [
    [("k", "1", 1.0), ("k", "1", 20.0), ("k", "1", 2.0)],
    [("k", "10", 3.0), ("k", "1", 26.0)],
    [("k", "100", 4.0), ("k", "1", 40.0)],
]
LATE_B = [[("k", "1", 21.0)], [("k", "1", 28.0)], [("k", "1", 29.0)], [("k", "5", 27.0), ("k", "1", 29.0)],
          [("k", "1", 41.0)], [("k", "1", 60.0)]]


def sums(df, grace="0 seconds"):
    numbers = df.withColumn("v", F.col("value").cast("int"))
    final = tumbling_final(numbers, "5 seconds", ["key"], [F.sum("v").alias("v")], grace=grace)
    return final.select(F.unix_seconds("window.start").alias("start"), "v")


def test_watermark_moves_between_batches(spark):
    assert rows_of(run_to_table(sums(topic(spark, LATE_A)), "late-a")) == [(0, 12), (20, 1), (25, 1)]


def test_a_late_row_of_an_open_window_counts(spark):
    assert rows_of(run_to_table(sums(topic(spark, LATE_B)), "late-b")) == [(20, 1), (25, 8), (40, 1)]


def test_grace_keeps_windows_open(spark):
    stream = sums(topic(spark, LATE_A), grace="10 seconds")
    assert rows_of(run_to_table(stream, "grace")) == [(0, 12), (20, 1), (25, 1)]
    batch = sums(records(spark, [("k", "1", 1.0), ("k", "1", 12.0)]), grace="10 seconds")
    assert rows_of(batch) == []


def test_batch_returns_closed_windows_only(spark):
    rows = [("a", "1", 0.0), ("a", "2", 4.999), ("a", "4", 5.0), ("b", "8", 9.0), ("a", "16", 10.0)]
    assert rows_of(sums(records(spark, rows))) == [(0, 3), (5, 4), (5, 8)]


def test_rows_without_a_key_leave(spark):
    rows = [(None, "1", 0.0), ("a", "2", 1.0), ("a", "1", 7.0), (None, "1", 100.0)]
    assert rows_of(sums(records(spark, rows))) == [(0, 2)]


def test_empty_batch(spark):
    assert rows_of(sums(records(spark, [("a", "1", 1.0)]).limit(0))) == []


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(2,), (3,)], "n bigint")
    assert rows_of(above(df, "n", 2)) == [(3,)]


def test_stream_equals_batch_for_ordered_input(spark):
    rows = [(f"k{i % 3}", str(i), i * 0.7) for i in range(200)]
    batches = [rows[i : i + 40] for i in range(0, 200, 40)]
    assert rows_of(run_to_table(sums(topic(spark, batches)), "ordered")) == rows_of(sums(records(spark, rows)))
