from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tests.helpers import records, rows_of, topic
from tidewatch.operators import aggregates, reports
from tidewatch.scratch import fresh_dir
from tidewatch.streaming import sinks
from tidewatch.streaming.runner import run_batches


def longest():
    """Keeps the longest text; not a built-in sum."""

    def pick(left, right):
        return max([left, right], key=lambda t: (len(t), t))

    def add(acc: str, rows: pd.DataFrame) -> str:
        for text in rows["value"]:
            acc = pick(acc, text)
        return acc

    return {"init": lambda: "", "add": add, "merge": pick, "acc_type": "string"}


ROWS = [(f"k{i % 3}" if i % 10 else None, "x" * (i * 7 % 23), float(i)) for i in range(100)]


def expected(rows):
    best = {}
    for key, value, *_ in rows:
        if key is not None:
            best[key] = max([best.get(key, ""), value], key=len)
    return sorted(best.items())


def test_custom_agg(spark):
    df = records(spark, ROWS).repartition(5).select("key", "value")
    assert rows_of(aggregates.custom_agg(df, "key", **longest())) == expected(ROWS)
    assert rows_of(aggregates.custom_agg(df.limit(0), "key", **longest())) == []


def test_custom_agg_stream_keeps_its_accumulators(spark):
    stream = topic(spark, [ROWS[:30], ROWS[30:60], ROWS[60:]]).select("key", "value")
    running = aggregates.custom_agg_stream(stream, "key", **longest())
    path = fresh_dir(spark, "custom")
    run_batches(running, "custom", sinks.batch_table(path), mode="update")
    changes = sinks.read_batch_table(spark, path, running)
    assert changes.select("version").distinct().count() == 3
    assert rows_of(changes.groupBy("key").agg(F.max_by("acc", "version"))) == expected(ROWS)


def summary(spark, rows):
    return spark.createDataFrame(rows, "id bigint, total_value double")


def test_reports(spark):
    table = summary(spark, [(1, 46.0), (2, 1.5), (3, 2.5)])
    assert rows_of(reports.high_mark(table, "id")) == [(3,)]
    assert rows_of(reports.sink_report(table, "id", "total_value", 1)) == [(2, 4.0)]
    assert rows_of(reports.sink_report(table, "id", "total_value", 3)) == [(0, 0.0)]
    empty = summary(spark, [])
    assert rows_of(reports.high_mark(empty, "id")) == [(0,)]


def test_live_report_counts_what_was_added_since(spark):
    versions = iter([[(1, 5.0)], [(1, 5.0), (2, 7.0)], [(1, 5.0), (2, 7.0), (3, 1.0)]])
    seen = []
    reports.live_report(
        lambda: summary(spark, next(versions)), "id", "total_value",
        lambda row: seen.append(tuple(row)), every_seconds=0.01, reports=2,
    )
    assert seen == [(1, 7.0), (2, 8.0)]


def test_nan_is_a_key(spark):
    rows = spark.createDataFrame([(float("nan"), 1), (2.0, 5), (float("nan"), 2)], "k double, v bigint")
    summed = aggregates.custom_agg(rows, "k", lambda: 0, lambda a, g: a + int(g["v"].sum()), lambda a, b: a + b, "bigint")
    assert sorted((str(r["k"]), r["acc"]) for r in summed.collect()) == [("2.0", 5), ("nan", 3)]


def test_64_bits_are_exact_beside_null(spark):
    big = 2**53 + 1
    rows = spark.createDataFrame([("a", big), ("a", None), ("b", None), (None, 1)], "k string, v bigint").coalesce(1)

    def add(acc, group):
        seen = [int(v) for v in group["v"].dropna()] + ([] if acc is None else [acc])
        return max(seen, default=None)

    def merge(left, right):
        return max([v for v in (left, right) if v is not None], default=None)

    for parts in (1, 4):
        got = aggregates.custom_agg(rows.repartition(parts), "k", lambda: None, add, merge, "bigint")
        assert rows_of(got.orderBy("k")) == [("a", big), ("b", None)]


def test_times_as_keys_and_values(spark):
    rows = spark.sql(
        "SELECT timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, id % 2) AS t,"
        " timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, id) AS v FROM range(6)"
    )
    latest = aggregates.custom_agg(rows, "t", lambda: 0, lambda a, g: max(a, int(g["v"].dt.hour.max())), max, "int")
    assert rows_of(latest.select(F.hour("t"), "acc")) == [(0, 4), (1, 5)]
