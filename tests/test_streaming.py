from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from tests.helpers import feed, records, rows_of, topic, unique
from tidewatch.functions import codecs
from tidewatch.operators.boards import rank_desc
from tidewatch.operators.dead_letters import DECODING, split_good_bad
from tidewatch.plans import patterns
from tidewatch.scratch import fresh_dir, scratch_root
from tidewatch.sources import envelope, jdbc
from tidewatch.sources.text_lines import text_lines
from tidewatch.streaming import sinks
from tidewatch.streaming.runner import NamedQuery, describe, finish, run_batches, run_to_table
from tidewatch.streaming.state import state_view
from tidewatch.streaming.store import Store


def alert(i, level, code, seconds):
    return (str(i), f'"2020-08-20 00:00:{i:02}.0","{level}","{code}","This is a {level} alert"', seconds)


ALERTS = [
    [alert(1, "CRITICAL", "100", 1.0), alert(2, "HIGH", "100", 2.0), alert(3, "critical", "100", 3.0)],
    [alert(4, "CRITICAL", "200", 4.0), ("5", "junk", 5.0), alert(6, "HIGH", "200", 12.0)],
    [alert(7, "HIGH", "200", 13.0), alert(8, "HIGH", "200", 14.0), alert(9, "HIGH", "200", 31.0)],
]


def test_fan_out_into_two_queries(spark):
    alerts = topic(spark, ALERTS)
    critical = patterns.critical_alerts(alerts)
    volume = patterns.high_volume_alerts(alerts)
    path = fresh_dir(spark, patterns.CRITICAL_TOPIC)
    finish(NamedQuery.fresh(spark, unique("critical")).start(sinks.to_directory(critical, path), spark))
    assert rows_of(spark.read.parquet(path)) == [
        ("1", '"2020-08-20 00:00:01.0","100","This is a CRITICAL alert"'),
        ("4", '"2020-08-20 00:00:04.0","200","This is a CRITICAL alert"'),
    ]
    assert rows_of(run_to_table(volume, unique("volume"))) == [
        ("[100@0/10000]", '"1970-01-01T00:00:00Z","100","3"'),
        ("[200@10000/20000]", '"1970-01-01T00:00:10Z","200","3"'),
    ]


def test_dead_letters_are_counted_in_the_progress(spark):
    good, bad = split_good_bad(codecs.decode_alerts(topic(spark, ALERTS)))
    seen = []
    query = run_batches(bad, unique("bad"), lambda batch, i: seen.extend(batch.collect()))
    assert [tuple(r) for r in seen] == [("5", "junk", "fewer than 4 fields")]
    counts = [p["observedMetrics"][DECODING] for p in query.recentProgress if p["numInputRows"]]
    assert [tuple(c) for c in counts] == [(3, 0), (3, 1), (3, 0)]


def test_bad_records_stop_the_query_on_request(spark):
    records_out = patterns.critical_alerts(topic(spark, ALERTS), on_error="fail")
    with pytest.raises(Exception, match="undecodable record"):
        run_to_table(records_out, unique("fails"))


def test_order_summary_from_json(spark):
    def order(i, product, quantity, price, seconds):
        value = f'{{"orderId":{i},"product":"{product}","quantity":{quantity},"price":{price}}}'
        return (str(i), value, seconds)

    orders = [
        [order(1, "Mouse", 2, 10.5, 1.0), order(2, "Mouse", 1, 10.5, 4.0), order(3, "Monitor", 1, 140, 2.0)],
        [order(4, "Mouse", 4, 10.5, 6.0), ("5", "broken 5", 7.0), order(6, "Mouse", 1, 10.5, 12.0)],
    ]
    expected = [
        ("1970-01-01T00:00:00Z", "Monitor", 140.0),
        ("1970-01-01T00:00:00Z", "Mouse", 31.5),
        ("1970-01-01T00:00:05Z", "Mouse", 42.0),
    ]
    stream = patterns.order_summary(topic(spark, orders))
    assert rows_of(run_to_table(stream, unique("orders"))) == expected
    assert rows_of(patterns.order_summary(records(spark, sum(orders, [])))) == expected


def test_restart_goes_on_where_it_stopped(spark):
    path, out = fresh_dir(spark, "topic"), fresh_dir(spark, "board")
    progress = NamedQuery.fresh(spark, unique("restart"))

    def run():
        totals = patterns.player_totals(envelope.from_directory(spark, path, 1))
        run_batches(totals, progress.name, sinks.board_table(out), "update", progress)
        return rows_of(rank_desc(sinks.read_board(spark, out)))

    feed(spark, path, [("Bob", "3", 1.0), ("Sam", "5", 2.0), ("Sam", "x", 2.0)])
    assert run() == [(1, "Sam", 5.0), (2, "Bob", 3.0)]
    feed(spark, path, [("Bob", "4", 3.0), ("Amy", "1", 4.0)])
    expected = [(1, "Bob", 7.0), (2, "Sam", 5.0), (3, "Amy", 1.0)]
    assert run() == expected
    assert run() == expected


def test_a_replayed_batch_changes_nothing(spark):
    path = fresh_dir(spark, "replay")
    write = sinks.board_table(path)
    batch = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "member string, score double")
    write(batch, 0)
    write(batch, 0)
    write(spark.createDataFrame([("a", 5.0)], "member string, score double"), 1)
    assert rows_of(sinks.read_board(spark, path)) == [("a", 5.0), ("b", 2.0)]


def folders(path):
    return [d for d, _, files in os.walk(path) if any(f.endswith((".parquet", ".txt")) for f in files)]


def test_a_board_over_many_triggers_keeps_few_files(spark):
    path = fresh_dir(spark, "board")
    write = sinks.board_table(path, fold_every=5)
    most, expected = 0, {}
    for i in range(60):
        expected |= {f"m{i % 7}": float(i), "hot": float(-i)}
        rows = [(f"m{i % 7}", float(i)), ("hot", float(-i))]
        write(spark.createDataFrame(rows, "member string, score double").coalesce(1), i)
        most = max(most, len(folders(path)))
        if i % 13 == 0:
            assert dict(rows_of(sinks.read_board(spark, path))) == expected
    assert dict(rows_of(sinks.read_board(spark, path))) == expected
    assert most <= 25
    sinks.reset_board(spark, path)
    assert rows_of(sinks.read_board(spark, path)) == []
    write = sinks.board_table(path, fold_every=5)
    write(spark.createDataFrame([("m1", 0.5)], "member string, score double"), 60)
    assert rows_of(sinks.read_board(spark, path)) == [("m1", 0.5)]


def test_an_uncommitted_version_is_not_read_and_replaced(spark):
    store = Store(spark, fresh_dir(spark, "store"))
    one, two = (spark.createDataFrame([(x,)], "x int") for x in (1, 2))
    store.put("rows", one)
    store.commit("run", 0, told="a")
    store.put("rows", one)  # the writer dies here
    again = Store(spark, store.path)
    assert rows_of(again.read("rows", "x int")) == [(1, 0)]
    again.put("rows", two)
    again.commit("run", 1)
    assert rows_of(again.read("rows", "x int")) == [(1, 0), (2, 1)]
    assert again.newest.notes == {"told": "a"} and again.is_committed("run", 1) and not again.is_committed("other", 0)
    assert rows_of(again.version("rows", "x int")) == [(2,)] and rows_of(again.version("none", "x int")) == []
    assert rows_of(Store(spark, fresh_dir(spark, "empty")).read("rows", "x int")) == []


SUMMARY = "interval_timestamp string, product string, total_value double"


class AppendTable:
    """A table without transactions; rows of a micro-batch may be there in part."""

    def __init__(self, spark):
        self.spark, self.path, self.asked = spark, fresh_dir(spark, "append"), []
        self.schema = f"{SUMMARY}, run_id string, batch_id bigint"
        spark.createDataFrame([], self.schema).write.parquet(self.path)

    def rows(self):
        return self.spark.read.schema(self.schema).parquet(self.path)

    def there(self, run, batch_id):
        self.asked.append(batch_id)
        return self.rows().where((F.col("run_id") == run) & (F.col("batch_id") == batch_id))

    def append(self, rows):
        rows.write.mode("append").parquet(self.path)


def test_append_after_a_partial_failure(spark):
    table, commits = AppendTable(spark), fresh_dir(spark, "commits")
    table.append(spark.createDataFrame([("t1", "Mouse", 46.0, "", 7)], table.schema))

    def sink():
        return sinks.append_missing(commits, ["interval_timestamp", "product"], table.there, table.append)

    write = sink()
    batch = spark.createDataFrame([("t1", "Mouse", 46.0), ("t1", "Monitor", 140.0)], SUMMARY)
    write(batch, 7)
    write(batch, 7)
    write(spark.createDataFrame([("t2", "Mouse", 1.0)], SUMMARY), 8)
    sink()(batch, 7)
    assert rows_of(table.rows().drop("run_id")) == [
        ("t1", "Monitor", 140.0, 7), ("t1", "Mouse", 46.0, 7), ("t2", "Mouse", 1.0, 8),
    ]
    assert table.asked == [7]


def test_append_with_a_fresh_checkpoint_on_the_same_table(spark):
    """The numbers of micro-batches start again; no row is taken for one of the run before."""
    table, commits = AppendTable(spark), fresh_dir(spark, "commits")
    write = sinks.append_missing(commits, ["interval_timestamp", "product"], table.there, table.append)
    stream = topic(spark, [[("Mouse", "1", 1.0)], [("Mouse", "2", 2.0)]])
    rows = stream.select(F.lit("t").alias("interval_timestamp"), F.col("key").alias("product"), F.col("value").cast("double").alias("total_value"))
    for _ in range(2):
        run_batches(rows, unique("append"), write)
    got = rows_of(table.rows().groupBy("run_id").agg(F.sum("total_value"), F.count(F.lit(1))))
    assert [r[1:] for r in got] == [(3.0, 2), (3.0, 2)] and all(r[0] for r in got)


def test_state_shows_open_windows(spark):
    views = [[("1", '"2020-08-20 00:00:01.0","Bob","AI",3', 1.0), ("2", '"2020-08-20 00:00:01.0","Bob","AI",4', 7.0)]]
    progress = NamedQuery.fresh(spark, unique("state"))
    table = run_to_table(patterns.user_minutes(topic(spark, views)), progress.name, progress)
    assert rows_of(table) == [("1970-01-01T00:00:00Z", "Bob", 3)]
    held = state_view(spark, progress.checkpoint)
    assert rows_of(held.select("key.user", "value.sum")) == [("Bob", 4)]


def test_board_is_ranked_at_every_trigger(spark):
    scores = topic(spark, [[("a", "3", 1.0)], [("b", "5", 2.0)], [("a", "100", 3.0)]])
    seen = []
    query = sinks.report_board(
        patterns.player_totals(scores),
        NamedQuery.fresh(spark, unique("periodic")),
        lambda ranking, i: seen.append(rows_of(ranking)),
        every=None,
    )
    finish(query, 120)
    assert seen == [
        [(1, "a", 3.0)],
        [(1, "b", 5.0), (2, "a", 3.0)],
        [(1, "a", 103.0), (2, "b", 5.0)],
    ]


def test_a_board_is_computed_once_a_trigger(spark):
    """Range bounds are sampled from the board, and the state below it is not to be written twice."""
    scores = topic(spark, [[("a", "3", 1.0)], [("b", "5", 2.0)]])
    computed = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            computed.add(len(batch))
            yield batch

    totals = patterns.player_totals(scores).mapInPandas(counting, "member string, score double")
    finish(sinks.report_board(totals, NamedQuery.fresh(spark, unique("once")), lambda *_: None, every=None), 120)
    assert computed.value == 1 + 2


def test_state_commits_changes_instead_of_snapshots(spark):
    progress = NamedQuery.fresh(spark, unique("changelog"))
    run_batches(patterns.player_totals(topic(spark, [[("a", "3", 1.0)]])), progress.name, lambda df, _: df.collect(), "update", progress)
    files = [name for _, _, names in os.walk(progress.checkpoint) for name in names]
    assert any(name.endswith(".changelog") for name in files)


def test_interval_trigger_and_stop(spark):
    seen = []
    writer = topic(spark, [[("a", "3", 1.0)]]).writeStream.foreachBatch(lambda df, i: seen.append(df.count()))
    query = NamedQuery.fresh(spark, unique("interval")).start(writer, spark, every="100 milliseconds")
    deadline = time.time() + 60
    while not seen and time.time() < deadline:
        time.sleep(0.1)
    with pytest.raises(TimeoutError):
        finish(query, 0.2)
    assert seen[0] == 1 and not query.isActive


def test_settings_of_the_session_are_given_back(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    run_to_table(topic(spark, [[("a", "3", 1.0)]]).select("key"), unique("settings"))
    assert spark.conf.get(name) == before


def test_text_lines(spark):
    path = fresh_dir(spark, "text")
    spark.createDataFrame([("one\n\ntwo",)], "value string").write.text(path)
    assert rows_of(text_lines(spark, path)) == [("",), ("one",), ("two",)]
    assert rows_of(run_to_table(text_lines(spark, path, stream=True), unique("text"))) == [("",), ("one",), ("two",)]


def test_publish_keyed_needs_no_shuffle(spark):
    df = spark.range(3).select("id", F.timestamp_seconds("id").alias("t"))
    out = envelope.publish_keyed(df, F.col("id"), F.lit("v"), F.col("t"), "there")
    assert out.schema.names == envelope.ENVELOPE.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in envelope.ENVELOPE]
    assert "Exchange" not in describe(out)


def test_kafka_shape_and_options(spark):
    raw = spark.createDataFrame(
        [(bytearray(b"k"), bytearray(b"v"), "t", 1, 5, 0)],
        "key binary, value binary, topic string, partition int, offset bigint, timestampType int",
    ).withColumn("timestamp", F.timestamp_seconds(F.lit(1)))
    assert tuple(envelope.as_envelope(raw).first())[:5] == ("k", "v", "t", 1, 5)
    options = envelope.kafka_options("host:9092", "streaming.orders.input", 1000)
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "1000"


def test_jdbc_options():
    options = jdbc.jdbc_options("jdbc:x", "order_summary", "u", "p", driver="d")
    assert options["dbtable"] == "order_summary" and options["driver"] == "d"
    assert jdbc.split_read_options("ID", 0, 100, 4)["numPartitions"] == "4"


def test_scratch_root_is_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or scratch_root(spark) == named.rstrip("/")
    assert scratch_root(spark) == scratch_root(spark)
