from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tests.check_oracles import compare
from tests.helpers import feed, records, rows_of, topic, unique
from tests.test_windows import LATE_A, LATE_B
from tidewatch.operators.strict_late import strict_flags
from tidewatch.operators.window_sums import STRICT, tumbling_sums
from tidewatch.plans.programs import into_store
from tidewatch.scratch import exists, fresh_dir
from tidewatch.sources.envelope import from_directory
from tidewatch.streaming.runner import NamedQuery, finish
from tidewatch.streaming.store import Store
from tidewatch.streaming.strict_windows import StrictWindows


SF_DIR = "/root/testdata/sf0.001"


def brute_force(rows, size, grace=0):
    """Accepted flags of ``(key, value, seconds, partition, offset)`` rows, one by one."""
    newest, accepted = {}, {}
    for _, _, s, partition, offset in sorted(rows, key=lambda r: r[4]):
        newest[partition] = max(newest.get(partition, s), s)
        accepted[(partition, offset)] = (s // size + 1) * size + grace > newest[partition]
    return accepted


def shuffled_rows(n, seed=1):
    """Partition 0 holds most rows; times wander backwards by up to 30 s."""
    random.seed(seed)
    return [
        (f"k{random.randrange(4)}", str(random.randrange(9)), i / 2 + random.uniform(-30, 0) + 50,
         random.choice([0, 0, 0, 1]), i)
        for i in range(n)
    ]


def numbers(df):
    return df.withColumn("v", F.col("value").cast("int"))


def strict(stream, rest=False, v="int", **kwargs):
    """Final windows and counts per partition of a topic under the strict rule."""
    spark = stream.sparkSession
    windows = StrictWindows("5 seconds", ["key"], {"v": F.col("value").cast(v)}, **kwargs)
    path = fresh_dir(spark, "strict")
    finish(into_store(stream, path, NamedQuery.fresh(spark, unique("strict")), None, windows))
    store = Store(spark, path)
    if rest:
        windows.publish_rest(store)
    return windows.results(store), windows.counts(store)


def starts(results):
    return rows_of(results.select(F.unix_seconds("window.start").alias("start"), "v"))


@pytest.mark.parametrize("chunk_rows", [1, 7, 100, 10_000])
@pytest.mark.parametrize("grace", [0, 7])
def test_batch_flags_against_brute_force(spark, chunk_rows, grace):
    rows = shuffled_rows(300)
    flags = strict_flags(records(spark, rows), "5 seconds", f"{grace} seconds", chunk_rows=chunk_rows)
    got = {(r["partition"], r["offset"]): r["accepted"] for r in flags.collect()}
    assert got == brute_force(rows, 5, grace)


def test_late_a(spark):
    assert starts(strict(topic(spark, LATE_A))[0]) == [(0, 1), (20, 1), (25, 1)]


def test_late_b(spark):
    assert starts(strict(topic(spark, LATE_B), chunk_rows=2)[0]) == [(20, 1), (25, 8), (40, 1)]


@pytest.mark.parametrize("grace", [0, 7])
def test_stream_against_brute_force_and_batch_over_batches(spark, grace):
    """Chunks are cut by micro-batches, and both by partitions."""
    rows = shuffled_rows(240)
    accepted = brute_force(rows, 5, grace)
    counts = defaultdict(lambda: [0, 0])
    for _, _, _, partition, offset in rows:
        counts[partition][0] += 1
        counts[partition][1] += not accepted[(partition, offset)]
    stream = topic(spark, [rows[:50], rows[50:170], rows[170:]])
    results, seen = strict(stream, rest=True, grace=f"{grace} seconds", chunk_rows=20)
    assert rows_of(seen.select("partition", "n", "dropped")) == sorted((p, *t) for p, t in counts.items())
    batch = tumbling_sums(
        records(spark, rows), "5 seconds", ["key"], {"v": F.col("value").cast("int")}, "n", f"{grace} seconds", STRICT
    )
    assert rows_of(results) == rows_of(batch.select(*results.columns))


def test_a_lagging_partition_loses_nothing(spark):
    """Partition 1 is an hour behind partition 0 and still adds to its own windows."""
    batches = [
        [("a", "1", 3600.0, 0), ("a", "1", 1.0, 1)],
        [("a", "1", 3700.0, 0), ("a", "10", 2.0, 1), ("a", "100", 7.0, 1)],
    ]
    results, counts = strict(topic(spark, batches))
    assert starts(results) == [(0, 11)]
    assert [r["dropped"] for r in counts.collect()] == [0, 0]
    results, _ = strict(topic(spark, batches), rest=True)
    assert starts(results) == [(0, 11), (5, 100), (3600, 1)]


def test_an_idle_partition_does_not_hold_back_the_others(spark):
    batches = [
        [("a", "1", 100.0, 0), ("a", "1", 1.0, 1)],
        [("a", "1", 200.0, 0)],
        [("a", "10", 2.0, 1), ("a", "1", 300.0, 0)],
    ]
    results, counts = strict(topic(spark, batches), idle="1 minute")
    assert starts(results) == [(0, 1), (100, 1), (200, 1)]
    assert rows_of(counts.select("partition", "n", "dropped")) == [(0, 3, 0), (1, 2, 1)]


def test_partitions_without_a_record_so_far_hold_back_the_others(spark):
    """Partition 1 is first heard of in the second micro-batch; with ``idle`` it is waited for that long."""
    batches = [
        [("a", "1", 1.0, 0), ("a", "1", 100.0, 0)],
        [("a", "10", 2.0, 1), ("a", "10", 100.0, 1)],
        [("a", "1", 200.0, 0)],
    ]
    for idle in (None, "50 seconds"):
        results, counts = strict(topic(spark, batches), partitions=[0, 1], idle=idle)
        assert starts(results)[0] == (0, 11)
        assert [r["dropped"] for r in counts.collect()] == [0, 0]
    results, _ = strict(topic(spark, [batches[0], batches[2]]), partitions=[0, 1])
    assert starts(results) == []
    results, _ = strict(topic(spark, [batches[0], batches[2]]), partitions=[0, 1], idle="50 seconds")
    assert starts(results) == [(0, 1), (100, 1)]


@pytest.mark.parametrize(
    "name", ["fan_out", "late_rejects_batches", "order_window_summary_batches", "user_minutes_strict_batches"]
)
def test_queries_over_micro_batches_that_lack_partitions(spark, name):
    """Larger tables are not put together into one file a range, which this setting shows on small ones."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        _, difference = compare(spark, entry_points.queries()[name], entry_points.oracle_sql()[name], SF_DIR)
    finally:
        spark.conf.unset(setting)
    assert difference == ""


def test_windows_go_on_after_a_stop(spark):
    path, store_path = fresh_dir(spark, "topic"), fresh_dir(spark, "strict")
    progress = NamedQuery.fresh(spark, unique("strict-restart"))
    windows = StrictWindows("5 seconds", ["key"], {"v": F.col("value").cast("int")})
    for i, batch in enumerate(LATE_A):
        feed(spark, path, [(*r, 0, 10 * i + j) for j, r in enumerate(batch)])
        for _ in range(2):  # the second start finds nothing new
            finish(into_store(from_directory(spark, path), store_path, progress, None, windows))
    store = Store(spark, store_path)
    assert starts(windows.results(store)) == [(0, 1), (20, 1), (25, 1)]
    assert list(store.newest.batches) == [spark.read.json(f"{progress.checkpoint}/metadata").first()["id"]]
    assert store.newest.version == 2
    assert not exists(spark, store.folder("windows-frontier", 0))


def test_a_failed_micro_batch_is_taken_again(spark):
    path = fresh_dir(spark, "strict")
    progress = NamedQuery.fresh(spark, unique("strict-replay"))
    stream = topic(spark, LATE_A)
    fails = iter([False, True])

    def then(closed, store):
        if next(fails, False):
            raise OSError("no space left")

    windows = StrictWindows("5 seconds", ["key"], {"v": F.col("value").cast("int")}, then=then)
    with pytest.raises(Exception, match="no space left"):
        finish(into_store(stream, path, progress, None, windows))
    assert Store(spark, path).newest.version == 0
    finish(into_store(stream, path, progress, None, windows))
    assert starts(windows.results(Store(spark, path))) == [(0, 1), (20, 1), (25, 1)]


@pytest.mark.parametrize("kind", ["int", "bigint", "double", "decimal(20,4)"])
def test_sums_have_the_types_and_nulls_of_a_batch(spark, kind):
    rows = [("k", "1.5", 1.0), ("k", None, 2.0), ("m", None, 1.0), ("k", "9007199254740993", 3.0), ("k", "2", 9.0), ("m", "x", 9.5)]
    cast = F.expr(f"try_cast(value as {kind})")
    windows = StrictWindows("5 seconds", ["key"], {"v": cast})
    path = fresh_dir(spark, "strict")
    finish(into_store(topic(spark, [rows[:2], rows[2:]]), path, NamedQuery.fresh(spark, unique("types")), None, windows))
    got = windows.results(Store(spark, path))
    batch = tumbling_sums(records(spark, rows), "5 seconds", ["key"], {"v": cast}, "n", late=STRICT)
    assert rows_of(got.select("key", "n", "v")) == rows_of(batch.select("key", "n", "v"))
    assert dict(got.dtypes)["v"] == dict(batch.dtypes)["v"]


def test_no_keys(spark):
    stream = topic(spark, [[("k", "1.5", 1.0), (None, "2.25", 2.0), ("k", "1", 9.0)]])
    windows = StrictWindows("5 seconds", [], {"v": F.col("value").cast("double")})
    path = fresh_dir(spark, "strict")
    finish(into_store(stream, path, NamedQuery.fresh(spark, unique("no-keys")), None, windows))
    assert rows_of(windows.results(Store(spark, path)).select("n", "v")) == [(2, 3.75)]


def test_the_strict_rule_on_a_stream_is_a_sink(spark):
    with pytest.raises(ValueError, match="StrictWindows"):
        tumbling_sums(topic(spark, LATE_A), "5 seconds", ["key"], {}, "n", late=STRICT)


def test_records_without_offset_are_an_error(spark):
    df = spark.createDataFrame([(0, None, 1)], "partition int, offset bigint, s int")
    df = df.withColumn("timestamp", F.timestamp_seconds("s"))
    with pytest.raises(Exception, match="needs a partition and an offset"):
        strict_flags(df, "5 seconds").collect()
