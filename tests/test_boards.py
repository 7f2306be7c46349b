from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import records, rows_of
from tidewatch.operators import boards
from tidewatch.operators.numbering import number_rows
from tidewatch.sources.envelope import assign_offsets


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Keep small inputs in several ranges, which adaptive execution would merge into one."""
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def board(spark, scores):
    return spark.createDataFrame(scores, "member string, score double")


def test_first_board(spark):
    increments = board(spark, [("Mouse", 2.0), ("Keyboard", 3.0), ("Monitor", 1.0), ("Mouse", 2.0)])
    ranked = boards.rank_desc(boards.running_totals(increments, "member", "score"))
    assert rows_of(ranked) == [(1, "Mouse", 4.0), (2, "Keyboard", 3.0), (3, "Monitor", 1.0)]


def test_ties_are_ordered_by_member_bytes_descending(spark):
    tied = board(spark, [("a", 5.0), ("b", 5.0), ("é", 5.0), ("B", 5.0)])
    assert [r[1] for r in rows_of(boards.rank_desc(tied))] == ["é", "b", "a", "B"]
    assert [r[1] for r in rows_of(boards.top_k(tied, 2))] == ["é", "b"]


def test_members_without_a_name_leave(spark):
    rows = board(spark, [(None, 1.0), ("a", 2.0)])
    assert rows_of(boards.running_totals(rows, "member", "score")) == [("a", 2.0)]
    assert rows_of(boards.running_counts(rows, "member")) == [("a", 1.0)]


def many(n):
    random.seed(2)
    return [(f"m{i:04}", float(random.choice([7, 7, 7, random.randrange(50)]))) for i in range(n)]


def test_ranking_over_many_ranges_with_a_hot_score(spark):
    scores = many(2000)
    expected = [
        (i + 1, m, s)
        for i, (m, s) in enumerate(sorted(scores, key=lambda r: (r[1], r[0]), reverse=True))
    ]
    df = board(spark, scores).repartition(7)
    ranked = boards.rank_desc(df)
    assert rows_of(ranked) == expected
    assert len(ranked.inputFiles()) > 4
    assert rows_of(boards.top_k(df, 10)) == expected[:10]


@pytest.mark.parametrize(
    ("start", "stop", "positions"),
    [(0, -1, range(1, 21)), (0, 2, [1, 2, 3]), (-2, -1, [19, 20]), (5, 3, []), (18, 99, [19, 20]), (-99, 0, [1]), (0, -21, [])],
)
def test_slices(spark, start, stop, positions):
    got = boards.rank_slice(board(spark, many(20)), start, stop)
    assert [r[0] for r in rows_of(got)] == list(positions)


def test_numbering_per_group_with_nulls(spark):
    random.seed(3)
    rows = [(random.choice(["x", "x", "x", "y", None]), i) for i in random.sample(range(1000), 500)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(5)
    got = rows_of(number_rows(df, [F.col("v").asc()], "i", 0, ["g"]).select(F.coalesce("g", F.lit("")), "v", "i"))
    expected = []
    for group in ["x", "y", None]:
        members = sorted(v for g, v in rows if g == group)
        expected += [(group or "", v, i) for i, v in enumerate(members)]
    assert got == sorted(expected)


def test_numbering_of_nothing(spark):
    assert rows_of(boards.rank_desc(board(spark, []))) == []


def test_offsets_are_dense_per_partition(spark):
    rows = [(f"k{i}", "v", float((i * 37) % 50), i % 3) for i in range(100)]
    got = assign_offsets(records(spark, rows), ["key"]).orderBy("partition", "offset").collect()
    for partition in range(3):
        mine = [r for r in got if r["partition"] == partition]
        assert [r["offset"] for r in mine] == list(range(len(mine)))
        order = [(r["timestamp"], r["key"]) for r in mine]
        assert order == sorted(order)


@pytest.mark.parametrize("start, stop", [(0, 3), (-3, -1), (-30, -1), (-4, 17), (-5, 2), (-9, -20), (5, -5), (30, 40)])
@pytest.mark.parametrize("selected", [0, 100])
def test_slices_are_the_same_by_selection_and_by_sorting(spark, monkeypatch, start, stop, selected):
    monkeypatch.setattr(boards, "_SELECTED", selected)
    scores = [(f"m{i}", float(i % 4)) for i in range(20)]
    ranked = sorted(((s, m) for m, s in scores), reverse=True)
    end = stop + 20 if stop < 0 else stop
    want = [(i + 1, m, s) for i, (s, m) in enumerate(ranked) if max(start + 20 if start < 0 else start, 0) <= i <= end]
    assert rows_of(boards.rank_slice(board(spark, scores), start, stop)) == want


def test_a_slice_from_the_end_is_neither_sorted_nor_written(spark):
    total = boards.running_totals(board(spark, [("a", 1.0), ("b", 2.0)]), "member", "score")
    plan = boards.rank_slice(total, -1, -1)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
    assert boards.rank_slice(total.limit(0), -3, -1).count() == 0
