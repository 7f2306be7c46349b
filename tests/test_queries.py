"""Every registered query against its SQL, and the shape of the plans behind them."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_points
from tests.check_oracles import compare
from tidewatch.plans.registered import QUERIES
from tidewatch.streaming.runner import describe

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, name):
    rows, difference = compare(
        spark, entry_points.queries()[name], entry_points.oracle_sql()[name], SF_DIR
    )
    assert difference == ""
    assert rows > 0 or name.startswith("high_volume_alerts_1h")


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(QUERIES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() == 988


BATCH = [
    name
    for name in QUERIES
    if name.endswith("_batch") or name in ("order_decode", "view_decode", "sink_report", "leaderboard_top3")
]


@pytest.mark.parametrize("name", BATCH)
def test_plans_have_no_cross_join_or_row_at_a_time_python(spark, name):
    plan = describe(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan


@pytest.mark.parametrize("name", ["critical_alerts_batch", "alert_decode", "sentiment_labels_batch"])
def test_stateless_queries_do_not_shuffle(spark, name):
    assert "Exchange" not in describe(QUERIES[name](spark, SF_DIR))


def test_filters_and_columns_reach_the_scan(spark):
    plan = describe(QUERIES["sink_report"](spark, SF_DIR))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    assert "GreaterThan(o_orderkey,100)" in plan
    scores = describe(QUERIES["leaderboard_top3"](spark, SF_DIR))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in scores
    assert "TakeOrderedAndProject" in scores


@pytest.mark.parametrize(
    "name",
    [
        "user_minutes_1h_batch",
        "high_volume_alerts_1h_batch",
        "order_window_summary_batch",
        "user_minutes_strict_batch",
    ],
)
def test_closed_windows_shuffle_the_rows_once(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    df.collect()
    assert re.search(r"ReusedExchange .*, Exchange hashpartitioning\(window", describe(df, "simple"))


def test_records_are_decoded_once(spark):
    plan = describe(QUERIES["order_decode"](spark, SF_DIR))
    body = plan.split("\n\n\n", 1)[1]
    lines = [line for line in body.splitlines() if line.startswith(("Output", "Condition"))]
    assert sum(line.count("from_json") for line in lines) == 1
