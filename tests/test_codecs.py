from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.helpers import records, rows_of
from tidewatch.functions import codecs, text_forms as tf
from tidewatch.operators.dead_letters import good_records, split_good_bad


def decoded(spark, decode, values, columns):
    df = decode(records(spark, [(str(i), v, 1.0) for i, v in enumerate(values)]))
    return [tuple(r) for r in df.orderBy("offset").select(*columns, "bad_reason").collect()]


ORDER = ["orderId", "product", "quantity", "price"]


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ('{"orderId":7,"product":"Mouse","quantity":2,"price":10.5}', (7, "Mouse", 2, 10.5, None)),
        ('{"price":1,"quantity":2,"product":"A","orderId":3}', (3, "A", 2, 1.0, None)),
        ('{"orderId":7,"product":"A","quantity":"3","price":"2.5"}', (7, "A", 3, 2.5, None)),
        ('{"orderId":7,"product":"A","quantity":3.7,"price":2}', (7, "A", 3, 2.0, None)),
        ('{"orderId":7,"product":"A"}', (7, "A", 0, 0.0, None)),
        ('{"orderId":7,"product":"A","quantity":null,"price":1}', (7, "A", 0, 1.0, None)),
        ('{"orderId":7,"quantity":1,"price":1}', (7, None, 1, 1.0, None)),
        ("{}", (0, None, 0, 0.0, None)),
        ('{"orderId":7,"orderId":8,"product":"A","product":"B","quantity":1,"price":1}', (8, "B", 1, 1.0, None)),
        ('{"orderId":7,"product":"A","quantity":"","price":" "}', (7, "A", 0, 0.0, None)),
        ('{"orderId":7,"product":"A","quantity":" 3 ","price":1e2}', (7, "A", 3, 100.0, None)),
        ('{"orderId":7,"product":"A","quantity":-3.7,"price":0.1}', (7, "A", -3, 0.1, None)),
        ('{"orderId":7,"product":12,"quantity":1,"price":1}', (7, "12", 1, 1.0, None)),
        ('{"orderId":7,"product":true,"quantity":1,"price":1}', (7, "true", 1, 1.0, None)),
        ('{"orderId":7,"product":null,"quantity":1,"price":1}', (7, None, 1, 1.0, None)),
        ('{"orderId":7,"product":{"a":1},"quantity":1,"price":1}', "bad product"),
        ('{"orderId":7,"product":["a"],"quantity":1,"price":1}', "bad product"),
        ('{"orderId":7,"product":"A","quantity":"3.7","price":1}', "bad number"),
        ('{"orderId":7,"product":"A","quantity":true,"price":1}', "bad number"),
        ('{"orderId":7,"product":"A","quantity":1,"price":{"eur":1}}', "bad number"),
        ('{"orderId":7,"product":"A","quantity":1,"price":[1]}', "bad number"),
        ('{"orderId":7,"product":"A","quantity":1,"price":1,"x":1}', "unknown property"),
        ('{"orderId":7,"product":"A","quantity":"many","price":1}', "bad number"),
        ('{"orderId":7,"product":"A","quantity":3000000000,"price":1}', "bad number"),
        ('{"orderId":7,"product":"A"', "not a JSON object"),
        ("broken 7", "not a JSON object"),
        ("[1]", "not a JSON object"),
        ("5", "not a JSON object"),
        ("", "not a JSON object"),
        (None, "not a JSON object"),
    ],
)
def test_order_decode(spark, value, expected):
    (row,) = decoded(spark, codecs.decode_orders, [value], ORDER)
    assert row[-1] == expected if isinstance(expected, str) else row == expected


def test_unknown_properties_can_be_allowed(spark):
    value = '{"orderId":7,"product":"A","quantity":1,"price":1,"x":1}'
    df = codecs.decode_orders(records(spark, [("k", value, 1.0)]), strict=False)
    assert rows_of(df.select(*ORDER, "bad_reason")) == [(7, "A", 1, 1.0, None)]


TS = dt.datetime(2020, 8, 20, 10, 11, 12)


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ('"2020-08-20 10:11:12.0","HIGH","100","hello"', (TS, "HIGH", "100", "hello", None)),
        ("2020-08-20 10:11:12,HIGH,100,hello", (TS, "HIGH", "100", "hello", None)),
        ('"2020-8-20 10:11:12","HIGH","100","a, b"', (TS, "HIGH", "100", "a", None)),
        ('"2020-08-20 10:11:12","HIGH","100","","x"', (TS, "HIGH", "100", "", None)),
        ('"2020-08-20 10:11:12","HIGH","100",""', "fewer than 4 fields"),
        ('"2020-08-20 10:11:12","HIGH","100"', "fewer than 4 fields"),
        ('"2020-08-20T10:11:12","HIGH","100","m"', "bad timestamp"),
        ('"2020-08-20","HIGH","100","m"', "bad timestamp"),
        ('"soon","HIGH","100","m"', "bad timestamp"),
        ("", "fewer than 4 fields"),
        (None, "no value"),
    ],
)
def test_alert_decode(spark, value, expected):
    (row,) = decoded(spark, codecs.decode_alerts, [value], ["alert_ts", "level", "code", "mesg"])
    assert row[-1] == expected if isinstance(expected, str) else row == expected


@pytest.mark.parametrize(
    ("minutes", "expected"),
    [("7", 7), ("+7", 7), ("-7", -7), (" 7", None), ("7.0", None), ("x", None), ("99999999999", None)],
)
def test_view_minutes(spark, minutes, expected):
    value = f'"2020-08-20 10:11:12.5","Bob","AI",{minutes}'
    (row,) = decoded(spark, codecs.decode_views, [value], ["view_ts", "user", "view_topic", "minutes"])
    assert row[:4] == (TS.replace(microsecond=500_000), "Bob", "AI", expected)
    assert row[4] == (None if expected is not None else "bad integer")


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("5", 5.0), ("-1.5", -1.5), (" 5 ", 5.0), ("5d", 5.0), ("1e3", 1000.0), ("Infinity", float("inf")),
        ("inf", None), ("NaN", None), ("nan", None), ("five", None), ("", None), (None, None),
    ],
)
def test_score(spark, value, expected):
    (row,) = decoded(spark, codecs.decode_scores, [value], ["score"])
    assert row == (expected, None if expected is not None else "bad number")


def test_timestamp_text_and_iso_instant(spark):
    texts = ["2020-01-01 00:00:00", "2020-01-01 00:00:00.25", "2020-01-01 00:00:00.05", "2020-01-01 00:00:00.179575"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast("timestamp"))
    got = [tuple(r) for r in df.select(tf.timestamp_text(F.col("t")), tf.iso_instant(F.col("t"))).collect()]
    assert got == [
        ("2020-01-01 00:00:00.0", "2020-01-01T00:00:00Z"),
        ("2020-01-01 00:00:00.25", "2020-01-01T00:00:00.250Z"),
        ("2020-01-01 00:00:00.05", "2020-01-01T00:00:00.050Z"),
        ("2020-01-01 00:00:00.179575", "2020-01-01T00:00:00.179575Z"),
    ]


def test_epoch_seconds_rounds_down(spark):
    df = spark.createDataFrame([(1.9,), (-0.5,)], "s double").select(F.timestamp_seconds("s").alias("t"))
    assert [r[0] for r in df.select(tf.epoch_seconds(F.col("t"))).collect()] == [1, -1]


def test_window_count_record(spark):
    df = spark.createDataFrame([(12.0, "100", 3)], "s double, code string, n bigint")
    df = df.select(F.window(F.timestamp_seconds("s"), "10 seconds").alias("window"), "code", "n")
    key, value = codecs.encode_window_count(F.col("window"), F.col("code"), F.col("n"))
    assert tuple(df.select(key, value).first()) == (
        "[100@10000/20000]",
        '"1970-01-01T00:00:10Z","100","3"',
    )


def test_a_missing_field_is_written_as_null(spark):
    df = spark.createDataFrame([(1.0, None, "m")], "s double, code string, mesg string")
    value = codecs.encode_critical(F.timestamp_seconds("s"), F.col("code"), F.col("mesg"))
    assert df.select(value).first()[0] == '"1970-01-01 00:00:01.0","null","m"'


def test_csv_round_trip(spark):
    df = spark.createDataFrame([(1.25, "Bob", "AI", 4)], "s double, user string, topic string, minutes int")
    ts = F.timestamp_seconds("s")
    view = df.select(codecs.encode_view(ts, F.col("user"), F.col("topic"), F.col("minutes")).alias("value"))
    assert view.first()[0] == '"1970-01-01 00:00:01.25","Bob","AI",4'
    back = codecs.decode_views(view).select("user", "view_topic", "minutes", "bad_reason")
    assert tuple(back.first()) == ("Bob", "AI", 4, None)


def test_split_and_fail(spark):
    df = codecs.decode_scores(records(spark, [("a", "1", 1.0), ("b", "x", 2.0)]))
    good, bad = split_good_bad(df)
    assert rows_of(good.select("key", "score")) == [("a", 1.0)]
    assert rows_of(bad) == [("b", "x", "bad number")]
    assert good_records(df).count() == 1
    with pytest.raises(Exception, match="undecodable record: bad number: x"):
        good_records(df, on_error="fail").collect()
    with pytest.raises(ValueError):
        good_records(df, on_error="ignore")
