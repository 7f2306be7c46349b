"""The five streaming patterns, from envelope records to results.

Each function takes a batch or a stream and returns plain DataFrames; sinks are attached by
the caller. The ``as_`` functions turn decoded records or window totals into what is published;
``programs`` uses them to make several outputs of one decoding.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.functions import codecs, text_forms as tf
from tidewatch.operators import boards, scoring
from tidewatch.operators.dead_letters import good_records
from tidewatch.operators.window_sums import WATERMARK, tumbling_sums
from tidewatch.operators.windows import above

# Window sizes, the level that is published and the high-volume threshold.
ORDER_WINDOW = "5 seconds"
ALERT_WINDOW = "10 seconds"
VIEW_WINDOW = "5 seconds"
CRITICAL = "CRITICAL"
HIGH_VOLUME = 2

# Names of the output topics.
CRITICAL_TOPIC = "streaming.alerts.critical"
HIGH_VOLUME_TOPIC = "streaming.alerts.highvolume"
SENTIMENT_TOPIC = "streaming.sentiment.output"

def order_value() -> dict[str, Column]:
    """What is summed up of decoded orders."""
    return {"total_value": F.col("price") * F.col("quantity")}


def view_minutes() -> dict[str, Column]:
    """What is summed up of decoded views."""
    return {"total_minutes": F.col("minutes")}


def _interval() -> Column:
    return tf.iso_instant(F.col("window.start")).alias("interval_timestamp")


def order_summary(
    orders: DataFrame,
    size: str = ORDER_WINDOW,
    grace: str = "0 seconds",
    on_error: str = "dead_letter",
    late: str = WATERMARK,
) -> DataFrame:
    """Order value per product and window: ``interval_timestamp, product, total_value``."""
    good = good_records(codecs.decode_orders(orders), on_error)
    return as_order_summary(tumbling_sums(good, size, ["product"], order_value(), None, grace, late))


def as_order_summary(totals: DataFrame) -> DataFrame:
    return totals.select(_interval(), "product", "total_value")


def critical_alerts(alerts: DataFrame, on_error: str = "dead_letter") -> DataFrame:
    """Keyed records of the alerts with level CRITICAL. Stateless, no shuffle."""
    return as_critical(good_records(codecs.decode_alerts(alerts), on_error))


def as_critical(good: DataFrame) -> DataFrame:
    value = codecs.encode_critical(F.col("alert_ts"), F.col("code"), F.col("mesg"))
    return good.filter(F.col("level") == CRITICAL).select("key", value.alias("value"))


def high_volume_alerts(
    alerts: DataFrame,
    size: str = ALERT_WINDOW,
    threshold: int = HIGH_VOLUME,
    grace: str = "0 seconds",
    on_error: str = "dead_letter",
    late: str = WATERMARK,
) -> DataFrame:
    """Keyed records of the codes with more than ``threshold`` alerts in a final window."""
    good = good_records(codecs.decode_alerts(alerts), on_error)
    return as_high_volume(tumbling_sums(good, size, ["code"], {}, "n", grace, late), threshold)


def as_high_volume(counts: DataFrame, threshold: int = HIGH_VOLUME) -> DataFrame:
    key, value = codecs.encode_window_count(F.col("window"), F.col("code"), F.col("n"))
    return above(counts, "n", threshold).select(key.alias("key"), value.alias("value"))


def player_totals(scores: DataFrame, on_error: str = "dead_letter") -> DataFrame:
    """Running board ``member, score`` of the score increments."""
    good = good_records(codecs.decode_scores(scores), on_error)
    return boards.running_totals(good, "key", "score")


def predictions(reviews: DataFrame, scorer: Callable[[Column], Column]) -> DataFrame:
    """Keyed records whose value is the label of the text."""
    return scoring.score_stream(reviews, scorer).select("key", F.col("label").alias("value"))


def user_minutes(
    views: DataFrame,
    size: str = VIEW_WINDOW,
    grace: str = "0 seconds",
    on_error: str = "dead_letter",
    late: str = WATERMARK,
) -> DataFrame:
    """Minutes per user and window: ``interval_timestamp, user, total_minutes``."""
    good = good_records(codecs.decode_views(views), on_error)
    return as_user_minutes(tumbling_sums(good, size, ["user"], view_minutes(), None, grace, late))


def as_user_minutes(totals: DataFrame) -> DataFrame:
    return totals.select(_interval(), "user", "total_minutes")


def topic_totals(views: DataFrame, on_error: str = "dead_letter") -> DataFrame:
    """Running board ``member, score`` of the number of views per topic."""
    return boards.running_counts(good_records(codecs.decode_views(views), on_error), "view_topic")
