"""The given tables as batch or stream, and the topics derived from them.

Every mapping is a projection (one equi-join for orders) and works on batch and stream alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.functions import codecs
from tidewatch.sources.envelope import publish_keyed

# Names of the input topics.
ORDERS_TOPIC = "streaming.orders.input"
ALERTS_TOPIC = "streaming.alerts.input"
SCORES_TOPIC = "streaming.leaderboards.input"
REVIEWS_TOPIC = "streaming.sentiment.input"
VIEWS_TOPIC = "streaming.views.input"

PARTITIONS = 4


def table(spark: SparkSession, sf_dir: str, name: str, stream: bool = False) -> DataFrame:
    """A parquet table, as a file or a directory, read whole or as a stream of its files."""
    path = f"{sf_dir}/{name}.parquet"
    batch = spark.read.parquet(path)
    if not stream:
        return batch
    # The braces make the path a glob, for which a stream accepts a single file as well.
    return spark.readStream.schema(batch.schema).parquet(f"{sf_dir}/{{{name}}}.parquet")


def _instant(column: str) -> Column:
    return F.col(column).cast("timestamp")


def products(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("product"))


def orders_topic(
    lineitem: DataFrame, product: DataFrame, value: Column | None = None
) -> DataFrame:
    """Order records as JSON, keyed by order id.

    The join strategy is left to Spark, which compares the size of ``product`` with its broadcast
    limit and otherwise shuffles both sides; on a batch it also splits hot keys at run time.
    """
    rows = lineitem.join(product, "l_partkey")
    order = codecs.encode_order(
        F.col("l_orderkey").cast("int"),
        F.col("product"),
        F.col("l_quantity").cast("int"),
        F.col("l_extendedprice"),
    )
    return publish_keyed(
        rows,
        F.col("l_orderkey"),
        order if value is None else F.coalesce(value, order),
        _instant("l_shipdate"),
        ORDERS_TOPIC,
        partition=F.col("l_orderkey") % PARTITIONS,
    )


def orders_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order records as a stream of lineitem, joined with the products as they are now."""
    lineitem = table(spark, sf_dir, "lineitem", stream=True)
    return orders_topic(lineitem, products(table(spark, sf_dir, "part")))


def broken_order() -> Column:
    """Values for the dead-letter fixture: orders 0, 97, 194, ... are not JSON."""
    return F.when(
        F.col("l_orderkey") % 97 == 0,
        F.concat(F.lit("broken "), F.col("l_orderkey").cast("string")),
    )


def alert_level() -> Column:
    return (
        F.when(F.col("event_type") == "error", "CRITICAL")
        .when(F.col("event_type") == "purchase", "HIGH")
        .otherwise("ELEVATED")
    )


def _from_events(
    events: DataFrame, key: Column, value: Column, topic: str, time: Column | None = None
) -> DataFrame:
    return publish_keyed(
        events,
        key,
        value,
        _instant("ts") if time is None else time,
        topic,
        partition=F.col("user_id") % PARTITIONS,
        offset=F.col("event_id"),
    )


def alerts_topic(events: DataFrame) -> DataFrame:
    level = alert_level()
    code = (F.lit(100) * (F.lit(1) + F.col("event_id") % 4)).cast("string")
    mesg = F.concat(F.lit("This is a "), level, F.lit(" alert"))
    value = codecs.encode_alert(_instant("ts"), level, code, mesg)
    return _from_events(events, F.col("event_id"), value, ALERTS_TOPIC)


def event_user() -> Column:
    return F.concat(F.lit("user-"), F.col("user_id").cast("string"))


def event_points() -> Column:
    return F.lit(1) + F.col("event_id") % 10


def scores_topic(events: DataFrame) -> DataFrame:
    return _from_events(events, event_user(), event_points().cast("string"), SCORES_TOPIC)


def views_topic(events: DataFrame, time: Column | None = None) -> DataFrame:
    value = codecs.encode_view(_instant("ts"), event_user(), F.col("event_type"), event_points())
    return _from_events(events, F.col("event_id"), value, VIEWS_TOPIC, time)


def shifted_time() -> Column:
    """Out-of-order record times: up to 12 hours early, by event id."""
    hours = (F.col("event_id") * 7) % 13
    return F.timestamp_micros(F.unix_micros(_instant("ts")) - hours * 3_600_000_000)


def reviews_topic(texts: DataFrame, key: Column, seconds: Column) -> DataFrame:
    return publish_keyed(
        texts, key, F.col("text"), F.timestamp_seconds(seconds), REVIEWS_TOPIC, offset=seconds
    )
