"""Topics: keyed string records with a time, read as a stream or as a batch.

The envelope has the column names of Spark's Kafka source, so a Kafka topic, a directory that
stands in for one, and a table mapped to records are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidewatch.operators.numbering import number_rows

ENVELOPE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def kafka_options(servers: str, topic: str, max_offsets: int | None = None) -> dict[str, str]:
    """Start at the oldest record; ignored by Spark once the query has a checkpoint."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def as_envelope(df: DataFrame) -> DataFrame:
    """Cast a Kafka-shaped DataFrame (binary key and value) to the envelope."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in ENVELOPE.fields])


def from_kafka(
    spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None
) -> DataFrame:
    reader = spark.readStream.format("kafka")
    return as_envelope(reader.options(**kafka_options(servers, topic, max_offsets)).load())


def from_directory(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Stream a topic directory; files are taken in the order in which they were written."""
    reader = spark.readStream.schema(ENVELOPE)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def publish_keyed(
    df: DataFrame,
    key: Column,
    value: Column,
    timestamp: Column,
    topic: str,
    partition: Column | None = None,
    offset: Column | None = None,
) -> DataFrame:
    """Turn rows into envelope records. A projection: it does not shuffle.

    ``partition`` and ``offset`` are for stand-ins; a broker assigns its own.
    """
    columns = [
        key,
        value,
        F.lit(topic),
        F.lit(0) if partition is None else partition,
        F.lit(None) if offset is None else offset,
        timestamp,
    ]
    return df.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(columns, ENVELOPE.fields)])


def publish_ranges(records: DataFrame, path: str, position: Column, ranges: list[tuple]) -> None:
    """Write a topic directory range by range: the records with ``begin <= position < end`` for each
    (begin, end) in turn, a file for each of their topic partitions.

    Files are streamed in the order in which they were written, so a consumer gets each topic partition
    in that order, whatever it takes at once.
    """
    for begin, end in ranges:
        rows = records.where((position >= F.lit(begin)) & (position < F.lit(end)))
        rows.repartition("partition").write.mode("append").parquet(path)


def assign_offsets(records: DataFrame, tiebreak: list[str]) -> DataFrame:
    """Dense offsets 0, 1, ... per topic partition in time order.

    Batch only. ``tiebreak`` names columns that make the order of equal times definite. The
    numbering is spread over range partitions, so one hot topic partition is no single task.
    """
    order = [F.col("timestamp").asc(), *[F.col(c).asc() for c in tiebreak]]
    numbered = number_rows(records.drop("offset"), order, name="offset", start=0, per=["partition"])
    return numbered.select(*[F.col(f.name).cast(f.dataType) for f in ENVELOPE.fields])
