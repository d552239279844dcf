"""Event streams from files or from Kafka topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptide.schemas import RAW

# The topics shop events arrive on.
TOPICS = ("user_clicks", "cart_events", "purchases")


def read_file_stream(
    spark: SparkSession, path: str, file_format: str = "parquet", **options: str
) -> DataFrame:
    """New files of a folder as a stream of raw events. Streams need a schema and zoned times."""
    return spark.readStream.schema(RAW).format(file_format).options(**options).load(path)


def read_topic_stream(
    spark: SparkSession, servers: str, topics: Sequence[str] = TOPICS, **options: str
) -> DataFrame:
    """Raw events from Kafka; needs the Kafka source of Spark on the class path."""
    messages = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .options(**options)
        .load()
    )
    return decode_messages(messages)


def _parsed(messages: DataFrame) -> DataFrame:
    """The messages with ``event``, and ``event._bad`` where the text does not fit the schema."""
    event = F.from_json(
        F.col("value").cast("string"), T.StructType([*RAW.fields, T.StructField("_bad", T.StringType())]), {"columnNameOfCorruptRecord": "_bad"}
    )
    return messages.withColumn("event", event)


def _fits() -> Column:
    return F.col("event").isNotNull() & F.col("event._bad").isNull()


def decode_messages(messages: DataFrame) -> DataFrame:
    """Raw events from JSON messages in a binary or text column ``value``.

    Messages that do not fit are not here but in ``rejected_messages``.
    """
    return _parsed(messages).where(_fits()).select(*(f"event.{c}" for c in RAW.names))


def rejected_messages(messages: DataFrame) -> DataFrame:
    """The messages, as they came, that are no JSON or have a field of another type."""
    return _parsed(messages).where(~_fits()).select(*messages.columns)
