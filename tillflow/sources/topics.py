"""Topics as frames of (key, value) text.

With Kafka a topic is a subscription. Everywhere else the topics are one folder
of parquet files, partitioned by ``topic``, with the columns key, value, at and
position. The last two tell which of two messages is the later one.
"""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Where a message stands in its source's order: time of the change in milliseconds, then position.
VERSION = ["at", "position"]
MESSAGE = "key string, value string, at bigint, position bigint, topic string"


def kafka_options(
    servers: str, topic: str, starting: str | dict[int, int] = "latest", **options: str
) -> dict[str, str]:
    """Source options of a topic, from ``latest``/``earliest`` or from given positions.

    ``starting`` may map partition numbers to offsets. It only counts on the
    first start: after that the query's checkpoint holds the positions.
    """
    offsets = (
        starting
        if isinstance(starting, str)
        else json.dumps({topic: {str(p): offset for p, offset in starting.items()}})
    )
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": offsets,
        **options,
    }


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """A Kafka topic as a stream. Set ``maxOffsetsPerTrigger`` to bound a batch."""
    return (
        spark.readStream.format("kafka").options(**options).load()
        .select(
            F.col("key").cast("string"),
            F.col("value").cast("string"),
            F.unix_millis("timestamp").alias("at"),
            F.col("offset").alias("position"),
        )
    )


def read_topic_stream(
    spark: SparkSession, root: str, topic: str, files_per_batch: int | None = None
) -> DataFrame:
    """A topic of a folder as a stream; other topics are pruned by partition.

    Messages without a time or position of their own have those of their file.
    """
    reader = spark.readStream.schema(MESSAGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    messages = reader.parquet(root).filter(F.col("topic") == topic)
    at = F.coalesce("at", F.unix_millis("_metadata.file_modification_time"))
    position = F.coalesce("position", "_metadata.row_index")
    return messages.select("key", "value", at.alias("at"), position.alias("position"))


def read_topic(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """All messages of a topic in a folder."""
    messages = spark.read.schema(MESSAGE).parquet(root)
    return messages.filter(F.col("topic") == topic).select("key", "value")


def with_key(messages: DataFrame) -> DataFrame:
    """(topic, key, value, at, position) of messages that may lack a key and a place."""

    def given(name: str, kind: str):
        column = F.col(name) if name in messages.columns else F.lit(None)
        return column.cast(kind).alias(name)

    return messages.select(
        "topic", given("key", "string"), "value", *[given(name, "bigint") for name in VERSION]
    )


def write_topics(messages: DataFrame, root: str) -> None:
    """Appends a batch of (topic, key, value) messages to a folder."""
    with_key(messages).write.mode("append").partitionBy("topic").parquet(root)


def write_kafka(messages: DataFrame, servers: str) -> None:
    """Sends a batch of (topic, key, value) messages, each to the topic in its row."""
    sent = with_key(messages).select("topic", "key", "value")
    sent.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
