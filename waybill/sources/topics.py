"""Topics as streams of envelopes: ``value, topic, message_id, message_ts``.

Kafka in production; a folder of JSON-lines files takes its place where there is no
broker, with the same columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENVELOPE = "value string, topic string, message_id string, message_ts timestamp"


def kafka_topics(
    spark: SparkSession,
    topics: Sequence[str],
    servers: str,
    messages_per_batch: int = 10_000,
    **options: str,
) -> DataFrame:
    """Envelopes of one or more Kafka topics; needs the Kafka connector on the class path."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("maxOffsetsPerTrigger", messages_per_batch)
        .options(**options)
        .load()
    )
    return raw.select(
        F.col("value").cast("string").alias("value"),
        "topic",
        F.concat_ws("-", "topic", "partition", "offset").alias("message_id"),
        F.col("timestamp").alias("message_ts"),
    )


def folder_topics(
    spark: SparkSession, folder: str, topics: Sequence[str] | None = None, files_per_batch: int = 1_000
) -> DataFrame:
    """Envelopes dropped into a folder as JSON lines (see ``publish_to_folder``)."""
    stream = (
        spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", files_per_batch).json(folder)
    )
    return stream.filter(F.col("topic").isin(*topics)) if topics else stream


def union_topics(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Several topic streams as one."""
    for other in others:
        first = first.unionByName(other)
    return first


def _payload_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).filter(F.trim("value") != "")


def publish_to_kafka(spark: SparkSession, path: str, topic: str, servers: str) -> None:
    """Sends every line of a text file as one message."""
    (
        _payload_lines(spark, path)
        .withColumn("topic", F.lit(topic))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .save()
    )


def publish_to_folder(lines: DataFrame, topic: str, folder: str) -> None:
    """Drops every row of a frame with a ``value`` column as one message.

    ``message_id`` and ``message_ts`` are taken from the frame where it has them.
    """
    columns = lines.columns
    envelopes = lines.select(
        "value",
        F.lit(topic).alias("topic"),
        "message_id" if "message_id" in columns else F.uuid().alias("message_id"),
        "message_ts" if "message_ts" in columns else F.current_timestamp().alias("message_ts"),
    )
    envelopes.write.mode("append").json(folder)


def publish_file_to_folder(spark: SparkSession, path: str, topic: str, folder: str) -> None:
    publish_to_folder(_payload_lines(spark, path), topic, folder)
