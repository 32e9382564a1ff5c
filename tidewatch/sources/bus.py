"""Message-bus source and sink, and message files of the same shape for replays and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.project import encode_events
from tidewatch.schema import MESSAGE_SCHEMA


def subscribe_options(
    brokers: str,
    topic: str,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of a Kafka subscription. The cap per trigger bounds a micro-batch, not the total."""
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def publish_options(brokers: str, topic: str) -> dict[str, str]:
    """Options of a Kafka write: acknowledged by all replicas, ordered, retried, compressed."""
    return {
        "kafka.bootstrap.servers": brokers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.max.in.flight.requests.per.connection": "1",
        "kafka.compression.type": "gzip",
        "kafka.linger.ms": "10",
    }


def stream_messages(spark: SparkSession, brokers: str, topic: str, **settings) -> DataFrame:
    """Subscribe to ``topic``; needs Spark's Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**subscribe_options(brokers, topic, **settings)).load()


def read_messages(spark: SparkSession, brokers: str, topic: str, **settings) -> DataFrame:
    """The topic's present content as a batch."""
    return spark.read.format("kafka").options(**subscribe_options(brokers, topic, **settings)).load()


def publish_events(events: DataFrame, brokers: str, topic: str) -> None:
    encode_events(events).write.format("kafka").options(**publish_options(brokers, topic)).save()


def stream_message_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files of bus records as a stream."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def stream_json_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Files with one JSON payload per line as a stream of messages."""
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path).select(
        F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value")
    )
