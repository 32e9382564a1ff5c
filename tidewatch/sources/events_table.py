"""Adapter from the wide ``events`` table to the event contract and to bus messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.project import encode_columns

WARNING_FROM = 100


def contract_events(table: DataFrame) -> DataFrame:
    """Columns of the contract; the time keeps its type (without zone in the given tables)."""
    status = (
        F.when(F.col("event_type") == "error", "critical")
        .when(F.col("value") >= WARNING_FROM, "warning")
        .otherwise("normal")
    )
    return table.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("device_id"),
        F.col("event_type").alias("device_type"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("event_duration"),
        F.col("value"),
        status.alias("status"),
        F.from_json("props", "map<string,string>").alias("metadata"),
    )


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return contract_events(spark.read.parquet(f"{folder}/events.parquet"))


def stream_events(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """The same table as a stream; watermarks want an instant, so the time becomes one."""
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    # As a pattern, the path may be one file or a folder of files; a plain path must be a folder.
    table = spark.readStream.schema(schema).options(**options).parquet(f"{folder}/events.parque[t]")
    return contract_events(table.withColumn("ts", F.col("ts").cast("timestamp")))


def as_messages(events: DataFrame, partitions: int = 3, topic: str = "events") -> DataFrame:
    """Bus messages of the events, with partition and offset taken from the numeric identifier."""
    number = F.col("event_id").cast("bigint")
    return events.select(
        *encode_columns(events.columns),
        F.lit(topic).alias("topic"),
        F.pmod(number, F.lit(partitions)).cast("int").alias("partition"),
        F.call_function("div", number, F.lit(partitions)).alias("offset"),
        "timestamp",
    )
