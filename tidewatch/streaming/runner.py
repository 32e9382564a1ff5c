"""The streaming driver: messages in, hourly partitioned window table out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators.project import decode_events
from tidewatch.plans.windows import events_to_windows, is_usable_event
from tidewatch.schema import PARTITION_COLUMNS, TRIGGER_INTERVAL, WATERMARK_DELAY, WINDOW_LENGTH

LIVE = {"processingTime": TRIGGER_INTERVAL}
CATCH_UP = {"availableNow": True}

DECODED = "decoded"  # the name of the counts in a batch report

HOUR_PARTS = 1  # tasks, and so files, that share an hour in one batch


def append_windows(
    windows: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] = LIVE,
    name: str | None = None,
    hour_parts: int = HOUR_PARTS,
) -> StreamingQuery:
    """Start the exactly-once Parquet sink. A window is appended once, after the watermark passes it.

    The rows of an hour are brought to ``hour_parts`` tasks at most: the aggregate deals its windows over all
    shuffle partitions, each of which would write a file to every hour. An hour has one row per window and device
    type, and the hours of a batch are written side by side; more parts are for so many types that an hour is large.
    """
    part = F.pmod(F.xxhash64("window_start", "device_type"), F.lit(hour_parts))
    writer = (
        windows.repartition(*PARTITION_COLUMNS, part)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*PARTITION_COLUMNS)
        .outputMode("append")
        .trigger(**trigger)
    )
    if name is not None:
        writer = writer.queryName(name)
    return writer.start()


def run_stream(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    length: str = WINDOW_LENGTH,
    delay: str = WATERMARK_DELAY,
    trigger: Mapping[str, object] = LIVE,
    name: str | None = None,
    hour_parts: int = HOUR_PARTS,
) -> StreamingQuery:
    """Decode, validate, deduplicate, aggregate and land a stream of messages.

    Every batch report has the batch's decoded and invalid rows, observed while they pass; rows of a task that
    a lost executor makes run again may be in there twice.
    """
    events = decode_events(messages).observe(
        DECODED, F.count(F.lit(1)).alias("rows"), F.count_if(~is_usable_event()).alias("invalid")
    )
    windows = events_to_windows(events, length, delay)
    return append_windows(windows, path, checkpoint, trigger, name, hour_parts)
