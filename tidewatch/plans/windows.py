"""Events to window aggregates: the same body for a batch and for a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import functions as E
from tidewatch.operators.aggregate import window_aggregates
from tidewatch.operators.dedup import dedup_events
from tidewatch.operators.filters import is_valid_event
from tidewatch.operators.project import unpack_window
from tidewatch.schema import WATERMARK_DELAY, WINDOW_LENGTH


def is_usable_event() -> Column:
    """A valid event with an identifier; never NULL."""
    return F.coalesce(is_valid_event(), F.lit(False)) & F.col("event_id").isNotNull()


def events_to_windows(
    events: DataFrame, length: str = WINDOW_LENGTH, delay: str = WATERMARK_DELAY, sketch: bool = False
) -> DataFrame:
    """Valid events, once each, aggregated per window and device type, with partition columns.

    Invalid rows go first, so that an invalid copy cannot displace a valid one; an event without an
    identifier is invalid too (``split_valid`` with the contract's rules says so of each). Only the
    columns of the result take part in the deduplication, which keeps its shuffle narrow. A batch
    removes copies at any distance in time, a stream those within ``delay``. ``sketch`` adds a quantile sketch
    of the durations to every window.
    """
    valid = events.filter(is_valid_event() & F.col("event_id").isNotNull()).select("event_id", "device_type", "timestamp", "event_duration", "value")
    once = dedup_events(valid, delay=delay, keep_unnamed=False)
    return unpack_window(window_aggregates(once, length, sketch=sketch)).select(
        "*", F.current_timestamp().alias("processing_time"), *E.calendar_parts(F.col("window_start"))
    )
