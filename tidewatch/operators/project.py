"""Row-to-row transforms: decoding, derived columns and column subsets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import functions as E
from tidewatch.schema import WIRE_SCHEMA

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def computed_once(column: Column) -> Column:
    """``column`` behind a one-element explode, so that it is computed once per row.

    Catalyst moves a filter below the projection it reads from by repeating the projected
    expression, which for a parsed payload means parsing it once per condition. It does not do
    so across a generator.
    """
    return F.explode(F.array(column))


def decode_messages(
    messages: DataFrame, schema: T.StructType = WIRE_SCHEMA, payload: str = "value"
) -> DataFrame:
    """JSON payloads to the columns of ``schema``; malformed text gives a row of NULLs."""
    decoded = F.from_json(F.col(payload).cast("string"), schema)
    return messages.select(computed_once(decoded).alias("data")).select("data.*")


def decode_events(messages: DataFrame, payload: str = "value") -> DataFrame:
    """Messages to events of the contract, with ``timestamp`` as an instant."""
    return with_event_time(decode_messages(messages, WIRE_SCHEMA, payload))


def with_event_time(df: DataFrame, column: str = "timestamp") -> DataFrame:
    return df.withColumn(column, E.parse_event_time(column))


def encode_columns(fields: Sequence[str], key: str = "device_id") -> list[Column]:
    """``key`` and a JSON ``value`` of ``fields`` that decodes to the same event."""
    payload = F.to_json(F.struct(*fields), {"timestampFormat": ISO_MICROS, "ignoreNullFields": "false"})
    return [F.col(key).cast("binary").alias("key"), payload.cast("binary").alias("value")]


def encode_events(events: DataFrame, key: str = "device_id") -> DataFrame:
    """Events to messages."""
    return events.select(*encode_columns(events.columns, key))


def with_event_date(df: DataFrame, time: str = "window_start") -> DataFrame:
    return df.withColumn("date", E.event_date(time))


def daily_window_rows(windows: DataFrame) -> DataFrame:
    """The columns of the window table that the daily percentile needs, with their date."""
    needed = ["window_start", "device_type", "avg_duration", "event_count", "year", "month", "day"]
    return with_event_date(windows.select(*needed))


def with_calendar_parts(df: DataFrame, time: str = "window_start") -> DataFrame:
    return df.select("*", *E.calendar_parts(F.col(time)))


def unpack_window(df: DataFrame, window: str = "window") -> DataFrame:
    """``window`` struct to leading columns window_start and window_end."""
    rest = [c for c in df.columns if c != window]
    return df.select(
        F.col(f"{window}.start").alias("window_start"), F.col(f"{window}.end").alias("window_end"), *rest
    )


def with_processing_time(df: DataFrame) -> DataFrame:
    return df.withColumn("processing_time", F.current_timestamp())


def enrich_with_metadata(df: DataFrame) -> DataFrame:
    """Adds ``is_critical`` and ``duration_category``."""
    return df.withColumns(
        {
            "is_critical": E.is_critical(F.col("status")),
            "duration_category": E.duration_category(F.col("event_duration")),
        }
    )


def with_map_entries(df: DataFrame, keys: Sequence[str], column: str = "metadata") -> DataFrame:
    """One column per map key."""
    return df.withColumns({key: E.map_entry(F.col(column), key) for key in keys})
