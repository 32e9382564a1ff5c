"""The event contract: schemas, fixed values and the names of the tables' columns."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the event contract.
DEVICE_TYPES = ("temperature", "pressure", "humidity", "motion", "light")
STATUSES = ("normal", "warning", "critical")
DEVICE_ID_PATTERN = r"^device-\d{3}\z"
LOCATION_PATTERN = r"^zone-[A-E]\z"
FIRMWARE_PATTERN = r"^v\d\.\d\.\d\z"
DURATION_RANGE_MS = (0, 1000)

# Fixed defaults of the pipeline and of the daily percentile question.
WINDOW_LENGTH = "1 minute"
WATERMARK_DELAY = "10 minutes"
TRIGGER_INTERVAL = "30 seconds"
MIN_DAILY_EVENTS = 500
SIGMA_LIMIT = 3.0
PERCENTILE = 0.95

STRING, LONG, INT, DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
BINARY, INSTANT, TEXT_MAP = T.BinaryType(), T.TimestampType(), T.MapType(T.StringType(), T.StringType())


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, data_type) for name, data_type in columns.items()])


# A JSON payload as it travels; the time is still ISO-8601 text. JSON decoding never
# enforces NOT NULL, so every field is nullable here and validity is a filter.
WIRE_SCHEMA = _struct(
    event_id=STRING, device_id=STRING, device_type=STRING, timestamp=STRING,
    event_duration=DOUBLE, value=DOUBLE, status=STRING, metadata=TEXT_MAP,
)

# The decoded event.
EVENT_SCHEMA = _struct(
    event_id=STRING, device_id=STRING, device_type=STRING, timestamp=INSTANT,
    event_duration=DOUBLE, value=DOUBLE, status=STRING, metadata=TEXT_MAP,
)

# A record of the message bus.
MESSAGE_SCHEMA = _struct(
    key=BINARY, value=BINARY, topic=STRING, partition=INT, offset=LONG, timestamp=INSTANT
)

# The landed table of window aggregates; the last four columns are its partition columns.
WINDOW_SCHEMA = _struct(
    window_start=INSTANT, window_end=INSTANT, device_type=STRING, event_count=LONG,
    avg_duration=DOUBLE, min_duration=DOUBLE, max_duration=DOUBLE, avg_value=DOUBLE,
    processing_time=INSTANT, year=INT, month=INT, day=INT, hour=INT,
)

PARTITION_COLUMNS = ("year", "month", "day", "hour")
GROUP_KEYS = ("device_type", "date")
REQUIRED_EVENT_COLUMNS = frozenset(
    {"event_id", "device_id", "device_type", "timestamp", "event_duration", "value"}
)
REQUIRED_RESULT_COLUMNS = frozenset({"device_type", "date", "p95_duration", "total_events"})
