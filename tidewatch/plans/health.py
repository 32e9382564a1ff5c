"""All stream-health reports of one message table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import metrics as M
from tidewatch.operators.project import decode_events
from tidewatch.operators.quality import contract_rules


def stream_metrics(messages: DataFrame, length: str = "1 minute", silence_seconds: int = 300) -> dict[str, DataFrame]:
    """Reports by name; each is lazy, and only those that are used are computed.

    ``messages`` has the columns of the bus; rates, devices, errors and gaps use event time,
    offsets and sizes use the time of the message.
    """
    events = decode_events(messages)
    timed = events.filter(F.col("timestamp").isNotNull())
    return {
        "event_rates": M.event_rates(timed, length),
        "messages_per_minute": M.window_counts(timed, "1 minute"),
        "active_devices": M.active_devices(timed, length),
        "message_sizes": M.message_sizes(messages, length),
        "partition_offsets": M.partition_offsets(messages, length),
        "silence_gaps": M.silence_gaps(timed, silence_seconds),
        "error_rates": M.error_rates(events, contract_rules(), length),
    }
