"""Stream-health questions as aggregations over the event or message table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.project import unpack_window
from tidewatch.operators.quality import Rule, any_failed
from tidewatch.operators.quantiles import quantiles_of_counts
from tidewatch.operators.sketches import distinct_sketch, merged_distinct

# Stands in for a missing event time while windows are formed; no event is that old.
NO_TIME = "0001-06-01 00:00:00"


def seconds_between(start: Column, end: Column) -> Column:
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(1_000_000.0)


def window_counts(
    events: DataFrame, length: str, keys: Sequence[str] = (), time: str = "timestamp"
) -> DataFrame:
    """Events and events per second for each window and key combination."""
    counted = events.groupBy(F.window(time, length), *keys).agg(F.count("*").alias("events"))
    return _with_rate(unpack_window(counted))


def event_rates(events: DataFrame, length: str, time: str = "timestamp") -> DataFrame:
    """Rates by type and status, by type, by status and in total, from one pass over the events.

    The coarser levels are summed from the finest one, so the events are counted once.
    ``level`` names the level; a key that a level does not use is NULL.
    """
    keys = ["device_type", "status"]
    finest = window_counts(events, length, keys, time).drop("events_per_second")
    span = ["window_start", "window_end"]
    levels = finest.groupingSets(
        [[*span, *keys], [*span, "device_type"], [*span, "status"], span], *span, *keys
    ).agg(
        F.sum("events").alias("events"),
        F.when((F.grouping("device_type") == 0) & (F.grouping("status") == 0), "device_type,status")
        .when(F.grouping("device_type") == 0, "device_type")
        .when(F.grouping("status") == 0, "status")
        .otherwise("total")
        .alias("level"),
    )
    return _with_rate(levels)


def _with_rate(counted: DataFrame) -> DataFrame:
    seconds = seconds_between(F.col("window_start"), F.col("window_end"))
    return counted.withColumn("events_per_second", F.col("events") / seconds)


def active_devices(
    events: DataFrame, length: str, time: str = "timestamp", rsd: float | None = None
) -> DataFrame:
    """Distinct devices per window; a stream, or ``rsd``, selects the approximate count."""
    if events.isStreaming or rsd is not None:
        devices = F.approx_count_distinct("device_id", rsd or 0.05)
    else:
        devices = F.count_distinct("device_id")
    return unpack_window(events.groupBy(F.window(time, length)).agg(devices.alias("active_devices")))


def device_sketches(events: DataFrame, length: str, time: str = "timestamp") -> DataFrame:
    """A sketch of the distinct devices of every window (batch or stream), to be rolled up."""
    return unpack_window(events.groupBy(F.window(time, length)).agg(distinct_sketch(F.col("device_id")).alias("devices")))


def roll_up_devices(windows: DataFrame, keys: Sequence[str] = ("date",)) -> DataFrame:
    """Active devices of longer spans, from the sketches of their windows only (relative error about 0.8 %)."""
    return merged_distinct(windows, "devices", keys).select(*keys, F.hll_sketch_estimate("devices").alias("active_devices"))


def message_sizes(
    messages: DataFrame, length: str | None = None, payload: str = "value", time: str = "timestamp"
) -> DataFrame:
    """Count, mean, exact p50 and p95 of the payload size, per window or overall.

    Sizes are whole numbers with few distinct values, so the table is first reduced to rows per
    size; ordering happens on that small table.
    """
    size = F.octet_length(payload).cast("bigint").alias("size")
    groups = [] if length is None else [F.window(time, length).alias("window")]
    keys = [] if length is None else ["window_start", "window_end"]
    sized = messages.filter(F.col(payload).isNotNull()).groupBy(*groups, size).agg(F.count("*").alias("rows"))
    if length is not None:
        sized = unpack_window(sized)
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    totals = sized.withColumns(
        {
            "messages": F.sum("rows").over(group),
            "mean_bytes": F.sum(F.col("size") * F.col("rows")).over(group) / F.sum("rows").over(group),
        }
    )
    return quantiles_of_counts(
        totals, "size", "rows", {"p50_bytes": 0.5, "p95_bytes": 0.95}, [*keys, "messages", "mean_bytes"]
    )


def partition_offsets(messages: DataFrame, length: str, time: str = "timestamp") -> DataFrame:
    """Latest offset per bus partition and window, and its growth since the previous window.

    A window without messages has no row; the growth rate is over the time that really passed.
    """
    latest = unpack_window(
        messages.groupBy("partition", F.window(time, length)).agg(F.max("offset").alias("latest_offset"))
    )
    # One row per window is left here, so a partition's series is short whatever its traffic.
    series = Window.partitionBy("partition").orderBy("window_start")
    previous, since = F.lag("latest_offset").over(series), F.lag("window_start").over(series)
    growth = F.col("latest_offset") - previous
    return latest.withColumns(
        {
            "offset_growth": growth,
            "offsets_per_second": growth / seconds_between(since, F.col("window_start")),
        }
    )


def silence_gaps(
    events: DataFrame,
    threshold_seconds: int = 300,
    keys: Sequence[str] = ("device_type",),
    time: str = "timestamp",
    still_open: bool = False,
    until: datetime | None = None,
) -> DataFrame:
    """Pauses of more than ``threshold_seconds`` between consecutive events of a key.

    With ``still_open`` there is also a row, with ``gap_end`` NULL, for each key that is silent for
    longer than the threshold at ``until`` (default: the latest event of all keys).

    Two events of one time slot of that length are closer than the threshold, so only the first
    and last event of each slot matter. The rows per key that are put in order are thus bounded
    by the time covered, not by the number of events.
    """
    instant = F.unix_micros(F.col(time).cast("timestamp"))
    slot = F.floor(instant / F.lit(threshold_seconds * 1_000_000)).alias("__slot")
    slots = (
        events.filter(F.col(time).isNotNull())
        .groupBy(*keys, slot)
        .agg(F.min(time).alias("__first"), F.max(time).alias("__last"))
    )
    order = Window.partitionBy(*keys).orderBy("__slot") if keys else Window.orderBy("__slot")
    paired = slots.withColumn("gap_start", F.lag("__last").over(order))
    gap = seconds_between(F.col("gap_start"), F.col("__first"))
    closed = (
        paired.withColumn("gap_seconds", gap)
        .filter(F.col("gap_seconds") > threshold_seconds)
        .select(*keys, "gap_start", F.col("__first").alias("gap_end"), "gap_seconds")
    )
    if not still_open:
        return closed
    kind = events.schema[time].dataType
    last = slots.groupBy(*keys).agg(F.max("__last").alias("gap_start"))
    end = slots.agg(F.max("__last").alias("end")).scalar() if until is None else F.lit(until).cast(kind)
    silent = seconds_between(F.col("gap_start"), end)
    return closed.unionByName(
        last.withColumn("gap_seconds", silent)
        .filter(F.col("gap_seconds") > threshold_seconds)
        .select(*keys, "gap_start", F.lit(None).cast(kind).alias("gap_end"), "gap_seconds")
    )


def stream_silences(
    events: DataFrame, threshold_seconds: int = 300, hold_seconds: int = 0, keys: Sequence[str] = ("device_type",),
    time: str = "timestamp",
) -> DataFrame:
    """Alerts of a stream with a watermark: keys silent for more than the threshold and the hold time.

    Events closer than that are one session. A session is over, and its row appears, once the watermark has passed
    its last event by that time, so an alert is raised while the silence lasts; what is held is one session per key.
    ``silent_since`` is the last event, ``alert_at`` the instant from which the key counts as silent.
    """
    silence = f"{threshold_seconds + hold_seconds} seconds"
    # A session ends where a gap of its length begins; a microsecond more, as a gap of just that length is none.
    sessions = events.groupBy(F.session_window(time, f"{silence} 1 microsecond"), *keys).agg(
        F.max(time).alias("silent_since"), F.count(F.lit(1)).alias("events")
    )
    return sessions.select(*keys, "silent_since", (F.col("silent_since") + F.expr(f"INTERVAL {silence}")).alias("alert_at"), "events")


def error_rates(
    events: DataFrame, rules: Sequence[Rule], length: str, time: str = "timestamp"
) -> DataFrame:
    """Rows that fail any rule, as a share of all rows of the window.

    In a batch, rows without a time are counted too, in one line with NULL window bounds. A
    stream cannot place them in any window and leaves them out.
    """
    clock = F.col(time)
    if not events.isStreaming:
        clock = F.coalesce(clock, F.lit(NO_TIME).cast(events.schema[time].dataType))
    counted = unpack_window(
        events.groupBy(F.window(clock, length)).agg(
            F.count_if(any_failed(rules)).alias("rejected"), F.count("*").alias("events")
        )
    )
    timed = F.year("window_start") > 1
    return counted.select(
        F.when(timed, F.col("window_start")).alias("window_start"),
        F.when(timed, F.col("window_end")).alias("window_end"),
        "rejected",
        "events",
        (F.col("rejected") / F.col("events")).alias("error_rate"),
    )
