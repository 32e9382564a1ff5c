"""Row filters; all are plain predicates, so Catalyst can push them into the scan."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import within_sigma
from tidewatch.schema import MIN_DAILY_EVENTS, SIGMA_LIMIT


def is_valid_event() -> Column:
    """Duration present, not NaN and not negative; value present and not NaN; time present."""
    duration, value = F.col("event_duration"), F.col("value")
    return (
        (duration >= 0) & ~F.isnan(duration) & value.isNotNull() & ~F.isnan(value)
        & F.col("timestamp").isNotNull()
    )


def drop_invalid_events(events: DataFrame) -> DataFrame:
    return events.filter(is_valid_event())


def filter_qualified_devices(daily_stats: DataFrame, min_events: int = MIN_DAILY_EVENTS) -> DataFrame:
    """Groups with at least ``min_events`` distinct events."""
    return daily_stats.filter(F.col("distinct_events") >= min_events)


def keep_inliers(df: DataFrame, column: str, k: float = SIGMA_LIMIT) -> DataFrame:
    """Rows within ``k`` sigma of the ``mu`` and ``sigma`` they carry, bounds included."""
    return df.filter(within_sigma(F.col(column), F.col("mu"), F.col("sigma"), k))


def in_days(first: date, last: date) -> Column:
    """Days ``first`` to ``last`` as a predicate over the partition columns year, month and day.

    A filter on ``window_start`` cannot prune folders; this one can. Months in the middle of
    the range need no day test, so the predicate stays short for long ranges.
    """
    if last < first:
        return F.lit(False)
    year, month, day = F.col("year"), F.col("month"), F.col("day")
    month_index = year * 12 + month
    low, high = first.year * 12 + first.month, last.year * 12 + last.month
    after = (month_index > low) | ((month_index == low) & (day >= first.day))
    before = (month_index < high) | ((month_index == high) & (day <= last.day))
    return year.between(first.year, last.year) & after & before
