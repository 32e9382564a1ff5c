"""Scalar expressions over one event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Duration classes in milliseconds and the accepted forms of an identifier.
FAST_BELOW_MS = 100
NORMAL_BELOW_MS = 300
CANONICAL_UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\z"
BARE_UUID = r"^[0-9a-fA-F]{32}\z"
DATE_TIME = r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})\z"


def parse_event_time(text: Column | str) -> Column:
    """Full date and time with ``Z`` or an offset (RFC 3339) to an instant; any other text gives NULL.

    A time alone, a year or a region name would be read as some day that the text doesn't name.
    """
    column = F.col(text) if isinstance(text, str) else text
    return F.when(column.rlike(DATE_TIME), F.try_to_timestamp(F.upper(column)))


def event_date(time: Column | str) -> Column:
    return F.to_date(time)


def calendar_parts(time: Column) -> list[Column]:
    """The partition columns year, month, day and hour of ``time``."""
    return [
        F.year(time).alias("year"),
        F.month(time).alias("month"),
        F.dayofmonth(time).alias("day"),
        F.hour(time).alias("hour"),
    ]


def is_critical(status: Column) -> Column:
    """True for status ``critical``; never NULL."""
    return F.coalesce(status == "critical", F.lit(False))


def duration_category(duration: Column) -> Column:
    """``fast``, ``normal`` or ``slow``; a missing duration counts as slow."""
    return (
        F.when(duration < FAST_BELOW_MS, "fast")
        .when(duration < NORMAL_BELOW_MS, "normal")
        .otherwise("slow")
    )


def map_entry(entries: Column, key: str) -> Column:
    """Value of ``key`` in a map, NULL when the map or the key is missing."""
    return F.try_element_at(entries, F.lit(key))


def is_uuid(text: Column, strict: bool = True) -> Column:
    """Whether ``text`` is a UUID; NULL is not.

    ``strict`` wants the canonical 8-4-4-4-12 form. The lenient form also accepts braces, the
    ``urn:uuid:`` prefix and any placement of hyphens.
    """
    if strict:
        matches = text.rlike(CANONICAL_UUID)
    else:
        bare = F.regexp_replace(text, r"urn:|uuid:", "")
        bare = F.regexp_replace(bare, r"^[{}]+|[{}]+$|-", "")
        matches = bare.rlike(BARE_UUID)
    return F.coalesce(matches, F.lit(False))
