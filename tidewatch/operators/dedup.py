"""Duplicate removal by identifier, in batch and within the watermark of a stream."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.schema import WATERMARK_DELAY


def dedup_events(
    events: DataFrame,
    keys: Sequence[str] = ("event_id",),
    time: str = "timestamp",
    delay: str = WATERMARK_DELAY,
    keep_unnamed: bool = True,
) -> DataFrame:
    """One event per identifier.

    A stream forgets an identifier once the watermark has passed its time by ``delay``, so its
    state is bounded. A batch keeps the earliest copy; equally early copies are ordered by their
    other columns, so a rerun keeps the same row. Spark applies the first-per-key limit before
    the shuffle too, so the copies of one identifier never meet in one task.

    Events without an identifier can't be told to be copies. A batch keeps all of them where they are: they are
    neither sorted nor moved. A stream, where they would share one entry of the state, leaves them out, as does a
    batch without ``keep_unnamed``.
    """
    named = reduce(Column.__and__, [F.col(key).isNotNull() for key in keys])
    if events.isStreaming:
        return events.withWatermark(time, delay).filter(named).dropDuplicatesWithinWatermark(list(keys))
    ties = [
        F.array_sort(F.map_entries(c)) if isinstance(events.schema[c].dataType, T.MapType) else F.col(c)
        for c in events.columns
        if c not in keys and c != time
    ]
    copies = Window.partitionBy(*keys).orderBy(time, *ties)
    once = events.filter(named).withColumn("__copy", F.row_number().over(copies)).filter("__copy = 1").drop("__copy")
    return once.unionByName(events.filter(~named)) if keep_unnamed else once
