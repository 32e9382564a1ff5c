"""Batch latency, lag and late drops of a running stream, as rows."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidewatch.shared import scratch_path
from tidewatch.streaming.runner import DECODED

PROGRESS_SCHEMA = (
    "query string, batch_id bigint, started timestamp, batch_ms bigint, input_rows bigint, "
    "input_rows_per_second double, processed_rows_per_second double, offsets_behind bigint, "
    "state_rows bigint, dropped_late bigint, decoded_rows bigint, invalid_rows bigint"
)


def progress_row(progress: Mapping) -> tuple:
    """One batch report in the column order of :data:`PROGRESS_SCHEMA`."""
    state = progress.get("stateOperators") or []
    behind = [
        int(float(source["metrics"]["maxOffsetsBehindLatest"]))
        for source in progress.get("sources") or []
        if "maxOffsetsBehindLatest" in (source.get("metrics") or {})
    ]
    durations = progress.get("durationMs") or {}
    decoded = (progress.get("observedMetrics") or {}).get(DECODED) or {}
    return (
        progress.get("name"),
        progress["batchId"],
        datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00")),
        durations.get("triggerExecution", progress.get("batchDuration")),
        progress.get("numInputRows"),
        progress.get("inputRowsPerSecond"),
        progress.get("processedRowsPerSecond"),
        max(behind) if behind else None,
        sum(s.get("numRowsTotal", 0) for s in state),
        sum(s.get("numRowsDroppedByWatermark", 0) for s in state),
        decoded.get("rows"),
        decoded.get("invalid"),
    )


def progress_frame(spark: SparkSession, reports: Iterable[Mapping]) -> DataFrame:
    """Batch reports as a DataFrame; there are few of them, whatever the traffic."""
    return spark.createDataFrame([progress_row(r) for r in reports], PROGRESS_SCHEMA)


def recent_progress(query: StreamingQuery) -> DataFrame:
    """The batches a query still remembers (``spark.sql.streaming.numRecentProgressUpdates``)."""
    return progress_frame(SparkSession.active(), [json.loads(p.json) for p in query.recentProgress])


class ProgressLog(StreamingQueryListener):
    """All batch reports of a session's queries, as a table that outlives the driver.

    Reports are appended to the Parquet table at ``path`` (default: a new one in the shared folder)
    whenever ``every`` of them have come, and by :meth:`flush`; only those after that are held here.
    """

    def __init__(self, path: str | None = None, every: int = 100):
        self.path = path or scratch_path(SparkSession.active(), "progress")
        self.every = every
        self.unwritten: list[dict] = []
        self.failures: list[str] = []  # one for each query that failed

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.unwritten.append(json.loads(event.progress.json))
        if len(self.unwritten) >= self.every:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception is not None:
            self.failures.append(event.exception)

    def flush(self) -> None:
        """Append what is held to the table."""
        reports = list(self.unwritten)
        if reports:
            progress_frame(SparkSession.active(), reports).coalesce(1).write.mode("append").parquet(self.path)
            self.unwritten = self.unwritten[len(reports) :]  # a failed write keeps them

    def frame(self, spark: SparkSession) -> DataFrame:
        held = progress_frame(spark, list(self.unwritten))
        try:
            return spark.read.schema(PROGRESS_SCHEMA).parquet(self.path).unionByName(held)
        except AnalysisException:  # nothing written yet
            return held
