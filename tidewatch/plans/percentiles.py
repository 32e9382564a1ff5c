"""The daily percentile question, over raw events or over the landed window table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.shared import durable
from tidewatch.functions import event_date, numeric
from tidewatch.operators.aggregate import (
    compute_daily_statistics,
    compute_percentiles,
    order_by_day,
    qualified_spread,
)
from tidewatch.operators.joins import Sized, keyed_join
from tidewatch.operators.outliers import remove_outliers
from tidewatch.operators.project import daily_window_rows
from tidewatch.operators.quantiles import exact_quantiles
from tidewatch.schema import GROUP_KEYS, MIN_DAILY_EVENTS, PERCENTILE, SIGMA_LIMIT


def daily_durations(events: DataFrame) -> DataFrame:
    """The columns of the question: device_type, date, event_id and event_duration without NaN."""
    return events.select(
        "device_type",
        event_date("timestamp").alias("date"),
        "event_id",
        numeric(F.col("event_duration")).alias("event_duration"),
    )


def p95_from_events(
    events: DataFrame,
    min_events: int = MIN_DAILY_EVENTS,
    k: float = SIGMA_LIMIT,
    q: float = PERCENTILE,
    exact: bool = False,
) -> DataFrame:
    """Percentile of event_duration per device type and day, without outliers.

    Only groups with at least ``min_events`` distinct events count; mean and sigma are those of
    the whole day, outliers included. The percentile is a quantile summary, or with ``exact`` the
    discrete percentile. ``events`` is scanned for the statistics and again for the percentile,
    three columns wide; it is not shuffled by row.
    """
    rows = daily_durations(events)
    spread = qualified_spread(rows, "event_duration", "event_id", min_events)
    if exact:
        return _exact_percentiles(rows, spread, k, q)
    return compute_percentiles(_inliers(rows, spread, k), "event_duration", q)


def _exact_percentiles(rows: DataFrame, spread: Sized, k: float, q: float) -> DataFrame:
    spread = spread.part(durable(spread.frame))
    clean = _inliers(rows, spread, k)
    measures = clean.groupBy(*GROUP_KEYS).agg(
        F.count("*").alias("total_events"),
        F.avg("event_duration").alias("avg_duration"),
        F.avg("mu").alias("mean_duration"),
        F.avg("sigma").alias("stddev_duration"),
    )
    p95 = exact_quantiles(clean, "event_duration", {"p95_duration": q}, GROUP_KEYS)
    if not spread.fits:
        measures, p95 = durable(measures), durable(p95)
    joined = keyed_join(measures, spread.part(p95), GROUP_KEYS)
    return order_by_day(
        joined.select(
            *GROUP_KEYS, "p95_duration", "total_events", "avg_duration", "mean_duration", "stddev_duration"
        )
    )


def _inliers(rows: DataFrame, spread: Sized, k: float) -> DataFrame:
    stats = spread.part(spread.frame.filter("qualified"))
    columns = rows.select(*GROUP_KEYS, "event_duration")
    return remove_outliers(columns, stats, "event_duration", k=k)


def removal_report(
    events: DataFrame, min_events: int = MIN_DAILY_EVENTS, k: float = SIGMA_LIMIT
) -> DataFrame:
    """What the question leaves out: rows of each group, whether it qualified, outliers removed.

    Rows of groups below the gate and outliers of the other groups are separate figures. Together with
    the report itself, :func:`counted_p95_from_events` gives the same for no further pass.
    """
    rows = daily_durations(events)
    spread = qualified_spread(rows, "event_duration", "event_id", min_events)
    spread = spread.part(durable(spread.frame))
    kept = _inliers(rows, spread, k).groupBy(*GROUP_KEYS).agg(F.count("*").alias("kept"))
    return _removals(spread, kept if spread.fits else durable(kept))


def _removals(groups: Sized, kept: DataFrame) -> DataFrame:
    """Rows, kept rows and removed outliers of every group from its ``rows`` and ``qualified``, and ``kept``."""
    joined = keyed_join(
        groups.frame, groups.part(kept), GROUP_KEYS, how="left", null_safe=True
    )
    kept_rows = F.coalesce("kept", F.lit(0).cast("bigint"))
    return joined.select(
        *GROUP_KEYS,
        "rows",
        "qualified",
        kept_rows.alias("kept"),
        F.when(F.col("qualified"), F.col("rows") - kept_rows).otherwise(0).alias("removed"),
    )


@dataclass(frozen=True)
class CountedReport:
    """A finished report, and what went into every group of it: rows, qualified, kept and removed.

    The counts come from the statistics and the report, which are both kept, so no row is read again for them;
    and unlike counters that tasks send, they are right when tasks of a lost executor run twice.
    """

    report: DataFrame
    removals: DataFrame

    def totals(self) -> dict[str, int]:
        """Groups of the report, rows loaded, rows of qualified groups, rows kept and outliers removed."""
        qualified = F.col("qualified")
        row = self.removals.agg(
            F.count_if(F.col("kept") > 0).alias("groups"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("loaded"),
            F.coalesce(F.sum(F.when(qualified, F.col("rows"))), F.lit(0)).alias("qualified"),
            F.coalesce(F.sum("kept"), F.lit(0)).alias("kept"),
            F.coalesce(F.sum("removed"), F.lit(0)).alias("removed"),
        ).first()
        return row.asDict()


def _counted(groups: Sized, report: DataFrame) -> CountedReport:
    report = durable(report)
    return CountedReport(report, _removals(groups, report.select(*GROUP_KEYS, F.col("total_events").alias("kept"))))


def counted_p95_from_events(
    events: DataFrame,
    min_events: int = MIN_DAILY_EVENTS,
    k: float = SIGMA_LIMIT,
    q: float = PERCENTILE,
) -> CountedReport:
    """:func:`p95_from_events` with :func:`removal_report`, in the passes of the first alone."""
    rows = daily_durations(events)
    spread = qualified_spread(rows, "event_duration", "event_id", min_events)
    spread = spread.part(durable(spread.frame))
    return _counted(spread, compute_percentiles(_inliers(rows, spread, k), "event_duration", q))


def p95_from_windows(
    windows: DataFrame,
    min_events: int = MIN_DAILY_EVENTS,
    k: float = SIGMA_LIMIT,
    q: float = PERCENTILE,
) -> DataFrame:
    """The same report over per-window averages; the gate counts distinct windows.

    This answers a different question than :func:`p95_from_events`: every window weighs the
    same, and ``total_events`` counts windows.
    """
    rows, groups = _window_groups(windows, min_events)
    return _window_percentiles(rows, groups, k, q)


def counted_p95_from_windows(
    windows: DataFrame,
    min_events: int = MIN_DAILY_EVENTS,
    k: float = SIGMA_LIMIT,
    q: float = PERCENTILE,
) -> CountedReport:
    """:func:`p95_from_windows` with its counts of windows, in the same two passes."""
    rows, groups = _window_groups(windows, min_events)
    return _counted(groups, _window_percentiles(rows, groups, k, q))


def _window_groups(windows: DataFrame, min_events: int) -> tuple[DataFrame, Sized]:
    """The rows of the question, and the statistics of every group with whether it ``qualified``."""
    rows = daily_window_rows(windows)
    passed = F.coalesce(F.col("distinct_events") >= min_events, F.lit(False))
    stats = durable(compute_daily_statistics(rows).withColumn("qualified", passed))
    return rows, Sized.of(stats.withColumnRenamed("total_windows", "rows"))


def _window_percentiles(rows: DataFrame, groups: Sized, k: float, q: float) -> DataFrame:
    return compute_percentiles(remove_outliers(rows, groups.part(groups.frame.filter("qualified")), k=k), q=q)
