"""The daily program: the landed window table to the percentile report, validated and exported as CSV.

    spark-submit -m tidewatch.jobs.daily_report --input PATH --output PATH --first-day 2025-11-01
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date

from tidewatch.operators.aggregate import preview
from tidewatch.operators.quality import validate_results
from tidewatch.plans.percentiles import counted_p95_from_windows
from tidewatch.schema import MIN_DAILY_EVENTS, PERCENTILE, WINDOW_SCHEMA
from tidewatch.session import build_session
from tidewatch.sources.tables import export_results, load_data


def main(argv: Sequence[str] | None = None) -> dict[str, int]:
    """Runs the report; returns its groups, and how many windows were loaded, qualified, kept and removed."""
    parser = argparse.ArgumentParser(description="Percentile of durations per day and device type.")
    parser.add_argument("--input", required=True, help="landed window table")
    parser.add_argument("--output", required=True, help="folder of the CSV report")
    parser.add_argument("--first-day", type=date.fromisoformat)
    parser.add_argument("--last-day", type=date.fromisoformat)
    parser.add_argument("--min-events", type=int, default=MIN_DAILY_EVENTS, help="windows a group needs in a day")
    parser.add_argument("--quantile", type=float, default=PERCENTILE)
    parser.add_argument("--single-file", action="store_true")
    given = parser.parse_args(argv)

    spark = build_session("tidewatch-daily-report")
    windows = load_data(spark, given.input, given.first_day, given.last_day, WINDOW_SCHEMA)
    counted = counted_p95_from_windows(windows, min_events=given.min_events, q=given.quantile)
    counts = counted.totals()
    if not counts["groups"]:
        raise SystemExit(f"no device type has {given.min_events} windows on any day of {given.input}")
    validate_results(counted.report)
    preview(counted.report).show(truncate=False)
    print(", ".join(f"{name}: {number}" for name, number in counts.items()))
    export_results(counted.report, given.output, given.single_file)
    return counts


if __name__ == "__main__":
    main()
