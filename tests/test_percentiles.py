"""The daily question: gate, outlier removal, both forms."""

from __future__ import annotations

from datetime import timedelta

import pytest

from tests.conftest import at, rows_of, plan_of
from tests.test_quantiles import brute
from tidewatch.operators import aggregate as A
from tidewatch.operators import quality
from tidewatch.operators.project import with_event_date
from tidewatch.plans.percentiles import (
    counted_p95_from_events,
    counted_p95_from_windows,
    p95_from_events,
    p95_from_windows,
    removal_report,
)
from tidewatch.schema import EVENT_SCHEMA, WINDOW_SCHEMA

EVENT_COLUMNS = "event_id string, device_type string, timestamp timestamp, event_duration double"


def events(spark, spec):
    """``spec``: (type, ids, rows); rows reuse the ids in turn, durations are 1, 2, 3, ..."""
    rows = [
        (f"{kind}-{i % ids}", kind, at("00:00") + timedelta(seconds=i), float(i + 1))
        for kind, ids, count in spec
        for i in range(count)
    ]
    return spark.createDataFrame(rows, EVENT_COLUMNS).repartition(4)


@pytest.mark.parametrize("divisor", [1, 2, 1024])
def test_gate_counts_distinct_ids_exactly(spark, divisor):
    df = with_event_date(
        events(spark, [("a", 499, 499), ("b", 500, 500), ("c", 501, 501), ("d", 400, 600), ("e", 3, 2000)]), "timestamp"
    )
    sized = A.qualified_spread(df, "event_duration", "event_id", 500, proof_divisor=divisor)
    assert {r["device_type"]: r["qualified"] for r in sized.frame.collect()} == {
        "a": False, "b": True, "c": True, "d": False, "e": False
    }
    assert {r["device_type"]: r["rows"] for r in sized.frame.collect()}["e"] == 2000


def test_gate_without_broadcast(no_broadcast):
    df = with_event_date(events(no_broadcast, [("a", 499, 499), ("b", 500, 500), ("d", 400, 900)]), "timestamp")
    sized = A.qualified_spread(df, "event_duration", "event_id", 500)
    assert not sized.fits
    assert {r["device_type"]: r["qualified"] for r in sized.frame.collect()} == {"a": False, "b": True, "d": False}


@pytest.mark.parametrize("exact", [False, True])
def test_outliers_leave_before_the_percentile(spark, exact):
    df = events(spark, [("a", 600, 600)]).unionByName(
        spark.createDataFrame([("far", "a", at("01:00"), 1e6), ("nan", "a", at("01:00"), float("nan")),
                               ("none", "a", at("01:00"), None)], EVENT_COLUMNS)
    )
    row = p95_from_events(df, min_events=500, exact=exact).first()
    values = [float(i + 1) for i in range(600)]
    assert row["p95_duration"] == brute(values, 0.95)
    assert row["total_events"] == 600
    assert row["avg_duration"] == pytest.approx(300.5)
    assert row["mean_duration"] == pytest.approx((sum(values) + 1e6) / 601)


def test_both_methods_agree_without_broadcast(no_broadcast):
    df = events(no_broadcast, [("a", 600, 600), ("b", 700, 700), ("c", 10, 800)])
    approximate = p95_from_events(df).collect()
    assert [r["device_type"] for r in approximate] == ["a", "b"]
    assert p95_from_events(df, exact=True).collect() == approximate


def test_removal_report_separates_gate_and_outliers(spark):
    df = events(spark, [("a", 600, 600), ("b", 10, 10)]).unionByName(
        spark.createDataFrame([("far", "a", at("01:00"), 1e6)], EVENT_COLUMNS)
    )
    report = {r["device_type"]: tuple(r)[2:] for r in removal_report(df).collect()}
    assert report == {"a": (601, True, 600, 1), "b": (10, False, 0, 0)}


@pytest.mark.parametrize("broadcast", [True, False])
def test_counted_report_agrees_with_its_parts(spark, broadcast, request):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    df = events(spark, [("a", 600, 600), ("b", 10, 10), (None, 700, 700)]).unionByName(
        spark.createDataFrame([("far", "a", at("01:00"), 1e6)], EVENT_COLUMNS)
    )
    counted = counted_p95_from_events(df)
    assert counted.report.collect() == p95_from_events(df).collect()
    assert rows_of(counted.removals) == rows_of(removal_report(df))
    # The group without a type qualifies, but the question drops it.
    assert counted.totals() == {"groups": 1, "loaded": 1311, "qualified": 1301, "kept": 600, "removed": 701}


def test_empty_input(spark):
    windows = counted_p95_from_windows(spark.createDataFrame([], WINDOW_SCHEMA))
    assert windows.totals() == {"groups": 0, "loaded": 0, "qualified": 0, "kept": 0, "removed": 0}
    none = spark.createDataFrame([], EVENT_SCHEMA)
    assert p95_from_events(none).count() == 0
    assert p95_from_events(none, exact=True).count() == 0
    assert removal_report(none).count() == 0


def window_rows(spark):
    rows = []
    for i in range(600):
        start = at("00:00") + timedelta(minutes=i)
        count, mean = (9, 10.0) if i % 2 else (1, 30.0)
        rows.append((start, start + timedelta(minutes=1), "a", count, mean, mean - 1, mean + 1, mean, start, 2024, 1, 1, i // 60))
    return spark.createDataFrame(rows, WINDOW_SCHEMA)


def test_window_form_weighs_windows_equally(spark):
    row = p95_from_windows(window_rows(spark)).first()
    assert (row["p95_duration"], row["total_events"], row["avg_duration"]) == (30.0, 600, 20.0)
    assert p95_from_windows(window_rows(spark), min_events=601).count() == 0


def test_roll_up_weighs_events(spark):
    day = A.roll_up_windows(with_event_date(window_rows(spark))).first()
    assert (day["event_count"], day["avg_duration"]) == (3000, 12.0)
    assert (day["min_duration"], day["max_duration"]) == (9.0, 31.0)


def test_result_validation(spark):
    result = p95_from_windows(window_rows(spark))
    assert quality.validate_results(result)
    with pytest.raises(ValueError, match="p95_duration"):
        quality.validate_results(result.drop("p95_duration"))
    with pytest.raises(ValueError, match=r"device_type \(1\)"):
        quality.validate_results(result.withColumn("device_type", result["device_type"].substr(1, 0).try_cast("int").cast("string")))


def test_plan_of_the_question(spark):
    from tests.conftest import CHECK_FOLDER
    from tidewatch.sources.events_table import read_events

    plan = plan_of(p95_from_events(read_events(spark, CHECK_FOLDER), min_events=50))
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "Python" not in plan and "Pandas" not in plan
    assert "props" not in plan, "unused columns must not be read"
    assert "partial_kll_sketch_agg_double" in plan, "values are summarised before the shuffle"
