"""Stream-health reports on small hand-made tables."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import at, plan_of
from tidewatch.operators import metrics as M
from tidewatch.operators import quality as Q
from tidewatch.operators.project import encode_events
from tidewatch.plans.health import stream_metrics
from tidewatch.schema import MESSAGE_SCHEMA


def typed(spark, rows):
    return spark.createDataFrame(rows, "device_type string, timestamp timestamp")


def test_gap_threshold_is_strict(spark):
    start, times = at("12:00:00"), [0]
    for gap in (299, 300, 301):
        times.append(times[-1] + gap)
    gaps = M.silence_gaps(typed(spark, [("light", start + timedelta(seconds=s)) for s in times])).collect()
    assert [r["gap_seconds"] for r in gaps] == [301.0]


@pytest.mark.parametrize("threshold", [1, 7, 60])
def test_gaps_equal_a_plain_scan(spark, threshold):
    rng, rows = random.Random(threshold), []
    for kind in ("hot", "cold", None):
        moment = at("12:00:00")
        for _ in range(800 if kind == "hot" else 100):
            moment += timedelta(seconds=rng.choice([0.0, 0.25, 1.0, 1.000001, 6.9, 7.0, 7.1, 59.0, 60.0, 61.0]))
            rows.append((kind, moment))
    expected = sorted(
        (str(k), round((b - a).total_seconds(), 6))
        for k in ("hot", "cold", None)
        for a, b in zip([t for g, t in rows if g == k], [t for g, t in rows if g == k][1:])
        if (b - a).total_seconds() > threshold
    )
    got = M.silence_gaps(typed(spark, rows).repartition(4), threshold).collect()
    assert sorted((str(r["device_type"]), round(r["gap_seconds"], 6)) for r in got) == expected


def test_gaps_are_summarised_before_they_are_ordered(spark):
    plan = plan_of(M.silence_gaps(typed(spark, [("light", at("12:00:00"))])))
    assert "partial_min(timestamp" in plan and "partial_max(timestamp" in plan


def test_levels_share_one_count(spark):
    rows = [("light", "normal", at("12:00:01"))] * 3 + [("light", "critical", at("12:00:02")), ("motion", "normal", at("12:00:59"))]
    rates = M.event_rates(spark.createDataFrame(rows, "device_type string, status string, timestamp timestamp"), "1 minute")
    found = {(r["level"], r["device_type"], r["status"]): r["events"] for r in rates.collect()}
    assert found == {
        ("device_type,status", "light", "normal"): 3, ("device_type,status", "light", "critical"): 1,
        ("device_type,status", "motion", "normal"): 1, ("device_type", "light", None): 4,
        ("device_type", "motion", None): 1, ("status", None, "normal"): 4, ("status", None, "critical"): 1,
        ("total", None, None): 5,
    }
    assert rates.filter("level = 'total'").first()["events_per_second"] == pytest.approx(5 / 60)


def messages(spark):
    rows = []
    for partition, offsets in ((0, [0, 1, 2, 3]), (1, [10]), (2, [5, 6])):
        for i, offset in enumerate(offsets):
            rows.append((None, b"x" * (offset + 1), "events", partition, offset, at("12:00:00") + timedelta(minutes=i)))
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def test_offsets_and_growth(spark):
    table = {(r["partition"], r["window_start"].minute): (r["latest_offset"], r["offset_growth"], r["offsets_per_second"])
             for r in M.partition_offsets(messages(spark), "1 minute").collect()}
    assert table[(0, 0)] == (0, None, None)
    assert table[(0, 3)] == (3, 1, pytest.approx(1 / 60))
    assert table[(1, 0)] == (10, None, None) and len([k for k in table if k[0] == 1]) == 1


def test_sizes(spark):
    row = M.message_sizes(messages(spark)).first()
    sizes = sorted([1, 2, 3, 4, 11, 6, 7])
    assert (row["messages"], row["p50_bytes"], row["p95_bytes"]) == (7, sizes[3], sizes[6])
    assert row["mean_bytes"] == pytest.approx(sum(sizes) / 7)


def test_devices(spark):
    rows = [(f"d{i % 4}", at("12:00:00") + timedelta(seconds=i)) for i in range(100)]
    df = spark.createDataFrame(rows, "device_id string, timestamp timestamp")
    assert [r["active_devices"] for r in M.active_devices(df, "1 minute").collect()] == [4, 4]
    assert [r["active_devices"] for r in M.active_devices(df, "1 minute", rsd=0.01).collect()] == [4, 4]


def test_error_rate_counts_rows_without_time(spark):
    rows = [("light", at("12:00:01"), -1.0), ("light", at("12:00:02"), 1.0), ("light", None, 1.0)]
    df = spark.createDataFrame(rows, "device_type string, timestamp timestamp, event_duration double")
    rules = [Q.not_null("timestamp"), Q.non_negative("event_duration")]
    found = {r["window_start"]: (r["rejected"], r["events"], r["error_rate"]) for r in M.error_rates(df, rules, "1 minute").collect()}
    assert found.pop(None) == (1, 1, 1.0)
    assert list(found.values()) == [(1, 2, 0.5)]


def test_all_reports_of_a_message_table(spark):
    from tests.test_quality import events

    sent = encode_events(events(spark, {}, {"event_id": "odd"}, {"timestamp": at("12:20:00")})).selectExpr(
        "*", "'events' AS topic", "0 AS partition", "monotonically_increasing_id() AS offset", "TIMESTAMP'2024-01-01 12:00:30' AS timestamp"
    )
    reports = stream_metrics(sent)
    counted = {name: report.count() for name, report in reports.items()}
    assert counted == {
        "event_rates": 8, "messages_per_minute": 2, "active_devices": 2, "message_sizes": 1, "partition_offsets": 1,
        "silence_gaps": 1, "error_rates": 2,
    }
    assert reports["error_rates"].agg(F.sum("rejected")).first()[0] == 1
