"""Decoding, projections and filters."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import at, plan_of, rows_of
from tidewatch import functions as E
from tidewatch.operators import filters, project
from tidewatch.operators.dedup import dedup_events
from tidewatch.schema import EVENT_SCHEMA, MESSAGE_SCHEMA, WIRE_SCHEMA

EVENT = {
    "event_id": "0f1e2d3c-4b5a-4978-8695-a4b3c2d1e0f9", "device_id": "device-417", "device_type": "motion",
    "timestamp": "2024-01-01T12:00:00.123456Z", "event_duration": 87.25, "value": 0.5, "status": "warning",
    "metadata": {"location": "zone-D", "firmware": "v3.1.4"},
}


def messages(spark, *payloads):
    rows = [
        (None, p if p is None or isinstance(p, bytes) else json.dumps(p).encode(), "events", 0, i, at("12:00"))
        for i, p in enumerate(payloads)
    ]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def test_decode_valid_event(spark):
    row = project.decode_events(messages(spark, EVENT)).first()
    assert row["metadata"] == EVENT["metadata"]
    assert row["event_duration"] == 87.25
    assert project.decode_events(messages(spark, EVENT)).schema == EVENT_SCHEMA


def test_decode_bad_payloads_gives_null_rows_and_keeps_every_message(spark):
    bad = messages(spark, b"{not json", None, {**EVENT, "event_duration": "long"}, {"event_id": "x"}, EVENT)
    decoded = project.decode_events(bad)
    assert decoded.count() == 5
    assert [r["event_duration"] for r in decoded.collect()] == [None, None, None, None, 87.25]
    assert filters.drop_invalid_events(decoded).count() == 1


def test_event_times_in_every_form(spark):
    texts = ["2024-01-01T12:00:00.123456Z", "2024-01-01T12:00:00+02:00", "2024-01-01T12:00:00.5Z", "noon", None]
    texts += ["12:30", "2024", "2024-01-01T12:00:00 Europe/Paris", "2024-01-01T12:00:00Z\n", "2024-02-30T12:00:00Z"]
    frame = spark.createDataFrame([(t,) for t in texts], "timestamp string")
    parsed = project.with_event_time(frame).select(F.col("timestamp").cast("timestamp_ntz"))
    assert [r[0] for r in parsed.collect()] == [
        datetime(2024, 1, 1, 12, 0, 0, 123456), datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 12, 0, 0, 500000),
        *[None] * 7,
    ]


def test_bad_time_does_not_stop_the_query(spark):
    decoded = project.decode_events(messages(spark, {**EVENT, "timestamp": "yesterday"}, EVENT))
    assert filters.drop_invalid_events(decoded).count() == 1


def test_encode_then_decode_is_identity(spark):
    event = {**EVENT, "timestamp": at("2024-01-01 12:00:00.123456")}
    odd = {**event, "event_id": "odd", "event_duration": float("nan"), "value": None, "metadata": None}
    frame = spark.createDataFrame([event, odd], EVENT_SCHEMA)
    sent = project.encode_events(frame)
    assert bytes(sent.first()["key"]) == b"device-417"
    assert repr(rows_of(project.decode_events(sent))) == repr(rows_of(frame))  # NaN is not equal to itself


def test_payload_is_parsed_once(spark):
    """A filter on decoded columns must not repeat the JSON parser below the projection."""
    plan = plan_of(filters.drop_invalid_events(project.decode_events(messages(spark, EVENT))))
    arguments = [line for line in plan.splitlines() if "from_json" in line]
    assert sum(line.count("from_json") for line in arguments) == 1


def test_validity_filter(spark):
    nan = float("nan")
    rows = [
        ("ok", 0.0, 1.0, at("12:00")), ("negative", -1.0, 1.0, at("12:00")), ("null", None, 1.0, at("12:00")),
        ("nan", nan, 1.0, at("12:00")), ("no value", 1.0, None, at("12:00")), ("nan value", 1.0, nan, at("12:00")),
        ("no time", 1.0, 1.0, None),
    ]
    frame = spark.createDataFrame(rows, "event_id string, event_duration double, value double, timestamp timestamp")
    assert [r["event_id"] for r in filters.drop_invalid_events(frame).collect()] == ["ok"]


def test_enrichment(spark):
    rows = [("critical", 99.9), ("normal", 100.0), (None, 299.9), ("warning", 300.0), ("critical", None)]
    enriched = project.enrich_with_metadata(spark.createDataFrame(rows, "status string, event_duration double"))
    assert [tuple(r)[2:] for r in enriched.collect()] == [
        (True, "fast"), (False, "normal"), (False, "normal"), (False, "slow"), (True, "slow")
    ]


def test_map_entries(spark):
    frame = spark.createDataFrame([({"location": "zone-C"},), (None,)], "metadata map<string,string>")
    entries = project.with_map_entries(frame, ["location", "firmware"])
    assert [tuple(r)[1:] for r in entries.collect()] == [("zone-C", None), (None, None)]


@pytest.mark.parametrize(
    ("text", "strict", "lenient"),
    [
        ("0f1e2d3c-4b5a-4978-8695-a4b3c2d1e0f9", True, True),
        ("0f1e2d3c-4b5a-1978-8695-a4b3c2d1e0f9", True, True),
        ("0F1E2D3C-4B5A-4978-8695-A4B3C2D1E0F9", True, True),
        ("{0f1e2d3c-4b5a-4978-8695-a4b3c2d1e0f9}", False, True),
        ("urn:uuid:0f1e2d3c-4b5a-4978-8695-a4b3c2d1e0f9", False, True),
        ("0f1e2d3c4b5a49788695a4b3c2d1e0f9", False, True),
        ("test-123", False, False),
        (None, False, False),
    ],
)
def test_uuid_forms(spark, text, strict, lenient):
    frame = spark.createDataFrame([(text,)], "id string")
    row = frame.select(E.is_uuid(F.col("id")), E.is_uuid(F.col("id"), strict=False)).first()
    assert tuple(row) == (strict, lenient)


@pytest.mark.parametrize(
    ("first", "last"),
    [(date(2024, 1, 10), date(2024, 1, 20)), (date(2023, 12, 30), date(2024, 2, 2)),
     (date(2024, 1, 5), date(2024, 1, 5)), (date(2022, 6, 1), date(2024, 3, 31)), (date(2024, 2, 1), date(2024, 1, 1))],
)
def test_day_range_predicate(spark, first, last):
    days = spark.sql("SELECT explode(sequence(DATE'2022-01-01', DATE'2024-12-31')) AS d").select(
        "d", F.year("d").alias("year"), F.month("d").alias("month"), F.dayofmonth("d").alias("day")
    )
    kept = days.filter(filters.in_days(first, last)).agg(F.min("d"), F.max("d"), F.count("*")).first()
    n = (last - first).days + 1
    assert tuple(kept) == ((first, last, n) if n > 0 else (None, None, 0))


def test_filter_reaches_the_scan(spark):
    from tests.conftest import CHECK_FOLDER
    from tidewatch.sources.events_table import read_events

    chosen = read_events(spark, CHECK_FOLDER).filter("device_type = 'purchase'").select("event_id", "value")
    plan = plan_of(chosen)
    assert "EqualTo(event_type,purchase)" in plan
    assert "ReadSchema: struct<event_id:bigint,event_type:string,value:double>" in plan


def test_batch_dedup_keeps_the_earliest_copy(spark):
    rows = [("a", at("12:05"), 1.0, {"k": "1"}), ("a", at("12:00"), 2.0, {"k": "2"}), ("b", at("12:00"), 3.0, None),
            ("b", at("12:00"), 2.5, None)]
    frame = spark.createDataFrame(rows, "event_id string, timestamp timestamp, value double, metadata map<string,string>")
    kept = {r["event_id"]: r for r in dedup_events(frame).collect()}
    assert (kept["a"]["value"], kept["a"]["metadata"]) == (2.0, {"k": "2"})
    assert kept["b"]["value"] == 2.5
    assert dedup_events(frame).columns == frame.columns


def test_wire_schema_fields():
    assert WIRE_SCHEMA.names == EVENT_SCHEMA.names
    assert all(field.nullable for field in EVENT_SCHEMA)
