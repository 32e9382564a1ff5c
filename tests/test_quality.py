"""Rules, the one-pass report, the split, and the boolean checks."""

from __future__ import annotations

import pytest

from tests.conftest import at, plan_of
from tidewatch.operators import quality as Q
from tidewatch.schema import EVENT_SCHEMA

VALID = dict(
    event_id="0f1e2d3c-4b5a-4978-8695-a4b3c2d1e0f9", device_id="device-417", device_type="motion",
    timestamp=at("12:00"), event_duration=87.25, value=0.5, status="normal",
    metadata={"location": "zone-A", "firmware": "v1.0.0"},
)

BAD = [
    ({"event_id": None}, ["not_null:event_id"]),
    ({"event_id": "test-123"}, ["uuid:event_id"]),
    ({"device_id": "invalid-device"}, ["pattern:device_id"]),
    ({"device_id": "device-0001"}, ["pattern:device_id"]),
    ({"device_type": "invalid_type"}, ["one_of:device_type"]),
    ({"timestamp": None}, ["not_null:timestamp"]),
    ({"event_duration": -10.0}, ["range:event_duration"]),
    ({"event_duration": 1000.5}, ["range:event_duration"]),
    ({"status": "invalid_status"}, ["one_of:status"]),
    ({"metadata": None}, ["not_null:metadata"]),
    ({"metadata": {"firmware": "v1.0.0"}}, ["entry_location:metadata"]),
    ({"metadata": {"location": "zone-F", "firmware": "v1.10.0"}}, ["entry_location:metadata", "entry_firmware:metadata"]),
    ({"value": None, "status": None}, ["not_null:value", "not_null:status"]),
]


def events(spark, *changes):
    return spark.createDataFrame([{**VALID, **change} for change in changes], EVENT_SCHEMA)


def test_contract(spark):
    valid, rejected = Q.split_valid(events(spark, {}, *[c for c, _ in BAD]).coalesce(1), Q.contract_rules())
    assert valid.count() == 1
    assert valid.columns == EVENT_SCHEMA.names
    assert [r["reject_reasons"] for r in rejected.collect()] == [reasons for _, reasons in BAD]


@pytest.mark.parametrize("bounds", [0.0, 1000.0])
def test_contract_bounds_are_inclusive(spark, bounds):
    valid, _ = Q.split_valid(events(spark, {"event_duration": bounds}), Q.contract_rules())
    assert valid.count() == 1


def test_ingest_check_is_shorter_than_the_contract(spark):
    changes = [{}, {"metadata": None}, {"status": "odd"}, {"device_id": "odd"}, {"event_duration": 5000.0},
               {"event_duration": -1.0}, {"event_id": "{0f1e2d3c-4b5a-4978-8695-a4b3c2d1e0f9}"}, {"status": None}]
    df = events(spark, *changes).coalesce(1)
    strict = [r["is_valid"] for r in Q.with_validity(df, Q.ingest_rules()).collect()]
    lenient = [r["is_valid"] for r in Q.with_validity(df, Q.ingest_rules(strict=False)).collect()]
    assert strict == [True, True, True, True, True, False, False, False]
    assert lenient == [True, True, True, True, True, False, True, False]


def known(spark):
    rows = [("x", 1.0, 5.0), (None, -1.0, 0.0), ("y", 0.0, 11.0), (None, None, 10.0), ("z", -2.0, None)]
    return spark.createDataFrame(rows, "a string, b double, c double")


def test_report_counts(spark):
    report = Q.quality_report(known(spark), [Q.not_null("a"), Q.non_negative("b"), Q.in_range("c", 0, 10), Q.not_null("c")])
    assert [tuple(r) for r in report.collect()] == [
        ("not_null", "a", 2, 5, False), ("non_negative", "b", 2, 5, False), ("range", "c", 1, 5, False),
        ("not_null", "c", 1, 5, False),
    ]


def test_report_is_one_aggregation(spark):
    plan = plan_of(Q.quality_report(known(spark), [Q.not_null(c) for c in "abc"]))
    assert plan.count("Exchange\n") <= 2 and plan.count("Scan ExistingRDD") <= 2


def test_report_on_nothing_passes(spark):
    assert all(r["passed"] for r in Q.quality_report(known(spark).limit(0), [Q.not_null("a")]).collect())


def test_boolean_checks(spark):
    df = known(spark)
    assert not Q.validate_no_nulls(df, ["a", "b"])
    assert Q.validate_no_nulls(df.filter("a IS NOT NULL"), ["a", "b"])
    assert not Q.validate_positive_values(df, ["b"])
    assert Q.validate_positive_values(df.filter("b >= 0 OR b IS NULL"), ["b"]), "zero and NULL pass"
    assert not Q.validate_range(df, "c", 0, 10)
    assert Q.validate_range(df, "c", 0, 11)


def test_schema_checks(spark):
    df = known(spark)
    assert Q.validate_schema(df, {"a", "b"})
    assert not Q.validate_schema(df, {"a", "d"})
    assert (Q.missing_columns(df, {"a", "d"}), Q.extra_columns(df, {"a", "b"})) == (["d"], ["c"])
    assert Q.validate_schema(events(spark, {}))
    assert not Q.validate_schema(events(spark, {}).drop("event_duration"))
    retyped = events(spark, {}).drop("value").selectExpr("*", "1 AS value")
    assert Q.mistyped_columns(retyped, EVENT_SCHEMA) == ["value"]


def test_patterns_end_where_the_text_ends(spark):
    frame = events(spark, {"device_id": "device-417\n"}, {"event_id": "0f1e2d3c-4b5a-4978-8695-a4b3c2d1e0f9\n"}, {})
    valid, rejected = Q.split_valid(frame, Q.contract_rules())
    assert (valid.count(), rejected.count()) == (1, 2)


def test_raw_times_have_a_rule(spark):
    raw = spark.createDataFrame([("12:30",), ("2024",), ("2024-01-01T12:00:00Z",), (None,)], "timestamp string")
    assert raw.filter(Q.date_time("timestamp").failed()).count() == 2
    assert Q.contract_rules(decoded=False)[0].label == "date_time:timestamp"
