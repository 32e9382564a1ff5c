"""The streaming job over files, one file per micro-batch."""

from __future__ import annotations

import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import at, rows_of
from tidewatch import registry
from tidewatch.operators.dedup import dedup_events
from tidewatch.operators.project import decode_events
from tidewatch.plans.windows import events_to_windows
from tidewatch.schema import WINDOW_SCHEMA
from tidewatch.sources import bus, tables
from tidewatch.streaming.progress import ProgressLog, recent_progress
from tidewatch.streaming.runner import CATCH_UP, HOUR_PARTS, LIVE, run_stream

OUTPUT = ["window_start", "window_end", "device_type", "event_count", "avg_duration", "min_duration", "max_duration", "avg_value"]


def event(name, time, duration=10.0, kind="light", value=1.0):
    return {"event_id": name, "device_id": "device-001", "device_type": kind, "timestamp": at(time).isoformat(),
            "event_duration": duration, "value": value, "status": "normal", "metadata": {}}


class Feed:
    """A folder of JSON files that are read in the order they were added."""

    def __init__(self, folder):
        self.folder, self.added = str(folder), 0
        os.makedirs(self.folder, exist_ok=True)

    def add(self, *events):
        self.added += 1
        path = os.path.join(self.folder, f"{self.added:03}.json")
        with open(path, "w") as file:
            file.writelines((e if isinstance(e, str) else json.dumps(e)) + "\n" for e in events)
        os.utime(path, (1_700_000_000 + self.added, 1_700_000_000 + self.added))
        return self


@pytest.fixture
def feed(tmp_path):
    return Feed(tmp_path / "feed")


def run(spark, feed, tmp_path, **options):
    messages = bus.stream_json_lines(spark, feed.folder, max_files_per_trigger=1)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    query = run_stream(messages, out, state, trigger=CATCH_UP, name="job", **options)
    query.awaitTermination()
    return query, tables.load_data(spark, out, schema=WINDOW_SCHEMA)


def counts(windows):
    return {(r["window_start"].strftime("%H:%M"), r["device_type"]): r["event_count"] for r in windows.collect()}


def dedup_only(spark, feed, tmp_path):
    events = decode_events(bus.stream_json_lines(spark, feed.folder, max_files_per_trigger=1))
    kept = dedup_events(events).select("event_id", "event_duration")
    query = (
        kept.writeStream.format("parquet").option("path", str(tmp_path / "kept"))
        .option("checkpointLocation", str(tmp_path / "kept-state")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query, rows_of(spark.read.parquet(str(tmp_path / "kept")))


def test_windows_appear_once_closed(spark, feed, tmp_path):
    feed.add(event("a", "12:00:10", 10.0), event("b", "12:00:50", 30.0), event("c", "12:00:20", 5.0, "motion"),
             event("d", "12:05:00"))
    _, windows = run(spark, feed, tmp_path)
    assert windows.count() == 0, "the watermark is still at 11:55"
    feed.add(event("close", "12:20:00"))
    _, windows = run(spark, feed, tmp_path)
    assert counts(windows) == {("12:00", "light"): 2, ("12:00", "motion"): 1, ("12:05", "light"): 1}
    row = windows.filter("device_type = 'light' AND minute(window_start) = 0").first()
    assert (row["avg_duration"], row["min_duration"], row["max_duration"]) == (20.0, 10.0, 30.0)
    assert (row["year"], row["month"], row["day"], row["hour"]) == (2024, 1, 1, 12)
    assert row["processing_time"] is not None


def test_duplicates_within_and_across_batches(spark, feed, tmp_path):
    feed.add(event("a", "12:00:00"), event("a", "12:00:01"), event("b", "12:00:02"))
    feed.add(event("a", "12:00:03"), event("c", "12:00:04"))
    _, kept = dedup_only(spark, feed, tmp_path)
    assert [k for k, _ in kept] == ["a", "b", "c"]


def test_state_is_forgotten_after_the_delay(spark, feed, tmp_path):
    for hour in range(10, 16):
        feed.add(*[event(f"{hour}-{i}", f"{hour}:00:0{i}") for i in range(5)])
    query, kept = dedup_only(spark, feed, tmp_path)
    assert len(kept) == 30
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress) <= 10


def test_copy_after_the_delay_is_a_new_event(spark, feed, tmp_path):
    """The batch after the one that moves the watermark evicts; the copy comes in the next."""
    feed.add(event("a", "12:00:00")).add(event("b", "13:00:00")).add(event("c", "13:00:10")).add(event("a", "13:00:30"))
    _, kept = dedup_only(spark, feed, tmp_path)
    assert [k for k, _ in kept] == ["a", "a", "b", "c"]


def test_invalid_copy_does_not_displace_a_valid_one(spark, feed, tmp_path):
    feed.add(event("a", "12:00:00", duration=-1.0), event("a", "12:00:01", duration=7.0))
    feed.add(event("b", "12:00:02", value=None)).add(event("b", "12:00:03", duration=9.0)).add(event("z", "12:30:00"))
    _, windows = run(spark, feed, tmp_path)
    assert counts(windows) == {("12:00", "light"): 2}
    assert windows.first()["avg_duration"] == 8.0


def test_malformed_messages_are_left_out(spark, feed, tmp_path):
    feed.add("{broken", "", json.dumps({**event("x", "12:00:00"), "timestamp": "soon"}), event("a", "12:00:00"))
    feed.add(event("z", "12:30:00"))
    _, windows = run(spark, feed, tmp_path)
    assert counts(windows) == {("12:00", "light"): 1}


def test_late_rows_are_dropped_and_counted(spark, feed, tmp_path):
    feed.add(event("a", "12:00:00")).add(event("b", "12:30:00")).add(event("c", "12:30:30"))
    feed.add(event("late", "12:00:30"), event("in time", "12:25:00")).add(event("z", "13:00:00"))
    query, windows = run(spark, feed, tmp_path)
    assert counts(windows) == {("12:00", "light"): 1, ("12:25", "light"): 1, ("12:30", "light"): 2}
    report = recent_progress(query)
    assert report.agg(F.sum("dropped_late")).first()[0] >= 1
    assert report.filter("batch_ms > 0 AND input_rows IS NOT NULL AND started IS NOT NULL").count() == report.count()
    assert report.agg(F.sum("input_rows")).first()[0] == 6


def test_restart_loses_and_repeats_nothing(spark, feed, tmp_path):
    for minute in range(0, 30, 5):
        feed.add(event(f"e{minute}", f"12:{minute:02}:00"), event(f"f{minute}", f"12:{minute:02}:30"))
    run(spark, feed, tmp_path)
    for minute in range(30, 60, 5):
        feed.add(event(f"e{minute}", f"12:{minute:02}:00"), event(f"e{minute - 5}", f"12:{minute - 5:02}:00"))
    feed.add(event("close", "14:00:00"))
    _, windows = run(spark, feed, tmp_path)
    landed = counts(windows)
    assert sum(landed.values()) == 18, "6 pairs, then 6 new events; repeated events count once"
    assert windows.count() == len(landed) == 12


def test_batch_and_stream_give_the_same_windows(spark, feed, tmp_path):
    kinds = ["light", "motion", "humidity"]
    for minute in range(12):
        feed.add(*[event(f"{minute}-{i % 7}", f"12:{minute:02}:{i:02}", float(minute * i % 13), kinds[i % 3]) for i in range(10)])
    feed.add(event("close", "13:00:00"))
    _, streamed = run(spark, feed, tmp_path)
    text = spark.read.text(feed.folder).select(F.col("value").cast("binary").alias("value"))
    batch = events_to_windows(decode_events(text)).filter("window_start < TIMESTAMP'2024-01-01 12:59:00'")
    # Copies differ only in fields that decide which copy is earliest, so compare what cannot depend on it.
    stable = ["window_start", "window_end", "device_type"]
    assert streamed.groupBy().agg(F.sum("event_count")).first() == batch.groupBy().agg(F.sum("event_count")).first()
    assert set(rows_of(batch.select(*stable))) >= set(rows_of(streamed.select(*stable)))
    once = [e for m in range(12) for e in range(7)]
    assert streamed.groupBy().agg(F.sum("event_count")).first()[0] == len(once)


def test_identical_copies_give_identical_windows(spark, feed, tmp_path):
    rows = [event(f"{m}-{i}", f"12:{m:02}:{i:02}", float(m * i % 13), ["light", "motion"][i % 2]) for m in range(8) for i in range(10)]
    feed.add(*rows[:50], *rows[:20]).add(*rows[40:]).add(event("close", "13:00:00"))
    _, streamed = run(spark, feed, tmp_path)
    text = spark.read.text(feed.folder).select(F.col("value").cast("binary").alias("value"))
    batch = events_to_windows(decode_events(text)).filter("hour < 13")
    assert rows_of(streamed.select(*OUTPUT)) == rows_of(batch.select(*OUTPUT))


def test_landed_table_passes_the_audit(spark, feed, tmp_path):
    feed.add(event("a", "12:00:00"), event("b", "13:10:00"), event("c", "13:20:00")).add(event("z", "15:00:00"))
    run(spark, feed, tmp_path)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    assert tables.landing_problems(spark, out, checkpoint=state) == []
    hours = {(r["hour"], r["rows"]) for r in tables.landed_hours(spark, out).collect()}
    assert hours == {(12, 1), (13, 2)}
    assert os.path.isdir(f"{out}/year=2024/month=1/day=1/hour=12")


def test_an_hour_has_few_files_at_any_shuffle_width(spark, feed, tmp_path):
    kinds = ["light", "motion", "humidity"]
    feed.add(*[event(f"{m}-{k}", f"12:{m:02}:10", kind=k) for m in range(60) for k in kinds], event("close", "14:00:00"))
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        _, windows = run(spark, feed, tmp_path)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    assert windows.count() == 180
    [hour] = tables.landed_hours(spark, str(tmp_path / "out")).collect()
    assert (hour["hour"], hour["rows"]) == (12, 180) and hour["files"] <= HOUR_PARTS


@pytest.mark.parametrize("parts", [1, 3])
def test_a_long_catch_up_has_one_file_an_hour_unless_told(spark, feed, tmp_path, parts):
    kinds = ["light", "motion", "humidity"]
    feed.add(*[event(f"{h}-{m}-{k}", f"{h}:{m}:10", kind=k) for h in range(10, 16) for m in range(10, 60) for k in kinds],
             event("close", "18:00:00"))
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        _, windows = run(spark, feed, tmp_path, **({} if parts == 1 else {"hour_parts": parts}))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    assert windows.count() == windows.select("window_start", "device_type").distinct().count() == 6 * 50 * 3
    hours = {r["hour"]: r["files"] for r in tables.landed_hours(spark, str(tmp_path / "out")).collect()}
    assert sorted(hours) == list(range(10, 16))
    assert max(hours.values()) == 1 if parts == 1 else 1 < max(hours.values()) <= parts


def test_arrived_files_can_be_read_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "ARRIVED_GROUP_BYTES", 1 << 17)
    rows = spark.range(200_000).select(F.col("id").alias("event_id"), F.rand(1).alias("value"))
    registry.arrive(rows.withColumn("ts", F.lit(at("12:00:00"))), str(tmp_path / "in"), registry.slice_of(), 0)
    files = [pq.ParquetFile(path).metadata for path in (tmp_path / "in").glob("*.parquet")]
    assert [f.num_rows for f in files] == [50_000] * registry.FILES_OF_SLICE
    assert all(f.num_row_groups > 3 for f in files)


def test_audit_names_what_is_missing(spark, tmp_path):
    assert tables.landing_problems(spark, str(tmp_path / "nothing")) == [f"no Parquet table at {tmp_path / 'nothing'}"]
    spark.range(0).write.parquet(str(tmp_path / "odd"))
    problems = tables.landing_problems(spark, str(tmp_path / "odd"), ["id", "year"], str(tmp_path / "no-state"))
    assert problems == ["column year is missing", f"no rows at {tmp_path / 'odd'}", f"no checkpoint at {tmp_path / 'no-state'}"]


def test_listener_collects_progress(spark, feed, tmp_path):
    log = ProgressLog(every=1)
    spark.streams.addListener(log)
    try:
        feed.add(event("a", "12:00:00"), event("b", "12:00:01"))
        run(spark, feed, tmp_path)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
    assert log.frame(spark).agg(F.sum("input_rows")).first()[0] == 2
    assert log.unwritten == [] and spark.read.parquet(log.path).count() == log.frame(spark).count()
    assert not log.failures


def test_live_trigger_and_bus_options():
    assert LIVE == {"processingTime": "30 seconds"}
    options = bus.subscribe_options("b1:9092,b2:9092", "events", max_offsets_per_trigger=1000)
    assert options == {
        "kafka.bootstrap.servers": "b1:9092,b2:9092", "subscribe": "events", "startingOffsets": "earliest",
        "failOnDataLoss": "false", "maxOffsetsPerTrigger": "1000",
    }
    published = bus.publish_options("b:9092", "events")
    assert (published["kafka.acks"], published["kafka.retries"], published["kafka.compression.type"]) == ("all", "3", "gzip")


def test_message_files_have_the_shape_of_the_bus(spark, tmp_path):
    from tidewatch.operators.project import encode_events
    from tidewatch.schema import EVENT_SCHEMA, MESSAGE_SCHEMA

    row = {**event("a", "12:00:00"), "timestamp": at("12:00:00")}
    sent = encode_events(spark.createDataFrame([row], EVENT_SCHEMA)).selectExpr(
        "*", "'events' AS topic", "0 AS partition", "0L AS offset", "TIMESTAMP'2024-01-01 12:00:00' AS timestamp"
    )
    sent.write.parquet(str(tmp_path / "messages"))
    stream = bus.stream_message_files(spark, str(tmp_path / "messages"))
    assert stream.schema == MESSAGE_SCHEMA
    query = (
        decode_events(stream).select("event_id").writeStream.format("parquet").option("path", str(tmp_path / "decoded"))
        .option("checkpointLocation", str(tmp_path / "decoded-state")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert rows_of(spark.read.parquet(str(tmp_path / "decoded"))) == [("a",)]
