"""Batches split over tables: a replay adds nothing, late rows by the committed watermark, alerts of silence."""

from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.conftest import at, plan_of, rows_of
from tidewatch.operators.dedup import dedup_events
from tidewatch.operators.metrics import stream_silences
from tidewatch.streaming.batches import ledger, run_split, split_late
from tidewatch.streaming.runner import CATCH_UP

SCHEMA = "id long, timestamp timestamp"


def add(spark, folder, *rows):
    spark.createDataFrame([(i, None if t is None else at(t)) for i, t in rows], SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def source(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    feed, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    for k in range(3):
        add(spark, feed, *((10 * k + i, f"12:0{k}:0{i}") for i in range(4)))
    failed = []

    def split(batch, batch_id):
        parts = {"odd": batch.where("id % 2 = 1"), "even": batch.where("id % 2 = 0")}
        if batch_id == 1 and not failed:
            failed.append(1)
            parts["odd"].write.parquet(f"{out}/odd/batch=1")
            raise RuntimeError("between two tables")
        return parts

    with pytest.raises(StreamingQueryException):
        run_split(source(spark, feed), out, state, split, trigger=CATCH_UP).awaitTermination()
    run_split(source(spark, feed), out, state, split, trigger=CATCH_UP).awaitTermination()
    both = [spark.read.parquet(f"{out}/{name}").select("id") for name in ("odd", "even")]
    assert rows_of(both[0].union(both[1])) == [(i,) for i in sorted((10 * k + i for k in range(3) for i in range(4)), key=lambda i: repr((i,)))]
    assert rows_of(ledger(spark, out).select("batch", "rows")) == [(0, 4), (1, 4), (2, 4)]


def test_late_rows_have_their_own_table(spark, tmp_path):
    feed, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    add(spark, feed, (1, "12:00:00"), (2, "12:30:00"), (3, "11:00:00"))
    add(spark, feed, (4, "12:20:00"), (5, "12:19:59"), (6, None), (7, "13:00:00"))
    add(spark, feed, (8, "12:49:00"), (9, "12:50:00"))
    run_split(source(spark, feed), out, state, split_late(out, "10 minutes"), trigger=CATCH_UP).awaitTermination()
    late = {r["id"] for r in spark.read.parquet(f"{out}/late").collect()}
    kept = {r["id"] for r in spark.read.parquet(f"{out}/in_time").collect()}
    assert late == {5, 6, 8} and kept == {1, 2, 3, 4, 7, 9}
    assert ledger(spark, str(tmp_path / "none")).collect() == []


def test_alerts_while_a_silence_lasts(spark, tmp_path):
    feed, schema = tmp_path / "in", "k string, timestamp timestamp"
    rows = [("a", "12:00:00"), ("a", "12:05:00"), ("b", "12:00:00"), ("b", "12:05:01"), ("a", "12:20:00"), ("c", "12:59:00")]
    spark.createDataFrame([(k, at(t)) for k, t in rows], schema).coalesce(1).write.parquet(str(feed))
    events = spark.readStream.schema(schema).parquet(str(feed)).withWatermark("timestamp", "1 minute")
    alerts = stream_silences(events, 240, hold_seconds=60, keys=("k",))
    out = str(tmp_path / "out")
    alerts.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    got = sorted((r["k"], r["silent_since"].strftime("%H:%M:%S"), r["events"]) for r in spark.read.parquet(out).select("k", F.col("silent_since"), "events").collect())
    # Five minutes to the second are no silence; the last event of all is still within its time.
    assert got == [("a", "12:05:00", 2), ("a", "12:20:00", 1), ("b", "12:00:00", 1), ("b", "12:05:01", 1)]


def test_dedup_generates_no_key(spark):
    events = spark.createDataFrame([("a", at("12:00"), 1.0, {"x": "1"}), ("a", at("12:00"), 2.0, {"x": "2"}), (None, at("12:00"), 3.0, None), (None, at("12:00"), 3.0, None)],
                                   "event_id string, timestamp timestamp, value double, metadata map<string,string>")
    once = dedup_events(events)
    assert "monotonically_increasing_id" not in plan_of(once) and "WindowGroupLimit" in plan_of(once)
    rows = [(r["event_id"], r["value"]) for r in once.collect()]
    assert len(rows) == 3 and rows.count((None, 3.0)) == 2
    assert rows_of(once.select("value")) == rows_of(dedup_events(events.repartition(3)).select("value"))
    assert dedup_events(events, keep_unnamed=False).count() == 1
