"""Sketches merged in two steps: a hot group, bounded lots, windows rolled up without the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests.conftest import plan_of
from tidewatch.operators import sketches as S
from tidewatch.operators.aggregate import compute_percentiles, roll_up_percentiles
from tidewatch.operators.metrics import device_sketches, roll_up_devices


def test_rank_error_of_a_hot_group(spark, monkeypatch):
    """Half of all rows in one group, over more map tasks than a lot holds."""
    monkeypatch.setattr(S, "FAN_IN", 4)
    n = 200_000
    rows = spark.range(0, n, 1, 40).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"), F.xxhash64("id").cast("double").alias("x")
    )
    found = {r["k"]: r["p"] for r in S.grouped_sketches(rows, "x", ["k"], size=1024).select("k", S.sketch_quantile(F.col("sketch"), 0.95).alias("p")).collect()}
    assert len(found) == 8
    for k, p in found.items():
        group = rows.where(F.col("k") == k)
        below = group.where(F.col("x") <= p).count() / group.count()
        assert abs(below - 0.95) < 0.01


def test_lots_bound_what_a_task_merges(spark, monkeypatch):
    monkeypatch.setattr(S, "FAN_IN", 4)
    rows = spark.range(0, 4000, 1, 40).select(F.lit("hot").alias("k"), F.col("id").cast("double").alias("x"))
    lots = S.with_lot(rows).groupBy(S.LOT).agg(F.count("*").alias("rows"))
    got = lots.collect()
    assert len(got) == 10 and {r["rows"] for r in got} == {400}
    plan = plan_of(S.grouped_sketches(rows, "x", ["k"]))
    assert "partial_kll_sketch_agg_double" in plan and "partial_kll_merge_agg_double" in plan


def test_small_groups_are_exact_and_empty_ones_null(spark):
    rows = [("a", float(i)) for i in range(1, 101)] + [("b", None), ("b", float("nan")), (None, 3.0)]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {r["k"]: r["p"] for r in S.grouped_sketches(df, "x", ["k"]).select("k", S.sketch_quantile(F.col("sketch"), 0.95).alias("p")).collect()}
    assert got == {"a": 95.0, "b": None, None: 3.0}
    assert S.grouped_sketches(df.limit(0), "x", ["k"]).collect() == []


def test_means_of_groups_leave_nulls_out(spark):
    df = spark.createDataFrame([("a", 1.0, None, 2.0), ("a", 3.0, 5.0, None), ("b", None, 1.0, 1.0)], "k string, x double, mu double, sigma double")
    df = df.withColumn("date", F.lit("2024-01-01").cast("date")).withColumn("device_type", F.col("k"))
    rows = {r["device_type"]: tuple(r)[2:] for r in compute_percentiles(df, "x").collect()}
    assert rows == {"a": (3.0, 2, 2.0, 5.0, 2.0), "b": (None, 1, None, 1.0, 1.0)}


def test_days_from_sketches_of_windows(spark):
    events = spark.range(0, 30_000, 1, 6).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("timestamp"), (F.col("id") % 977).cast("string").alias("device_id"),
        F.lit("light").alias("device_type"), (F.col("id") * 7919 % 30_011).cast("double").alias("event_duration"),
    )
    from tidewatch.operators.aggregate import window_aggregates

    windows = window_aggregates(events.withColumn("value", F.lit(1.0)), "1 minute", sketch=True)
    day = roll_up_percentiles(windows, 0.95, ["device_type"]).first()["p95_duration"]
    rank = events.where(F.col("event_duration") <= day).count() / 30_000
    assert abs(rank - 0.95) < 0.005
    devices = roll_up_devices(device_sketches(events, "1 minute").withColumn("all", F.lit(1)), ["all"]).first()["active_devices"]
    assert abs(devices - 977) < 0.03 * 977
