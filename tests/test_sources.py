"""Table reader and writers, and where intermediate results go."""

from __future__ import annotations

import glob
from datetime import date, datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.conftest import CHECK_FOLDER, plan_of, rows_of
from tidewatch import shared as D
from tidewatch.plans.windows import events_to_windows
from tidewatch.sources import tables
from tidewatch.sources.events_table import contract_events, read_events


def few_days(spark):
    table = spark.read.parquet(f"{CHECK_FOLDER}/events.parquet").filter("ts < TIMESTAMP_NTZ'2024-01-04 00:00:00'")
    return events_to_windows(contract_events(table), "1 hour")


def test_pruned_scan_reads_only_the_wanted_days(spark, tmp_path):
    path = str(tmp_path / "windows")
    tables.write_windows(few_days(spark), path)
    everything = tables.load_data(spark, path)
    assert everything.count() == few_days(spark).count()
    chosen = tables.load_data(spark, path, date(2024, 1, 2), date(2024, 1, 2))
    assert "PartitionFilters: [isnotnull(year" in plan_of(chosen)
    files = {f for f in chosen.select("_metadata.file_path").distinct().toPandas()["file_path"]}
    assert files and all("/day=2/" in f for f in files)
    assert chosen.count() == everything.filter("day = 2").count()
    assert tables.load_data(spark, path, last_day=date(2024, 1, 1)).select("day").distinct().count() == 1


def test_hours_are_written_together(spark, tmp_path):
    path = str(tmp_path / "windows")
    tables.write_windows(few_days(spark), path)
    assert {r["files"] for r in tables.landed_hours(spark, path).collect()} == {1}


def test_compaction_keeps_rows_and_reduces_files(spark, tmp_path):
    path, target = str(tmp_path / "loose"), str(tmp_path / "tight")
    windows = few_days(spark)
    for part in ("light", "view"):
        chosen = windows.filter(F.col("device_type") == part) if part == "view" else windows.filter("device_type <> 'view'")
        tables.write_windows(chosen, path)
    assert max(r["files"] for r in tables.landed_hours(spark, path).collect()) == 2
    tables.compact_days(spark, path, target, date(2024, 1, 1), date(2024, 1, 3))
    assert {r["files"] for r in tables.landed_hours(spark, target).collect()} == {1}
    same = ["window_start", "device_type", "event_count", "avg_duration"]
    assert rows_of(tables.load_data(spark, path).select(*same)) == rows_of(tables.load_data(spark, target).select(*same))


def test_csv_round_trip(spark, tmp_path):
    result = spark.createDataFrame(
        [("light", date(2024, 1, 1), 1.25, 10), ("a,\"b\"", date(2024, 1, 2), None, 3)],
        "device_type string, date date, p95_duration double, total_events long",
    ).repartition(2)
    for single in (True, False):
        path = str(tmp_path / f"csv-{single}")
        tables.export_results(result, path, single_file=single)
        tables.export_results(result, path, single_file=single)
        assert rows_of(tables.read_results(spark, path, result.schema)) == rows_of(result)
        assert not single or len(glob.glob(f"{path}/*.csv")) == 1


def test_intermediate_results_live_in_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert D.shared_folder(spark) == folder
    assert D.scratch_path(spark, "x").startswith(folder)
    before = len(glob.glob(f"{folder}/**/rdd-*", recursive=True))
    kept = D.durable(spark.range(10))
    assert kept.count() == 10
    assert len(glob.glob(f"{folder}/**/rdd-*", recursive=True)) == before + 1


def test_a_cluster_without_a_shared_folder_is_an_error():
    context = SimpleNamespace(master="spark://master:7077", getCheckpointDir=lambda: None)
    cluster = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        D.shared_folder(cluster)


def test_reading_events_keeps_the_contract(spark):
    from tidewatch.schema import EVENT_SCHEMA

    assert read_events(spark, CHECK_FOLDER).columns == EVENT_SCHEMA.names


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("RocksDBStateStoreProvider")


def test_compaction_keeps_the_days_that_are_there(spark, tmp_path):
    rows = [(datetime(2024, 1, d, 10), 2024, 1, d, 10) for d in (1, 1, 2)]
    frame = spark.createDataFrame(rows, "window_start timestamp, year int, month int, day int, hour int")
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    tables.write_windows(frame, source)
    for day in (1, 2, 1):
        tables.compact_days(spark, source, target, date(2024, 1, day), date(2024, 1, day))
    assert sorted(r["day"] for r in spark.read.parquet(target).collect()) == [1, 1, 2]
    for other in (source + "/", f"file:{source}", f"file://{source}/.", f"{source}//year=2024", source.rpartition("/")[0]):
        with pytest.raises(ValueError):
            tables.compact_days(spark, source, other, date(2024, 1, 1), date(2024, 1, 2))
