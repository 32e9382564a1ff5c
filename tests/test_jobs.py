"""Both programs, end to end on files."""

from __future__ import annotations

import json

import pytest

from tidewatch.jobs import daily_report, stream


def test_stream_to_report(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for part in range(2):
        lines = []
        for i in range(part * 30, part * 30 + 30):
            for kind, duration in (("motion", 80.0 + i), ("light", 200.0)):
                lines.append(json.dumps({
                    "event_id": f"{kind}-{i}", "device_id": "device-417", "device_type": kind, "value": 1.0,
                    "timestamp": f"2024-03-05T10:{i:02d}:30Z", "event_duration": duration, "status": "normal",
                    "metadata": {"location": "zone-D", "firmware": "v3.1.4"},
                }))
        (source / f"part-{part}.json").write_text("\n".join(lines) + "\n")
    landed, state, report = (str(tmp_path / n) for n in ("landed", "state", "report"))
    stream.main(["--input", str(source), "--output", landed, "--checkpoint", state, "--catch-up"])
    windows = spark.read.parquet(landed)
    assert windows.count() == 2 * 49  # the watermark stands ten minutes before 10:59:30

    found = daily_report.main(["--input", landed, "--output", report, "--min-events", "10", "--first-day", "2024-03-05"])
    assert found == {"groups": 2, "loaded": 98, "qualified": 98, "kept": 98, "removed": 0}
    rows = {r["device_type"]: r for r in spark.read.option("header", True).csv(report).collect()}
    assert set(rows) == {"motion", "light"} and float(rows["light"]["p95_duration"]) == 200.0
    with pytest.raises(SystemExit):
        daily_report.main(["--input", landed, "--output", report, "--min-events", "500"])
    with pytest.raises(SystemExit):
        daily_report.main(["--input", landed, "--output", report, "--min-events", "10", "--last-day", "2024-03-04"])
