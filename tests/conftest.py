from __future__ import annotations

import contextlib
import io
from datetime import datetime, timezone

import pytest
from pyspark.sql import DataFrame

from tidewatch.session import build_session

CHECK_FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tidewatch-tests",
        master="local[4]",
        options={
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """A session whose threshold rules out every broadcast by size."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df: DataFrame) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode="formatted")
    return out.getvalue()


def rows_of(df: DataFrame) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)


def at(text: str) -> datetime:
    """An instant in UTC from ``HH:MM[:SS]`` on 1 January 2024, or from a full date and time."""
    stamp = text if "-" in text else f"2024-01-01 {text}"
    return datetime.fromisoformat(stamp).replace(tzinfo=timezone.utc)
