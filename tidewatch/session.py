"""Session settings the library is tuned for; every one can be overridden by the caller."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

SETTINGS = {
    # Calendar columns and ISO parsing depend on the session time zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Checkpoint files go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Methods beyond 8000 bytes of bytecode are never compiled by the JVM; a long list of rules is
    # faster as several smaller methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Large keyed state belongs on disk, with only changes uploaded per batch.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app_name: str = "tidewatch",
    master: str | None = None,
    options: Mapping[str, str] | None = None,
) -> SparkSession:
    """Session with :data:`SETTINGS`, then ``options`` on top.

    Object-store access (``spark.hadoop.fs.s3a.*``), memory and shuffle widths belong to the
    deployment: pass them in ``options`` or in the cluster's own configuration.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(options or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
