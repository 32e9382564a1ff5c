"""The landed window table and the CSV report: readers, writers and the landing audit."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.filters import in_days
from tidewatch.operators.quality import missing_columns
from tidewatch.schema import PARTITION_COLUMNS, WINDOW_SCHEMA


def load_data(
    spark: SparkSession,
    input_path: str,
    first_day: date | None = None,
    last_day: date | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """The hive-partitioned table; a range of days reads only the folders of those days."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    table = reader.parquet(input_path)
    if first_day is None and last_day is None:
        return table
    return table.filter(in_days(first_day or date.min, last_day or date.max))


def write_windows(windows: DataFrame, path: str, mode: str = "append") -> None:
    """Append to the table, with the rows of an hour together so that hours have few files.

    The rebalance splits an hour that outgrows the advisory partition size, so a full hour is
    written by several tasks.
    """
    together = windows.hint("rebalance", *PARTITION_COLUMNS)
    writer = together.write.mode(mode).partitionBy(*PARTITION_COLUMNS)
    # Overwriting replaces the hours that are written, never the other ones.
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def _plain_path(path: str) -> str:
    """The path without the scheme of local files, doubled slashes, single dots and a slash at the end."""
    scheme, _, rest = path.rpartition(":/") if ":/" in path else ("", "", path)
    rest = "/" + rest if scheme else rest
    parts = [part for part in rest.split("/") if part not in ("", ".")]
    return ("" if scheme in ("", "file") else f"{scheme}:") + ("/" if rest.startswith("/") else "") + "/".join(parts)


def compact_days(spark: SparkSession, path: str, target: str, first_day: date, last_day: date) -> None:
    """Rewrite closed days of ``path`` into ``target`` with few files per hour.

    Hours of ``target`` that hold other days stay as they are. Neither table may lie in the other.
    """
    source, written = (_plain_path(p) + "/" for p in (path, target))
    if source.startswith(written) or written.startswith(source):
        raise ValueError("compact into another table: this one is read while its hours are replaced")
    write_windows(load_data(spark, path, first_day, last_day), target, mode="overwrite")


def export_results(result: DataFrame, output_path: str, single_file: bool = False) -> None:
    """CSV with header, replacing what is there. ``single_file`` writes through one task."""
    if single_file:
        result = result.coalesce(1)
    result.write.mode("overwrite").option("header", True).csv(output_path)


def read_results(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def landed_hours(spark: SparkSession, path: str) -> DataFrame:
    """Rows and Parquet files of every hour partition."""
    table = spark.read.parquet(path)
    return (
        table.select(*PARTITION_COLUMNS, F.col("_metadata.file_path").alias("file"))
        .groupBy(*PARTITION_COLUMNS, "file")
        .agg(F.count("*").alias("rows"))
        .groupBy(*PARTITION_COLUMNS)
        .agg(F.sum("rows").alias("rows"), F.count("*").alias("files"))
    )


def landing_problems(
    spark: SparkSession,
    path: str,
    required: Iterable[str] = tuple(WINDOW_SCHEMA.names),
    checkpoint: str | None = None,
) -> list[str]:
    """What is wrong with a landed table: no files, columns missing, no checkpoint. Empty if fine."""
    try:
        table = spark.read.parquet(path)
    except AnalysisException:
        return [f"no Parquet table at {path}"]
    problems = [f"column {name} is missing" for name in missing_columns(table, required)]
    if table.isEmpty():
        problems.append(f"no rows at {path}")
    if checkpoint is not None:
        try:
            if spark.read.text(f"{checkpoint}/offsets").isEmpty():
                problems.append(f"no offsets in {checkpoint}")
        except AnalysisException:
            problems.append(f"no checkpoint at {checkpoint}")
    return problems
