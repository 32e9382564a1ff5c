"""Streams whose batches are split over several tables: rejected rows, late rows, counts on the way.

Every batch writes a folder of its own below each table and replaces what is there, so a batch that is replayed after a
failure adds nothing. The last folder written is the batch's line in the ledger; it holds the counts that the
batch's own write has observed, so no row is read again for them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from time import sleep

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators.quality import Rule, split_valid
from tidewatch.streaming.runner import LIVE

Split = Callable[[DataFrame, int], Mapping[str, DataFrame]]

LEDGER = "ledger"
LEDGER_SCHEMA = "last_time timestamp, rows bigint, batch bigint"


def run_split(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    split: Split,
    time: str = "timestamp",
    trigger: Mapping[str, object] = LIVE,
    name: str | None = None,
) -> StreamingQuery:
    """Write what ``split`` makes of every batch to ``path/<table>/batch=<id>``, and a line to the ledger.

    The batch is kept while its tables are written, so the source is read once; what is lost with an
    executor is read again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for table, part in split(kept, batch_id).items():
                part.write.mode("overwrite").parquet(f"{path}/{table}/batch={batch_id}")
            line = kept.agg(F.max(F.col(time).cast("timestamp")).alias("last_time"), F.count(F.lit(1)).alias("rows"))
            line.coalesce(1).write.mode("overwrite").parquet(f"{path}/{LEDGER}/batch={batch_id}")
        finally:
            kept.unpersist()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger)
    return (writer if name is None else writer.queryName(name)).start()


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The latest event time and the rows of every batch written so far."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(f"{path}/{LEDGER}")
    except AnalysisException:  # no batch yet
        return spark.createDataFrame([], LEDGER_SCHEMA)


def split_by_rules(rules: list[Rule]) -> Split:
    """Valid rows and rejected rows with their reasons."""

    def split(batch: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        valid, rejected = split_valid(batch, rules)
        return {"valid": valid, "rejected": rejected}

    return split


def split_late(path: str, delay: str, time: str = "timestamp") -> Split:
    """Rows in time, and rows behind the watermark that the earlier batches have committed.

    The watermark of a batch is the latest event time of all batches before it, less ``delay``. Rows without
    a time are late.
    """

    def split(batch: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        spark = batch.sparkSession
        before = ledger(spark, path).where(F.col("batch") < batch_id)
        # One instant, from a table of one row per batch.
        watermark = before.agg((F.max("last_time") - F.expr(f"INTERVAL {delay}")).alias("w")).first()["w"]
        behind: Column = F.col(time).isNull()
        if watermark is not None:
            behind = behind | (F.col(time).cast("timestamp") < F.lit(watermark))
        return {"in_time": batch.where(~behind), "late": batch.where(behind)}

    return split


def stop_after(query: StreamingQuery, batches: int, poll_seconds: float = 0.05) -> None:
    """Stop a running query once it has reported that many batches with rows, in the middle of what comes next."""
    while query.isActive and len({p.batchId for p in query.recentProgress if p.numInputRows}) < batches:
        sleep(poll_seconds)
    query.stop()
