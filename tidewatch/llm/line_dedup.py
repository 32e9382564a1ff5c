"""Removal of lines that repeat across documents, with two Bloom filters before the exact step.

A first pass marks the hash of every long line in two filters: seen once, seen twice. Filters of
tasks are merged in a tree (``twice`` also takes what two ``once`` filters share), so ``twice`` holds
every line that occurs in two documents, and few others. Only lines found there are shuffled, with
their whole text, for the exact count and the choice of the document that keeps them.

The filters have a fixed largest size, so what the second pass broadcasts is bounded. In a corpus of
more lines than they can tell apart more lines are suspected; the result is the same.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import pieces
from tidewatch.shared import durable, scratch_path

MAX_FILTER_BITS = 1 << 30
SEGMENTS = 64  # parts of a filter that are merged apart
FAN_IN = 32
SPACES = b" \t\n\x0b\x0c\r"

FILTER_SCHEMA = "segment int, node long, once binary, twice binary"


def long_key(line: bytes, least: int) -> bytes | None:
    """The key of a line: without white space at its ends, A-Z in lower case; None if short."""
    key = line.strip(SPACES)
    if len(key) < least or (len(key) < 4 * least and len(key.decode()) < least):
        return None
    return key.lower()


def text_lines(batch: pa.RecordBatch) -> Iterator[list[bytes]]:
    for text in batch.column("text").cast(pa.binary()).to_pylist():
        yield (text or b"").split(b"\n")


def _bits(hashes: np.ndarray, n_bits: int) -> tuple[np.ndarray, np.ndarray]:
    return hashes & np.uint64(n_bits - 1), (hashes >> np.uint64(32)) & np.uint64(n_bits - 1)


def _has(filter_: np.ndarray, hashes: np.ndarray, n_bits: int) -> np.ndarray:
    found = np.ones(len(hashes), bool)
    for at in _bits(hashes, n_bits):
        found &= (filter_[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


def _add(filter_: np.ndarray, hashes: np.ndarray, n_bits: int) -> None:
    for at in _bits(hashes, n_bits):
        np.bitwise_or.at(filter_, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))


def twice_filter(docs: DataFrame, least: int) -> np.ndarray:
    """The filter of the long lines that occur in two rows or more, merged from all tasks."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_bits = 1 << 16
    while n_bits < min(4 * size // least, MAX_FILTER_BITS):
        n_bits *= 2
    part = n_bits // 8 // SEGMENTS

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        once, twice = np.zeros(n_bits // 8, np.uint8), np.zeros(n_bits // 8, np.uint8)
        for batch in pieces(batches, "text"):
            seen: list[int] = []
            for lines in text_lines(batch):
                keys = {k for line in lines if (k := long_key(line, least)) is not None}
                seen.extend(map(xxhash.xxh3_64_intdigest, keys))
            hashes, counts = np.unique(np.array(seen, np.uint64), return_counts=True)
            _add(twice, hashes[(counts > 1) | _has(once, hashes, n_bits)], n_bits)
            _add(once, hashes, n_bits)
        rows = [
            (k, once[k * part : (k + 1) * part], twice[k * part : (k + 1) * part])
            for k in range(SEGMENTS) if once[k * part : (k + 1) * part].any()
        ]
        if rows:
            node = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([
                pa.array([k for k, *_ in rows], pa.int32()), pa.array([node] * len(rows), pa.int64()),
                pa.array([zlib.compress(o.tobytes(), 1) for _, o, _ in rows], pa.binary()),
                pa.array([zlib.compress(t.tobytes(), 1) for _, _, t in rows], pa.binary()),
            ], ["segment", "node", "once", "twice"])

    def merge(group: pa.Table) -> pa.Table:
        once, twice = np.zeros(part, np.uint8), np.zeros(part, np.uint8)
        for row in group.to_pylist():
            other = np.frombuffer(zlib.decompress(row["once"]), np.uint8)
            twice |= np.frombuffer(zlib.decompress(row["twice"]), np.uint8)
            twice |= once & other
            once |= other
        return pa.table({
            "segment": group["segment"][:1], "node": group["node"][:1],
            "once": pa.array([zlib.compress(once.tobytes(), 1)]), "twice": pa.array([zlib.compress(twice.tobytes(), 1)]),
        })

    filters = durable(docs.select("text").mapInArrow(build, FILTER_SCHEMA))
    nodes = (filters.agg(F.max("node")).first()[0] or 0) + 1
    while nodes > 1:
        filters = filters.withColumn("node", F.expr(f"node div {FAN_IN}"))
        filters = filters.groupBy("segment", "node").applyInArrow(merge, FILTER_SCHEMA)
        nodes = -(-nodes // FAN_IN)
    # MAX_FILTER_BITS bits at most, whatever the input.
    merged = np.zeros(n_bits // 8, np.uint8)
    for segment, data in filters.select("segment", "twice").collect():
        merged[segment * part : (segment + 1) * part] = np.frombuffer(zlib.decompress(data), np.uint8)
    return merged


def lost_lines(losing: DataFrame) -> DataFrame:
    """The ``__lost`` keys of each row (doc_id, row): never more than the row has lines."""
    return losing.groupBy("doc_id", "row").agg(F.collect_set("key").alias("__lost"))


def dedup_lines(docs: DataFrame, least_length: int = 40, least_documents: int = 5) -> DataFrame:
    """``docs`` with ``text`` without repeated lines, and ``n_lines``, ``n_dropped``.

    A text is cut at each newline (null or empty: one empty line). A line's key is the line without
    ``[\\x20\\x09-\\x0D]`` at its ends and with A-Z in lower case. Lines whose key has at least
    ``least_length`` code points and is found in at least ``least_documents`` documents go from all
    documents but that with the largest ``doc_id``. Rows of one ``doc_id`` count as one document, and
    rows with a null ``doc_id`` together as one, below all others. Other columns of ``docs`` stay as
    they are (columns named like the two new ones are replaced). An empty table stays empty; a text
    of which nothing is left becomes an empty text, a null text too.
    """
    spark = docs.sparkSession
    # A row's own key: rows of one id (or of none) would else gather all their lost lines in one list.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("row"))
    bits = spark.sparkContext.broadcast(twice_filter(texts, least_length))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = bits.value
        n_bits = 8 * len(twice)
        for batch in pieces(batches, "text"):
            ids, rows, keys = [], [], []
            for doc_id, row, lines in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), text_lines(batch)):
                own = {k for line in lines if (k := long_key(line, least_length)) is not None}
                ids.extend([doc_id] * len(own))
                rows.extend([row] * len(own))
                keys.extend(own)
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
            kept = np.flatnonzero(_has(twice, hashes, n_bits)).tolist()
            yield pa.RecordBatch.from_arrays([
                pa.array([ids[i] for i in kept], pa.int64()), pa.array([rows[i] for i in kept], pa.int64()),
                pa.array([keys[i] for i in kept], pa.binary()),
            ], ["doc_id", "row", "key"])

    path = scratch_path(spark, "lines")
    texts.mapInArrow(suspects, "doc_id long, row long, key binary").write.parquet(path)
    suspected = spark.read.schema("doc_id long, row long, key binary").parquet(path)
    # A struct is never null, and orders a null id below all others.
    of = F.struct("doc_id")
    repeated = suspected.groupBy("key").agg(F.count_distinct(of).alias("n"), F.max(of).alias("keeper"))
    repeated = repeated.where(F.col("n") >= least_documents).select("key", F.col("keeper.doc_id").alias("keeper"))
    # A side of its own, so that a line with very many documents can be split over tasks by the join.
    repeated = durable(repeated)
    losing = suspected.join(repeated, "key").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    losing = lost_lines(losing).withColumnsRenamed({"doc_id": "__id", "row": "__row"})
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__row"))
    joined = docs.join(losing, same, "left").drop("__id", "__row")

    columns = [f for f in docs.schema.fields if f.name not in ("n_lines", "n_dropped")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in columns] + ["n_lines long", "n_dropped long"])

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            out, total, dropped = [], [], []
            for lines, lost in zip(text_lines(batch), batch.column("__lost").to_pylist()):
                total.append(len(lines))
                if lost:
                    lost = set(lost)
                    lines = [line for line in lines if line.strip(SPACES).lower() not in lost]
                dropped.append(total[-1] - len(lines))
                out.append(b"\n".join(lines))
            arrays = [
                pa.array(out, pa.binary()).cast(pa.string()) if f.name == "text" else batch.column(f.name) for f in columns
            ]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(total, pa.int64()), pa.array(dropped, pa.int64())],
                [f.name for f in columns] + ["n_lines", "n_dropped"],
            )

    return joined.select(*[F.col(f"`{f.name}`") for f in columns], "__lost").mapInArrow(drop, schema)
