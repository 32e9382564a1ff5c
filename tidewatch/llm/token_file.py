"""A token file with direct access: ids in chunk levels with continuation bitmaps and rank directories.

Level 0 holds the lowest chunk of every id. Its bitmap marks the ids that have more bits; their next
chunks are level 1, and so on. The chunk of id ``i`` on the next level stands at the number of marks
before ``i``, which the rank directory gives with one addition and the count of a few bits. No block
is decoded to read one token.

The file is a Parquet table with one row per segment (whole documents, about ``SEGMENT_IDS`` ids), so
that Spark's committer writes it on any store and a lost executor's segments are written anew.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import partitions_of, pieces
from tidewatch.llm.tokens import encoder, with_end

SEGMENT_IDS = 1 << 18
CHUNK_BITS = 8
RANK_BYTES = 64  # the rank directory has one count per so many bytes of a bitmap

SEGMENT_SCHEMA = (
    "partition int, segment long, first long, n_ids long, doc_ids array<long>, lengths array<long>, codes binary"
)
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1).astype(np.int64)


def encode_codes(ids: np.ndarray) -> bytes:
    """Unsigned 32-bit ids as levels: number of levels, then per level count, chunks, bitmap, ranks."""
    rest, levels = np.asarray(ids, dtype=np.uint32), []
    while True:
        chunks = (rest & ((1 << CHUNK_BITS) - 1)).astype(np.uint8)
        rest = rest >> CHUNK_BITS
        more = rest > 0
        bitmap = np.packbits(more, bitorder="little")
        counts = np.add.reduceat(_BITS[bitmap], np.arange(0, len(bitmap), RANK_BYTES)) if len(bitmap) else []
        ranks = np.cumsum(np.concatenate([[0], counts]))[:-1].astype("<u4")
        levels += [np.array([len(chunks)], "<u8").tobytes(), chunks.tobytes(), bitmap.tobytes(), ranks.tobytes()]
        rest = rest[more]
        if not len(rest):
            return np.array([len(levels) // 4], "<u8").tobytes() + b"".join(levels)


class Codes:
    """Views of one segment's levels; nothing is decoded when it is opened."""

    def __init__(self, data: bytes):
        view, at = memoryview(data), 8
        self.levels = []
        for _ in range(int(np.frombuffer(view[:8], "<u8")[0])):
            n = int(np.frombuffer(view[at : at + 8], "<u8")[0])
            n_bitmap = -(-n // 8)
            n_ranks = -(-n_bitmap // RANK_BYTES)
            cuts = np.cumsum([at + 8, n, n_bitmap, 4 * n_ranks]).tolist()
            self.levels.append((
                np.frombuffer(view[cuts[0] : cuts[1]], np.uint8),
                np.frombuffer(view[cuts[1] : cuts[2]], np.uint8),
                np.frombuffer(view[cuts[2] : cuts[3]], "<u4"),
            ))
            at = cuts[3]

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        """The id at position ``i``, from one chunk per level."""
        value, shift = 0, 0
        for chunks, bitmap, ranks in self.levels:
            value |= int(chunks[i]) << shift
            byte, bit = divmod(i, 8)
            if not (bitmap[byte] >> bit) & 1:
                return value
            block = byte // RANK_BYTES
            below = _BITS[bitmap[block * RANK_BYTES : byte]].sum() + _BITS[bitmap[byte] & ((1 << bit) - 1)]
            i, shift = int(ranks[block]) + int(below), shift + CHUNK_BITS
        raise ValueError("the last level marks a continuation")

    def all(self) -> np.ndarray:
        """Every id of the segment in order."""
        values = np.zeros(0, np.uint32)
        for chunks, bitmap, _ in reversed(self.levels):
            more = np.unpackbits(bitmap, count=len(chunks), bitorder="little").astype(bool)
            upper, values = values, chunks.astype(np.uint32)
            values[more] |= upper << CHUNK_BITS
        return values


def write_token_file(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, partitions: int | None = None) -> None:
    """Tokenize ``docs`` (doc_id, text) and write the file at ``path`` in ascending ``doc_id`` order.

    Null text is an empty text and gives the end id alone. A null ``doc_id`` comes first. Rows that
    share a ``doc_id`` are documents of their own, in the order of a hash of their texts (equal rows
    are alike in either order). Other columns are ignored. An empty table writes an empty file.
    """

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, number, first = TaskContext.get().partitionId(), 0, 0
        ids, doc_ids, lengths, held = [], [], [], 0
        schema = pa.schema([
            ("partition", pa.int32()), ("segment", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("codes", pa.binary()),
        ])

        def segment() -> pa.RecordBatch:
            row = [partition, number, first, held, doc_ids, lengths, encode_codes(np.concatenate(ids))]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        coder = encoder(tokenizer_path)
        for batch in pieces(batches, "text"):
            flat, counts = with_end(*coder.encode(batch.column("text")), end_id)
            ends = np.cumsum(counts)
            for doc_id, n, end in zip(batch.column("doc_id").to_pylist(), counts.tolist(), ends.tolist()):
                ids.append(flat[end - n : end])
                doc_ids.append(doc_id)
                lengths.append(n)
                held += n
                if held >= SEGMENT_IDS:
                    yield segment()
                    number, first = number + 1, first + held
                    ids, doc_ids, lengths, held = [], [], [], 0
        if doc_ids:
            yield segment()

    tie = F.xxhash64("text")
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(
        partitions or partitions_of(docs.sparkSession), F.col("doc_id").asc(), tie
    )
    ordered.sortWithinPartitions(F.col("doc_id").asc(), tie).mapInArrow(segments, SEGMENT_SCHEMA).write.parquet(path)


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """The segments of a file with ``base``, the number of ids before each segment.

    The totals of the partitions (one number for each writing task) pass through the driver.
    """
    stored = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    totals = sorted(map(tuple, stored.groupBy("partition").agg(F.sum("n_ids")).collect()))
    bases, base = [], 0
    for partition, total in totals:
        bases.append((partition, base))
        base += total
    starts = spark.createDataFrame(bases, "partition int, partition_base long")
    return stored.join(F.broadcast(starts), "partition").withColumn("base", F.col("partition_base") + F.col("first"))


def document_digests(segments: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the file."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = Codes(row["codes"]).all().astype("<u4")
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(ids[e - n : e].tobytes()) for n, e in zip(lengths.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(row["base"] + ends - lengths),
                     pa.array(lengths), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return segments.select("doc_ids", "lengths", "codes", "base").mapInArrow(
        digest, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def tokens_at(segments: DataFrame, positions: DataFrame) -> DataFrame:
    """The ids at global ``position`` values: each is found in its segment without decoding the segment.

    Positions outside the file, and null ones, have no row; repeated ones are answered as often.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(p, Codes(row["codes"])[p - row["base"]]) for row in batch.to_pylist() for p in row["positions"]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in found], pa.int64()), pa.array([v for _, v in found], pa.int64())],
                ["position", "token"],
            )

    # Both sides are cut by a grid of positions, so the join has an equal key.
    grid, last = F.lit(SEGMENT_IDS), F.col("base") + F.col("n_ids")
    wanted = positions.select("position", F.expr(f"position div {SEGMENT_IDS}").alias("cell"))
    cells = F.sequence(F.floor(F.col("base") / grid), F.floor((last - 1) / grid))
    places = segments.select("partition", "segment", "base", "n_ids", F.explode(cells).alias("cell")).join(wanted, "cell")
    places = places.where((F.col("position") >= F.col("base")) & (F.col("position") < last))
    grouped = places.groupBy("partition", "segment").agg(F.collect_list("position").alias("positions"))
    return segments.join(grouped, ["partition", "segment"]).select("codes", "base", "positions").mapInArrow(
        read, "position long, token long"
    )
