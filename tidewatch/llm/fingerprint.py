"""Bottom-k sketches of shingle hashes: mergeable fingerprints of documents.

A sketch holds the ``k`` smallest distinct hashes of a text's shingles, in order. Sketches of parts
merge into that of the whole; two of them estimate resemblance and containment, one the number of
distinct shingles. Texts of fewer shingles than ``k`` are compared exactly.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import partitions_of, pieces

K = 64
WORDS = 5
_FACTORS = np.array([xxhash.xxh64_intdigest(bytes([i])) | 1 for i in range(64)], np.uint64)


def sketch(text: str | bytes | None, k: int = K, words: int = WORDS) -> np.ndarray:
    """The ``k`` smallest distinct shingle hashes, ascending.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, a shingle is ``words`` of them (all, if
    fewer). A text without words has one shingle too if it has white space, and none if it is empty.
    """
    data = (text.encode() if isinstance(text, str) else text or b"").lower()
    tokens = data.split()
    if not tokens:
        return np.array([xxhash.xxh64_intdigest(data)] if data else [], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    width = min(words, len(hashes))
    mixed = np.full(len(hashes) - width + 1, np.uint64(width))
    for j in range(width):
        mixed += hashes[j : len(hashes) - width + 1 + j] * _FACTORS[j]
    # The finalizer spreads every bit of the sum over the whole hash.
    mixed ^= mixed >> np.uint64(30)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(27)
    mixed *= np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(31)
    return np.unique(mixed)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of both parts together."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of common shingles among all of both (two empty texts: 1)."""
    union = merge(a, b, k)
    if not len(union):
        return 1.0
    both = np.isin(union, a, assume_unique=True) & np.isin(union, b, assume_unique=True)
    return float(both.sum() / len(union))


def distinct_shingles(a: np.ndarray, k: int = K) -> float:
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[-1]) + 1) / 2.0**64)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of ``a``'s shingles that ``b`` has (an empty ``a``: 1)."""
    n = distinct_shingles(a, k)
    if not n:
        return 1.0
    j = resemblance(a, b, k)
    return min(1.0, j / (1 + j) * (n + distinct_shingles(b, k)) / n)


def text_of(sketched: np.ndarray) -> str:
    """Sixteen hex digits for each hash."""
    return sketched.astype(">u8").tobytes().hex()


def sketch_of(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u8").astype(np.uint64)


def document_sketches(docs: DataFrame, k: int = K, words: int = WORDS) -> DataFrame:
    """doc_id, ``sketch`` (hashes as signed longs, in unsigned order) and ``n_shingles`` (estimated)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found = [sketch(t, k, words) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64())),
                pa.array([distinct_shingles(s, k) for s in found], pa.float64()),
            ], ["doc_id", "sketch", "n_shingles"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(read, "doc_id long, sketch array<long>, n_shingles double")


def merged_sketches(sketches: DataFrame, by: str, k: int = K) -> DataFrame:
    """The sketch of all rows of each ``by``. Every task keeps ``k`` hashes of a key before the shuffle."""
    hashes = sketches.select(by, F.explode("sketch").alias("hash")).distinct()
    # Flipping the sign bit turns the unsigned order into that of longs.
    flipped = F.col("hash").bitwiseXOR(F.lit(-(2**63)))
    hashes = hashes.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(flipped)))
    kept = hashes.where(F.col("rank") <= k).groupBy(by).agg(F.collect_list(F.struct("rank", "hash")).alias("found"))
    return kept.select(by, F.transform(F.array_sort("found"), lambda x: x["hash"]).alias("sketch"))


_LEAST = -(2**63)


def _key(doc_id: int | None, text: bytes | None) -> tuple[int, int]:
    """Order of documents: the id (null below all others), then a hash of the text."""
    tie = -1 if text is None else xxhash.xxh3_64_intdigest(text) >> 1
    return (_LEAST if doc_id is None else doc_id, tie)


def neighbours(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows of documents by bucket, with the next document of a bucket's last one as its guest.

    Buckets are ranges of the descending order, bounded by a hash sample of about 20 rows a bucket.
    The guest of a bucket is the first document of the next bucket that has one (of the first bucket,
    after the last), so that neighbours meet in one bucket and every text moves once, compressed.
    """
    n_buckets = 4 * partitions_of(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found = [_key(i, t) for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["id", "tie"]
            )

    rate = max(1, texts.count() // (20 * n_buckets))
    ordered = texts.mapInArrow(keys, "id long, tie long")
    sample = sorted(map(tuple, ordered.where(F.pmod(F.xxhash64("id", "tie"), F.lit(rate)) == 0).collect()), reverse=True)
    step = max(1, len(sample) // n_buckets)
    bounds = sorted(set(sample[step::step]))

    def bucket(key: tuple[int, int]) -> int:
        return len(bounds) - bisect.bisect_left(bounds, key)

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[int, int]] = {}
        for batch in batches:
            for key in zip(batch.column("id").to_pylist(), batch.column("tie").to_pylist()):
                own = bucket(key)
                best[own] = max(key, best.get(own, key))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(best), pa.int64()), pa.array([k[0] for k in best.values()], pa.int64()),
             pa.array([k[1] for k in best.values()], pa.int64())], ["bucket", "id", "tie"]
        )

    first = ordered.mapInArrow(firsts, "bucket long, id long, tie long")
    first = first.groupBy("bucket").agg(F.max(F.struct("id", "tie")).alias("key"))
    first = {r["bucket"]: (r["key"]["id"], r["key"]["tie"]) for r in first.collect()}  # a row per bucket
    order = sorted(first)
    host = {first[b]: order[i - 1] for i, b in enumerate(order)}  # of the first document of b

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in pieces(batches, "text"):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                key = _key(doc_id, text)
                data = None if text is None else pack(text)
                rows.append((bucket(key), False, *key, doc_id, data))
                if key in host:
                    rows.append((host[key], True, *key, doc_id, data))
            types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                ["bucket", "guest", "id", "tie", "doc_id", "data"],
            )

    dealt = texts.mapInArrow(deal, "bucket long, guest boolean, id long, tie long, doc_id long, data binary")
    dealt = dealt.repartition(partitions_of(docs.sparkSession), "bucket")
    return dealt.sortWithinPartitions("bucket", "guest", F.desc("id"), F.desc("tie")), n_buckets


def compare_neighbours(docs: DataFrame, k: int = K, words: int = WORDS) -> DataFrame:
    """Fingerprints of every document and of its edited text, and likeness to that and to the next one.

    The next document is that of the next smaller ``doc_id`` (after the smallest: the largest). The
    edited text has the last third of the code points replaced by the first as many of the next
    document (all, if it has fewer). Null text is empty. A null ``doc_id`` is below all others; rows
    of one ``doc_id`` are documents of their own, in descending order of a hash of their texts. A
    single document is its own next one. Other columns are ignored; an empty table gives no row.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        held, out = None, []
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

        def batch_of() -> pa.RecordBatch:
            arrays = [pa.array([r[i] for r in out], t) for i, t in enumerate(types)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, COMPARED)

        for batch in batches:
            for bucket, guest, doc_id, data in zip(*(batch.column(c).to_pylist() for c in ("bucket", "guest", "doc_id", "data"))):
                if held is not None and held[0] != bucket:
                    held = None  # what follows a guest is another bucket
                text = unpack(data).decode() if data else ""
                own = sketch(text, k, words)
                if held is not None:
                    _, id_, before, before_sketch = held
                    n = len(before)
                    edited = before[: n - n // 3] + text[: n // 3]
                    edited_sketch = sketch(edited, k, words)
                    out.append((
                        id_, n, hashlib.sha256(edited.encode()).hexdigest(), text_of(before_sketch), text_of(edited_sketch),
                        resemblance(before_sketch, edited_sketch, k), resemblance(before_sketch, own, k),
                    ))
                held = None if guest else (bucket, doc_id, text, own)
            if out:
                yield batch_of()

    return neighbours(docs)[0].mapInArrow(
        compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


COMPARED = [
    "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
]
