"""SimHash near-duplicates: fingerprints, blocks of equal bits, bit-sliced comparison, components.

Two fingerprints within the radius agree on all but ``radius`` of their pieces, so they share the
bits of some choice of the other pieces: every choice is a table of blocks. Blocks meet as sorted
runs in a partition. There the fingerprints stand as bit planes, and one pass over the planes
updates 64 distances at once with carry-save counters; words of 64 pairs are abandoned as soon as all
of their pairs exceed the radius. Of the links found a partition keeps a spanning forest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import pieces
from tidewatch.shared import durable

TILE = 2048  # fingerprints of a block that meet in one task; larger blocks are dealt into tile pairs
SHINGLES_AT_ONCE = 1 << 14


def fingerprint(text: bytes, words: int) -> int:
    """The majority of every bit over XXH64 (seed 42) of all word shingles; no words: 0."""
    tokens = text.lower().split()
    n = max(1, len(tokens) - words + 1) if tokens else 0
    if n == 0:
        return 0
    shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)))) if n > 1 or len(tokens) == words else iter([b" ".join(tokens)])
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), ">u8", n)
    counts = np.zeros(64, np.int64)
    for start in range(0, n, SHINGLES_AT_ONCE):
        part = hashes[start : start + SHINGLES_AT_ONCE]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the 64-bit ``fingerprint`` (as a signed long) of every whole text, and the columns ``keep``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. A text of fewer words than a shingle
    has one shingle; a null text, and one without words, has the fingerprint 0.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            values = np.array([fingerprint(t or b"", words) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(values.view(np.int64)), *(batch.column(c) for c in keep)],
                ["doc_id", "fingerprint", *keep],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *keep)
    kept = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return texts.mapInArrow(read, "doc_id long, fingerprint long" + kept)


def block_masks(radius: int) -> list[int]:
    """Masks of which one at least covers only equal bits of any two fingerprints within the radius."""
    n = radius + 3 if radius else 1
    edges = np.linspace(0, 64, n + 1).astype(int).tolist()
    parts = [((1 << (high - low)) - 1) << low for low, high in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, n - radius)] if radius else [(1 << 64) - 1]


def close_pairs(values: np.ndarray, ends: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs within the radius, as two arrays of positions at a time.

    ``values`` holds a row of 64-bit parts per position. ``ends[i]`` is the end of the run that position
    ``i`` belongs to; only pairs of one run count. Positions are compared with those ``shift`` further
    on, all at once, for one shift after another.
    """
    n = len(values)
    if n < 2:
        return
    n_words = -(-n // 64) + 1
    planes = np.zeros((64 * values.shape[1], n_words), np.uint64)
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(n, -1), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    planes.view(np.uint8)[:, : packed.shape[1]] = packed
    n_counters = radius.bit_length()
    left = ends - np.arange(n)  # a position has partners for shifts below this
    left_of_word = np.zeros(-(-n // 64) * 64, np.int64)
    left_of_word[:n] = left
    most_left = left_of_word.reshape(-1, 64).max(axis=1)
    for shift in range(1, int(left.max())):
        words = np.flatnonzero(most_left > shift)
        if not len(words):
            break
        inside = left_of_word.reshape(-1, 64)[words] > shift
        far = ~np.packbits(inside, axis=1, bitorder="little").view(np.uint64).ravel()  # pairs given up
        whole, part = divmod(shift, 64)
        counters = [np.zeros(len(words), np.uint64) for _ in range(n_counters)]
        for at, plane in enumerate(planes):
            low = plane[np.minimum(words + whole, n_words - 1)] >> np.uint64(part)
            if part:
                low = low | plane[np.minimum(words + whole + 1, n_words - 1)] << np.uint64(64 - part)
            carry = plane[words] ^ low
            for k in range(n_counters):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            far |= carry  # past what the counters hold
            if n_counters and radius + 1 < 1 << n_counters:
                over = np.full(len(words), ~np.uint64(0))
                above = np.zeros(len(words), np.uint64)
                for k in reversed(range(n_counters)):
                    if radius >> k & 1:
                        over &= counters[k]
                    else:
                        above |= over & counters[k]
                        over &= ~counters[k]
                far |= above
            if at % 4 == 3:
                open_ = far != ~np.uint64(0)
                if not open_.all():
                    words, far, counters = words[open_], far[open_], [c[open_] for c in counters]
                    if not len(words):
                        break
        if len(words):
            near = np.unpackbits((~far).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, bit = np.nonzero(near)
            first = words[row] * 64 + bit
            yield first, first + shift


def close_runs(values: np.ndarray, ends: np.ndarray, radius: int) -> np.ndarray:
    """A spanning forest of the pairs of 64-bit ``values`` within the radius, as rows of two positions."""
    forest, root = [], np.arange(len(values))
    for first, second in close_pairs(values.reshape(-1, 1), ends, radius):
        apart = root[first] != root[second]
        for a, b in zip(first[apart].tolist(), second[apart].tolist()):
            x, y = root[a], root[b]
            if x != y:
                forest.append((a, b))
                root[root == max(x, y)] = min(x, y)
    return np.array(forest, np.int64).reshape(-1, 2)


def near_links(distinct: DataFrame, radius: int) -> DataFrame:
    """Links a < b between the rows of ``distinct`` (fingerprint long, each once) within the radius.

    Not every pair: a forest per partition that connects whatever the pairs connect. A block of more
    than ``TILE`` fingerprints is dealt into parts by a hash, and every pair of parts is a run.
    """
    masks = block_masks(radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = distinct.select("fingerprint", F.posexplode(F.array(*[F.col("fingerprint").bitwiseAND(F.lit(m)) for m in signed])))
    keys = keys.select("fingerprint", F.col("pos").alias("mask"), F.col("col").alias("bits"))

    def links(rows: pa.Table, ends: np.ndarray) -> pa.RecordBatch:
        values = rows["fingerprint"].to_numpy()
        found = values[close_runs(values.view(np.uint64), ends, radius)]
        return pa.RecordBatch.from_arrays(
            [pa.array(found.min(axis=1, initial=2**63 - 1)), pa.array(found.max(axis=1, initial=-(2**63)))], ["a", "b"]
        )

    return compare_blocks(keys, "fingerprint", links, "a long, b long").distinct()


def compare_blocks(
    keys: DataFrame, node: str, links: Callable[[pa.Table, np.ndarray], pa.RecordBatch], schema: str,
    weight: Column | None = None,
) -> DataFrame:
    """What ``links`` finds in the blocks of ``keys`` (mask, bits, ``node`` and others; equal mask and bits are a block).

    ``links`` gets rows of whole runs and for each of them the end of its run. A block of more than
    ``TILE`` nodes (or of that ``weight``) is dealt into ``part`` s by a hash, and every pair of parts is a run.
    """
    # A side of its own, so that a large block can be split over tasks by the join.
    load = F.count(F.lit(1)) if weight is None else F.sum(weight)
    sizes = durable(keys.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("n"), load.alias("load")).where("n > 1"))
    parts = F.ceil(F.col("load") / TILE)
    part = F.pmod(F.xxhash64(node), parts)
    met = keys.join(sizes, ["mask", "bits"]).select(
        *keys.columns, part.alias("part"),
        F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("other"),
    )
    runs = met.select(*keys.columns, "part", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"))
    run = ["mask", "bits", "low", "high"]
    runs = runs.repartition(*run).sortWithinPartitions(*run, node)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def found(rows: pa.Table) -> pa.RecordBatch:
            columns = [rows[c].to_numpy() for c in run]
            new = np.ones(rows.num_rows, bool)
            new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            starts = np.flatnonzero(new)
            return links(rows, np.append(starts[1:], rows.num_rows)[np.cumsum(new) - 1])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, rows]).combine_chunks() if held is not None else rows
            last = [held[c][-1].as_py() for c in run]
            same = np.logical_and.reduce([held[c].to_numpy() == v for c, v in zip(run, last)])
            start = int(np.argmax(same))  # the last run may go on in the next batch
            if start:
                yield found(held.slice(0, start))
                held = held.slice(start)
        if held is not None:
            yield found(held)

    return runs.mapInArrow(compare, schema)


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) of every node in ``links`` (a, b).

    Alternating large-star and small-star rounds until nothing changes: every round links nodes to
    the smallest node near them. A hub's links are rows of a join that can be split over tasks, and its
    smallest neighbour is a partial aggregate. Every round is a reliable checkpoint.
    """
    edges = durable(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = durable(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = durable(small)
        now = tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v"))).first())
        if now == state:
            break
        state = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs``.

    Rows are linked when their fingerprints differ in ``radius`` bits at most; ``component_id`` is the
    smallest ``doc_id`` reachable over links. Equal fingerprints are one node, so copies never meet as
    pairs. Null and empty texts share the fingerprint 0 and are linked like any other. Rows with a
    null ``doc_id`` take part and get the smallest other id of their component (null if none).
    Repeated rows each get a row. Other columns are ignored; an empty table gives no row.
    """
    marked, rooted = rooted_fingerprints(docs, words, radius)
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("fingerprint", "component_id")
    return marked.join(named, "fingerprint").select("doc_id", hex_of("fingerprint"), "component_id")


def rooted_fingerprints(
    docs: DataFrame, words: int, radius: int, keep: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """The marked rows, and every fingerprint with its smallest id and the root of its component."""
    marked = durable(fingerprints(docs, words, keep))
    distinct = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    roots = components(near_links(distinct.select("fingerprint"), radius))
    rooted = distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    return marked, durable(rooted.select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")))


def without_near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each component of :func:`near_duplicates`: that of the smallest ``doc_id``, then of a hash of its text.

    Null texts and texts without words are one group. A row without an id stays only if its whole group
    has none. Columns stay as they are, whatever their names; a repeated row stays once; an empty
    table gives no row. A text of any length is one fingerprint.
    """
    tie = F.coalesce(F.xxhash64(docs["text"]), F.lit(0))
    marked, rooted = rooted_fingerprints(docs.select("doc_id", "text", tie.alias("tie")), words, radius, keep=("tie",))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")).alias("kept")
    # Copies are reduced to a row per fingerprint before the roots are joined.
    best = marked.groupBy("fingerprint").agg(first).join(rooted, "fingerprint").groupBy("root").agg(F.min("kept").alias("kept"))
    best = best.select("kept.doc_id", "kept.tie")
    same = docs["doc_id"].cast("long").eqNullSafe(best["doc_id"]) & (tie == best["tie"])
    return docs.join(best, same, "left_semi").dropDuplicates(["doc_id", "text"])


def hex_of(column: str) -> Column:
    return F.lpad(F.lower(F.hex(column)), 16, "0").alias(column)
