"""Packing of documents into token windows by the sum-of-squares rule, online in every task."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidewatch.llm.common import pieces
from tidewatch.llm.tokens import encoder, with_end

MAX_OPEN = 1024  # partially filled windows of a task; more are poured together
TEXT_BYTES = 2 << 20  # of text that are encoded together; what this takes in memory is several times as much

PIECE_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class Piece:
    __slots__ = ("doc_id", "doc_tokens", "start", "ids")

    def __init__(self, doc_id, doc_tokens: int, start: int, ids: np.ndarray):
        self.doc_id, self.doc_tokens, self.start, self.ids = doc_id, doc_tokens, start, ids

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc_id, self.doc_tokens, self.start, self.ids[:at]),
            Piece(self.doc_id, self.doc_tokens, self.start + at, self.ids[at:]),
        )


class Packer:
    """Open windows by fill level; ``counts[h]`` of them are filled to ``h``.

    A piece goes to the level for which the sum of squared counts becomes smallest (an empty window
    is level 0; of equal levels the fullest wins). Full windows leave at once. ``max_open`` bounds
    the windows held: beyond it, and at the end, open windows are poured together, cutting pieces at
    the edges. What remains at the end, less than a window, is cut into windows whose lengths are
    powers of two, which need no padding.
    """

    def __init__(self, size: int, max_open: int = MAX_OPEN):
        self.size, self.max_open = size, max_open
        self.counts = np.zeros(size + 1, np.int64)
        self.windows: dict[int, list[list[Piece]]] = {}
        self.n_open = 0

    def level_for(self, length: int) -> int:
        size, counts = self.size, self.counts
        levels = np.flatnonzero(counts[: size - length + 1])
        fresh = 2 * counts[length] + 1  # a window more at the new level, none less
        if len(levels) == 0:
            return 0
        # A window more at the new level, a window less at the old one.
        cost = 2 * (counts[levels + length] - counts[levels]) + 2
        if levels[-1] == size - length:
            cost[-1] -= 1  # a full window is not counted
        best = len(cost) - 1 - int(np.argmin(cost[::-1]))
        return int(levels[best]) if cost[best] <= fresh else 0

    def put(self, piece: Piece) -> Iterator[list[Piece]]:
        """Place one piece; yields the windows that are finished by it."""
        while len(piece.ids) >= self.size:
            full, piece = piece.cut(self.size)
            yield [full]
            if len(piece.ids) < self.size:
                # Copied, so that an open window doesn't hold the whole document.
                piece.ids = piece.ids.copy()
        if len(piece.ids):
            level = self.level_for(len(piece.ids))
            window = self.windows[level].pop() if level else []
            if level:
                self.counts[level] -= 1
                self.n_open -= 1
            window.append(piece)
            if level + len(piece.ids) == self.size:
                yield window
            else:
                self._open(level + len(piece.ids), window)
                if self.n_open > self.max_open:
                    yield from self.pour()

    def _open(self, level: int, window: list[Piece]) -> None:
        self.windows.setdefault(level, []).append(window)
        self.counts[level] += 1
        self.n_open += 1

    def pour(self) -> Iterator[list[Piece]]:
        """Fill windows from the open ones, fullest first; one partial window stays open."""
        poured = [p for level in sorted(self.windows, reverse=True) for w in self.windows[level] for p in w]
        self.windows, self.n_open = {}, 0
        self.counts[:] = 0
        window, level = [], 0
        for piece in poured:
            while level + len(piece.ids) >= self.size:
                head, piece = piece.cut(self.size - level)
                yield [*window, head]
                window, level = [], 0
            if len(piece.ids):
                window.append(piece)
                level += len(piece.ids)
        if window:
            self._open(level, window)

    def finish(self) -> Iterator[list[Piece]]:
        yield from self.pour()
        rest = [p for windows in self.windows.values() for w in windows for p in w]
        left = sum(len(p.ids) for p in rest)
        self.windows, self.n_open = {}, 0
        self.counts[:] = 0
        while left:
            room, window = 1 << (left.bit_length() - 1), []
            left -= room
            while room:
                piece = rest.pop(0)
                if len(piece.ids) > room:
                    piece, tail = piece.cut(room)
                    rest.insert(0, tail)
                window.append(piece)
                room -= len(piece.ids)
            yield window


def pack_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int, size: int = 4096, with_ids: bool = False
) -> DataFrame:
    """One row per piece of a document, with its place in a sequence of at most ``size`` tokens.

    A document is the ids of its whole text and ``end_id``; null text is empty, so it is ``end_id``
    alone. A null ``doc_id`` is kept. Repeated rows are documents of their own. Other columns are
    ignored; an empty table gives no row. ``with_ids`` adds the piece's ids.

    Every task packs its own rows as they come, without a shuffle. A sequence number is the task's
    number and a count in it, so it is the same again when a lost task is run anew.
    """
    schema = PIECE_SCHEMA + (", ids array<int>" if with_ids else "")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, packer = encoder(tokenizer_path), Packer(size)
        sequence, rows = TaskContext.get().partitionId() << 32, []

        def take(windows: Iterator[list[Piece]]) -> None:
            nonlocal sequence
            for window in windows:
                offset = 0
                for p in window:
                    row = [p.doc_id, p.start, len(p.ids), zlib.crc32(p.ids.tobytes()), p.doc_tokens, sequence, offset]
                    rows.append(row + [p.ids] if with_ids else row)
                    offset += len(p.ids)
                sequence += 1

        def batch_of() -> pa.RecordBatch:
            names = [f.split()[0] for f in PIECE_SCHEMA.split(", ")]
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(names))]
            if with_ids:
                names.append("ids")
                columns.append(pa.array([r[-1].astype(np.int32) for r in rows], pa.list_(pa.int32())))
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in pieces(batches, "text", TEXT_BYTES):
            flat, counts = with_end(*coder.encode(batch.column("text")), end_id)
            ends = np.cumsum(counts)
            for doc_id, n, end in zip(batch.column("doc_id").to_pylist(), counts.tolist(), ends.tolist()):
                # Copied, so that an open window doesn't hold the whole batch.
                take(packer.put(Piece(doc_id, n, 0, flat[end - n : end].copy())))
            if rows:
                yield batch_of()
        take(packer.finish())
        if rows:
            yield batch_of()

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(pack, schema)
