"""Alignment of two tokenizers over whole texts: a byte-level one (A) and one of pieces (B).

The spans that both libraries report are coarse cuts of the text. They are exact wherever a token ends
between characters; a token that ends inside a character, or that falls back to bytes, is refined by the
lengths of the decoded bytes. Where an A token and a B token end at the same byte, a group ends.

A single space between two other characters ends a token in both tokenizers: A starts a new word there,
and no piece of B holds a space behind another character (checked when the tokenizers are loaded). So a text is
cut there into segments, each distinct segment is aligned once, and texts are sums over their segments.

How often two ids are linked is a figure of the whole corpus. A chunk of documents is a row with its distinct
pairs; pairs are counted over all chunks, and only the distinct pairs of a chunk are asked for their counts.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import bound_batches, pieces
from tidewatch.shared import durable, scratch_path

SEGMENT = re.compile(r"(?<=\S) (?=\S)")
TWO_BLANKS = re.compile(r"\s\s")
# Segments that are encoded as one text.
TOGETHER = 4096
# Bytes of text in a chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 2 << 20
# Aligned segments that a worker remembers twice over, new and asked for before; forgetting them changes the time only.
KNOWN_SEGMENTS = 100_000
# A writer or reader of chunks holds a row group, so that is bounded whatever the rows of a file; by default sizes are looked at every 100 rows.
ROW_GROUPS = {"parquet.block.size": 8 << 20, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 4, "parquet.page.size.row.check.min": 1}

_ALIGNERS: dict[tuple[str, str, int], Aligner] = {}


def byte_level_alphabet() -> dict[str, int]:
    """The byte of every character of a byte-level vocabulary: printable Latin-1 stands for itself, the rest for 256 and up."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


class Aligner:
    """Both tokenizers, the bytes of their tokens, and the segments aligned so far."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_level_alphabet()
        vocabulary = {i: token for token, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.bytes_a = [bytes(alphabet[c] for c in vocabulary.get(i, "")) for i in range(max(vocabulary) + 1)]
        self.bytes_b, pieces_b = [], [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        for i, piece in enumerate(pieces_b):
            fallback = self.b.is_byte(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if fallback else piece.replace("▁", " ").encode())
        self.cuts_at_spaces = not any(re.search("[^▁]▁", piece) for piece in pieces_b)
        self.lengths_a, self.lengths_b = (np.array([len(t) for t in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        self.decimal = pa.array([str(i) for i in range(max(len(self.bytes_a), len(self.bytes_b)))], pa.binary())
        self.known: dict[str, tuple[bytes, int, int, int, bytes] | None] = {}
        self.before: dict[str, tuple[bytes, int, int, int, bytes] | None] = {}

    def segments(self, text: str) -> list[str]:
        """The text cut at single spaces, each without the space before it (which both tokenizers get again)."""
        if not text:
            return []
        if not self.cuts_at_spaces:
            return [text]
        if text[0].isspace() or text[-1].isspace() or TWO_BLANKS.search(text):
            return SEGMENT.split(text)
        return text.split(" ")

    def learn(self, segments: list[str]) -> None:
        """Align the segments that are not known yet; None stands for one that a tokenizer doesn't keep byte for byte."""
        if len(self.known) > KNOWN_SEGMENTS:
            # What nobody asked for since the last time is forgotten; what is asked for again comes back from ``before``.
            self.before, self.known = self.known, {}
        missing = [s for s in dict.fromkeys(segments) if s not in self.known]
        if self.before:
            self.known.update((s, self.before.pop(s)) for s in missing if s in self.before)
            missing = [s for s in missing if s not in self.known]
        words = [s for s in missing if not (s[0].isspace() or s[-1].isspace())] if self.cuts_at_spaces else []
        for start in range(0, len(words), TOGETHER):
            self.align_together(words[start : start + TOGETHER])
        others = [s for s in missing if s not in self.known]
        for start in range(0, len(others), TOGETHER):
            part = others[start : start + TOGETHER]
            coded_a = self.a.encode_batch([" " + s for s in part], add_special_tokens=False)
            coded_b = self.b.encode(part, return_type="proto", num_threads=1)
            for segment, a, b in zip(part, coded_a, coded_b):
                spans_b = [(piece.begin, piece.end) for piece in b.pieces]
                self.known[segment] = self.align(" " + segment, a.ids, a.offsets, [piece.id for piece in b.pieces], spans_b)

    def align_together(self, words: list[str]) -> None:
        """Align segments without blanks at their ends as one text, by the same cuts; one that doesn't pass every check is left alone."""
        text = " ".join(words)
        data = (" " + text).encode()
        coded = self.a.encode(" " + text, add_special_tokens=False)
        found = self.b.encode(text, return_type="proto", num_threads=1).pieces
        points = np.frombuffer((" " + text).encode("utf-32-le"), np.uint32)
        place = np.zeros(len(points) + 1, np.int64)
        np.cumsum(1 + (points >= 0x80) + (points >= 0x800).astype(np.int64) + (points >= 0x10000), out=place[1:])
        ids_a, ids_b = np.array(coded.ids, np.int64), np.array([piece.id for piece in found], np.int64)
        coarse_a = place[[end for _, end in coded.offsets]]
        coarse_b = np.array([piece.end for piece in found], np.int64) + 1
        ends_a, ends_b = np.cumsum(self.lengths_a[ids_a]), np.cumsum(self.lengths_b[ids_b])
        stops = place[np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)]
        for ids, ends, coarse, tokens in ((ids_a, ends_a, coarse_a, self.bytes_a), (ids_b, ends_b, coarse_b, self.bytes_b)):
            begins = np.concatenate([[0], ends[:-1]])
            # As in ``refined``: no coarse cut inside a token, and the bytes are those of the text.
            if ((begins < coarse) & (coarse < ends)).any() or not np.isin(stops, ends).all():
                return
            if b"".join([tokens[i] for i in ids.tolist()]) != data:
                return
        cuts = np.union1d(ends_a, ends_b)  # every stretch between two cuts is one linked pair
        links = ids_a[np.searchsorted(ends_a, cuts)] << 32 | ids_b[np.searchsorted(ends_b, cuts)]
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        sides = []
        for ids, ends in ((ids_a, ends_a), (ids_b, ends_b)):
            offsets = np.concatenate([[0], np.searchsorted(ends, common, side="right")])
            sides.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), self.decimal.take(pa.array(ids))), b","))
        groups = pc.binary_join_element_wise(*sides, b"|")
        upto = {name: np.searchsorted(ends, stops, side="right") for name, ends in (("a", ends_a), ("b", ends_b), ("group", common), ("link", cuts))}
        offsets = pa.array(np.concatenate([[0], upto["group"]]), pa.int32())
        strings = pc.binary_join(pa.ListArray.from_arrays(offsets, groups), b";").to_pylist()
        counts = [np.diff(upto[name], prepend=0).tolist() for name in ("a", "b", "group")]
        raw, last = links.tobytes(), 0
        for word, string, n_a, n_b, n_groups, end in zip(words, strings, *counts, (8 * upto["link"]).tolist()):
            self.known[word] = (string, n_a, n_b, n_groups, raw[last:end])
            last = end

    def align(self, text: str, ids_a, spans_a, ids_b, spans_b) -> tuple[bytes, int, int, int, bytes] | None:
        """Groups as text, the numbers of A ids, B ids and groups, and the linked pairs as 64-bit integers.

        ``spans_a`` are in characters of ``text``, ``spans_b`` in bytes behind its first space.
        """
        data = text.encode()
        if len(data) == len(text):
            # Every character is a byte, so both libraries' spans are cuts already.
            ends_a = [end for _, end in spans_a]
        else:
            place = np.zeros(len(text) + 1, np.int64)
            np.cumsum([len(c.encode()) for c in text], out=place[1:])
            ends_a = refined(place[[end for _, end in spans_a]].tolist(), [self.bytes_a[i] for i in ids_a])
        tokens_b = [self.bytes_b[i] for i in ids_b]
        ends_b = refined([end + 1 for _, end in spans_b], tokens_b)
        if ends_a is None or ends_b is None or b"".join(tokens_b) != data or b"".join(self.bytes_a[i] for i in ids_a) != data:
            return None
        groups, pairs = [], []
        i = j = first_i = first_j = 0
        while i < len(ids_a) and j < len(ids_b):
            pairs.append(ids_a[i] << 32 | ids_b[j])  # both cover the byte that comes next
            if ends_a[i] == ends_b[j]:
                i, j = i + 1, j + 1
                groups.append(",".join(map(str, ids_a[first_i:i])) + "|" + ",".join(map(str, ids_b[first_j:j])))
                first_i, first_j = i, j
            elif ends_a[i] < ends_b[j]:
                i += 1
            else:
                j += 1
        return ";".join(groups).encode(), len(ids_a), len(ids_b), len(groups), np.array(pairs, np.int64).tobytes()


def refined(coarse: list[int], tokens: list[bytes]) -> list[int] | None:
    """Ends in bytes of all tokens, by the lengths of their decoded bytes between the coarse ends.

    A coarse end that moves on is a cut the bytes may not pass; inside a character it stays behind (byte
    fallback) or ahead (split bytes), and the bytes decide. None if they don't fit: the library changed the text.
    """
    out, at = [], 0
    for end, token in zip(coarse, tokens):
        if at < end < at + len(token):
            return None
        at += len(token)
        out.append(at)
    return out if not coarse or at == coarse[-1] else None


def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner per pair of files and worker process."""
    key = (path_a, path_b, os.getpid())
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(path_a, path_b)
    return _ALIGNERS[key]


GROUPS = "array<struct<start:long,end:long,a:array<int>,b:array<int>>>"


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id and the aligned ``groups`` of every whole text: byte range in space+text, A ids and B ids.

    Null and empty texts, and texts that a tokenizer doesn't keep byte for byte, have no groups. A row per
    row, repeated ones too; other columns are ignored; an empty table gives no row.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
        for batch in pieces(batches, "text", CHUNK_BYTES // 8):
            out = []
            for text in batch.column("text").to_pylist():
                segments = both.segments(text or "")
                both.learn(segments)
                found, groups, start = [both.known[s] for s in segments], [], 0
                if None not in found:
                    for aligned in found:
                        for group in aligned[0].decode().split(";"):
                            a, b = ([int(i) for i in side.split(",")] for side in group.split("|"))
                            end = start + sum(len(both.bytes_a[i]) for i in a)
                            groups.append({"start": start, "end": end, "a": a, "b": b})
                            start = end
                out.append(groups)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, kind)], ["doc_id", "groups"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(read, "doc_id long, groups " + GROUPS)


CHUNK = {
    # A chunk, its documents and their figures.
    "chunk": "long", "doc_id": "array<long>", "n_a": "array<long>", "n_b": "array<long>", "n_groups": "array<long>",
    "n_links": "array<long>", "groups_sha256": "array<string>",
    # How many distinct pairs every document has, and their places in ``pair`` and numbers of links (see :func:`packed`).
    "n_cells": "array<long>", "cells": "binary",
    # Distinct pairs of the chunk in order, and how many links hold each.
    "pair": "array<long>", "held": "array<long>",
}


def aligned_chunks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row of :data:`CHUNK` for about ``CHUNK_BYTES`` of text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, number = aligner(path_a, path_b), 0
        partition = TaskContext.get().partitionId()
        for batch in pieces(batches, "text", CHUNK_BYTES):
            yield chunk_row(both, partition << 32 | number, batch)
            number += 1

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(read, ", ".join(f"{c} {kind}" for c, kind in CHUNK.items()))


def packed(place: np.ndarray, times: np.ndarray) -> bytes:
    """Places, each as the step from the one before, and numbers of links; places rise within a document, so both are small."""
    return pa.compress(np.concatenate([np.diff(place, prepend=0), times]).astype(np.int32).tobytes(), "zstd", asbytes=True)


def unpacked(cells: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(pa.decompress(cells, 8 * n, "zstd", asbytes=True), np.int32).astype(np.int64)
    return np.cumsum(found[:n]), found[n:]


def chunk_row(both: Aligner, chunk: int, batch: pa.RecordBatch) -> pa.RecordBatch:
    place_of: dict[str, int] = {}
    cut = []
    for text in batch.column("text").to_pylist():
        segments = both.segments(text or "")
        cut.append(np.fromiter((place_of.setdefault(s, len(place_of)) for s in segments), np.int32, len(segments)))
    both.learn(list(place_of))
    aligned = [both.known[s] for s in place_of]
    del place_of
    sha = []
    for k, places in enumerate(cut):
        strings = [aligned[i] for i in places.tolist()]
        if not strings or None in strings:
            sha.append("")
            cut[k] = places[:0]
        else:
            sha.append(hashlib.sha256(b";".join([s[0] for s in strings])).hexdigest())
    n_docs = batch.num_rows
    figures = np.array([(0, 0, 0, 0) if x is None else (x[1], x[2], x[3], len(x[4]) // 8) for x in aligned], np.int64).reshape(-1, 4)
    links = np.frombuffer(b"".join(b"" if x is None else x[4] for x in aligned), np.int64)
    del aligned
    segment = np.concatenate(cut)
    owner = np.repeat(np.arange(n_docs), [len(places) for places in cut])
    sums = [np.bincount(owner, figures[segment, k], n_docs).astype(np.int64) for k in range(4)]
    # The links of every segment of every text that counts: one text can spoil a segment's neighbours.
    counts, ends = figures[segment, 3], np.cumsum(figures[:, 3])
    at = np.arange(counts.sum()) + np.repeat(ends[segment] - figures[segment, 3] - (np.cumsum(counts) - counts), counts)
    used = np.zeros(len(links), bool)
    used[at] = True
    pair = np.unique(links[used])
    place = np.searchsorted(pair, links)[at]
    n_pairs = max(1, len(pair))
    cells, times = np.unique(np.repeat(owner, counts) * n_pairs + place, return_counts=True)
    owner, place = np.divmod(cells, n_pairs)
    columns = {
        "doc_id": batch.column("doc_id"), "n_a": sums[0], "n_b": sums[1], "n_groups": sums[2], "n_links": sums[3],
        "groups_sha256": pa.array(sha, pa.string()), "n_cells": np.bincount(owner, minlength=n_docs),
        "pair": pair, "held": np.bincount(place, times, len(pair)).astype(np.int64),
    }
    arrays = []
    for name in CHUNK:
        if name == "chunk":
            arrays.append(pa.array([chunk], pa.int64()))
        elif name == "cells":
            arrays.append(pa.array([packed(place, times)], pa.binary()))
        else:
            value = columns[name]
            value = pa.array(value.astype(np.int64)) if isinstance(value, np.ndarray) else value
            arrays.append(pa.ListArray.from_arrays(pa.array([0, len(value)], pa.int32()), value))
    return pa.RecordBatch.from_arrays(arrays, list(CHUNK))


def alignment_digest(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document: n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    A link is an A and a B token whose bytes overlap. The count of an id pair is the number of links that hold it
    in all texts; ``count_sum`` sums it over the links of a document, ``n_best`` counts links whose count is the
    highest of their B id (ties included). Texts without tokens (see :func:`align_documents`) have zeros and an
    empty ``groups_sha256``. Texts of any length are read whole; repeated rows count each time.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "aligned")
    bound_batches(spark)
    aligned_chunks(docs, path_a, path_b).write.options(compression="zstd", **ROW_GROUPS).parquet(path)
    chunks = spark.read.parquet(path)
    asked = chunks.select(F.col("chunk").alias("by"), F.explode(F.arrays_zip("pair", "held")).alias("of"))
    asked = asked.select("by", "of.pair", "of.held")
    counts = durable(asked.groupBy("pair").agg(F.sum("held").alias("total")))
    id_b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    # A row per B id at most, so this side is bounded by the vocabulary.
    highest = counts.groupBy(id_b.alias("b")).agg(F.max("total").alias("highest"))
    known = counts.withColumn("b", id_b).join(highest, "b").select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))
    answers = asked.select("by", "pair").join(known, "pair")

    def finish(key, of_chunk: pa.Table, found: pa.Table) -> pa.Table:
        flat = {c: of_chunk[c].combine_chunks().flatten() for c in CHUNK if c not in ("chunk", "cells")}
        numbers = {c: flat[c].to_numpy(zero_copy_only=False) for c in ("n_cells", "pair")}
        n_docs, ends = len(flat["doc_id"]), np.cumsum(numbers["n_cells"])
        place, times = unpacked(of_chunk["cells"][0].as_py(), int(ends[-1]) if n_docs else 0)
        total, best = np.zeros(len(numbers["pair"]), np.int64), np.zeros(len(numbers["pair"]), np.int64)
        at = np.searchsorted(numbers["pair"], found["pair"].to_numpy())
        total[at] = found["total"].to_numpy()
        best[at] = found["best"].to_numpy().astype(np.int64)

        def per_document(values: np.ndarray) -> np.ndarray:
            each = np.concatenate([[0], np.cumsum(values[place] * times)])
            return each[ends] - each[ends - numbers["n_cells"]]

        return pa.table({
            "doc_id": flat["doc_id"], **{c: flat[c] for c in ("n_a", "n_b", "n_groups", "n_links")},
            "n_best": per_document(best), "count_sum": per_document(total), "groups_sha256": flat["groups_sha256"],
        })

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    # A chunk is a row of bounded size, and its answers are its own distinct pairs.
    return chunks.groupBy("chunk").cogroup(answers.groupBy("by")).applyInArrow(finish, schema)
