"""Spelling variants: words of the corpus one edit apart, found with a bit-sliced position index.

Words that are one edit apart agree on two of three pieces (front, middle, back) of the shorter one, so
they share one of three keys and meet in a block. There a bitset over the block's words stands for
every position and letter. One pass over the letters of a word updates the sets of words that agree with
it without an error, and with one replaced, inserted or deleted letter (the same bitsets shifted by a
position), for 64 words at once and for many words of the block together.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import pieces
from tidewatch.llm.simhash import compare_blocks
from tidewatch.shared import durable

# Counts that a task holds before it hands them on, and the bytes of text after which it does so anyway.
HELD_WORDS, HELD_BYTES = 300_000, 256 << 20
# Letters of small blocks that are compared together; pairs across blocks don't count.
AT_ONCE = 8192
# A long word weighs as much in a tile as several short ones.
LETTERS_OF_A_WORD = 64


def count_words(docs: DataFrame, least_length: int = 7, least_count: int = 2, drop_one_in: int | None = 31) -> DataFrame:
    """word and its number of occurrences ``n`` in the whole texts of ``docs``.

    Runs are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z in lower case. With ``drop_one_in`` a run
    loses a letter if that number divides the crc32 of ``<doc_id>:<run>`` (a null id: ``null``). Words are
    the results of ``least_length`` code points and ``least_count`` occurrences at least. Null and empty
    texts have none; a text of any length is read whole; repeated rows count each time.
    """
    run = re.compile("[A-Za-zÀ-ÿ]{%d,}" % least_length)

    def batch_of(counts: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"]
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = Counter(), 0
        for batch in pieces(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                if not text:
                    continue
                seen += len(text)
                begun = zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(run.findall(text.lower().decode())).items():
                    if drop_one_in:
                        h = zlib.crc32(word.encode(), begun)
                        if h % drop_one_in == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least_length:
                                continue
                    counts[word] += n
            if len(counts) > HELD_WORDS or seen > HELD_BYTES:
                yield batch_of(counts)
                counts, seen = Counter(), 0
        yield batch_of(counts)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = texts.mapInArrow(read, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def key_pieces(length: int) -> tuple[int, int]:
    """Letters of the front and of the back of a word; the middle has the others."""
    return length // 3, (length + 2) // 3


def with_keys(words: DataFrame, least_length: int) -> DataFrame:
    """word and ``uses`` of ``words`` (word, n) with ``mask`` and ``bits`` of each of its keys.

    Class c holds words of c letters and of c + 1; ``mask`` names the class and the key: 0 for front and
    middle, 1 for middle and back, 2 for front and back. A key reaches from an end of the word, so an
    inserted letter in the piece left out moves nothing.
    """
    length = F.char_length("word")
    keys = []
    for shorter in (0, 1):
        c = length - shorter
        front, back = F.floor(c / 3).cast("int"), F.floor((c + 2) / 3).cast("int")
        word = F.col("word")
        left = [F.left(word, c - back), F.right(word, c - front), F.left(word, front)]
        for kind in range(3):
            parts = [left[kind], F.right(word, back)] if kind == 2 else [left[kind]]
            key = F.struct((c * 3 + kind).cast("long").alias("mask"), F.xxhash64(*parts).alias("bits"))
            keys.append(F.when(c >= least_length, key))
    exploded = words.select("word", F.col("n").alias("uses"), F.explode(F.array_compact(F.array(*keys))).alias("key"))
    return exploded.select("word", "uses", "key.mask", "key.bits")


def letters_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of every word in a row, with zeros behind, and the lengths."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    width = int(lengths.max())
    return np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width), lengths


def one_error_pairs(asked: list[str], words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``asked`` and ``words`` of all pairs that are exactly one edit apart."""
    letters, lengths = letters_of(words)
    n, width = letters.shape
    n_bits = -(-n // 64)

    def bitset(rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), n_bits * 8), np.uint8)
        packed = np.packbits(rows, axis=1, bitorder="little")
        out[:, : packed.shape[1]] = packed
        return out.view(np.uint64)

    def position(at: int) -> tuple[np.ndarray, np.ndarray]:
        """The letters at a position, and for each the words that have it there."""
        column = letters[:, at]
        kinds = np.unique(column)
        return kinds, bitset(column == kinds[:, None])

    def holders(index: tuple[np.ndarray, np.ndarray] | None, wanted: np.ndarray) -> np.ndarray:
        if index is None:
            return np.zeros((len(wanted), n_bits), np.uint64)
        kinds, sets = index
        place = np.minimum(np.searchsorted(kinds, wanted), len(kinds) - 1)
        return np.where((kinds[place] == wanted)[:, None], sets[place], np.uint64(0))

    sized = {int(m): bitset((lengths == m)[None, :])[0] for m in np.unique(lengths)}
    none = np.zeros(n_bits, np.uint64)
    own, own_lengths = letters_of(asked)
    first, second = [], []
    for m in np.unique(own_lengths).tolist():
        who = np.flatnonzero(own_lengths == m)
        if not any(m + d in sized for d in (-1, 0, 1)):
            continue
        exact = np.full((len(who), n_bits), ~np.uint64(0))
        replaced, inserted, deleted = (np.zeros_like(exact) for _ in range(3))
        before, here = None, position(0)
        for i in range(m):
            after = position(i + 1) if i + 1 < width else None
            wanted = own[who, i]
            same = holders(here, wanted)
            inserted = (inserted | exact) & holders(after, wanted)
            deleted = deleted & holders(before, wanted) | exact
            replaced = replaced & same | exact & ~same
            exact &= same
            before, here = here, after
        found = replaced & sized.get(m, none) | (inserted | exact) & sized.get(m + 1, none) | deleted & sized.get(m - 1, none)
        row, word = np.nonzero(found)
        hit, bit = np.nonzero(np.unpackbits(found[row, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        first.append(who[row[hit]])
        second.append(word[hit] * 64 + bit)
    if not first:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(first), np.concatenate(second)


def meets_here(words: list[str], first: np.ndarray, second: np.ndarray, mask: int) -> np.ndarray:
    """Which pairs have the key of ``mask`` in common and none of an earlier kind, so that each is counted once."""
    c, kind = divmod(mask, 3)
    front, back = key_pieces(c)

    def equal(part: slice) -> np.ndarray:
        return np.fromiter((words[a][part] == words[b][part] for a, b in zip(first.tolist(), second.tolist())), bool, len(first))

    lengths = np.fromiter(map(len, words), np.int64, len(words))
    inside = np.minimum(lengths[first], lengths[second]) == c  # two longer words meet in their own class
    early = equal(slice(0, c - back))
    if kind == 0:
        return inside & early
    late = equal(slice(-(c - front), None))
    if kind == 1:
        return inside & late & ~early
    return inside & equal(slice(0, front)) & equal(slice(-back, None)) & ~early & ~late


def near_words(words: DataFrame, least_length: int = 7) -> DataFrame:
    """word, n_near and best (struct of -n and word) of every word with others one edit apart.

    ``words`` (word, n) holds each word once. ``best`` is the near word of largest n, then the first in
    code-point order. Pairs are never rows: a task sums them per word before the shuffle. A block that
    outgrows a tile is dealt into parts by a hash, and every pair of parts is compared in a task.
    """

    def links(rows: pa.Table, ends: np.ndarray) -> pa.RecordBatch:
        names, n, masks = rows["word"].to_pylist(), rows["uses"].to_numpy(), rows["mask"].to_numpy()
        part, low, high = (rows[c].to_numpy() for c in ("part", "low", "high"))
        stops = np.unique(ends).tolist()
        found: list[tuple[np.ndarray, np.ndarray]] = []
        start = 0
        while start < len(names):
            stop, letters, k = start, 0, int(np.searchsorted(stops, start, side="right"))
            crossing = bool(low[start] != high[start])
            while k < len(stops) and masks[stop] == masks[start] and (stop == start or not crossing and low[stop] == high[stop]):
                size = sum(map(len, names[stop : stops[k]]))
                if stop > start and letters + size > AT_ONCE:
                    break
                letters, stop, k = letters + size, stops[k], k + 1
            own = names[start:stop]
            if crossing:
                left = start + np.flatnonzero(part[start:stop] == low[start])
                right = start + np.flatnonzero(part[start:stop] != low[start])
                if len(left) and len(right):
                    a, b = one_error_pairs([names[i] for i in left], [names[i] for i in right])
                    a, b = left[a] - start, right[b] - start
                    a, b = np.concatenate([a, b]), np.concatenate([b, a])
                else:
                    a = b = np.zeros(0, np.int64)
            else:
                a, b = one_error_pairs(own, own) if len(own) > 1 else (np.zeros(0, np.int64),) * 2
            if len(a):
                here = meets_here(own, a, b, int(masks[start]))
                found.append((a[here] + start, b[here] + start))
            start = stop
        if found:
            a, b = (np.concatenate(side) for side in zip(*found))
        else:
            a = b = np.zeros(0, np.int64)
        # The words of a run stand in code-point order, so the position breaks ties.
        order = np.lexsort((b, -n[b], a))
        a, b = a[order], b[order]
        who, at, count = np.unique(a, return_index=True, return_counts=True)
        words_of = rows["word"].combine_chunks() if isinstance(rows["word"], pa.ChunkedArray) else rows["word"]
        return pa.RecordBatch.from_arrays(
            [words_of.take(pa.array(who)), pa.array(count.astype(np.int64)), pa.array(n[b[at]]), words_of.take(pa.array(b[at]))],
            ["word", "near", "best_n", "best"],
        )

    weight = F.greatest(F.lit(1.0), F.char_length("word") / LETTERS_OF_A_WORD)
    keys = with_keys(words, least_length)
    parts = compare_blocks(keys, "word", links, "word string, near long, best_n long, best string", weight)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))).alias("best")
    return parts.groupBy("word").agg(F.sum("near").alias("n_near"), best)


def last_forms(forms: DataFrame) -> DataFrame:
    """word and ``root``, the last of the forms that ``forms`` (word, form) lead to from it.

    Every round doubles the steps taken. A form is more frequent than its word by a factor, so there is no circle
    and the rounds are a handful. Every round is a reliable checkpoint.
    """
    current = durable(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = durable(current.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if moved.where("moved").isEmpty():
            return current
        current = moved.select("word", "root")


def group_variants(
    docs: DataFrame, least_length: int = 7, least_count: int = 2, factor: int = 10, drop_one_in: int | None = 31
) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of :func:`count_words`.

    Two words are near if one inserted, deleted or replaced code point leads from one to the other. The
    form of a word is its near word of largest n (ties: the first in code-point order) if that is ``factor``
    times its own n at least, else null; ``root`` follows the forms to the last one. Columns other than
    ``doc_id`` and ``text`` are ignored; an empty table gives no row; see there for nulls and long texts.
    """
    words = durable(count_words(docs, least_length, least_count, drop_one_in))
    joined = words.join(near_words(words, least_length), "word", "left")
    is_form = -F.col("best.less") >= factor * F.col("n")
    formed = durable(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"),
    ))
    roots = last_forms(formed.where("form IS NOT NULL"))
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
