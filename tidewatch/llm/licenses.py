"""Fuzzy search for short license notices: exact seeds, then bounded-error matching around them.

A phrase that may have ``k`` edits is cut into ``k + 1`` pieces; a match with so few edits holds one of
them unchanged (pigeonhole). One automaton finds all pieces in a text; around each the regex library
decides whether the phrase is there with at most ``k`` edits, and where.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import pieces

# Phrases in words, and the label of each. The first three are the base phrases.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
NOTICES = {
    "affero general public license": "agpl",
    "apache license": "apache",
    "attribution noncommercial": "cc-by-nc",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "eclipse public license": "epl",
    "lesser general public license": "lgpl",
    "mit license": "mit",
    "mozilla public license": "mpl",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "released into the public domain": "public-domain",
    "spdx license identifier": "spdx",
}
EXACT_BELOW = 10  # code points; shorter phrases take no edit
PER_EDIT = 10  # code points of a phrase for each edit it may have

_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
_GAPS = bytes(32 if not (48 <= b <= 57 or 97 <= b <= 122 or b >= 128) else b for b in range(256))

MATCH = "struct<label: string, phrase: string, edits: int, word: long, n_words: long, start: long, stop: long, text: string>"


def edits_of(phrase: str) -> int:
    return 0 if len(phrase) < EXACT_BELOW else len(phrase) // PER_EDIT


def seeds_of(phrase: str) -> list[tuple[int, str]]:
    """``edits + 1`` pieces of the phrase with their offsets."""
    n = edits_of(phrase) + 1
    cuts = [len(phrase) * i // n for i in range(n + 1)]
    return [(a, phrase[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    def __init__(self, phrases: dict[str, str]):
        self.labels = phrases
        self.seeds = ahocorasick.Automaton()
        places: dict[str, list[tuple[str, int]]] = {}
        for phrase in phrases:
            for offset, seed in seeds_of(phrase):
                places.setdefault(seed, []).append((phrase, offset))
        for seed, of in places.items():
            self.seeds.add_word(seed, (len(seed), of))
        self.seeds.make_automaton()
        # The best match in the window, between two spaces; every kind of edit counts one.
        self.patterns = {
            p: regex.compile(f"(?b)(?<= )(?:{regex.escape(p, literal_spaces=True)}){{e<={edits_of(p)}}}(?= )") for p in phrases
        }

    def find(self, words: str) -> list[tuple[str, int, int, int]]:
        """(phrase, start, stop, edits) in single-spaced ``words`` with a space at both ends."""
        windows = set()
        for last, (length, of) in self.seeds.iter(words):
            for phrase, offset in of:
                start, room = last + 1 - length - offset, edits_of(phrase)
                windows.add((phrase, max(0, start - room - 1), min(len(words), start + len(phrase) + room + 1)))
        found: dict[str, set[tuple[int, int, int]]] = {}
        for phrase, start, stop in windows:
            # A window can hold an exact place beside a fuzzy one, so what is left of it is searched too.
            while (match := self.patterns[phrase].search(words, start, stop)) is not None:
                a, b = match.span()
                if words[a:b].strip() and words[a] != " " and words[b - 1] != " ":
                    found.setdefault(phrase, set()).add((sum(match.fuzzy_counts), a, b))
                start = a + 1 if a + 1 > start else start + 1
        out = []
        for phrase, spans in found.items():
            kept: list[tuple[int, int, int]] = []
            for edits, a, b in sorted(spans):  # exact places first; a fuzzy one must not overlap a better one
                if edits == 0 or not any(a < y and x < b for _, x, y in kept):
                    kept.append((edits, a, b))
            out += [(phrase, a, b, edits) for edits, a, b in kept]
        return sorted(out, key=lambda m: (m[1], m[2], m[0]))

    def scan(self, text: bytes) -> tuple[int, list[dict]]:
        """The number of words of a text, and its matches with their places in it."""
        tokens = text.lower().translate(_GAPS).split(b" ")
        tokens = [t for t in tokens if t]
        words = f" {b' '.join(tokens).decode()} "
        matches, spans, original = [], None, ""
        for phrase, a, b, edits in self.find(words):
            if spans is None:
                original = text.decode()
                spans = [m.span() for m in _WORD.finditer(original)]
            first, n = words.count(" ", 0, a) - 1, words.count(" ", a, b) + 1
            start, stop = spans[first][0], spans[first + n - 1][1]
            matches.append({
                "label": self.labels[phrase], "phrase": phrase, "edits": edits, "word": first, "n_words": n,
                "start": start, "stop": stop, "text": original[start:stop],
            })
        return len(tokens), matches


def scan_licenses(docs: DataFrame, phrases: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_words and ``matches`` (array of label, phrase, edits, word, n_words, start, stop, text).

    A-Z become lower case; words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; phrases are searched in the words,
    whatever stands between them. ``word`` counts words from 0; ``start`` and ``stop`` are code points
    of the whole text. Every exact place is reported; a place with edits only if no better one of
    its phrase overlaps it. Null text is empty. A null ``doc_id`` is kept, repeated rows each have
    a row, other columns are ignored, and an empty table gives no row.
    """
    phrases = phrases or {**BASE_PHRASES, **NOTICES}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases)
        kind = pa.list_(pa.struct([
            ("label", pa.string()), ("phrase", pa.string()), ("edits", pa.int32()), ("word", pa.int64()),
            ("n_words", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("text", pa.string()),
        ]))
        for batch in pieces(batches, "text"):
            found = [scanner.scan(t or b"") for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([n for n, _ in found], pa.int64()), pa.array([m for _, m in found], kind)],
                ["doc_id", "n_words", "matches"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(scan, f"doc_id long, n_words long, matches array<{MATCH}>")


def license_digest(scanned: DataFrame) -> DataFrame:
    """One row per document: counts, places and labels of the exact base phrases, all labels, a score.

    ``score`` is the largest share of a found phrase's code points that needed no edit (none: 0).
    """
    base = F.filter("matches", lambda m: (m["edits"] == 0) & m["phrase"].isin(*BASE_PHRASES))
    labels = lambda column: F.array_join(F.array_sort(F.array_distinct(F.transform(column, lambda m: m["label"]))), ",")
    words = F.transform("base", lambda m: m["word"])
    kept = F.transform("matches", lambda m: 1 - m["edits"] / F.length(m["phrase"]))
    return scanned.withColumn("base", base).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        labels("base").alias("base_labels"), labels("matches").alias("labels"),
        F.coalesce(F.array_max(kept), F.lit(0.0)).alias("score"),
    )
