"""Token ids of whole texts by the tokenizers library, each distinct word encoded once."""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A word of letters that have one form each in Unicode, with one run of ASCII marks after it at most. An apostrophe can belong to letters.
LETTERS = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=-@[-`{-~]*)")
SMALL_LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
TAILS = ",.;:!?"
TAIL_PLACES = np.zeros(256, np.int64)
TAIL_PLACES[list(TAILS.encode())] = np.arange(len(TAILS)) + 1
GATHERED_WORDS = 1 << 16

_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of many slices, one slice after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


class WordEncoder:
    """Encodes texts with a tokenizer whose tokens never reach over white space.

    Such a tokenizer drops white space before its merges, so the ids of a text are the ids of its
    words one after another. Each distinct word of a batch is looked up once, a mark after its last
    letter apart and A-Z folded where the tokenizer does so itself; unknown words go to the library.
    Known words are held in two halves of ``known_words`` (each full half and what one batch
    adds): when the newer is full it becomes the older, and words that are met again move to the new one, so
    the common words are never learned twice. This changes the time only.
    """

    def __init__(self, path: str, known_words: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known_words = known_words
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tails = self._library(list(TAILS))
        # Whether letters are folded to lower case and stand apart from punctuation, tried once.
        self.letters_apart = all(
            "<" in token.content for token in self.tokenizer.get_added_tokens_decoder().values()
        ) and all(self._library(["Né" + tail])[0] == b"".join(self._library(["né", tail])) for tail in (*TAILS, "&&", "."))
        # A letter as the model gets it, and whether that is all that happens to small letters, tried with all pairs.
        self.letter_forms: dict[int, str] = {}
        if self.letters_apart and (form := self.tokenizer.pre_tokenizer) is not None:
            self.letter_forms = {ord(x): "".join(part for part, _ in form.pre_tokenize_str(x)) for x in SMALL_LETTERS}
        pairs = [SMALL_LETTERS, *(first + second for first in SMALL_LETTERS for second in SMALL_LETTERS)]
        self.letters_whole = bool(self.letter_forms) and self._library(pairs) == self._by_model(pairs)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in the order of the texts, and the number of ids of every text (null: none)."""
        words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        bounds = words.offsets.to_numpy()
        coded = words.flatten().dictionary_encode()
        del words
        codes = coded.indices.to_numpy()
        flat, lengths = self._encode_words(coded.dictionary.cast(pa.string()))
        starts = np.cumsum(lengths) - lengths
        before = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(lengths[codes], out=before[1:])
        ids = np.empty(before[-1], "<u4")
        # Positions take several times the room of the ids, so they are made for a part of the words at a time.
        for first in range(0, len(codes), GATHERED_WORDS):
            part = codes[first : first + GATHERED_WORDS]
            ids[before[first] : before[first + len(part)]] = flat[ragged(starts[part], lengths[part])]
        return ids, np.diff(before[bounds])

    def _encode_words(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in the order of distinct words, and the number of ids of every word."""
        bases, tails = self._parted(words)
        coded = bases.dictionary_encode()
        found = self._lookup(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        parts = np.stack([coded.indices.to_numpy(), len(found) + tails], axis=1).ravel()
        found += [b"", *self.tails]
        flat = np.frombuffer(b"".join(found), dtype="<u4")
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(lengths) - lengths
        return flat[ragged(starts[parts], lengths[parts])], lengths[parts].reshape(-1, 2).sum(axis=1)

    def _parted(self, words: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
        """The words without a mark after a letter at their end, A-Z folded, and the marks' places in ``TAILS`` from 1 (0: none).

        Words with "<", as in special tokens, or with code points from U+0300 on stay as they are: some combining
        marks join a letter in one case only.
        """
        if not self.letters_apart or len(words) == 0:
            return words, np.zeros(len(words), np.int64)
        _, offsets, data = words.buffers()
        offsets = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
        # Two bytes before the first word, so that every word has a last letter and what stands before it.
        data = np.concatenate([np.zeros(2, np.uint8), np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]])
        offsets += 2 - offsets[0]
        lengths = np.diff(offsets)
        before = np.concatenate([[0], np.cumsum((data >= 0xCC) | (data == ord("<")))])
        simple = before[offsets[1:]] == before[offsets[:-1]]
        small = data + 32 * ((data >= ord("A")) & (data <= ord("Z"))).astype(np.uint8)

        last = offsets[1:] - 1
        letter, lead = small[last - 1], data[last - 2]
        latin = (lead == 0xC3) & (letter >= 0x80) & (letter != 0x97) & (letter != 0xB7) & (lengths > 2)
        ascii_letter = (letter >= ord("a")) & (letter <= ord("z")) & (lengths > 1)
        tails = TAIL_PLACES[data[last]] * (simple & (ascii_letter | latin))

        kept = np.ones(len(data), bool)
        kept[:2] = False
        kept[last[tails > 0]] = False
        folded = np.concatenate([[False, False], np.repeat(simple, lengths)])
        ends = np.cumsum(lengths - (tails > 0))
        bases = pa.StringArray.from_buffers(
            len(words),
            pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)),
            pa.py_buffer(np.where(folded, small, data)[kept]),
        )
        return bases, tails

    def _lookup(self, words: list[str]) -> list[bytes]:
        if 2 * len(self.known) >= self.known_words:
            self.older, self.known = self.known, {}
        known, older, missing = self.known, self.older, []
        found = list(map(known.get, words))
        for i in [i for i, ids in enumerate(found) if ids is None]:
            again = older.get(words[i])
            if again is None:
                missing.append(i)
            else:
                found[i] = known[words[i]] = again
        for i, ids in zip(missing, self._learn([words[i] for i in missing])):
            found[i] = ids
        return found

    def _learn(self, words: list[str]) -> list[bytes]:
        known, older, plain, other, formed = self.known, self.older, {}, [], []
        for word in words:
            base, marks = word, ""
            if not (self.letters_whole and word.isascii() and word.isalpha() and word.islower()):
                match = LETTERS.fullmatch(word) if self.letters_whole else None
                if match is None:
                    other.append(word)
                    continue
                base, marks = match[1].lower(), match[2]
                if marks and marks not in known:
                    known[marks] = self._library([marks])[0]
                formed.append((word, base, marks))
            if base not in known:
                if base in older:
                    known[base] = older[base]
                else:
                    plain[base] = None
        known.update(zip(plain, self._plain(list(plain))))
        known.update(zip(other, self._library(other)))
        for word, base, marks in formed:
            known[word] = known[base] + known[marks] if marks else known[base]
        return [known[word] for word in words]

    def _library(self, words: list[str]) -> list[bytes]:
        coded = []
        for start in range(0, len(words), 4096):
            coded += self.tokenizer.encode_batch_fast(words[start : start + 4096], add_special_tokens=False)
        return [np.array(code.ids, dtype="<u4").tobytes() for code in coded]

    def _plain(self, words: list[str]) -> list[bytes]:
        """Ids of words of small letters."""
        return self._by_model(words)

    def _by_model(self, words: list[str]) -> list[bytes]:
        tokenize, forms = self.model.tokenize, self.letter_forms
        return [
            array("I", [token.id for token in tokenize(word if word.isascii() else word.translate(forms))]).tobytes()
            for word in words
        ]


def encoder(path: str) -> WordEncoder:
    """One encoder per tokenizer file and worker process."""
    key = (path, os.getpid())
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(path)
    return _ENCODERS[key]


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same ids with ``end_id`` after those of every text, and the new counts."""
    ends = np.cumsum(counts)
    return np.insert(ids, ends, np.uint32(end_id)).astype("<u4", copy=False), counts + 1
