"""Token ids, packing and the token file against the library itself and exact round trips."""

from __future__ import annotations

import random
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.conftest import CHECK_FOLDER
from tests.llm.helpers import awkward, documents, empty
from tidewatch.llm.common import table
from tidewatch.llm.packing import Packer, Piece, pack_documents
from tidewatch.llm.queries import LLM_QUERIES, TOKENIZER
from tidewatch.llm.token_file import Codes, document_digests, encode_codes, read_token_file, tokens_at, write_token_file
from tidewatch.llm.tokens import WordEncoder, encoder

LIBRARY = Tokenizer.from_file(TOKENIZER)


def ids_of(text, end):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [end]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(), st.text(alphabet="aB'sé́ \t\n\x1c\x85 <|endoftext|>Σς1٣")), max_size=6))
def test_word_ids_are_those_of_whole_texts(texts):
    coder = WordEncoder(TOKENIZER, known_words=5)
    for _ in range(2):
        flat, counts = coder.encode(pa.array(texts, pa.string()))
        expected = [ids_of(t, 0)[:-1] for t in texts]
        assert counts.tolist() == [len(e) for e in expected]
        assert flat.tolist() == [i for e in expected for i in e]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text(alphabet="abShHKÉßÀ×÷Σςİſé̱́̇ \t,.;:!?'\"&<|>3_—", max_size=20), max_size=4))
def test_marks_and_capitals_give_the_ids_of_whole_texts(texts):
    coder = encoder(TOKENIZER)
    assert coder.letters_whole
    special = ["<|ENDOFTEXT|>, <|endoftext|>.", "H\u0331, J\u030c. don'T, X&&& É!! É, ×, a\u00e9; À"]
    flat, counts = coder.encode(pa.array(texts + special, pa.string()))
    expected = [ids_of(t, 0)[:-1] for t in texts + special]
    assert counts.tolist() == [len(e) for e in expected]
    assert flat.tolist() == [i for e in expected for i in e]


def test_a_word_is_remembered_without_its_mark_and_capitals():
    coder = WordEncoder(TOKENIZER)
    flat, _ = coder.encode(pa.array(["Word, wORD. word! WORD? word: word;", "Word"]))
    assert flat.tolist() == ids_of("Word, wORD. word! WORD? word: word; Word", 0)[:-1]
    assert list(coder.known) == ["word"]


def test_common_words_are_learned_once(monkeypatch):
    coder, learned = WordEncoder(TOKENIZER, known_words=40), []
    library, plain = coder._library, coder._plain
    monkeypatch.setattr(coder, "_library", lambda words: learned.extend(words) or library(words))
    monkeypatch.setattr(coder, "_plain", lambda words: learned.extend(words) or plain(words))
    for batch in range(8):
        text = " ".join(["Common,", "x9y", *[f"w{batch}q{i}" for i in range(25)]])
        flat, _ = coder.encode(pa.array([text, "", None], pa.string()))
        assert flat.tolist() == ids_of(text, 0)[:-1]
        assert len(coder.known) + len(coder.older) <= 2 * (20 + 30)
    assert (learned.count("common"), learned.count("x9y")) == (1, 1)


def test_encoding_takes_little_more_than_its_ids():
    coder, words = WordEncoder(TOKENIZER), 1_000_000
    coder.encode(pa.array(["a b"]))
    texts = pa.array(["a b " * (words // 2)])
    tracemalloc.start()
    flat, counts = coder.encode(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counts.tolist() == [words] and flat.tolist() == ids_of("a b", 0)[:-1] * (words // 2)
    assert peak < 7 * flat.nbytes


def test_codes_round_trip_and_random_access():
    rng = np.random.default_rng(5)
    for n in (0, 1, 7, 8, 9, 511, 512, 513, 4095, 20_000):
        ids = (rng.integers(0, 2**32, n, dtype=np.uint64) >> rng.integers(0, 32, n).astype(np.uint64)).astype(np.uint32)
        codes = Codes(encode_codes(ids))
        assert len(codes) == n
        assert np.array_equal(codes.all(), ids)
        for i in rng.integers(0, max(n, 1), min(n, 200)):
            assert codes[int(i)] == ids[i]


def packed(rows, docs, size, end):
    """Checks all pieces against the documents; returns tokens of padding."""
    expected = defaultdict(list)
    for doc_id, text in docs:
        expected[doc_id].append(ids_of(text, end))
    sequences, copies = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        copies[r["doc_id"]].append(r)
        assert r["length"] > 0
        assert any(
            r["doc_tokens"] == len(ids)
            and r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes())
            for ids in expected[r["doc_id"]]
        )
    for doc_id, texts in expected.items():
        covered = sorted(i for r in copies[doc_id] for i in range(r["start"], r["start"] + r["length"]))
        assert covered == sorted(i for ids in texts for i in range(len(ids)))
    padding = 0
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding


def test_packing_of_the_check_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, CHECK_FOLDER, "documents").collect()]
    rows = LLM_QUERIES["op5_packing"](spark, CHECK_FOLDER).collect()
    assert packed(rows, docs, 4096, 2) == 0
    assert len(rows) < 1.5 * len(docs) + sum(r["length"] for r in rows) / 4096


def test_packing_of_awkward_rows(spark):
    docs = awkward(spark)
    rows = pack_documents(docs, TOKENIZER, end_id=2, size=64, with_ids=True).collect()
    assert packed(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], 64, 2) == 0
    assert all(len(r["ids"]) == r["length"] for r in rows)
    assert pack_documents(empty(spark), TOKENIZER, end_id=2).collect() == []


def test_level_has_the_smallest_sum_of_squares():
    rng = random.Random(3)
    packer = Packer(32, max_open=10**6)
    for i in range(2000):
        length = rng.randint(1, 31)
        level = packer.level_for(length)

        def after(h):
            c = packer.counts.copy()
            if h:
                c[h] -= 1
            if h + length < 32:
                c[h + length] += 1
            return int((c * c).sum())

        choices = {h: after(h) for h in range(33 - length) if h == 0 or packer.counts[h]}
        assert choices[level] == min(choices.values())
        assert level == max(h for h, v in choices.items() if v == choices[level])
        list(packer.put(Piece(i, length, 0, np.zeros(length, np.uint32))))


def test_an_open_window_holds_no_more_than_its_pieces():
    packer = Packer(4096)
    assert sum(len(p.ids) for w in packer.put(Piece(1, 100_000, 0, np.arange(100_000, dtype="<u4"))) for p in w) == 98_304
    (tail,), = [w for windows in packer.windows.values() for w in windows]
    assert (tail.start, tail.ids.tolist()) == (98_304, list(range(98_304, 100_000)))
    assert tail.ids.base is None


def test_open_windows_are_bounded():
    packer, seen = Packer(100, max_open=8), 0
    for i in range(500):
        for window in packer.put(Piece(i, 51, 0, np.zeros(51, np.uint32))):
            assert sum(len(p.ids) for p in window) == 100
            seen += 100
        assert packer.n_open <= 8
    assert seen + sum(len(p.ids) for w in packer.finish() for p in w) == 500 * 51


def digests_of(docs):
    start, out = 0, []
    for doc_id, text in docs:
        ids = ids_of(text, 1)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_file_of_the_check_table(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in table(spark, CHECK_FOLDER, "documents").collect())
    rows = LLM_QUERIES["op8_token_file"](spark, CHECK_FOLDER).collect()
    assert sorted(map(tuple, rows)) == digests_of(docs)


def test_token_file_of_awkward_rows(spark, tmp_path):
    docs = awkward(spark)
    write_token_file(docs, str(tmp_path / "t"), TOKENIZER, end_id=1, partitions=4)
    segments = read_token_file(spark, str(tmp_path / "t"))
    rows = sorted(map(tuple, document_digests(segments).collect()), key=lambda r: r[1])
    assert [r[0] for r in rows] == [None, None, 1, 1, 2, 3, 4, 5, 6]
    at = 0
    for _, start, n, _ in rows:
        assert start == at
        at += n
    texts = {(r["doc_id"], r["text"]) for r in docs.collect()}
    possible = {(t[0], *d[2:]) for t in texts for d in digests_of([t])}
    assert {(doc_id, n, crc) for doc_id, _, n, crc in rows} == possible
    wanted = spark.createDataFrame([(0,), (at - 1,), (at,), (5,), (5,), (None,)], "position long")
    found = sorted(map(tuple, tokens_at(segments, wanted).collect()))
    assert [p for p, _ in found] == [0, 5, 5, at - 1]
    assert found[-1][1] == 1


@pytest.mark.parametrize("n", [0, 1])
def test_small_token_files(spark, tmp_path, n):
    docs = documents(spark, ["ab cd"] * n) if n else empty(spark)
    write_token_file(docs, str(tmp_path / f"t{n}"), TOKENIZER, end_id=1)
    assert document_digests(read_token_file(spark, str(tmp_path / f"t{n}"))).count() == n
