"""Alignment of two tokenizers against both libraries' ids of whole texts, token by token."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import sentencepiece
from tokenizers import Tokenizer

from tests.conftest import CHECK_FOLDER
from tests.llm.helpers import awkward, documents, empty
from tidewatch.llm import alignment
from tidewatch.llm.alignment import Aligner, align_documents, alignment_digest, chunk_row
from tidewatch.llm.common import table
from tidewatch.llm.queries import LLM_QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    " two  blanks ", "tab\there\n\nand lines \n", "É́ ǅ ﬁn x <|endoftext|> <s> </s> <unk> <0x41> 🙂 z", "ก็ ḃ 𐍈𐍈 é",
    "a▁b", "▁", " ", "   ", "\n", "\x00\x01", "it's we'll 'tis", "x " * 50, " nbsp em​zero", "👩‍👩‍👧 fin", "  \x1f y \x85z",
    "ab" * 3000, "日本語のテキスト。 です", "�﻿ bom", "1234567890 12 3.14 %%% $$$\r\nend", "é́ ́",
]


def tokens_of_bytes():
    """Bytes of all ids of both tokenizers, by their definitions."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    shown = {b: chr(b) for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD}
    hidden = [b for b in range(256) if b not in shown]
    shown |= {b: chr(256 + k) for k, b in enumerate(hidden)}
    back = {c: b for b, c in shown.items()}
    b = sentencepiece.SentencePieceProcessor(model_file=B)

    def ids_a(text):
        coded = a.encode(text, add_special_tokens=False)
        return coded.ids, [bytes(back[c] for c in t) for t in coded.tokens]

    def ids_b(text):
        ids = b.encode(text)
        names = [b.id_to_piece(i) for i in ids]
        return ids, [bytes.fromhex(p[3:5]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids, names)]

    return ids_a, ids_b


def plain(rows):
    """Digest rows from the ids of whole texts, without segments, spans or chunks."""
    ids_a, ids_b = tokens_of_bytes()
    per_row, counts = [], Counter()
    for doc_id, text in rows:
        (x, bytes_x), (y, bytes_y) = (ids_a(" " + text), ids_b(text)) if text else (([], []), ([], []))
        whole = (" " + text).encode() if text else b""
        if not text or b"".join(bytes_x) != whole or b"".join(bytes_y) != whole:
            x, y, bytes_x, bytes_y = [], [], [], []
        spans = []
        for parts in (bytes_x, bytes_y):
            at, out = 0, []
            for p in parts:
                out.append((at, at + len(p)))
                at += len(p)
            spans.append(out)
        links, j = [], 0
        for i, (start, end) in enumerate(spans[0]):
            while j and spans[1][j - 1][1] > start:
                j -= 1
            while j < len(y) and spans[1][j][0] < end:
                if spans[1][j][1] > start:
                    links.append((x[i], y[j]))
                j += 1
        cuts = {e for _, e in spans[0]} & {e for _, e in spans[1]}
        groups, at_a, at_b = [], 0, 0
        for cut in sorted(cuts):
            to_a = next(k for k, s in enumerate(spans[0]) if s[1] == cut) + 1 if len(x) < 300 else at_a + next(k for k, s in enumerate(spans[0][at_a:]) if s[1] == cut) + 1
            to_b = at_b + next(k for k, s in enumerate(spans[1][at_b:]) if s[1] == cut) + 1
            groups.append(",".join(map(str, x[at_a:to_a])) + "|" + ",".join(map(str, y[at_b:to_b])))
            at_a, at_b = to_a, to_b
        counts.update(links)
        per_row.append((doc_id, x, y, groups, links))
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    return sorted(
        (
            (
                doc_id, len(x), len(y), len(groups), len(links), sum(counts[p] == highest[p[1]] for p in links),
                sum(counts[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
            )
            for doc_id, x, y, groups, links in per_row
        ),
        key=repr,
    )


def result(df):
    return sorted(map(tuple, df.select(COLUMNS).collect()), key=repr)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_segments_give_the_ids_of_whole_texts():
    """Random texts of blanks, marks, letters and characters that one tokenizer has no piece for."""
    rng, both, (ids_a, ids_b) = random.Random(8), Aligner(A, B), tokens_of_bytes()
    assert both.cuts_at_spaces
    for _ in range(1500):
        text = "".join(rng.choices(" \n\t' éaAbsḃ🙂1,.-́ \x1cthe ", k=rng.randint(1, 14)))
        segments = both.segments(text)
        assert " ".join(segments) == text
        both.learn(segments)
        found = [both.known[s] for s in segments]
        groups = [g.split("|") for f in found for g in f[0].decode().split(";")]
        assert ",".join(a for a, _ in groups) == ",".join(map(str, ids_a(" " + text)[0])), repr(text)
        assert ",".join(b for _, b in groups) == ",".join(map(str, ids_b(text)[0])), repr(text)


def test_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 200)
    docs = documents(spark, ODD + ["the plain text of it"] * 5 + ["", None])
    got = result(alignment_digest(docs, A, B))
    assert got == plain(pairs(docs))
    kept = {r[0] for r in got if r[1]}
    assert 2 in kept and 3 in kept and not kept & {4, 5, len(ODD) + 5, len(ODD) + 6}


def test_groups_cover_the_text(spark):
    docs = documents(spark, ODD)
    texts = dict(pairs(docs))
    for row in align_documents(docs, A, B).collect():
        groups = row["groups"]
        if groups:
            assert [g["start"] for g in groups] == [0, *(g["end"] for g in groups[:-1])]
            assert groups[-1]["end"] == len((" " + texts[row["doc_id"]]).encode())


def test_awkward_rows(spark):
    docs = awkward(spark)
    assert result(alignment_digest(docs, A, B)) == plain(pairs(docs))
    assert alignment_digest(empty(spark), A, B).collect() == []
    assert alignment_digest(documents(spark, [None, ""]), A, B).count() == 2
    assert align_documents(empty(spark), A, B).collect() == []


def test_check_table(spark):
    got = LLM_QUERIES["op11_alignment"](spark, CHECK_FOLDER)
    assert got.columns == COLUMNS
    assert result(got) == plain(pairs(table(spark, CHECK_FOLDER, "documents")))


def test_a_chunk_is_smaller_than_its_text():
    """Executors hold, sort and send chunks, so their size counts, not only that of what the aligner remembers."""
    rng = random.Random(3)
    words = ["".join(rng.choices("aeioulnrst", k=rng.randint(2, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    row = chunk_row(Aligner(A, B), 0, batch)
    assert row.num_rows == 1 and row.nbytes < sum(map(len, texts)) / 2


def test_chunks_lie_in_row_groups_by_size(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 200)
    monkeypatch.setitem(alignment.ROW_GROUPS, "parquet.block.size", 4096)
    monkeypatch.setattr(alignment, "scratch_path", lambda *_: str(tmp_path / "aligned"))
    docs = documents(spark, [f"{text} text {k} of it" for k in range(4) for text in ODD])
    assert result(alignment_digest(docs, A, B)) == plain(pairs(docs))
    files = [pq.ParquetFile(f).metadata for f in (tmp_path / "aligned").glob("*.parquet")]
    assert sum(f.num_rows for f in files) > 3 and all(f.num_row_groups > 1 for f in files if f.num_rows > 8)


def test_segments_asked_for_again_are_remembered(monkeypatch):
    monkeypatch.setattr(alignment, "KNOWN_SEGMENTS", 20)
    both, encoded = Aligner(A, B), []
    whole = both.align_together
    monkeypatch.setattr(both, "align_together", lambda words: (encoded.extend(words), whole(words)))
    for k in range(10):
        segments = [f"word{k}x{i}" for i in range(15)] + ["often"] * (k % 2)
        both.learn(segments)
        assert all(s in both.known for s in segments)
        assert len(both.known) + len(both.before) <= 2 * (20 + 16)
    assert encoded.count("often") == 1 and len(encoded) == 151
