from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tests.conftest import CHECK_FOLDER
from tests.llm.helpers import awkward, documents, empty
from tidewatch.llm.common import table
from tidewatch.llm.fingerprint import (
    compare_neighbours, containment, distinct_shingles, document_sketches, merge, merged_sketches, resemblance, sketch,
    sketch_of, text_of,
)
from tidewatch.llm.queries import LLM_QUERIES


def shingles(text, n=5):
    w = text.lower().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))}


def test_estimates():
    rng = random.Random(3)
    words = [f"w{rng.randrange(10**6)}" for _ in range(6000)]
    a, b = " ".join(words[:4000]), " ".join(words[2000:])
    x, y = sketch(a), sketch(b)
    assert abs(resemblance(x, y) - 1 / 3) < 0.15
    assert abs(containment(x, y) - 0.5) < 0.2
    assert abs(distinct_shingles(x) / 3996 - 1) < 0.4
    errors = [resemblance(sketch(a, 1024), sketch(b, 1024), 1024) - 1 / 3, distinct_shingles(sketch(a, 1024), 1024) / 3996 - 1]
    assert max(map(abs, errors)) < 0.08
    short = sketch("a b c d e f"), sketch("b c d e f g")
    assert resemblance(*short) == 1 / 3 and distinct_shingles(short[0]) == 2 and containment(*short) == 0.5
    assert resemblance(sketch(""), sketch("")) == 1 and resemblance(sketch(""), sketch(" ")) == 0
    assert np.array_equal(sketch_of(text_of(x)), x)
    parts = [" ".join(words[i : i + 1004]) for i in range(0, 4000, 1000)]  # parts that overlap by a shingle
    whole = sketch(" ".join(words[:4004]))
    merged = np.array([], np.uint64)
    for p in parts:
        merged = merge(merged, sketch(p))
    assert np.array_equal(merged, whole)


def test_sketches_merge_in_spark(spark):
    texts = [" ".join(f"w{i * 7 + j % 50}" for j in range(60)) for i in range(20)]
    docs = documents(spark, texts)
    by = document_sketches(docs).selectExpr("doc_id % 2 AS half", "sketch")
    for r in merged_sketches(by, "half").collect():
        expected = np.array([], np.uint64)
        for i in range(r["half"], 20, 2):
            expected = merge(expected, sketch(texts[i]))
        assert np.array_equal(np.array(r["sketch"], np.int64).view(np.uint64), expected)


def brute(rows):
    """Rows by descending id; ids are distinct."""
    rows = sorted(rows, key=lambda r: -1 if r[0] is None else r[0], reverse=True)
    out = {}
    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        text, after = text or "", after or ""
        n = len(text)
        edited = text[: n - n // 3] + after[: n // 3]
        a, e, x = sketch(text), sketch(edited), sketch(after)
        out[doc_id] = (n, hashlib.sha256(edited.encode()).hexdigest(), text_of(a), text_of(e), resemblance(a, e), resemblance(a, x))
    return out


def result(df):
    rows = df.collect()
    found = {r["doc_id"]: tuple(r)[1:] for r in rows}
    assert len(found) == len(rows)
    return found


def test_check_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, CHECK_FOLDER, "documents").collect()]
    found = result(LLM_QUERIES["op7_fingerprint"](spark, CHECK_FOLDER))
    assert found == brute(rows)
    ordered = sorted(rows, reverse=True)
    errors = []
    for (doc_id, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        n = len(text)
        a, b = shingles(text), shingles(text[: n - n // 3] + after[: n // 3])
        errors.append(abs(found[doc_id][4] - len(a & b) / len(a | b)))
    assert max(errors) < 0.25 and sum(errors) / len(errors) < 0.06


@pytest.mark.parametrize("n", [1, 2, 3, 50])
def test_few_documents(spark, n):
    texts = ["é🙂" * i + " x y" for i in range(n)]
    ids = [7 * i if i else None for i in range(n)]
    assert result(compare_neighbours(documents(spark, texts, ids=ids))) == brute(list(zip(ids, texts)))


def test_awkward_rows(spark):
    rows = compare_neighbours(awkward(spark)).collect()
    assert sorted((r["doc_id"] or 0) for r in rows) == [0, 0, 1, 1, 2, 3, 4, 5, 6]
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[2]["fingerprint"] == by_id[3]["fingerprint"] == ""
    assert compare_neighbours(empty(spark)).collect() == []
