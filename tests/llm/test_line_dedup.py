from __future__ import annotations

import random
import re
from collections import defaultdict

from tests.llm.helpers import awkward, documents, empty
from tidewatch.llm import line_dedup
from tidewatch.llm.line_dedup import dedup_lines

EDGES = re.compile(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z")


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in EDGES.sub("", line))


def brute(rows, least=40, count=5):
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(-1 if doc_id is None else doc_id)
    lost = {k: max(v) for k, v in holders.items() if len(k) >= least and len(v) >= count}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        own = -1 if doc_id is None else doc_id
        kept = [x for x in lines if lost.get(key(x), own) == own]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in df.collect()), key=repr)


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_random_lines(spark, monkeypatch):
    rng = random.Random(2)
    lines = [("é" if i % 3 else "E") * n + f"{i:02d}" for i, n in enumerate([36, 37, 38, 39, 60] * 6)]
    texts = []
    for i in range(300):
        chosen = [rng.choice(lines) for _ in range(rng.randint(0, 4))] + [f"a line of document {i} that no other one has"]
        rng.shuffle(chosen)
        texts.append("\n".join(rng.choice(["", " ", "\t\x0b"]) + rng.choice([x, x.lower(), x.upper()]) + "\r" for x in chosen))
    texts += [None, "", "\n", "x" * 50 + "\n" + "x" * 50]
    docs = documents(spark, texts)
    expected = brute(list(enumerate(texts)))
    assert result(dedup_lines(docs)) == expected
    # Filters far too small suspect everything and change nothing.
    monkeypatch.setattr(line_dedup, "MAX_FILTER_BITS", 64)
    assert result(dedup_lines(docs)) == expected
    monkeypatch.setattr(line_dedup, "FAN_IN", 2)
    assert result(dedup_lines(docs.repartition(9))) == expected


def test_awkward_rows(spark):
    docs = awkward(spark)
    again = dedup_lines(docs)
    assert set(docs.columns) <= set(again.columns)
    assert result(again) == brute(rows_of(docs))
    line = "the same long line stands in all of these documents"
    ids = [None, None, 1, 1, 2, 3, 4, 5]
    docs = documents(spark, [line] * 8, ids=ids)
    assert result(dedup_lines(docs)) == brute(rows_of(docs))
    docs = documents(spark, [line] * 6, ids=[None, None, 1, 1, 2, 3])
    assert [r[2] for r in result(dedup_lines(docs))] == [0] * 6
    assert dedup_lines(empty(spark)).collect() == []


def test_rows_without_id_get_their_own_lost_lines(spark, monkeypatch):
    lists = []
    kept = line_dedup.lost_lines
    monkeypatch.setattr(line_dedup, "lost_lines", lambda df: lists.append(kept(df)) or lists[-1])
    lines = [f"a line of the corpus with number {i:03d} and some more" for i in range(40)]
    ids = [*range(8), *[None] * 40]
    docs = documents(spark, ["\n".join(lines)] * 8 + lines, ids=ids)
    assert result(dedup_lines(docs)) == brute(rows_of(docs))
    assert sorted(len(r["__lost"]) for r in lists[0].collect()) == [1] * 40 + [40] * 7
