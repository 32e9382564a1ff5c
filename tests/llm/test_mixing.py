from __future__ import annotations

import re
from collections import Counter, defaultdict
from fractions import Fraction

from pyspark.sql import functions as F

from tests.llm.helpers import DOCUMENTS, awkward, empty
from tidewatch.llm import mixing
from tidewatch.llm.mixing import apportion, mix_sources, mixed_documents


def sainte_lague(votes, seats):
    got = [0] * len(votes)
    for _ in range(seats):
        best = max(range(len(votes)), key=lambda i: (Fraction(votes[i], 2 * got[i] + 1), -i))
        got[best] += 1
    return got


def test_apportion_is_sainte_lague(spark):
    cases = [([100, 80, 30, 20], 8), ([1, 1, 1, 1, 1], 3), ([5, 0, 3], 40), ([0, 0], 0), ([1], 7), ([1000, 1, 1, 1, 1, 1], 10),
             ([53, 24, 23], 7), ([7] * 9, 4), ([3, 3, 2], 1)]
    rows = [(g, i, float(v), n) for g, (votes, n) in enumerate(cases) for i, v in enumerate(votes)]
    df = spark.createDataFrame(rows, "g int, i int, votes double, seats long")
    found = {(r["g"], r["i"]): r["quota"] for r in apportion(df, ["g"], "votes", "seats", "i").collect()}
    for g, (votes, n) in enumerate(cases):
        assert [found[g, i] for i in range(len(votes))] == sainte_lague(votes, n)


def targets(sizes, share=1.5, limit=2):
    """Shares stop at their limits in rounds."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), Fraction(share) * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > limit * sizes[s]}
        if not full:
            target |= {s: weight[s] * level for s in free}
            break
        target |= {s: Fraction(limit * sizes[s]) for s in full}
        left -= sum(limit * sizes[s] for s in full)
        free -= full
    return target


def check(df, block=16):
    rows = df.collect()
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["taken"] == r["copies"] * r["size"] + r["n_first"] + r["n_second"]
    expected = targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - expected[r["source"]]) < 1e-6
    for s, n in taken.items():
        assert abs(n - expected[s]) <= block * (1 + sizes[s] // 4096), (s, n, expected[s])
    return rows


def docs_of(spark, n=600):
    text = lambda i: " ".join(f"w{i}x{k}" for k in range((i * 37) % 290))
    source = lambda i: "hot" if i % 3 == 0 else None if i % 7 == 1 else f"s{i % 5}" if i < 500 else "Z"
    return spark.createDataFrame([(i, text(i), "en", source(i), 0) for i in range(n)], DOCUMENTS).repartition(4)


def test_targets_and_reruns(spark, monkeypatch):
    docs = docs_of(spark)
    rows = check(mix_sources(docs))
    again = mix_sources(docs.repartition(2, "lang")).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    monkeypatch.setattr(mixing, "CELL_WORDS", 300)
    check(mix_sources(docs), block=16 * 16)


def test_mixed_texts(spark):
    docs = docs_of(spark)
    plan = {r["doc_id"]: r for r in mix_sources(docs).collect()}
    words = defaultdict(int)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in mixed_documents(docs).collect():
        assert r["text"] in texts[r["doc_id"]]
        assert r["n_chars"] == len(r["text"])
        words[r["doc_id"]] += len(re.findall(mixing.WORD, r["text"]))
    assert {i: r["taken"] for i, r in plan.items() if r["taken"]} == dict(words)
    assert mixed_documents(docs).columns == docs.columns


def test_awkward_rows(spark):
    check(mix_sources(awkward(spark)))
    assert mixed_documents(awkward(spark)).count() > 0
    assert mix_sources(empty(spark)).collect() == []
    blank = spark.createDataFrame([(1, " ", "en", "a", 1), (2, None, None, None, None)], DOCUMENTS)
    assert [r["taken"] for r in mix_sources(blank).collect()] == [0, 0]
    assert mixed_documents(blank).collect() == []
    assert mix_sources(docs_of(spark, 30).withColumn("cell", F.lit(1))).count() == 30
