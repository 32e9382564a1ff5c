from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from tests.conftest import CHECK_FOLDER
from tests.llm.helpers import awkward, documents, empty
from tidewatch.llm import simhash
from tidewatch.llm.common import table
from tidewatch.llm.queries import LLM_QUERIES
from tidewatch.llm.simhash import (
    block_masks, close_runs, components, fingerprint, near_duplicates, near_links, without_near_duplicates,
)


def plain_fingerprint(text, words=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    tokens = [t for t in low.split(" ") if t]
    shingles = [" ".join(tokens[i : i + words]) for i in range(len(tokens) - words + 1)] or [" ".join(tokens)] * bool(tokens)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def grouped(ids, near):
    """Smallest member of each component, by plain union of all close pairs."""
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in near:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def brute(rows, radius=2):
    prints = [plain_fingerprint(t) for _, t in rows]
    near = [(i, j) for i, j in combinations(range(len(rows)), 2) if (prints[i] ^ prints[j]).bit_count() <= radius]
    group = grouped(range(len(rows)), near)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[group[i]] = min(doc_id, least.get(group[i], doc_id))
    return sorted(((d, f"{p:016x}", least.get(group[i])) for i, ((d, _), p) in enumerate(zip(rows, prints))), key=repr)


def single(rows, radius=2):
    """The ids that stay: the smallest of every component (None for a component without ids)."""
    return sorted({c for _, _, c in brute(rows, radius)}, key=lambda c: (c is None, c or 0))


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_masks_cover_every_difference(radius):
    rng = random.Random(radius)
    for _ in range(500):
        flipped = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(not m & flipped for m in block_masks(radius))


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4, 7])
def test_bit_sliced_runs(radius):
    rng = random.Random(radius)
    values, ends = [], []
    while len(values) < 700:
        base, size = rng.getrandbits(64), rng.choice([1, 1, 2, 3, 70, 130])
        run = []
        for _ in range(size):
            for b in rng.sample(range(64), rng.randint(0, 3)):
                base ^= 1 << b
            run.append(base)
        ends += [len(values) + size] * size
        values += run
    forest = close_runs(np.array(values, np.uint64), np.array(ends), radius).tolist()
    pairs = [(i, j) for i in range(len(values)) for j in range(i + 1, ends[i]) if (values[i] ^ values[j]).bit_count() <= radius]
    assert {tuple(p) for p in forest} <= set(pairs)
    assert grouped(range(len(values)), forest) == grouped(range(len(values)), pairs)
    assert len(forest) < len(values)


@pytest.mark.parametrize("tile", [2048, 5])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = random.Random(4)
    values = set()
    for _ in range(30):
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 20])):
            values.add(base)
            for b in rng.sample(range(64), rng.randint(1, 3)):
                base ^= 1 << b
    values |= {0, 1, 3, (1 << 64) - 1, (1 << 63) - 1}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = near_links(spark.createDataFrame([(v,) for v in signed], "fingerprint long"), 2).collect()
    u = {v: v & (1 << 64) - 1 for v in signed}
    pairs = {(a, b) for a, b in combinations(sorted(signed), 2) if (u[a] ^ u[b]).bit_count() <= 2}
    assert {tuple(r) for r in found} <= pairs
    assert grouped(signed, map(tuple, found)) == grouped(signed, pairs)
    if tile == 5:
        roots = {r["node"]: r["root"] for r in components(spark.createDataFrame(found)).collect()}
        assert {v: roots.get(v, v) for v in signed} == grouped(signed, pairs)


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    roots = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert roots == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_fingerprints_and_awkward_rows(spark):
    for text in ("", " \n", "One", "one two", "a B c", "É x y É z", "the same " * 30_000):
        assert fingerprint(text.encode(), 3) == plain_fingerprint(text)
    docs = awkward(spark)
    assert result(near_duplicates(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert near_duplicates(empty(spark)).collect() == []
    assert result(near_duplicates(documents(spark, ["a b c d"] * 5))) == brute([(i, "a b c d") for i in range(5)])


def test_check_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, CHECK_FOLDER, "documents").collect()]
    assert result(LLM_QUERIES["op10_simhash"](spark, CHECK_FOLDER)) == brute(rows)


def test_one_row_of_each_component_stays(spark):
    docs = awkward(spark).withColumnsRenamed({"size": "tie", "start": "fingerprint", "key": "root"})
    kept = without_near_duplicates(docs)
    assert kept.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted((r["doc_id"] for r in kept.collect()), key=lambda c: (c is None, c or 0)) == single(rows)
    assert without_near_duplicates(empty(spark)).collect() == []
    # One id with two texts: each row goes with its own component.
    texts = documents(spark, ["a b c d e", "v w x y z", "v w x y z", None], ids=[1, 1, 0, None])
    kept = sorted((r["doc_id"], r["text"]) for r in without_near_duplicates(texts).where("doc_id IS NOT NULL").collect())
    assert kept == [(0, "v w x y z"), (1, "a b c d e")]


def test_rows_that_stay_of_the_check_table(spark):
    docs = table(spark, CHECK_FOLDER, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(r["doc_id"] for r in without_near_duplicates(docs).collect()) == single(rows)
