from __future__ import annotations

import random

from pyspark.sql import functions as F

from tidewatch.llm import topk
from tidewatch.llm.topk import top_k

SCHEMA = "vec_id long, embedding array<double>, label int, vector string, shard long"
def asks():
    return F.col("vec_id") % 100 == 0


def brute(rows, k):
    from math import floor, isfinite

    valid = {
        (i, tuple(floor(1024 * x) for x in v))
        for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and isfinite(x) for x in v)
    }
    asked = {}
    for i, v in sorted(valid, reverse=True):
        if i % 100 == 0:
            asked[i] = v
    out = []
    for i, q in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in valid if j != i and len(v) == len(q))
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def check(spark, rows, k=10):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert sorted(map(tuple, top_k(df, asks(), k=k).collect())) == brute(rows, k)


def test_random_and_awkward_rows(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)], 0, "x", i) for i in range(700)]
    rows += [(i, [0.5] * 8, None, None, None) for i in range(700, 1000)]  # ties
    rows += [rows[0], rows[5], (100, [0.25] * 8, 1, "y", 0), (1000, [float("nan")] * 8, 1, "y", 0)]
    rows += [(1100, [1.0, None], 0, "z", 0), (1200, None, 0, "z", 0), (None, [1.0] * 8, 0, "z", 0)]
    rows += [(1300, [float("inf")] * 8, 0, "", 0), (1400, [1.0, 2.0], 0, "", 0), (1401, [3.0, 2.0], 0, "", 0)]
    rows += [(1500, [], 0, "", 0), (1501, [], 0, "", 0), (1600, [2.0**30] * 8, 0, "", 0)]
    for block, shard, fan in ((1024, 8192, 32), (3, 50, 2), (4, 7, 5)):
        monkeypatch.setattr(topk, "BLOCK_ROWS", block)
        monkeypatch.setattr(topk, "SHARD_ROWS", shard)
        monkeypatch.setattr(topk, "FAN_IN", fan)
        check(spark, rows)


def test_fewer_candidates_than_k_and_empty(spark):
    check(spark, [(0, [1.0], 0, "", 0), (1, [2.0], 0, "", 0)])
    check(spark, [(0, [1.0], 0, "", 0)])
    assert top_k(spark.createDataFrame([], SCHEMA), asks()).collect() == []
