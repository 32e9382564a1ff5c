"""Exact and approximate quantiles against plain sorting."""

from __future__ import annotations

import math
import random
from decimal import ROUND_CEILING, Decimal

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import quantiles as Q

WANTED = {"lo": 0.01, "q1": 0.25, "mid": 0.5, "p95": 0.95, "top": 1.0}


def brute(values, p):
    ordered = sorted(v for v in values if v is not None and not math.isnan(v))
    if not ordered:
        return None
    rank = int((Decimal(str(p)) * len(ordered)).to_integral_value(rounding=ROUND_CEILING))
    return ordered[max(1, rank) - 1]


def shapes():
    rng = random.Random(11)
    yield "uniform", [rng.uniform(-5, 5) for _ in range(3000)]
    yield "long tail", [math.exp(rng.gauss(0, 6)) for _ in range(3000)]
    yield "signs", [rng.choice([-1, 1]) * math.exp(rng.gauss(0, 20)) for _ in range(2000)]
    yield "few values", [float(rng.choice([1, 1, 1, 2, 7])) for _ in range(3000)]
    yield "constant", [4.2] * 500
    yield "one far value", [rng.random() for _ in range(2000)] + [1e300]
    yield "infinite", [rng.random() for _ in range(500)] + [math.inf] * 40 + [-math.inf] * 30
    yield "holes", [rng.random() for _ in range(500)] + [None] * 50 + [math.nan] * 50
    yield "tiny", [3.0, 1.0]
    yield "all scales", [rng.choice([-1, 1]) * rng.uniform(1, 10) * 10.0 ** rng.randint(-307, 307) for _ in range(1500)] + [0.0, -0.0, 5e-324, -5e-324, 1e-310, 1.7e308] * 20
    yield "neighbours", [math.nextafter(1.0, 2.0)] * 30 + [1.0] * 30 + [math.nextafter(1.0, 0.0)] * 30 + [2.0 ** k for k in range(-60, 60)]


@pytest.mark.parametrize("name", ["long tail", "few values", "infinite", "all scales"])
def test_exact_global(spark, name):
    values = dict(shapes())[name]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    row = Q.exact_quantiles(df, "x", WANTED, max_bucket_rows=10, digit_bits=10).first()
    assert row.asDict() == {n: brute(values, p) for n, p in WANTED.items()}


@pytest.mark.parametrize("small, bits", [(10, 10), (10, 4), (10**6, 10)], ids=["digits", "short digits", "small buckets"])
def test_exact_by_group(spark, small, bits):
    groups = dict(shapes())
    groups[None] = [float(i) for i in range(100)]
    rows = [(k, v) for k, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "k string, x double").repartition(4)
    result = Q.exact_quantiles(df, "x", WANTED, ["k"], max_bucket_rows=small, digit_bits=bits)
    got = {r["k"]: {n: r[n] for n in WANTED} for r in result.collect()}
    assert got == {k: {n: brute(v, p) for n, p in WANTED.items()} for k, v in groups.items()}


def test_exact_by_group_without_broadcast(no_broadcast):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(50)}", rng.gauss(0, 1)) for _ in range(4000)]
    df = no_broadcast.createDataFrame(rows, "k string, x double")
    got = {r["k"]: r["p95"] for r in Q.exact_quantiles(df, "x", {"p95": 0.95}, ["k"], 10, 4).collect()}
    assert got == {k: brute([x for g, x in rows if g == k], 0.95) for k in {g for g, _ in rows}}


def test_image_is_in_the_order_of_the_doubles(spark):
    rng = random.Random(5)
    values = [s * m * 2.0**e for s in (1, -1) for e in range(-1074, 1024, 7) for m in (1.0, 1.5, 1.999999999999)]
    values += [math.nextafter(2.0**k, x) for k in range(-1022, 1024, 9) for x in (0.0, math.inf)] + [rng.gauss(0, 1) for _ in range(500)]
    values += [math.inf, -math.inf, 0.0]
    values = sorted(set(values))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    images = [r["image"] for r in df.select("i", Q.ordered_image(F.col("x")).alias("image")).orderBy("i").collect()]
    assert images == sorted(images)
    assert len(set(images)) >= len(images) - sum(a == math.nextafter(b, a) for a, b in zip(values, values[1:]))
    assert max(images) - min(images) < 1 << 63


def test_exact_on_nothing(spark):
    df = spark.createDataFrame([], "k string, x double")
    assert Q.exact_quantiles(df, "x", WANTED, ["k"]).count() == 0


def test_rank_is_exact_decimal(spark):
    """0.07 * 100 is 7.000000000000001 in binary; the rank is 7."""
    df = spark.range(1, 101).selectExpr("CAST(id AS double) AS x")
    assert Q.exact_quantiles(df, "x", {"p": 0.07}).first()["p"] == 7.0


@pytest.mark.parametrize("error", [0.01, 0.001])
def test_approximate_rank_error_is_bounded(spark, error):
    n = 20000
    df = spark.range(1, n + 1, 1, 8).selectExpr("CAST(id AS double) AS x")
    row = Q.quantiles(df, "x", {"q1": 0.25, "q3": 0.75}, relative_error=error).first()
    assert abs(row["q1"] - 0.25 * n) <= error * n + 1
    assert abs(row["q3"] - 0.75 * n) <= error * n + 1


def test_invalid_probability(spark):
    with pytest.raises(ValueError):
        Q.exact_quantiles(spark.range(3).selectExpr("CAST(id AS double) AS x"), "x", {"p": 1.5}).collect()
