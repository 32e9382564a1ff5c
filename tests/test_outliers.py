"""Sigma, z-score, interquartile and percentile outliers; edges of each."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tidewatch.operators import aggregate, outliers

NAN = float("nan")


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, x double")


def flags(df, flag):
    return {(r["k"], r["x"]): r[flag] for r in df.collect()}


def test_planted_outlier_is_flagged(spark):
    rows = [("a", float(i % 5)) for i in range(30)] + [("a", 100.0), ("b", 100.0), ("b", 101.0)]
    found = flags(outliers.is_outlier_3sigma(frame(spark, rows), "x", "k"), "is_outlier")
    assert found[("a", 100.0)] is True
    assert sum(v is True for v in found.values()) == 1


@pytest.mark.parametrize("value,n", [(0.1, 3), (1.1, 1000)])
def test_constant_group_has_no_outliers(spark, value, n):
    df = frame(spark, [("a", value)] * n).repartition(4)
    flagged = outliers.is_outlier_3sigma(df, "x", "k")
    assert [tuple(r) for r in flagged.groupBy("mu", "sigma", "is_outlier").count().collect()] == [(value, 0.0, False, n)]
    assert outliers.detect_outliers_zscore(df, "x").filter("is_outlier_zscore").count() == 0
    stats = aggregate.group_spread(df, "x", ["k"])
    assert outliers.remove_outliers(df, stats, "x", keys=["k"]).count() == n


def test_single_row_group_has_no_sigma(spark):
    df = frame(spark, [("one", 5.0)])
    assert outliers.is_outlier_3sigma(df, "x", "k").first()["is_outlier"] is None
    assert outliers.remove_outliers(df, aggregate.group_spread(df, "x", ["k"]), "x", keys=["k"]).count() == 0


def test_null_key_is_a_group_of_its_own(spark):
    rows = [(None, float(i)) for i in range(5)] + [("a", 1.0), ("a", 3.0)]
    flagged = outliers.is_outlier_3sigma(frame(spark, rows), "x", "k")
    assert flagged.count() == 7
    assert flagged.filter("k IS NULL").first()["mu"] == 2.0


def test_null_value_gives_null_flag_in_all_detectors(spark):
    df = frame(spark, [("a", float(i)) for i in range(20)] + [("a", None)])
    for flagged, flag in [
        (outliers.is_outlier_3sigma(df, "x", "k"), "is_outlier"),
        (outliers.detect_outliers_zscore(df, "x"), "is_outlier_zscore"),
        (outliers.detect_outliers_iqr(df, "x"), "is_outlier_iqr"),
        (outliers.detect_outliers_percentile(df, "x"), "is_outlier_percentile"),
    ]:
        assert flagged.filter("x IS NULL").first()[flag] is None


def test_nan_does_not_void_its_group(spark):
    rows = [("a", float(i % 5)) for i in range(30)] + [("a", 100.0), ("a", NAN)]
    flagged = outliers.is_outlier_3sigma(frame(spark, rows), "x", "k")
    assert {("nan" if math.isnan(r["x"]) else r["x"]) for r in flagged.filter("is_outlier").collect()} == {100.0, "nan"}


@pytest.mark.parametrize("rows", [[], [("a", 1.0)]])
def test_no_statistic_gives_null_flags_and_no_error(spark, rows):
    df = frame(spark, rows)
    assert [r["is_outlier_zscore"] for r in outliers.detect_outliers_zscore(df, "x").collect()] == [None] * len(rows)
    outliers.detect_outliers_iqr(df, "x").collect()
    outliers.detect_outliers_percentile(df, "x", relative_error=0.0).collect()


def test_zscore_is_strict(spark):
    df = frame(spark, [("a", -1.0), ("a", 1.0), ("a", 0.0)])  # sigma is exactly 1
    found = flags(outliers.detect_outliers_zscore(df, "x", 1.0), "is_outlier_zscore")
    assert not any(found.values())
    assert sum(flags(outliers.detect_outliers_zscore(df, "x", 0.99), "is_outlier_zscore").values()) == 2


def test_iqr_fences(spark):
    df = frame(spark, [("a", float(i)) for i in range(1, 101)] + [("a", 151.0), ("a", -49.0), ("a", 500.0)])
    for error in (0.01, 0.0):
        found = flags(outliers.detect_outliers_iqr(df, "x", relative_error=error), "is_outlier_iqr")
        assert found[("a", 500.0)] is True
        assert found[("a", 50.0)] is False


def test_percentile_band(spark):
    df = frame(spark, [("a", float(i)) for i in range(1, 1001)])
    flagged = outliers.detect_outliers_percentile(df, "x", 0.01, 0.99, relative_error=0.0)
    assert flagged.filter("is_outlier_percentile").count() == 19  # below rank 10 and above rank 990


def test_grouped_detectors(spark):
    rows = [("a", float(i)) for i in range(50)] + [("b", float(i + 1000)) for i in range(50)] + [("b", 25.0)]
    df = frame(spark, rows)
    for call, options in [
        (outliers.detect_outliers_zscore, {}),
        (outliers.detect_outliers_iqr, {}),
        (outliers.detect_outliers_percentile, {"lower_pct": 0.1}),
    ]:
        flagged = call(df, "x", group_by=["k"], **options)
        flag = flagged.columns[-1]
        assert flagged.columns == ["k", "x", flag]
        assert flags(flagged, flag)[("b", 25.0)] is True
        assert flagged.count() == 101


def test_global_detectors_need_no_join(spark):
    df = frame(spark, [("a", float(i)) for i in range(50)])
    for call in (outliers.detect_outliers_zscore, outliers.detect_outliers_iqr):
        plan = plan_of(call(df, "x"))
        assert "Join" not in plan and "CartesianProduct" not in plan
        assert "Subquery" in plan


def test_removal_is_complement_of_flag(spark):
    rng = random.Random(7)
    rows = [(rng.choice("abc"), rng.gauss(0, 1) * (20 if rng.random() < 0.02 else 1)) for _ in range(2000)]
    df = frame(spark, rows)
    flagged = outliers.is_outlier_3sigma(df, "x", "k")
    kept = outliers.remove_outliers(df, aggregate.group_spread(df, "x", ["k"]), "x", keys=["k"])
    assert 0 < flagged.filter("is_outlier").count() == 2000 - kept.count()


def test_wide_groups_take_the_shuffle_path(no_broadcast):
    rows = [(f"k{i % 700}", float(i)) for i in range(2100)] + [("hot", float(i)) for i in range(1500)]
    df = frame(no_broadcast, rows)
    flagged = outliers.is_outlier_3sigma(df, "x", "k")
    assert flagged.count() == 3600
    expected = df.groupBy("k").agg(F.avg("x").alias("m"))
    got = flagged.groupBy("k").agg(F.max("mu").alias("m2"), F.min("mu").alias("m1"))
    joined = expected.join(got, "k")
    assert joined.count() == 701
    assert joined.filter("abs(m - m1) > 1e-9 OR abs(m - m2) > 1e-9").count() == 0
