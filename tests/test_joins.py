"""Keyed joins: same rows whether the side is broadcast, shuffled, or split by hot keys."""

from __future__ import annotations

import pytest

from tests.conftest import plan_of, rows_of
from tidewatch.operators import joins


def skewed(spark):
    """One key holds a third of the rows, one is NULL, some match nothing."""
    rows = [("hot", i) for i in range(1500)] + [(f"k{i % 1500}", i) for i in range(2900)]
    rows += [(None, i) for i in range(100)]
    side = [("hot", 1.0), (None, 2.0)] + [(f"k{i}", float(i)) for i in range(0, 1500, 2)]
    return spark.createDataFrame(rows, "k string, n int"), spark.createDataFrame(side, "k string, v double")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_paths_agree(spark, how, null_safe):
    fact, side = skewed(spark)
    small = rows_of(joins.keyed_join(fact, side, ["k"], how, null_safe))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = joins.keyed_join(fact, side, ["k"], how, null_safe)
        assert rows_of(wide) == small
        assert wide.columns == ["k", "n", "v"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760b")
    matched = 1500 + 1450 + (100 if null_safe else 0)
    assert len(small) == (4500 if how == "left" else matched)


def test_wide_sides_are_shuffled_with_one_read_of_the_fact(no_broadcast, tmp_path):
    fact, side = skewed(no_broadcast)
    fact.write.parquet(str(tmp_path / "fact"))
    fact = no_broadcast.read.parquet(str(tmp_path / "fact"))
    plan = plan_of(joins.keyed_join(fact, side, ["k"], "left", True))
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert plan.count("Scan parquet") == 2  # once in the tree and once in the details
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_many_null_columns_are_not_small(spark):
    row = "id AS k, " + ", ".join(f"CAST(NULL AS double) AS c{i}" for i in range(300))
    wide = spark.range(5000).selectExpr(*row.split(", "))
    assert joins.measured_bytes(wide) >= 5000 * 300 * 8
    assert not joins.fits_broadcast(wide)


def test_nested_and_unknown_types(spark):
    nested = spark.sql("SELECT map('a', array(1, 2)) AS m, named_struct('t', 'xyz') AS s, 1.5BD AS d")
    assert joins.measured_bytes(nested) > 100
    assert joins.measured_bytes(spark.sql("SELECT INTERVAL '1' MONTH AS i")) is None


def test_threshold_decides(spark):
    _, side = skewed(spark)
    assert joins.fits_broadcast(side)
    assert joins.measured_bytes(side) > 752 * joins.ROW_OVERHEAD_BYTES
    assert joins.measured_bytes(side.limit(0)) == 0
    for text, expected in [("10485760b", 10485760), ("10MB", 10 << 20), ("64k", 64 << 10), ("-1", -1), ("5", 5), ("1p", 1 << 50)]:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
        assert joins.broadcast_limit(spark) == expected
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100b")
    assert not joins.fits_broadcast(side)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760b")


def test_dimension_join_keeps_every_row(spark):
    fact, side = skewed(spark)
    joined = joins.join_dimension(fact, side.withColumnRenamed("k", "dim_key"), "k", "dim_key")
    assert joined.count() == 4500
    assert joined.columns == ["k", "n", "v"]
