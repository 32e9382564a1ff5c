"""Outlier flags and removal: sigma per group, z-score, interquartile range and percentile band.

Statistics are computed once, as a keyed table that is joined back or, for the whole frame, as a
scalar subquery. A row's flag is NULL when its value is NULL or the statistic does not exist.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.shared import durable
from tidewatch.functions import beyond_sigma
from tidewatch.operators.aggregate import group_spread
from tidewatch.operators.filters import keep_inliers
from tidewatch.operators.joins import Sized, keyed_join
from tidewatch.operators.quantiles import quantiles
from tidewatch.schema import GROUP_KEYS, SIGMA_LIMIT


def is_outlier_3sigma(
    df: DataFrame, column: str, group_by: str | Sequence[str], k: float = SIGMA_LIMIT
) -> DataFrame:
    """Adds mu and sigma of the row's group and ``is_outlier``. Rows with a NULL key are a group."""
    keys = [group_by] if isinstance(group_by, str) else list(group_by)
    spread = durable(group_spread(df, column, keys))
    joined = keyed_join(
        df, spread.select(*keys, "mu", "sigma"), keys, null_safe=True
    )
    return joined.withColumn("is_outlier", beyond_sigma(F.col(column), F.col("mu"), F.col("sigma"), k))


def detect_outliers_zscore(
    df: DataFrame, column: str, threshold: float = 3.0, group_by: Sequence[str] = ()
) -> DataFrame:
    """Adds ``is_outlier_zscore``: further than ``threshold`` sigmas from the mean."""
    spread = group_spread(df, column, group_by)
    return _flag(
        df, spread, ["mu", "sigma"], group_by, "is_outlier_zscore",
        lambda s: beyond_sigma(F.col(column), s["mu"], s["sigma"], threshold),
    )


def detect_outliers_iqr(
    df: DataFrame,
    column: str,
    multiplier: float = 1.5,
    group_by: Sequence[str] = (),
    relative_error: float = 0.01,
) -> DataFrame:
    """Adds ``is_outlier_iqr``: outside the quartiles widened by ``multiplier`` times their range."""
    quartiles = quantiles(df, column, {"q1": 0.25, "q3": 0.75}, group_by, relative_error)

    def outside(s: Mapping[str, Column]) -> Column:
        reach = F.lit(float(multiplier)) * (s["q3"] - s["q1"])
        return _outside(F.col(column), s["q1"] - reach, s["q3"] + reach)

    return _flag(df, quartiles, ["q1", "q3"], group_by, "is_outlier_iqr", outside)


def detect_outliers_percentile(
    df: DataFrame,
    column: str,
    lower_pct: float = 0.01,
    upper_pct: float = 0.99,
    group_by: Sequence[str] = (),
    relative_error: float = 0.01,
) -> DataFrame:
    """Adds ``is_outlier_percentile``: outside the band between two percentiles."""
    band = quantiles(df, column, {"lower": lower_pct, "upper": upper_pct}, group_by, relative_error)
    return _flag(
        df, band, ["lower", "upper"], group_by, "is_outlier_percentile",
        lambda s: _outside(F.col(column), s["lower"], s["upper"]),
    )


def remove_outliers(
    df: DataFrame,
    stats: DataFrame | Sized,
    value: str = "avg_duration",
    keys: Sequence[str] = GROUP_KEYS,
    k: float = SIGMA_LIMIT,
) -> DataFrame:
    """Rows of the groups in ``stats`` that lie within ``k`` sigma, with their mu and sigma.

    Unmeasured ``stats`` are read more than once; pass a durable frame when they are costly.
    """
    columns = [*keys, "mu", "sigma"]
    side = stats.part(stats.frame.select(*columns)) if isinstance(stats, Sized) else stats.select(*columns)
    return keep_inliers(keyed_join(df, side, keys), value, k)


def _outside(x: Column, low: Column, high: Column) -> Column:
    return (x < low) | (x > high)


def _flag(df, stats, names, group_by, flag, predicate) -> DataFrame:
    """Add ``flag`` from per-group statistics, or from a one-row frame when there are no groups."""
    keys = list(group_by)
    if not keys:
        whole = stats.select(F.struct(*names).alias("__s")).scalar()
        return df.withColumn(flag, predicate({name: whole[name] for name in names}))
    hidden = {name: f"__{name}" for name in names}
    side = durable(stats.select(*keys, *names)).withColumnsRenamed(hidden)
    joined = keyed_join(df, side, keys, null_safe=True)
    return joined.withColumn(flag, predicate({n: F.col(h) for n, h in hidden.items()})).drop(*hidden.values())
