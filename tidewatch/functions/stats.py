"""Aggregate and predicate expressions for means, sigmas and ranks."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def numeric(x: Column) -> Column:
    """``x`` as double with NaN turned into NULL, so that one NaN cannot void a group."""
    as_double = x.cast("double")
    return F.when(~F.isnan(as_double), as_double)


def sample_mean(x: Column) -> Column:
    """Mean without NaN. A group of equal values has exactly that value as its mean."""
    x = numeric(x)
    return F.when(F.min(x) == F.max(x), F.min(x)).otherwise(F.avg(x))


def sample_sigma(x: Column) -> Column:
    """Sample standard deviation without NaN: NULL below two values, exactly 0 for equal ones."""
    x = numeric(x)
    return F.when((F.count(x) > 1) & (F.min(x) == F.max(x)), F.lit(0.0)).otherwise(F.stddev_samp(x))


def beyond_sigma(x: Column, mu: Column, sigma: Column, k: float) -> Column:
    """``abs(x - mu) > k * sigma``, except that sigma 0 has no outliers. NULL input gives NULL."""
    return F.when(x.isNotNull(), (sigma > 0) & (F.abs(x - mu) > F.lit(float(k)) * sigma))


def within_sigma(x: Column, mu: Column, sigma: Column, k: float) -> Column:
    """The inclusive complement: true for inliers, NULL when undecidable."""
    return ~beyond_sigma(x, mu, sigma, k)


def discrete_rank(probability: float | str | Decimal, n: Column) -> Column:
    """1-based rank of the discrete quantile: ``max(1, ceil(p * n))`` in exact decimal arithmetic."""
    p = Decimal(str(probability))
    if not 0 <= p <= 1:
        raise ValueError(f"probability {probability} is outside [0, 1]")
    exact = F.ceil(F.lit(p) * n.cast("decimal(19,0)")).cast("bigint")
    return F.greatest(F.lit(1).cast("bigint"), exact)
