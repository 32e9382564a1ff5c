"""Window and daily aggregates. Partial aggregation on the map side keeps their shuffles small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.shared import durable
from tidewatch.functions import numeric, sample_mean, sample_sigma
from tidewatch.operators.joins import Sized, keyed_join
from tidewatch.operators.sketches import (
    SKETCH_SIZE,
    grouped_sketches,
    merged_sketches,
    quantile_sketch,
    sketch_quantile,
)
from tidewatch.schema import GROUP_KEYS, MIN_DAILY_EVENTS, PERCENTILE, WINDOW_LENGTH

PROOF_DIVISOR = 1024


def window_aggregates(
    events: DataFrame, length: str = WINDOW_LENGTH, duration_percentile: float | None = None, sketch: bool = False
) -> DataFrame:
    """Count, mean, min and max per tumbling event-time window and device type (batch or stream).

    ``sketch`` adds ``duration_sketch``, from which longer spans get their percentiles without the events (see
    :func:`roll_up_percentiles`); ``duration_percentile`` the window's own, from the same sketch.
    """
    measures = [
        F.count("*").alias("event_count"),
        F.avg("event_duration").alias("avg_duration"),
        F.min("event_duration").alias("min_duration"),
        F.max("event_duration").alias("max_duration"),
        F.avg("value").alias("avg_value"),
    ]
    if duration_percentile is None and not sketch:
        return events.groupBy(F.window("timestamp", length), "device_type").agg(*measures)
    measures.append(quantile_sketch(F.col("event_duration")).alias("duration_sketch"))
    windows = events.groupBy(F.window("timestamp", length), "device_type").agg(*measures)
    if duration_percentile is not None:
        windows = windows.withColumn("percentile_duration", sketch_quantile(F.col("duration_sketch"), duration_percentile))
    return windows if sketch else windows.drop("duration_sketch")


def group_spread(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """mu, sigma and row count per group."""
    x = F.col(column)
    return df.groupBy(*keys).agg(
        sample_mean(x).alias("mu"), sample_sigma(x).alias("sigma"), F.count("*").alias("rows")
    )


def compute_daily_statistics(
    df: DataFrame,
    value: str = "avg_duration",
    distinct: str = "window_start",
    keys: Sequence[str] = GROUP_KEYS,
) -> DataFrame:
    """mu, sigma, exact distinct count and row count per device type and day."""
    x = F.col(value)
    return df.groupBy(*keys).agg(
        sample_mean(x).alias("mu"),
        sample_sigma(x).alias("sigma"),
        F.count_distinct(distinct).alias("distinct_events"),
        F.count("*").alias("total_windows"),
    )


def qualified_spread(
    df: DataFrame,
    value: str,
    distinct: str,
    min_events: int = MIN_DAILY_EVENTS,
    keys: Sequence[str] = GROUP_KEYS,
    proof_divisor: int = PROOF_DIVISOR,
) -> Sized:
    """mu, sigma and rows of every group, and whether it is ``qualified`` by ``min_events`` ids.

    The gate only asks whether a count reaches a bound, so shuffling every id is wasteful. The
    distinct ids that fall in one of ``proof_divisor`` hash classes are a lower bound of all
    distinct ids: a group that reaches ``min_events`` with them alone has proven itself, and a
    group with fewer rows than that cannot qualify. All ids are counted exactly for the groups
    that are still open, which are those with few ids. The result is exact for any divisor.

    The recount of open groups is lazy when the result may be broadcast; make the result durable
    before using it more than once.
    """
    keys = list(keys)
    x, identifier = F.col(value), F.col(distinct)
    in_class = F.pmod(F.xxhash64(identifier), F.lit(proof_divisor)) == 0
    spread = durable(
        df.groupBy(*keys).agg(
            sample_mean(x).alias("mu"),
            sample_sigma(x).alias("sigma"),
            F.count("*").alias("rows"),
            F.count_distinct(F.when(in_class, identifier)).alias("proven"),
        )
    )
    sized = Sized.of(spread)
    measures = [*keys, "mu", "sigma", "rows"]
    is_proven = F.col("proven") >= min_events
    open_groups = spread.filter((F.col("rows") >= min_events) & ~is_proven).select(*keys)
    if open_groups.isEmpty():
        return sized.part(spread.select(*measures, is_proven.alias("qualified")))
    passed = (
        keyed_join(
            df.select(*keys, distinct), sized.part(open_groups), keys, null_safe=True
        )
        .groupBy(*keys)
        .agg(F.count_distinct(distinct).alias("distinct_events"))
        .filter(F.col("distinct_events") >= min_events)
        .select(*keys, F.lit(True).alias("__passed"))
    )
    if not sized.fits:
        passed = durable(passed)
    decided = keyed_join(
        spread, sized.part(passed), keys, how="left", null_safe=True
    )
    qualified = is_proven | F.coalesce(F.col("__passed"), F.lit(False))
    return sized.part(decided.select(*measures, qualified.alias("qualified")))


def compute_percentiles(
    df_clean: DataFrame,
    value: str = "avg_duration",
    q: float = PERCENTILE,
    keys: Sequence[str] = GROUP_KEYS,
    size: int = SKETCH_SIZE,
) -> DataFrame:
    """Approximate percentile, count and means per group, ordered by day and device type.

    The percentile comes from KLL sketches merged in two steps, so that no task merges a hot group's sketches of
    all map tasks; groups of up to about ``size`` values are exact.
    """
    means = {"avg_duration": value, "mean_duration": "mu", "stddev_duration": "sigma"}
    sums = {"total_events": F.lit(1)}
    for name, column in means.items():
        sums[f"__sum_{name}"], sums[f"__n_{name}"] = F.col(column).cast("double"), F.col(column).isNotNull().cast("bigint")
    summed = grouped_sketches(df_clean, value, keys, sums, size)
    return order_by_day(
        summed.select(
            *keys,
            sketch_quantile(F.col("sketch"), q).alias("p95_duration"),
            "total_events",
            *[F.try_divide(F.col(f"__sum_{name}"), F.col(f"__n_{name}")).alias(name) for name in means],
        )
    )


def order_by_day(result: DataFrame) -> DataFrame:
    """The report in order of day and device type.

    A global sort samples its input first, which would run the final aggregation a second time.
    The shuffle in between keeps the few finished rows, and the sample reads those.
    """
    return result.repartition("date").orderBy("date", "device_type")


def preview(result: DataFrame, rows: int = 10) -> DataFrame:
    """The first rows of an ordered result; the sort becomes a top-k."""
    return result.limit(rows)


def roll_up_windows(windows: DataFrame, keys: Sequence[str] = GROUP_KEYS) -> DataFrame:
    """Windows to days, with means weighted by the events behind each window.

    A window whose mean is NULL has no usable events and adds no weight to that mean.
    """
    def weighted(column: str) -> Column:
        mean = numeric(F.col(column))
        weight = F.when(mean.isNotNull(), F.col("event_count"))
        return F.try_divide(F.sum(mean * F.col("event_count")), F.sum(weight)).alias(column)

    return windows.groupBy(*keys).agg(
        F.sum("event_count").alias("event_count"),
        weighted("avg_duration"),
        F.min("min_duration").alias("min_duration"),
        F.max("max_duration").alias("max_duration"),
        weighted("avg_value"),
    )


def roll_up_percentiles(
    windows: DataFrame, q: float = PERCENTILE, keys: Sequence[str] = GROUP_KEYS, sketch: str = "duration_sketch"
) -> DataFrame:
    """The percentile of the events behind the windows of each group, from the windows' sketches only."""
    return merged_sketches(windows, sketch, keys).select(*keys, sketch_quantile(F.col(sketch), q).alias("p95_duration"))


def non_null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the non-null count of each column."""
    return df.agg(*[F.count(c).alias(c) for c in columns])
