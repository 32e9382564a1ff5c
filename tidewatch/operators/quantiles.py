"""Quantiles per group: a mergeable sketch, or an exact answer that no single task has to hold.

The exact form is a radix selection on an order-preserving integer image of the doubles. Values are
counted by the ten highest bits in which a bucket's bounds differ, the bucket that holds the wanted rank is taken,
and this repeats until the bucket is small, after seven rounds at most; only its values are then ordered.
What is shuffled is bucket counts and, at the end, the values of one small bucket per group, never
the group itself. Scale and sign of the values do not matter.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.shared import durable
from tidewatch.functions import discrete_rank, numeric
from tidewatch.operators.joins import keyed_join
from tidewatch.operators.sketches import grouped_sketches, sketch_quantile

# Bits of a digit, so 1024 buckets; an image has 63 bits.
DIGIT_BITS = 10
# A bucket this small is cheaper to order than to narrow once more.
MAX_BUCKET_ROWS = 16_384


def quantiles(
    df: DataFrame,
    column: str,
    probabilities: Mapping[str, float],
    group_by: Sequence[str] = (),
    relative_error: float = 0.01,
) -> DataFrame:
    """One row per group with a column per named probability; NULL and NaN are ignored.

    ``relative_error`` bounds the rank error as a share of the group; 0 asks for the exact
    discrete quantile. Without ``group_by`` there is one row for the whole frame.
    """
    if relative_error <= 0:
        return exact_quantiles(df, column, probabilities, group_by)
    # The rank error of a KLL sketch is about 2.3 / size with 99 % confidence; this leaves room for the rest.
    size = min(65_535, max(200, round(4 / relative_error)))
    summary = grouped_sketches(df, column, list(group_by), size=size)
    return summary.select(
        *group_by, *[sketch_quantile(F.col("sketch"), p).alias(name) for name, p in probabilities.items()]
    )


def exact_quantiles(
    df: DataFrame,
    column: str,
    probabilities: Mapping[str, float],
    group_by: Sequence[str] = (),
    max_bucket_rows: int = MAX_BUCKET_ROWS,
    digit_bits: int = DIGIT_BITS,
) -> DataFrame:
    """Exact discrete quantiles (the smallest value whose rank reaches ``ceil(p * n)``)."""
    keys = list(group_by)
    data = df.select(*keys, numeric(F.col(column)).alias("__x")).filter(F.col("__x").isNotNull())
    bounds = durable(
        data.groupBy(*keys).agg(
            F.count("*").alias("rows"), F.min("__x").alias("lo"), F.max("__x").alias("hi")
        )
    )
    targets = bounds.select(
        *keys,
        F.explode(
            F.array(*[
                F.struct(F.lit(i).alias("slot"), discrete_rank(p, F.col("rows")).alias("rank"))
                for i, p in enumerate(probabilities.values())
            ])
        ).alias("__target"),
        "lo", "hi", "rows",
    ).select(*keys, "__target.slot", "__target.rank", "lo", "hi", "rows")
    targets = durable(targets)
    # Two values can share an image; a bucket of one image is ordered whatever its rows, which its counts collapse.
    large = (ordered_image(F.col("lo")) < ordered_image(F.col("hi"))) & (F.col("rows") > max_bucket_rows)
    # Every round takes a digit off the bits that the bounds of a bucket differ in.
    while not targets.filter(large).isEmpty():
        narrowed = _narrow(data, targets.filter(large), keys, digit_bits)
        targets = durable(targets.filter(~large).unionByName(narrowed))

    open_targets = targets.filter(F.col("lo") < F.col("hi"))
    inside = _inside(data, open_targets, keys)
    counts = inside.groupBy(*keys, "slot", "rank", "__x").agg(F.count("*").alias("rows"))
    ordered = Window.partitionBy(*keys, "slot").orderBy("__x")
    reached = counts.withColumn("__upto", F.sum("rows").over(ordered)).filter(F.col("__upto") >= F.col("rank"))
    found = reached.groupBy(*keys, "slot").agg(F.min("__x").alias("__q"))
    settled = targets.filter(F.col("lo") >= F.col("hi")).select(*keys, "slot", F.col("lo").alias("__q"))
    return (
        settled.unionByName(found)
        .groupBy(*keys)
        .agg(*[
            F.max(F.when(F.col("slot") == i, F.col("__q"))).alias(name)
            for i, name in enumerate(probabilities)
        ])
    )


def quantiles_of_counts(
    counts: DataFrame,
    value: str,
    rows: str,
    probabilities: Mapping[str, float],
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Exact discrete quantiles from a table of (group, value, rows), one row per value."""
    keys = list(group_by)
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    ranked = counts.select(
        *keys, value,
        F.sum(rows).over(group.orderBy(value)).alias("__upto"),
        F.sum(rows).over(group).alias("__all"),
    )
    return ranked.groupBy(*keys).agg(*[
        F.min(F.when(F.col("__upto") >= discrete_rank(p, F.col("__all")), F.col(value))).alias(name)
        for name, p in probabilities.items()
    ])


def ordered_image(x: Column) -> Column:
    """A long in the order of the doubles: sign and the 63-bit magnitude of their bits, halved. Infinities are ends.

    The exponent is guessed by the logarithm and corrected; powers of two are exact in Java, so the rest is too.
    """
    a = F.abs(x)
    guess = F.greatest(F.lit(-1022.0), F.least(F.lit(1023.0), F.floor(F.log2(a)).cast("double")))
    scaled = a * F.pow(F.lit(2.0), -guess)
    exponent = F.when(scaled >= 2, guess + 1).when((scaled < 1) & (guess > -1022), guess - 1).otherwise(guess)
    mantissa = F.when(scaled >= 2, scaled / 2).when((scaled < 1) & (guess > -1022), scaled * 2).otherwise(scaled)
    # The leading 1 of a normal number's mantissa adds one to the exponent field; numbers below them have none.
    bits = (exponent + 1022).cast("bigint") * F.lit(1 << 51) + F.floor(mantissa * float(1 << 51)).cast("bigint")
    finite = F.when(a == 0, F.lit(0).cast("bigint")).otherwise(bits)
    magnitude = F.when(a == float("inf"), F.lit(2047 << 51)).otherwise(finite)
    return F.when(x < 0, -magnitude).otherwise(magnitude)


def _narrow(data: DataFrame, targets: DataFrame, keys: list[str], digit_bits: int) -> DataFrame:
    """Each target's bucket that holds its rank, with the rank counted from that bucket."""
    low, high = ordered_image(F.col("lo")), ordered_image(F.col("hi"))
    shift = F.greatest(F.lit(0), F.length(F.bin(high - low)) - digit_bits)
    sides = targets.withColumns({"__low": low, "__shift": shift})
    bucket = F.call_function("shiftright", ordered_image(F.col("__x")) - F.col("__low"), F.col("__shift"))
    histogram = (
        _inside(data, sides, keys, ["__low", "__shift"])
        .select(*keys, "slot", "rank", bucket.alias("__bucket"), "__x")
        .groupBy(*keys, "slot", "rank", "__bucket")
        .agg(F.count("*").alias("rows"), F.min("__x").alias("lo"), F.max("__x").alias("hi"))
    )
    ordered = Window.partitionBy(*keys, "slot").orderBy("__bucket")
    before = F.col("__upto") - F.col("rows")
    return (
        histogram.withColumn("__upto", F.sum("rows").over(ordered))
        .filter((before < F.col("rank")) & (F.col("rank") <= F.col("__upto")))
        .select(*keys, "slot", (F.col("rank") - before).alias("rank"), "lo", "hi", "rows")
    )


def _inside(data: DataFrame, targets: DataFrame, keys: list[str], more: Sequence[str] = ()) -> DataFrame:
    """Rows of ``data`` with the targets whose value range they fall into."""
    in_range = F.col("__x").between(F.col("lo"), F.col("hi"))
    side = targets.select(*keys, "slot", "rank", "lo", "hi", *more)
    if keys:
        return keyed_join(data, side, keys, null_safe=True).filter(in_range)
    # One group: at most one target per probability, so the ranges become literals that reach the scan.
    rows = side.collect()
    if not rows:
        return data.select(
            "__x", F.lit(0).alias("slot"), F.lit(0).alias("rank"),
            F.col("__x").alias("lo"), F.col("__x").alias("hi"), *[F.lit(0).alias(c) for c in more],
        ).filter(F.lit(False))
    literals = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in row.asDict().items()]) for row in rows])
    any_range = reduce(Column.__or__, [F.col("__x").between(row["lo"], row["hi"]) for row in rows])
    return (
        data.filter(any_range)
        .select("__x", F.explode(literals).alias("__target"))
        .select("__x", "__target.*")
        .filter(in_range)
    )
