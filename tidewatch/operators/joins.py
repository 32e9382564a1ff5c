"""Equi-joins of a large table with a keyed side whose size is measured before it is broadcast."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Upper bounds for what a row and a value take in memory besides their content.
ROW_OVERHEAD_BYTES = 48
VALUE_BYTES = 16

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}
_FLAT_TYPES = {
    "boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz", "void",
}


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; negative means never."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    match = re.fullmatch(r"(-?\d+)\s*([kmgtp]?)(?:i?b)?", text)
    if match is None:
        raise ValueError(f"spark.sql.autoBroadcastJoinThreshold is not a size: {text}")
    return int(match[1]) * _UNITS[match[2]]


def _value_bytes(column: Column, kind: T.DataType) -> Column:
    """Upper bound of the bytes of one value, NULL or not, by its type."""
    flat = F.lit(VALUE_BYTES)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return flat + F.coalesce(F.octet_length(column), F.lit(0))
    if isinstance(kind, T.ArrayType):
        inner = lambda total, x: total + _value_bytes(x, kind.elementType)
        return flat + F.coalesce(F.aggregate(column, F.lit(0), inner), F.lit(0))
    if isinstance(kind, T.MapType):
        keys, values = T.ArrayType(kind.keyType), T.ArrayType(kind.valueType)
        return flat + _value_bytes(F.map_keys(column), keys) + _value_bytes(F.map_values(column), values)
    if isinstance(kind, T.StructType):
        return reduce(Column.__add__, [_value_bytes(column[f.name], f.dataType) for f in kind.fields], flat)
    return flat if kind.simpleString() in _FLAT_TYPES or isinstance(kind, T.DecimalType) else F.lit(None)


def measured_bytes(df: DataFrame) -> int | None:
    """Upper bound of the rows' size, from one aggregate; None if a type has no bound here."""
    bounds = F.array(*[_value_bytes(F.col(f"`{f.name}`"), f.dataType).cast("bigint") for f in df.schema.fields])
    width = F.aggregate(bounds, F.lit(ROW_OVERHEAD_BYTES).cast("bigint"), lambda total, x: total + x)
    total, unbounded = df.agg(F.sum(width), F.count_if(width.isNull())).first()
    return None if unbounded else total or 0


def fits_broadcast(df: DataFrame) -> bool:
    limit = broadcast_limit(df.sparkSession)
    if limit <= 0:
        return False
    size = measured_bytes(df)
    return size is not None and size <= limit


@dataclass(frozen=True)
class Sized:
    """A keyed side with the verdict of its measurement: whether it may be broadcast."""

    frame: DataFrame
    fits: bool

    @classmethod
    def of(cls, frame: DataFrame) -> Sized:
        return cls(frame, fits_broadcast(frame))

    def part(self, frame: DataFrame) -> Sized:
        """``frame``, made of rows and columns of this side, under the same verdict."""
        return Sized(frame, self.fits)


def keyed_join(
    fact: DataFrame,
    side: DataFrame | Sized,
    keys: Sequence[str],
    how: str = "inner",
    null_safe: bool = False,
) -> DataFrame:
    """Join ``fact`` with ``side``, which has one row (or a fixed few rows) per key.

    An unmeasured ``side`` is read more than once, so pass a table or a
    :func:`~tidewatch.shared.durable` result. If its measured size is within the session's broadcast
    threshold, it is broadcast and ``fact`` is not shuffled. Otherwise both are shuffled once, and
    adaptive execution splits the partitions of hot keys, which it can do because a table or a
    durable result is an exchange of its own.
    """
    keys = list(keys)
    sized = side if isinstance(side, Sized) else Sized.of(side)
    return _join(fact, F.broadcast(sized.frame) if sized.fits else sized.frame, keys, how, null_safe)


def _join(left: DataFrame, right: DataFrame, keys: list[str], how: str, null_safe: bool) -> DataFrame:
    names = {key: f"__key_{i}" for i, key in enumerate(keys)}
    right = right.withColumnsRenamed(names)
    pairs: list[Column] = [
        F.col(key).eqNullSafe(F.col(name)) if null_safe else F.col(key) == F.col(name)
        for key, name in names.items()
    ]
    return left.join(right, reduce(Column.__and__, pairs), how).drop(*names.values())


def join_dimension(fact: DataFrame, dimension: DataFrame, key: str, dimension_key: str) -> DataFrame:
    """Left join with a dimension table that has one row per ``dimension_key``."""
    if dimension_key != key:
        dimension = dimension.withColumnRenamed(dimension_key, key)
    return keyed_join(fact, dimension, [key], how="left")
