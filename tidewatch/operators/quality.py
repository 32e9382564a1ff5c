"""Data-quality rules as Column predicates, a one-pass report, and the valid/rejected split."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import functions as E
from tidewatch.schema import (
    DEVICE_ID_PATTERN,
    DEVICE_TYPES,
    DURATION_RANGE_MS,
    EVENT_SCHEMA,
    FIRMWARE_PATTERN,
    LOCATION_PATTERN,
    REQUIRED_EVENT_COLUMNS,
    REQUIRED_RESULT_COLUMNS,
    STATUSES,
)


@dataclass(frozen=True)
class Rule:
    """A named check of one column; ``failure`` builds the predicate that is true for bad rows."""

    name: str
    column: str
    failure: Callable[[], Column]

    @property
    def label(self) -> str:
        return f"{self.name}:{self.column}"

    def failed(self) -> Column:
        return F.coalesce(self.failure(), F.lit(False))


def not_null(column: str) -> Rule:
    return Rule("not_null", column, lambda: F.col(column).isNull())


def non_negative(column: str) -> Rule:
    """Only values below zero fail; zero and NULL pass."""
    return Rule("non_negative", column, lambda: F.col(column) < 0)


def in_range(column: str, low: float, high: float) -> Rule:
    """Bounds included; NULL passes."""
    return Rule("range", column, lambda: ~F.col(column).between(low, high))


def one_of(column: str, values: Sequence[str]) -> Rule:
    """NULL passes."""
    return Rule("one_of", column, lambda: ~F.col(column).isin(*values))


def matches(column: str, pattern: str) -> Rule:
    """NULL passes."""
    return Rule("pattern", column, lambda: ~F.col(column).rlike(pattern))


def uuid_form(column: str, strict: bool = True) -> Rule:
    """NULL passes; combine with :func:`not_null`."""
    return Rule("uuid", column, lambda: F.col(column).isNotNull() & ~E.is_uuid(F.col(column), strict))


def entry_matches(column: str, key: str, pattern: str) -> Rule:
    """The map must have ``key``, and its text must match; a NULL map passes."""
    def failure() -> Column:
        entry = E.map_entry(F.col(column), key)
        return F.col(column).isNotNull() & (entry.isNull() | ~entry.rlike(pattern))

    return Rule(f"entry_{key}", column, failure)


def date_time(column: str) -> Rule:
    """Raw text must be a full date and time with a zone (RFC 3339) that exists; NULL passes."""
    return Rule("date_time", column, lambda: F.col(column).isNotNull() & E.parse_event_time(column).isNull())


def contract_rules(decoded: bool = True) -> list[Rule]:
    """Every rule of the event contract, as data.

    Events that are not ``decoded`` still have their time as text, which then has a rule of its own;
    in decoded ones unreadable text is NULL and fails as missing.
    """
    return [
        *([] if decoded else [date_time("timestamp")]),
        *[not_null(name) for name in EVENT_SCHEMA.names],
        uuid_form("event_id"),
        matches("device_id", DEVICE_ID_PATTERN),
        one_of("device_type", DEVICE_TYPES),
        in_range("event_duration", *DURATION_RANGE_MS),
        one_of("status", STATUSES),
        entry_matches("metadata", "location", LOCATION_PATTERN),
        entry_matches("metadata", "firmware", FIRMWARE_PATTERN),
    ]


def ingest_rules(strict: bool = True, device_types: Sequence[str] = DEVICE_TYPES) -> list[Rule]:
    """The shorter check made before an event is published; it does not look at metadata."""
    required = [name for name in EVENT_SCHEMA.names if name != "metadata"]
    return [
        *[not_null(name) for name in required],
        uuid_form("event_id", strict),
        non_negative("event_duration"),
        one_of("device_type", device_types),
    ]


def any_failed(rules: Iterable[Rule]) -> Column:
    return reduce(Column.__or__, [rule.failed() for rule in rules], F.lit(False))


def with_validity(df: DataFrame, rules: Iterable[Rule], column: str = "is_valid") -> DataFrame:
    return df.withColumn(column, ~any_failed(rules))


def with_reject_reasons(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Adds ``reject_reasons``, the labels of the failed rules in rule order."""
    reasons = F.array_compact(F.array(*[F.when(r.failed(), F.lit(r.label)) for r in rules]))
    return df.withColumn("reject_reasons", reasons)


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with ``reject_reasons``); works on batches and streams."""
    bad = any_failed(rules)
    return df.filter(~bad), with_reject_reasons(df.filter(bad), rules)


def quality_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule, from a single aggregation over ``df``."""
    counted = df.agg(
        F.count("*").alias("total_rows"),
        *[F.count_if(rule.failed()).alias(f"f{i}") for i, rule in enumerate(rules)],
    )
    lines = F.array(*[
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.lit(rule.column).alias("column"),
            F.col(f"f{i}").alias("failed_rows"),
        )
        for i, rule in enumerate(rules)
    ])
    return counted.select("total_rows", F.explode(lines).alias("line")).select(
        "line.rule", "line.column", "line.failed_rows", "total_rows",
        (F.col("line.failed_rows") == 0).alias("passed"),
    )


def holds(df: DataFrame, rules: Sequence[Rule]) -> bool:
    """Whether no row of ``df`` fails any rule (one job)."""
    return df.filter(any_failed(rules)).isEmpty()


def validate_no_nulls(df: DataFrame, columns: Sequence[str]) -> bool:
    return holds(df, [not_null(c) for c in columns])


def validate_positive_values(df: DataFrame, columns: Sequence[str]) -> bool:
    """False when a value is below zero; zero and NULL are accepted."""
    return holds(df, [non_negative(c) for c in columns])


def validate_range(df: DataFrame, column: str, min_val: float, max_val: float) -> bool:
    return holds(df, [in_range(column, min_val, max_val)])


def missing_columns(df: DataFrame, expected: Iterable[str]) -> list[str]:
    return sorted(set(expected) - set(df.columns))


def extra_columns(df: DataFrame, expected: Iterable[str]) -> list[str]:
    return sorted(set(df.columns) - set(expected))


def mistyped_columns(df: DataFrame, expected: T.StructType) -> list[str]:
    """Columns of ``expected`` that ``df`` has with another type."""
    actual = {f.name: f.dataType for f in df.schema}
    return sorted(f.name for f in expected if f.name in actual and actual[f.name] != f.dataType)


def schema_report(df: DataFrame, expected: T.StructType | Iterable[str]) -> DataFrame:
    """A row for every column that is expected or there: its status, its values and all rows.

    ``status`` is ok, missing, mistyped (only if ``expected`` has types) or extra. The values of all columns
    are counted in one aggregation.
    """
    names = expected.names if isinstance(expected, T.StructType) else list(expected)
    mistyped = mistyped_columns(df, expected) if isinstance(expected, T.StructType) else []
    status = {name: "missing" if name not in df.columns else "mistyped" if name in mistyped else "ok" for name in names}
    status |= dict.fromkeys(extra_columns(df, names), "extra")
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count(F.col(f"`{name}`") if name in df.columns else F.lit(None)).alias(f"n{i}") for i, name in enumerate(status)],
    )
    lines = F.array(*[
        F.struct(F.lit(name).alias("column"), F.lit(kind).alias("status"), F.col(f"n{i}").alias("present_rows"))
        for i, (name, kind) in enumerate(status.items())
    ])
    return counted.select("total_rows", F.explode(lines).alias("line")).select("line.*", "total_rows")


def validate_schema(df: DataFrame, expected_columns: Iterable[str] = REQUIRED_EVENT_COLUMNS) -> bool:
    """Whether every expected column exists; extra columns are no error."""
    return not missing_columns(df, expected_columns)


def validate_results(result: DataFrame) -> bool:
    """True, or ValueError naming the missing columns or the columns with NULLs."""
    missing = missing_columns(result, REQUIRED_RESULT_COLUMNS)
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    rules = [not_null(c) for c in ("device_type", "date", "p95_duration")]
    bad = quality_report(result, rules).filter(~F.col("passed")).collect()
    if bad:
        raise ValueError("NULLs in " + ", ".join(f"{r['column']} ({r['failed_rows']})" for r in bad))
    return True
