"""The registered queries: one Spark query per operator, with the SQL that must give the same rows.

Queries read the whole given tables. Where an operator is about faults, duplicates or late
copies, these are derived from all rows of ``events`` by expressions that both sides state.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch import functions as E
from tidewatch.shared import durable, scratch_path
from tidewatch.operators import aggregate as A
from tidewatch.operators import filters, metrics, outliers, project, quality, quantiles, sketches
from tidewatch.operators.dedup import dedup_events
from tidewatch.operators.joins import join_dimension, keyed_join
from tidewatch.plans.health import stream_metrics
from tidewatch.plans.percentiles import (
    CountedReport,
    counted_p95_from_events,
    counted_p95_from_windows,
    p95_from_events,
    p95_from_windows,
    removal_report,
)
from tidewatch.plans.windows import events_to_windows
from tidewatch.schema import EVENT_SCHEMA, PARTITION_COLUMNS, REQUIRED_EVENT_COLUMNS, WATERMARK_DELAY, WINDOW_SCHEMA
from tidewatch.sources import tables
from tidewatch.sources.events_table import as_messages, contract_events, read_events, stream_events
from tidewatch.streaming.batches import run_split, split_by_rules, split_late, stop_after
from tidewatch.streaming.progress import ProgressLog, recent_progress
from tidewatch.streaming.runner import CATCH_UP, run_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# The gate of the daily question at the size of the check tables (47 to 86 events per group).
GATE = 50


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, in a session whose calendar is UTC."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(spark, folder)

        QUERIES[function.__name__] = run
        if sql is not None:
            SQL[function.__name__] = sql.strip()
        return function

    return register


# Means of values with two decimals can end exactly in half of the last digit, where the order of
# additions would decide how they round. Both sides add this before rounding to six decimals.
TIE = "1.37e-8"


def _r(column: Column | str, name: str | None = None) -> Column:
    """Six decimals, so that the order of additions does not show."""
    expression = F.col(column) if isinstance(column, str) else column
    return F.round(expression + float(TIE), 6).alias(name or column)


# ---------------------------------------------------------------------------------------------
# Shared sources and their SQL

EVENTS_SQL = """
ev AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS device_id,
         event_type AS device_type, ts, CAST(ts AS DATE) AS date, value AS event_duration, value,
         CASE WHEN event_type = 'error' THEN 'critical' WHEN value >= 100 THEN 'warning'
              ELSE 'normal' END AS status
  FROM events)
"""

# Every fault the contract knows, spread over all events by their own values.
FAULTY_SQL = """
faulty AS (
  SELECT CASE WHEN value BETWEEN 18 AND 20 THEN NULL
              WHEN value BETWEEN 20 AND 22 THEN CAST(event_id AS VARCHAR)
              WHEN value BETWEEN 22 AND 24 THEN '{' || id || '}'
              WHEN value BETWEEN 24 AND 26 THEN 'urn:uuid:' || id
              WHEN value BETWEEN 26 AND 28 THEN replace(id, '-', '')
              ELSE id END AS event_id,
         'device-' || CASE WHEN user_id < 1000 THEN lpad(CAST(user_id AS VARCHAR), 3, '0')
                           ELSE CAST(user_id AS VARCHAR) END AS device_id,
         CASE event_type WHEN 'view' THEN 'temperature' WHEN 'click' THEN 'pressure'
              WHEN 'signup' THEN 'humidity' WHEN 'purchase' THEN 'motion' ELSE event_type END AS device_type,
         CASE WHEN value BETWEEN 2 AND 3 THEN NULL ELSE ts END AS ts,
         CASE WHEN value > 150 THEN -value WHEN value < 1 THEN NULL
              WHEN value BETWEEN 1 AND 2 THEN CAST('nan' AS DOUBLE) ELSE value * 10 END AS event_duration,
         CASE WHEN event_type = 'click' AND value > 100 THEN NULL ELSE value END AS value,
         CASE WHEN value BETWEEN 3 AND 4 THEN 'unknown' WHEN value >= 100 THEN 'warning'
              ELSE 'normal' END AS status,
         'zone-' || chr(CAST(65 + user_id % 7 AS INTEGER)) AS location,
         'v1.2.' || k AS firmware, event_number
  FROM (SELECT *, event_id AS event_number, regexp_extract(props, '([0-9]+)', 1) AS k,
               substr(m, 1, 8) || '-' || substr(m, 9, 4) || '-' || substr(m, 13, 4) || '-' ||
               substr(m, 17, 4) || '-' || substr(m, 21, 12) AS id
        FROM (SELECT *, md5(CAST(event_id AS VARCHAR)) AS m FROM events) AS hashed) AS named)
"""

VALID_SQL = """
event_duration >= 0 AND NOT isnan(event_duration) AND value IS NOT NULL AND NOT isnan(value) AND ts IS NOT NULL
"""

CANONICAL_SQL = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"


def faulty_events(spark: SparkSession, folder: str, table: DataFrame | None = None) -> DataFrame:
    """Contract events with every kind of fault; ``event_number`` identifies the source row."""
    table = spark.read.parquet(f"{folder}/events.parquet") if table is None else table
    digest = F.md5(F.col("event_id").cast("string"))
    parts = [F.substring(digest, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    identifier, value, user = F.concat_ws("-", *parts), F.col("value"), F.col("user_id")
    names = {"view": "temperature", "click": "pressure", "signup": "humidity", "purchase": "motion"}
    device_type = F.col("event_type")
    for source, target in names.items():
        device_type = F.when(F.col("event_type") == source, target).otherwise(device_type)
    row = F.struct(
        F.when(value.between(18, 20), F.lit(None).cast("string"))
        .when(value.between(20, 22), F.col("event_id").cast("string"))
        .when(value.between(22, 24), F.concat(F.lit("{"), identifier, F.lit("}")))
        .when(value.between(24, 26), F.concat(F.lit("urn:uuid:"), identifier))
        .when(value.between(26, 28), F.replace(identifier, F.lit("-"), F.lit("")))
        .otherwise(identifier).alias("event_id"),
        F.concat(
            F.lit("device-"),
            F.when(user < 1000, F.lpad(user.cast("string"), 3, "0")).otherwise(user.cast("string")),
        ).alias("device_id"),
        device_type.alias("device_type"),
        F.when(~value.between(2, 3), F.col("ts")).alias("timestamp"),
        F.when(value > 150, -value)
        .when(value < 1, F.lit(None).cast("double"))
        .when(value.between(1, 2), F.lit(float("nan")))
        .otherwise(value * 10).alias("event_duration"),
        F.when(~((F.col("event_type") == "click") & (value > 100)), value).alias("value"),
        F.when(value.between(3, 4), "unknown").when(value >= 100, "warning").otherwise("normal").alias("status"),
        F.create_map(
            F.lit("location"), F.concat(F.lit("zone-"), F.char(65 + user % 7)),
            F.lit("firmware"), F.concat(F.lit("v1.2."), F.regexp_extract("props", "([0-9]+)", 1)),
        ).alias("metadata"),
        F.col("event_id").alias("event_number"),
    )
    return table.select(project.computed_once(row).alias("row")).select("row.*")


def repeated_events(spark: SparkSession, folder: str) -> DataFrame:
    """All events and, for each, a later copy with another duration under the same identifier."""
    events = read_events(spark, folder)
    later = events.withColumns(
        {
            "timestamp": F.col("timestamp") + F.expr("INTERVAL 5 MINUTES"),
            "event_duration": F.col("event_duration") + 1,
        }
    )
    return later.unionByName(events)


def landed_windows(spark: SparkSession, folder: str) -> str:
    """Path of the one-minute window table of all events, landed anew."""
    path = scratch_path(spark, "windows")
    tables.write_windows(events_to_windows(read_events(spark, folder)), path)
    return path


# Events arrive in four slices of the month, by the day; a slice is as many files, so a batch can be a slice.
SLICES, FILES_OF_SLICE = 4, 4
# Row groups of arrived files, so that a batch of few large files is read by many tasks.
ARRIVED_GROUP_BYTES = 4 << 20
SLICE_SQL = "CAST(floor((day(ts) - 1) / 8) AS INTEGER)"


def arrive(table: DataFrame, path: str, slice_of: Column, number: int) -> None:
    """Append the rows of one slice to the folder that a stream watches."""
    rows = table.where(slice_of == number).repartition(FILES_OF_SLICE)
    rows.write.mode("append").option("parquet.block.size", str(ARRIVED_GROUP_BYTES)).parquet(path)


def slice_of(time: str = "ts") -> Column:
    return F.floor((F.dayofmonth(time) - 1) / 8).cast("int")


def watched(spark: SparkSession, path: str, schema, **options: str) -> DataFrame:
    table = spark.readStream.schema(schema).options(**options).parquet(path)
    return table.withColumn("ts", F.col("ts").cast("timestamp"))


def streamed_windows(spark: SparkSession, folder: str) -> str:
    """Path of the same table as the streaming job lands it, run anew."""
    path = scratch_path(spark, "stream")
    messages = project.encode_events(stream_events(spark, folder))
    run_stream(messages, path, scratch_path(spark, "stream-state"), trigger=CATCH_UP).awaitTermination()
    return path


def _windows_sql(unit: str, source: str = "ev", extra: str = "") -> str:
    return f"""
win AS (
  SELECT date_trunc('{unit}', ts) AS window_start, date_trunc('{unit}', ts) + INTERVAL 1 {unit} AS window_end,
         device_type, count(*) AS event_count, avg(event_duration) AS avg_duration,
         min(event_duration) AS min_duration, max(event_duration) AS max_duration,
         avg(value) AS avg_value{extra}
  FROM {source} GROUP BY ALL)
"""


WINDOW_OUTPUT_SQL = f"""
window_start, window_end, device_type, event_count, round(avg_duration + {TIE}, 6) AS avg_duration, min_duration,
max_duration, round(avg_value + {TIE}, 6) AS avg_value
"""

CALENDAR_SQL = """
CAST(year(window_start) AS INTEGER) AS year, CAST(month(window_start) AS INTEGER) AS month,
CAST(day(window_start) AS INTEGER) AS day, CAST(hour(window_start) AS INTEGER) AS hour
"""


def _window_output(windows: DataFrame, *more: str) -> DataFrame:
    return windows.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "device_type", "event_count", _r("avg_duration"), "min_duration", "max_duration", _r("avg_value"), *more,
    )


# ---------------------------------------------------------------------------------------------
# Composite questions

P95_OUTPUT = ("p95_duration", "avg_duration", "mean_duration", "stddev_duration")

P95_SQL = f"""
WITH {EVENTS_SQL},
stats AS (
  SELECT device_type, date, avg(event_duration) AS mu, stddev_samp(event_duration) AS sigma
  FROM ev GROUP BY device_type, date HAVING count(DISTINCT event_id) >= {GATE})
SELECT device_type, date, round(quantile_disc(event_duration, 0.95) + {TIE}, 6) AS p95_duration,
       count(*) AS total_events, round(avg(event_duration) + {TIE}, 6) AS avg_duration,
       round(avg(mu) + {TIE}, 6) AS mean_duration, round(avg(sigma) + {TIE}, 6) AS stddev_duration
FROM ev JOIN stats USING (device_type, date)
WHERE sigma = 0 OR abs(event_duration - mu) <= 3 * sigma
GROUP BY device_type, date ORDER BY date, device_type
"""


def _p95_output(result: DataFrame) -> DataFrame:
    return result.select("device_type", "date", "total_events", *[_r(c) for c in P95_OUTPUT])


@query(P95_SQL)
def q1_p95_from_events(spark, folder):
    return _p95_output(p95_from_events(read_events(spark, folder), min_events=GATE))


@query(P95_SQL)
def q1_p95_from_events_exact(spark, folder):
    return _p95_output(p95_from_events(read_events(spark, folder), min_events=GATE, exact=True))


@query(f"""
WITH {EVENTS_SQL},
stats AS (
  SELECT device_type, date, avg(event_duration) AS mu, stddev_samp(event_duration) AS sigma,
         count(*) AS "rows", count(DISTINCT event_id) >= {GATE} AS qualified
  FROM ev GROUP BY device_type, date),
kept AS (
  SELECT device_type, date, count(*) AS kept FROM ev JOIN stats USING (device_type, date)
  WHERE qualified AND (sigma = 0 OR abs(event_duration - mu) <= 3 * sigma) GROUP BY device_type, date)
SELECT device_type, date, "rows", qualified, coalesce(kept, 0) AS kept,
       CASE WHEN qualified THEN "rows" - coalesce(kept, 0) ELSE 0 END AS removed
FROM stats LEFT JOIN kept USING (device_type, date)
""")
def q1_removal_report(spark, folder):
    return removal_report(read_events(spark, folder), min_events=GATE)


@query(f"""
WITH {EVENTS_SQL}, {_windows_sql('minute')},
daily AS (SELECT *, CAST(window_start AS DATE) AS date FROM win),
stats AS (
  SELECT device_type, date, avg(avg_duration) AS mu, stddev_samp(avg_duration) AS sigma
  FROM daily GROUP BY device_type, date HAVING count(DISTINCT window_start) >= {GATE})
SELECT device_type, date, round(quantile_disc(avg_duration, 0.95) + {TIE}, 6) AS p95_duration,
       count(*) AS total_events, round(avg(avg_duration) + {TIE}, 6) AS avg_duration,
       round(avg(mu) + {TIE}, 6) AS mean_duration, round(avg(sigma) + {TIE}, 6) AS stddev_duration
FROM daily JOIN stats USING (device_type, date)
WHERE sigma = 0 OR abs(avg_duration - mu) <= 3 * sigma
GROUP BY device_type, date
""")
def q2_p95_from_windows(spark, folder):
    path = scratch_path(spark, "windows")
    events_to_windows(read_events(spark, folder)).write.parquet(path)
    windows = tables.load_data(spark, path, schema=WINDOW_SCHEMA)
    return _p95_output(p95_from_windows(windows, min_events=GATE))


# A gate that some groups of the check tables miss.
COUNTED_GATE = 65


def _counted_sql(value: str, distinct: str) -> str:
    """Every group of ``day`` with its counts, and with its percentile if it qualified."""
    return f"""
stats AS (
  SELECT device_type, date, avg({value}) AS mu, stddev_samp({value}) AS sigma,
         count(*) AS "rows", count(DISTINCT {distinct}) >= {COUNTED_GATE} AS qualified
  FROM day GROUP BY device_type, date),
clean AS (
  SELECT device_type, date, quantile_disc({value}, 0.95) AS p95, count(*) AS kept
  FROM day JOIN stats USING (device_type, date)
  WHERE qualified AND (sigma = 0 OR abs({value} - mu) <= 3 * sigma) GROUP BY device_type, date)
SELECT device_type, date, "rows", qualified, coalesce(kept, 0) AS kept,
       CASE WHEN qualified THEN "rows" - coalesce(kept, 0) ELSE 0 END AS removed,
       round(p95 + {TIE}, 6) AS p95_duration,
       (SELECT CAST(sum("rows") AS BIGINT) FROM stats) AS all_loaded,
       (SELECT CAST(sum("rows") AS BIGINT) FROM stats WHERE qualified) AS all_qualified,
       (SELECT CAST(sum(kept) AS BIGINT) FROM clean) AS all_kept
FROM stats LEFT JOIN clean USING (device_type, date)
"""


def _counted_output(counted: CountedReport) -> DataFrame:
    totals = counted.totals()
    values = counted.report.select("device_type", "date", _r("p95_duration"))
    return keyed_join(counted.removals, values, ["device_type", "date"], how="left").select(
        "device_type", "date", "rows", "qualified", "kept", "removed", "p95_duration",
        *[F.lit(totals[name]).cast("bigint").alias(f"all_{name}") for name in ("loaded", "qualified", "kept")],
    )


@query(f"WITH {EVENTS_SQL}, day AS (SELECT * FROM ev), {_counted_sql('event_duration', 'event_id')}")
def q1_counted_report(spark, folder):
    """The report with the rows of all groups, also those below the gate, and the program's totals."""
    return _counted_output(counted_p95_from_events(read_events(spark, folder), min_events=COUNTED_GATE))


@query(f"""
WITH {EVENTS_SQL}, {_windows_sql('minute')}, day AS (SELECT *, CAST(window_start AS DATE) AS date FROM win),
{_counted_sql('avg_duration', 'window_start')}""")
def q2_counted_report(spark, folder):
    """The same over landed windows, as the daily program runs it."""
    windows = tables.load_data(spark, landed_windows(spark, folder), schema=WINDOW_SCHEMA)
    return _counted_output(counted_p95_from_windows(windows, min_events=COUNTED_GATE))


@query(f"""
WITH {FAULTY_SQL}, valid AS (SELECT * FROM faulty WHERE {VALID_SQL} AND event_id IS NOT NULL), {_windows_sql('hour', 'valid')}
SELECT {WINDOW_OUTPUT_SQL}, {CALENDAR_SQL} FROM win
""")
def q3_events_to_windows(spark, folder):
    windows = events_to_windows(faulty_events(spark, folder).drop("event_number"), "1 hour")
    return _window_output(windows, *PARTITION_COLUMNS)


@query(f"""
WITH {EVENTS_SQL}, {_windows_sql('minute')}
SELECT {WINDOW_OUTPUT_SQL}, {CALENDAR_SQL} FROM win
WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)
""")
def q4_run_stream(spark, folder):
    """The whole streaming job from messages to the landed table; the last minutes are still open."""
    return _window_output(spark.read.parquet(streamed_windows(spark, folder)), *PARTITION_COLUMNS)


def _contract_failures_sql() -> list[tuple[str, str, str]]:
    """(rule, column, failing predicate) of the contract, in rule order."""
    return [
        ("not_null", "event_id", "event_id IS NULL"),
        ("not_null", "device_id", "device_id IS NULL"),
        ("not_null", "device_type", "device_type IS NULL"),
        ("not_null", "timestamp", "ts IS NULL"),
        ("not_null", "event_duration", "event_duration IS NULL"),
        ("not_null", "value", "value IS NULL"),
        ("not_null", "status", "status IS NULL"),
        ("not_null", "metadata", "FALSE"),
        ("uuid", "event_id", f"NOT regexp_full_match(event_id, '{CANONICAL_SQL}')"),
        ("pattern", "device_id", "NOT regexp_full_match(device_id, 'device-[0-9]{3}')"),
        ("one_of", "device_type", "device_type NOT IN ('temperature','pressure','humidity','motion','light')"),
        ("range", "event_duration", "event_duration < 0 OR event_duration > 1000"),
        ("one_of", "status", "status NOT IN ('normal','warning','critical')"),
        ("entry_location", "metadata", "NOT regexp_full_match(location, 'zone-[A-E]')"),
        ("entry_firmware", "metadata", "NOT regexp_full_match(firmware, 'v[0-9].[0-9].[0-9]')"),
    ]


def _report_sql(source: str, rules: list[tuple[str, str, str]]) -> str:
    lines = [
        f"SELECT '{rule}' AS rule, '{column}' AS \"column\", count(*) FILTER (WHERE {bad}) AS failed_rows, "
        f"count(*) AS total_rows, count(*) FILTER (WHERE {bad}) = 0 AS passed FROM {source}"
        for rule, column, bad in rules
    ]
    return "\nUNION ALL\n".join(lines)


REASONS_SQL = "concat_ws(',', {})".format(
    ", ".join(f"CASE WHEN {bad} THEN '{rule}:{column}' END" for rule, column, bad in _contract_failures_sql())
)


@query(f"WITH {FAULTY_SQL} {_report_sql('faulty', _contract_failures_sql())}")
def q5_quality_report(spark, folder):
    return quality.quality_report(faulty_events(spark, folder), quality.contract_rules())


# ---------------------------------------------------------------------------------------------
# Sources and sinks

@query("SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events")
def s2_json_decode(spark, folder):
    table = spark.read.parquet(f"{folder}/events.parquet")
    coded = table.select("event_id", F.col("props").cast("binary").alias("value"))
    decoded = F.from_json(F.col("value").cast("string"), "k int")
    return coded.select("event_id", decoded["k"].alias("k"))


@query(f"""
WITH {EVENTS_SQL}, {_windows_sql('minute')}
SELECT {CALENDAR_SQL}, count(*) AS "rows", sum(event_count)::BIGINT AS events FROM win
WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events) GROUP BY ALL
""")
def s3_stream_parquet_sink(spark, folder):
    """What the sink landed in each hour partition."""
    landed = spark.read.parquet(streamed_windows(spark, folder))
    return landed.groupBy(*PARTITION_COLUMNS).agg(
        F.count("*").alias("rows"), F.sum("event_count").alias("events")
    )


@query(f"""
WITH {EVENTS_SQL}, {_windows_sql('minute')} SELECT {WINDOW_OUTPUT_SQL}, {CALENDAR_SQL} FROM win
""")
def s4_partitioned_scan(spark, folder):
    return _window_output(tables.load_data(spark, landed_windows(spark, folder)), *PARTITION_COLUMNS)


@query(f"""
WITH {EVENTS_SQL}, {_windows_sql('minute')} SELECT {WINDOW_OUTPUT_SQL}, {CALENDAR_SQL} FROM win
WHERE window_start >= TIMESTAMP '2024-01-10' AND window_start < TIMESTAMP '2024-01-21'
""")
def s5_pruned_scan(spark, folder):
    days = date(2024, 1, 10), date(2024, 1, 20)
    table = tables.load_data(spark, landed_windows(spark, folder), *days)
    return _window_output(table, *PARTITION_COLUMNS)


@query(P95_SQL)
def s6_csv_round_trip(spark, folder):
    result = _p95_output(p95_from_events(read_events(spark, folder), min_events=GATE))
    path = scratch_path(spark, "s6")
    tables.export_results(result, path)
    return tables.read_results(spark, path, result.schema)


@query(f"""
WITH {EVENTS_SQL} SELECT event_id, device_id, device_type, ts AS "timestamp", event_duration, value, status,
regexp_extract(props, '([0-9]+)', 1) AS k FROM ev JOIN (SELECT CAST(event_id AS VARCHAR) AS event_id, props FROM events)
AS p USING (event_id)
""")
def s7_encode_decode(spark, folder):
    events = read_events(spark, folder)
    sent = project.encode_events(events.withColumn("timestamp", F.col("timestamp").cast("timestamp")))
    received = project.with_map_entries(project.decode_events(sent), ["k"])
    return received.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).drop("metadata")


@query(f"""
WITH {EVENTS_SQL}, {_windows_sql('minute')}
SELECT {CALENDAR_SQL}, count(*) AS "rows" FROM win GROUP BY ALL
""")
def s9_landed_audit(spark, folder):
    return tables.landed_hours(spark, landed_windows(spark, folder)).drop("files")


# ---------------------------------------------------------------------------------------------
# Projections

@query(f"""
WITH {FAULTY_SQL} SELECT event_id, device_id, device_type, event_duration, value, status FROM faulty
""")
def p1_flatten(spark, folder):
    """Missing values and NaN survive the JSON form."""
    flat = project.decode_messages(project.encode_events(faulty_events(spark, folder).drop("event_number")))
    return flat.drop("timestamp", "metadata")


@query("""
SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN ts - INTERVAL 2 HOUR ELSE ts END AS "timestamp"
FROM events
""")
def p2_parse_event_time(spark, folder):
    """Texts with ``Z``, with an offset of two hours, and unreadable ones."""
    table = spark.read.parquet(f"{folder}/events.parquet")
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("at "), text))
        .when(F.col("event_type") == "view", F.concat(text, F.lit("+02:00")))
        .otherwise(F.concat(text, F.lit("Z")))
    )
    parsed = project.with_event_time(table.select("event_id", text.alias("timestamp")))
    return parsed.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query("""
SELECT event_id, date_trunc('minute', ts) AS window_start, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end
FROM events
""")
def p3_window_bounds(spark, folder):
    table = spark.read.parquet(f"{folder}/events.parquet")
    return project.unpack_window(table.select("event_id", F.window("ts", "1 minute").alias("window")))


@query("""
SELECT event_type AS device_type, count(*) AS "rows", count(DISTINCT now()) AS stamps, count(*) FILTER (WHERE ts <= now()) AS earlier
FROM events GROUP BY event_type
""")
def p4_processing_time(spark, folder):
    """All rows of a batch are stamped with one instant, which none of these events is after."""
    stamped = project.with_processing_time(read_events(spark, folder))
    return stamped.groupBy("device_type").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("processing_time").alias("stamps"),
        F.count_if(F.col("timestamp") <= F.col("processing_time")).alias("earlier"),
    )


@query("""
SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour FROM events
""")
def p5_calendar_parts(spark, folder):
    return project.with_calendar_parts(spark.read.parquet(f"{folder}/events.parquet"), "ts").select(
        "event_id", *PARTITION_COLUMNS
    )


@query(f"""
WITH {EVENTS_SQL}, {_windows_sql('hour')}
SELECT window_start, device_type, round(avg_duration + {TIE}, 6) AS avg_duration, event_count,
       CAST(year(window_start) AS INTEGER) AS year, CAST(month(window_start) AS INTEGER) AS month,
       CAST(day(window_start) AS INTEGER) AS day, CAST(window_start AS DATE) AS date FROM win
""")
def p6_daily_window_rows(spark, folder):
    rows = project.daily_window_rows(events_to_windows(read_events(spark, folder), "1 hour"))
    return rows.withColumn("avg_duration", _r("avg_duration"))


@query(f"WITH {EVENTS_SQL} SELECT event_id, status = 'critical' AS is_critical FROM ev")
def p7_is_critical(spark, folder):
    return project.enrich_with_metadata(read_events(spark, folder)).select("event_id", "is_critical")


@query(f"""
WITH {FAULTY_SQL} SELECT event_number, CASE WHEN event_duration < 100 THEN 'fast' WHEN event_duration < 300 THEN 'normal'
ELSE 'slow' END AS duration_category FROM faulty
""")
def p8_duration_category(spark, folder):
    return project.enrich_with_metadata(faulty_events(spark, folder)).select("event_number", "duration_category")


@query(f"""
WITH {EVENTS_SQL} SELECT device_type, date, round(avg(event_duration) + {TIE}, 6) AS mu,
round(stddev_samp(event_duration) + {TIE}, 6) AS sigma FROM ev GROUP BY device_type, date
""")
def p9_stats_subset(spark, folder):
    stats = A.compute_daily_statistics(_dated(spark, folder), "event_duration", "event_id")
    return stats.select("device_type", "date", _r("mu"), _r("sigma"))


@query(f"WITH {FAULTY_SQL} SELECT event_number, location, firmware FROM faulty")
def p10_map_entries(spark, folder):
    entries = project.with_map_entries(faulty_events(spark, folder), ["location", "firmware"])
    return entries.select("event_number", "location", "firmware")


def _dated(spark: SparkSession, folder: str) -> DataFrame:
    return project.with_event_date(read_events(spark, folder), "timestamp")


# ---------------------------------------------------------------------------------------------
# Filters

@query(f"WITH {FAULTY_SQL} SELECT event_number FROM faulty WHERE {VALID_SQL}")
def f1_drop_invalid(spark, folder):
    return filters.drop_invalid_events(faulty_events(spark, folder)).select("event_number")


@query(f"""
WITH {EVENTS_SQL} SELECT device_type, date, count(DISTINCT event_id) AS distinct_events FROM ev
GROUP BY device_type, date HAVING count(DISTINCT event_id) >= {GATE + 20}
""")
def f2_qualified_groups(spark, folder):
    stats = A.compute_daily_statistics(_dated(spark, folder), "event_duration", "event_id")
    return filters.filter_qualified_devices(stats, GATE + 20).select("device_type", "date", "distinct_events")


@query(f"""
WITH {EVENTS_SQL}, stats AS (SELECT device_type, avg(value) AS mu, stddev_samp(value) AS sigma FROM ev GROUP BY device_type)
SELECT event_id FROM ev JOIN stats USING (device_type) WHERE sigma = 0 OR abs(value - mu) <= 2.5 * sigma
""")
def f3_keep_inliers(spark, folder):
    flagged = outliers.is_outlier_3sigma(read_events(spark, folder), "value", "device_type")
    return filters.keep_inliers(flagged, "value", 2.5).select("event_id")


@query("SELECT event_id, value FROM events WHERE event_type = 'purchase'")
def f4_equality_pushdown(spark, folder):
    return read_events(spark, folder).filter(F.col("device_type") == "purchase").select(
        F.col("event_id").cast("bigint").alias("event_id"), "value"
    )


@query(f"""
WITH {FAULTY_SQL} SELECT event_number, {REASONS_SQL} AS reasons FROM faulty WHERE {REASONS_SQL} <> ''
""")
def f5_rejected_rows(spark, folder):
    _, rejected = quality.split_valid(faulty_events(spark, folder), quality.contract_rules())
    return rejected.select("event_number", F.array_join("reject_reasons", ",").alias("reasons"))


@query(f"WITH {FAULTY_SQL} SELECT event_number, event_id, device_id FROM faulty WHERE {REASONS_SQL} = ''")
def f5_valid_rows(spark, folder):
    valid, _ = quality.split_valid(faulty_events(spark, folder), quality.contract_rules())
    return valid.select("event_number", "event_id", "device_id")


# ---------------------------------------------------------------------------------------------
# Joins and outlier removal

INLIERS_SQL = f"""
WITH {EVENTS_SQL},
stats AS (SELECT device_type, date, avg(value) AS mu, stddev_samp(value) AS sigma FROM ev
          GROUP BY device_type, date HAVING count(*) >= {GATE})
SELECT event_id, device_type, date, value, round(mu + {TIE}, 6) AS mu, round(sigma + {TIE}, 6) AS sigma
FROM ev JOIN stats USING (device_type, date) WHERE sigma = 0 OR abs(value - mu) <= 3 * sigma
"""


@query(INLIERS_SQL)
def j1_remove_outliers(spark, folder):
    events = _dated(spark, folder)
    spread = A.qualified_spread(events, "value", "event_id", GATE)
    clean = outliers.remove_outliers(
        events, spread.part(spread.frame.filter("qualified")), "value"
    )
    return clean.select("event_id", "device_type", "date", "value", _r("mu"), _r("sigma"))


@query(f"""
WITH {EVENTS_SQL}, keyed AS (SELECT *, CASE WHEN device_type <> 'error' THEN device_type END AS k FROM ev),
stats AS (SELECT k, avg(value) AS mu, stddev_samp(value) AS sigma FROM keyed GROUP BY k)
SELECT event_id, keyed.k, round(mu + {TIE}, 6) AS mu, round(sigma + {TIE}, 6) AS sigma
FROM keyed JOIN stats ON keyed.k IS NOT DISTINCT FROM stats.k
""")
def j2_group_stats_back(spark, folder):
    """A fifth of the rows has a NULL key and keeps its own group."""
    keyed = read_events(spark, folder).withColumn(
        "k", F.when(F.col("device_type") != "error", F.col("device_type"))
    )
    return outliers.is_outlier_3sigma(keyed, "value", "k").select("event_id", "k", _r("mu"), _r("sigma"))


@query("""
SELECT CAST(event_id AS VARCHAR) AS event_id, c_name, c_mktsegment
FROM events LEFT JOIN customer ON user_id = c_custkey
""")
def j3_join_dimension(spark, folder):
    customers = spark.read.parquet(f"{folder}/customer.parquet").select(
        F.col("c_custkey").cast("string").alias("c_custkey"), "c_name", "c_mktsegment"
    )
    joined = join_dimension(read_events(spark, folder), customers, "device_id", "c_custkey")
    return joined.select("event_id", "c_name", "c_mktsegment")


@query(f"""
WITH {EVENTS_SQL}, {_windows_sql('minute')},
daily AS (SELECT *, CASE WHEN device_type <> 'view' THEN device_type END AS k, CAST(window_start AS DATE) AS date FROM win),
stats AS (
  SELECT k, date, avg(avg_duration) AS mu, CASE WHEN k <> 'click' THEN stddev_samp(avg_duration) END AS sigma
  FROM daily GROUP BY k, date)
SELECT window_start, daily.k AS device_type, date, event_count FROM daily JOIN stats USING (k, date)
WHERE sigma = 0 OR abs(avg_duration - mu) <= 2 * sigma
""")
def x5_remove_outliers(spark, folder):
    """From the window table: rows without a key and groups without a sigma have no inliers."""
    rows = project.daily_window_rows(events_to_windows(read_events(spark, folder)))
    rows = rows.withColumn("device_type", F.when(F.col("device_type") != "view", F.col("device_type")))
    stats = durable(A.group_spread(rows, "avg_duration", ["device_type", "date"]))
    stats = stats.withColumn("sigma", F.when(F.col("device_type") != "click", F.col("sigma")))
    kept = outliers.remove_outliers(rows, stats, k=2.0)
    return kept.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "device_type", "date", "event_count")


# ---------------------------------------------------------------------------------------------
# Aggregates

@query(f"WITH {EVENTS_SQL}, {_windows_sql('hour')} SELECT {WINDOW_OUTPUT_SQL} FROM win")
def a1_window_aggregates(spark, folder):
    return _window_output(project.unpack_window(A.window_aggregates(read_events(spark, folder), "1 hour")))


@query(f"""
WITH {EVENTS_SQL}, {_windows_sql('minute')}
SELECT device_type, CAST(window_start AS DATE) AS date, round(avg(avg_duration) + {TIE}, 6) AS mu,
       round(stddev_samp(avg_duration) + {TIE}, 6) AS sigma, count(DISTINCT window_start) AS distinct_events,
       count(*) AS total_windows FROM win GROUP BY ALL
""")
def a2_daily_statistics(spark, folder):
    rows = project.daily_window_rows(events_to_windows(read_events(spark, folder)))
    stats = A.compute_daily_statistics(rows)
    return stats.select("device_type", "date", _r("mu"), _r("sigma"), "distinct_events", "total_windows")


@query(f"""
WITH {EVENTS_SQL}, stats AS (
  SELECT device_type, date, avg(value) AS mu, stddev_samp(value) AS sigma FROM ev GROUP BY device_type, date)
SELECT device_type, date, round(quantile_disc(value, 0.95) + {TIE}, 6) AS p95_duration, count(*) AS total_events,
       round(avg(value) + {TIE}, 6) AS avg_duration, round(avg(mu) + {TIE}, 6) AS mean_duration, round(avg(sigma) + {TIE}, 6) AS stddev_duration
FROM ev JOIN stats USING (device_type, date) GROUP BY device_type, date
""")
def a3_percentiles(spark, folder):
    flagged = outliers.is_outlier_3sigma(_dated(spark, folder), "value", ["device_type", "date"])
    return _p95_output(A.compute_percentiles(flagged, "value"))


@query(f"""
WITH {EVENTS_SQL} SELECT device_type, round(avg(value) + {TIE}, 6) AS mu, round(stddev_samp(value) + {TIE}, 6) AS sigma,
count(*) AS "rows" FROM ev GROUP BY device_type
""")
def a4_group_spread(spark, folder):
    spread = A.group_spread(read_events(spark, folder), "value", ["device_type"])
    return spread.select("device_type", _r("mu"), _r("sigma"), "rows")


@query(f"""
WITH {EVENTS_SQL} SELECT round(avg(value) + {TIE}, 6) AS mu, round(stddev_samp(value) + {TIE}, 6) AS sigma, count(*) AS "rows" FROM ev
""")
def a5_global_spread(spark, folder):
    return A.group_spread(read_events(spark, folder), "value", []).select(_r("mu"), _r("sigma"), "rows")


@query("""
SELECT quantile_disc(value, 0.01) AS p01, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.5) AS q2,
       quantile_disc(value, 0.75) AS q3, quantile_disc(value, 0.99) AS p99 FROM events
""")
def a6_exact_quantiles(spark, folder):
    wanted = {"p01": 0.01, "q1": 0.25, "q2": 0.5, "q3": 0.75, "p99": 0.99}
    return quantiles.quantiles(read_events(spark, folder), "value", wanted, relative_error=0.0)


@query("""
SELECT event_type AS device_type, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3
FROM events GROUP BY event_type
""")
def a6_exact_quantiles_by_type(spark, folder):
    return quantiles.quantiles(
        read_events(spark, folder), "value", {"q1": 0.25, "q3": 0.75}, ["device_type"], relative_error=0.0
    )


@query(f"""
WITH {FAULTY_SQL} SELECT count(event_id) AS event_id, count(ts) AS "timestamp",
count(event_duration) AS event_duration, count(value) AS value FROM faulty
""")
def a7_non_null_counts(spark, folder):
    return A.non_null_counts(faulty_events(spark, folder), ["event_id", "timestamp", "event_duration", "value"])


A8_RULES_SQL = [
    ("non_negative", "event_duration", "event_duration < 0"),
    ("range", "event_duration", "event_duration < 50 OR event_duration > 500"),
    ("range", "value", "value < 5 OR value > 100"),
]


@query(f"WITH {FAULTY_SQL} {_report_sql('faulty', A8_RULES_SQL)}")
def a8_conditional_counts(spark, folder):
    rules = [
        quality.non_negative("event_duration"),
        quality.in_range("event_duration", 50, 500),
        quality.in_range("value", 5, 100),
    ]
    return quality.quality_report(faulty_events(spark, folder), rules)


@query(f"""
WITH {EVENTS_SQL}, {_windows_sql('day', extra=', quantile_disc(event_duration, 0.95) AS percentile_duration')}
SELECT {WINDOW_OUTPUT_SQL}, percentile_duration FROM win
""")
def a9_window_percentile(spark, folder):
    windows = A.window_aggregates(read_events(spark, folder), "1 day", duration_percentile=0.95)
    return _window_output(project.unpack_window(windows), "percentile_duration")


@query(f"""
WITH {EVENTS_SQL} SELECT device_type, date, quantile_disc(event_duration, 0.95) AS p95_duration FROM ev GROUP BY ALL
""")
def a10_day_percentile(spark, folder):
    """The day's percentile of the events, from the sketches of the landed one-minute windows only."""
    path = scratch_path(spark, "sketched")
    tables.write_windows(events_to_windows(read_events(spark, folder), sketch=True), path)
    return A.roll_up_percentiles(project.with_event_date(tables.load_data(spark, path)))


@query("""
SELECT CASE WHEN event_id % 2 = 0 THEN 'hot' ELSE event_type END AS part, count(*) AS "rows", TRUE AS within
FROM events GROUP BY ALL
""")
def a3_hot_group_rank(spark, folder):
    """One group holds half of all rows; a coarse sketch's value must have the rank it claims, within 2 %."""
    events = read_events(spark, folder)
    part = F.when(F.col("event_id").cast("bigint") % 2 == 0, "hot").otherwise(F.col("device_type"))
    rows = events.select(part.alias("part"), "value")
    found = durable(sketches.grouped_sketches(rows, "value", ["part"], size=256).select(
        "part", sketches.sketch_quantile(F.col("sketch"), 0.95).alias("p95")
    ))
    ranked = keyed_join(rows, found, ["part"]).groupBy("part").agg(
        F.count("*").alias("rows"), F.count_if(F.col("value") <= F.col("p95")).alias("upto"),
        F.count_if(F.col("value") < F.col("p95")).alias("below"),
    )
    low, high = F.col("below") / F.col("rows"), F.col("upto") / F.col("rows")
    return ranked.select("part", "rows", ((low <= 0.97) & (high >= 0.93)).alias("within"))


@query(f"""
WITH {EVENTS_SQL} SELECT device_type, date, count(*) AS event_count, round(avg(event_duration) + {TIE}, 6) AS avg_duration,
min(event_duration) AS min_duration, max(event_duration) AS max_duration, round(avg(value) + {TIE}, 6) AS avg_value
FROM ev GROUP BY device_type, date
""")
def a10_roll_up_windows(spark, folder):
    """Weighted means of the windows are the means of the events."""
    windows = events_to_windows(read_events(spark, folder))
    days = A.roll_up_windows(project.with_event_date(windows))
    return days.select(
        "device_type", "date", "event_count", _r("avg_duration"), "min_duration", "max_duration", _r("avg_value")
    )


# ---------------------------------------------------------------------------------------------
# Order and preview

@query(P95_SQL)
def o1_ordered_result(spark, folder):
    return q1_p95_from_events(spark, folder).orderBy("date", "device_type")


@query(f"SELECT * FROM ({P95_SQL}) AS report ORDER BY date, device_type LIMIT 10")
def o2_preview(spark, folder):
    return A.preview(A.order_by_day(q1_p95_from_events(spark, folder)))


# ---------------------------------------------------------------------------------------------
# Outlier flags

@query(f"""
WITH {EVENTS_SQL}, stats AS (
  SELECT device_type, avg(value) AS mu, stddev_samp(value) AS sigma FROM ev GROUP BY device_type)
SELECT event_id, sigma > 0 AND abs(value - mu) > 3 * sigma AS is_outlier FROM ev JOIN stats USING (device_type)
""")
def x1_outlier_3sigma(spark, folder):
    flagged = outliers.is_outlier_3sigma(read_events(spark, folder), "value", "device_type")
    return flagged.select("event_id", "is_outlier")


@query("""
SELECT CAST(event_id AS VARCHAR) AS event_id, sigma > 0 AND abs(value - mu) > 2.0 * sigma AS is_outlier_zscore
FROM events, (SELECT avg(value) AS mu, stddev_samp(value) AS sigma FROM events) AS stats
""")
def x2_outlier_zscore(spark, folder):
    flagged = outliers.detect_outliers_zscore(read_events(spark, folder), "value", 2.0)
    return flagged.select("event_id", "is_outlier_zscore")


@query("""
SELECT CAST(event_id AS VARCHAR) AS event_id,
       value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) AS is_outlier_iqr
FROM events, (SELECT quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3 FROM events) AS stats
""")
def x3_outlier_iqr(spark, folder):
    flagged = outliers.detect_outliers_iqr(read_events(spark, folder), "value", relative_error=0.0)
    return flagged.select("event_id", "is_outlier_iqr")


@query("""
SELECT CAST(event_id AS VARCHAR) AS event_id, value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) AS is_outlier_iqr
FROM events JOIN (SELECT event_type, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3
                  FROM events GROUP BY event_type) AS stats USING (event_type)
""")
def x3_outlier_iqr_by_type(spark, folder):
    flagged = outliers.detect_outliers_iqr(
        read_events(spark, folder), "value", group_by=["device_type"], relative_error=0.0
    )
    return flagged.select("event_id", "is_outlier_iqr")


@query("""
SELECT CAST(event_id AS VARCHAR) AS event_id, value < lo OR value > hi AS is_outlier_percentile
FROM events, (SELECT quantile_disc(value, 0.01) AS lo, quantile_disc(value, 0.99) AS hi FROM events) AS stats
""")
def x4_outlier_percentile(spark, folder):
    flagged = outliers.detect_outliers_percentile(read_events(spark, folder), "value", relative_error=0.0)
    return flagged.select("event_id", "is_outlier_percentile")


# ---------------------------------------------------------------------------------------------
# Streaming operators

@query("""
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS device_type, ts AS "timestamp", value AS event_duration
FROM events
""")
def t2_batch_dedup(spark, folder):
    """Every event has a later copy; the earliest stays."""
    kept = dedup_events(repeated_events(spark, folder))
    return kept.select("event_id", "device_type", "timestamp", "event_duration")


@query("""
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS device_type, ts AS "timestamp" FROM events
""")
def t2_stream_dedup(spark, folder):
    """Every event arrives twice."""
    events = stream_events(spark, folder).select("event_id", "device_type", "timestamp")
    again = stream_events(spark, folder).select("event_id", "device_type", "timestamp")
    once = dedup_events(events.unionByName(again), delay=WATERMARK_DELAY)
    return _drain(spark, once, "t2").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query(f"""
WITH {EVENTS_SQL}, {_windows_sql('hour')} SELECT {WINDOW_OUTPUT_SQL} FROM win
WHERE window_end <= (SELECT max(ts) - INTERVAL 30 MINUTE FROM events)
""")
def t3_stream_windows(spark, folder):
    """Append mode: windows whose end the watermark has passed, here 30 minutes behind."""
    events = stream_events(spark, folder).withWatermark("timestamp", "30 minutes")
    windows = project.unpack_window(A.window_aggregates(events, "1 hour"))
    return _window_output(_drain(spark, windows, "t3"))


@query("""
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS device_type, ts AS "timestamp" FROM events
WHERE value NOT BETWEEN 10 AND 20
UNION ALL
SELECT NULL, event_type, ts FROM events WHERE value BETWEEN 10 AND 20
UNION ALL
SELECT NULL, event_type, ts + INTERVAL 5 MINUTE FROM events WHERE value BETWEEN 10 AND 20
""")
def t2_missing_ids(spark, folder):
    """Copies with an identifier go, events without one all stay."""
    events = repeated_events(spark, folder)
    events = events.withColumn("event_id", F.when(~F.col("value").between(10, 20), F.col("event_id")))
    return dedup_events(events).select("event_id", "device_type", "timestamp")


@query(f"""
WITH {EVENTS_SQL}, {_windows_sql('minute')}
SELECT {WINDOW_OUTPUT_SQL}, {CALENDAR_SQL} FROM win
WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)
""")
def t8_restart(spark, folder):
    """A bounded catch-up in several batches, stopped after two of them and resumed from its checkpoint."""
    table = spark.read.parquet(f"{folder}/events.parquet")
    source, out, state = (scratch_path(spark, name) for name in ("arrived", "resumed", "resumed-state"))
    for number in range(SLICES):
        arrive(table, source, slice_of(), number)

    def start(trigger) -> StreamingQuery:
        events = contract_events(watched(spark, source, table.schema, maxFilesPerTrigger=str(FILES_OF_SLICE)))
        return run_stream(project.encode_events(events), out, state, trigger=trigger)

    stop_after(start({"processingTime": "0 seconds"}), 2)
    start(CATCH_UP).awaitTermination()
    return _window_output(spark.read.parquet(out), *PARTITION_COLUMNS)


@query(f"""
WITH arrived AS (
  SELECT event_id, ts, CASE WHEN event_id % 10 = 0 THEN least({SLICE_SQL} + 1, 3) ELSE {SLICE_SQL} END AS batch FROM events),
latest AS (SELECT batch, max(ts) AS last_time FROM arrived GROUP BY batch),
watermarks AS (
  SELECT batch, max(last_time) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 10 MINUTE AS w
  FROM latest)
SELECT event_id, batch::BIGINT AS batch, coalesce(ts < w, FALSE) AS late FROM arrived JOIN watermarks USING (batch)
""")
def t4_late_rows(spark, folder):
    """Every tenth event arrives a slice later; those behind the committed watermark go to a table of their own."""
    table = spark.read.parquet(f"{folder}/events.parquet")
    source, out, state = (scratch_path(spark, name) for name in ("arrived", "late", "late-state"))
    tenth = F.col("event_id") % 10 == 0
    at = F.when(tenth, F.least(slice_of() + 1, F.lit(SLICES - 1))).otherwise(slice_of())
    for number in range(SLICES):
        arrive(table, source, at, number)
        events = watched(spark, source, table.schema)
        split = split_late(out, WATERMARK_DELAY, "ts")
        run_split(events, out, state, split, time="ts", trigger=CATCH_UP).awaitTermination()
    parts = [
        spark.read.parquet(f"{out}/{name}").select("event_id", F.col("batch").cast("bigint").alias("batch"), F.lit(name == "late").alias("late"))
        for name in ("in_time", "late")
    ]
    return parts[0].unionByName(parts[1])


@query(f"WITH {FAULTY_SQL} SELECT event_number, {REASONS_SQL} AS reasons FROM faulty")
def f5_stream_split(spark, folder):
    """Valid and rejected rows of a stream from one pass; the second batch fails once after its writes and is replayed."""
    table = spark.read.parquet(f"{folder}/events.parquet")
    source, out, state = (scratch_path(spark, name) for name in ("arrived", "split", "split-state"))
    for number in range(SLICES):
        arrive(table, source, slice_of(), number)
    plain, failed = split_by_rules(quality.contract_rules()), []

    def failing(batch: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        parts = plain(batch, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            parts["valid"].write.mode("overwrite").parquet(f"{out}/valid/batch={batch_id}")
            raise RuntimeError("a failure between the tables of a batch")
        return parts

    def start() -> StreamingQuery:
        arrived = watched(spark, source, table.schema, maxFilesPerTrigger=str(FILES_OF_SLICE))
        return run_split(faulty_events(spark, folder, arrived), out, state, failing, trigger=CATCH_UP)

    try:
        start().awaitTermination()
    except StreamingQueryException:
        if not failed:
            raise
    start().awaitTermination()
    valid = spark.read.parquet(f"{out}/valid").select("event_number", F.lit("").alias("reasons"))
    rejected = spark.read.parquet(f"{out}/rejected")
    return valid.unionByName(rejected.select("event_number", F.array_join("reject_reasons", ",").alias("reasons")))


@query("""
WITH series AS (
  SELECT event_type AS device_type, ts, lead(ts) OVER (PARTITION BY event_type ORDER BY ts) AS next_ts FROM events)
SELECT device_type, ts AS silent_since, ts + INTERVAL 420 SECOND AS alert_at FROM series
WHERE (next_ts IS NULL OR epoch_us(next_ts) - epoch_us(ts) > 420000000)
  AND ts + INTERVAL 420 SECOND < (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)
""")
def m7_stream_silences(spark, folder):
    """Alerts of a stream, raised once a type has been silent for five minutes and two more."""
    events = stream_events(spark, folder).withWatermark("timestamp", "10 minutes")
    alerts = metrics.stream_silences(events, 300, hold_seconds=120)
    landed = _drain(spark, alerts, "m7")
    return landed.select("device_type", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("silent_since", "alert_at")])


@query("SELECT 0::BIGINT AS only_batch, 0::BIGINT AS only_stream, count(*) > 0 AS compared FROM events")
def t9_batch_equals_stream(spark, folder):
    """Closed windows of the stream against those of the batch plan, row by row."""
    columns = ["window_start", "window_end", "device_type", "event_count", "min_duration", "max_duration"]
    events = read_events(spark, folder)
    closed = events.select((F.max("timestamp").cast("timestamp") - F.expr("INTERVAL 10 MINUTES")).alias("until")).scalar()
    batch = events_to_windows(events).withColumn("window_end", F.col("window_end").cast("timestamp"))
    batch = batch.withColumn("window_start", F.col("window_start").cast("timestamp")).filter(F.col("window_end") <= closed)
    stream = durable(spark.read.parquet(streamed_windows(spark, folder)).select(columns))
    batch = durable(batch.select(columns))
    rows = batch.withColumn("b", F.lit(1)).withColumn("s", F.lit(0)).unionByName(
        stream.withColumn("b", F.lit(0)).withColumn("s", F.lit(1))
    ).groupBy(*columns).agg(F.sum("b").alias("b"), F.sum("s").alias("s"))
    return rows.agg(
        F.count_if(F.col("b") > F.col("s")).alias("only_batch"), F.count_if(F.col("s") > F.col("b")).alias("only_stream"),
        (F.sum("b") > 0).alias("compared"),
    )


def _drain(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over everything that is there and read what it wrote."""
    path = scratch_path(spark, name)
    writer = stream.writeStream.format("parquet").option("path", path).outputMode("append")
    writer = writer.option("checkpointLocation", scratch_path(spark, f"{name}-state"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


# ---------------------------------------------------------------------------------------------
# Validation

V1_SQL = [(r, c, b) for r, c, b in _contract_failures_sql() if r == "not_null"]


@query(f"WITH {FAULTY_SQL} {_report_sql('faulty', V1_SQL)}")
def v1_no_nulls(spark, folder):
    events = faulty_events(spark, folder)
    return quality.quality_report(events, [r for r in quality.contract_rules() if r.name == "not_null"])


def _schema_sql(source: str, columns: list[tuple[str, str, str]]) -> str:
    """Lines of name, status (or the type that is ok) and the column that is counted."""
    lines = []
    for name, status, counted in columns:
        if status.isupper():
            status = f"CASE WHEN max(typeof({counted})) = '{status}' THEN 'ok' ELSE 'mistyped' END"
        else:
            status = f"'{status}'"
        lines.append(
            f"SELECT '{name}' AS \"column\", {status} AS status, count({counted}) AS present_rows, "
            f"count(*) AS total_rows FROM {source}"
        )
    return " UNION ALL ".join(lines)


@query(_schema_sql("events", [
    *[(c, "ok", c) for c in ("event_id", "value")],
    *[(c, "missing", "NULL") for c in ("device_id", "device_type", "timestamp", "event_duration")],
    *[(c, "extra", c) for c in ("ts", "user_id", "event_type", "props")],
]))
def v4_schema_columns(spark, folder):
    """The given table against the names of the contract, which it has in part."""
    return quality.schema_report(spark.read.parquet(f"{folder}/events.parquet"), sorted(REQUIRED_EVENT_COLUMNS))


@query(f"WITH {FAULTY_SQL} " + _schema_sql("faulty", [
    *[(c, "VARCHAR", c) for c in ("event_id", "device_id", "device_type", "status")],
    *[(c, "DOUBLE", c) for c in ("event_duration", "value")],
    ("timestamp", "TIMESTAMP WITH TIME ZONE", "ts"), ("metadata", "ok", "event_number"), ("event_number", "extra", "event_number"),
]))
def v5_event_schema(spark, folder):
    """Faulty events against names and types of the contract; the time has no zone, which is another type."""
    return quality.schema_report(faulty_events(spark, folder), EVENT_SCHEMA)


@query(f"WITH {FAULTY_SQL} {_report_sql('faulty', A8_RULES_SQL[:1])}")
def v2_non_negative(spark, folder):
    return quality.quality_report(faulty_events(spark, folder), [quality.non_negative("event_duration")])


@query(f"WITH {FAULTY_SQL} {_report_sql('faulty', A8_RULES_SQL[1:])}")
def v3_range(spark, folder):
    rules = [quality.in_range("event_duration", 50, 500), quality.in_range("value", 5, 100)]
    return quality.quality_report(faulty_events(spark, folder), rules)


V6_SQL = [(rule, column, bad) for rule, column, bad in (
    ("not_null", "device_type", "device_type IS NULL"),
    ("not_null", "date", "date IS NULL"),
    ("not_null", "p95_duration", "p95_duration IS NULL"),
)]


@query(f"WITH result AS ({P95_SQL}) {_report_sql('result', V6_SQL)}")
def v6_result_rules(spark, folder):
    result = q1_p95_from_events(spark, folder)
    return quality.quality_report(result, [quality.not_null(c) for c in ("device_type", "date", "p95_duration")])


def _ingest_sql(uuid_ok: str) -> str:
    return f"""
WITH {FAULTY_SQL}
SELECT event_number, event_id IS NOT NULL AND device_id IS NOT NULL AND device_type IS NOT NULL AND ts IS NOT NULL
  AND event_duration IS NOT NULL AND value IS NOT NULL AND status IS NOT NULL AND {uuid_ok}
  AND NOT coalesce(event_duration < 0, FALSE)
  AND device_type IN ('temperature','pressure','humidity','motion','light') AS is_valid
FROM faulty
"""


@query(_ingest_sql(f"regexp_full_match(event_id, '{CANONICAL_SQL}')"))
def v7_validate_events(spark, folder):
    checked = quality.with_validity(faulty_events(spark, folder), quality.ingest_rules())
    return checked.select("event_number", "is_valid")


@query(_ingest_sql("""regexp_full_match(
    replace(trim(replace(replace(event_id, 'urn:', ''), 'uuid:', ''), '{}'), '-', ''), '[0-9a-fA-F]{32}')"""))
def v7_validate_events_lenient(spark, folder):
    checked = quality.with_validity(faulty_events(spark, folder), quality.ingest_rules(strict=False))
    return checked.select("event_number", "is_valid")


@query(f"WITH {FAULTY_SQL} SELECT event_number, {REASONS_SQL} = '' AS is_valid FROM faulty")
def v8_contract(spark, folder):
    checked = quality.with_validity(faulty_events(spark, folder), quality.contract_rules())
    return checked.select("event_number", "is_valid")


# ---------------------------------------------------------------------------------------------
# Stream metrics

def _rates_sql(unit: str, seconds: int, keys: str = "") -> str:
    return f"""
SELECT date_trunc('{unit}', ts) AS window_start, date_trunc('{unit}', ts) + INTERVAL 1 {unit} AS window_end{keys},
       count(*) AS events, round(count(*) / {seconds}.0 + {TIE}, 6) AS events_per_second FROM ev GROUP BY ALL
"""


def _rates(counted: DataFrame) -> DataFrame:
    return counted.withColumn("events_per_second", _r("events_per_second"))


@query(f"WITH {EVENTS_SQL} {_rates_sql('hour', 3600, ', device_type, status')}")
def m1_rates_by_type_and_status(spark, folder):
    return _rates(metrics.window_counts(read_events(spark, folder), "1 hour", ["device_type", "status"]))


def _level(level: str, type_key: str, status_key: str) -> str:
    keys = f", {type_key} AS device_type, {status_key} AS status, '{level}' AS level"
    return f"SELECT * FROM ({_rates_sql('hour', 3600, keys)}) AS counted"


@query(f"WITH {EVENTS_SQL} " + " UNION ALL ".join([
    _level("device_type,status", "device_type", "status"),
    _level("device_type", "device_type", "CAST(NULL AS VARCHAR)"),
    _level("status", "CAST(NULL AS VARCHAR)", "status"),
    _level("total", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)"),
]))
def m2_rates_by_level(spark, folder):
    return _rates(metrics.event_rates(read_events(spark, folder), "1 hour"))


@query(f"WITH {EVENTS_SQL} {_rates_sql('minute', 60)}")
def m3_messages_per_minute(spark, folder):
    return _rates(metrics.window_counts(read_events(spark, folder), "1 minute"))


@query(f"""
WITH {EVENTS_SQL} SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
count(DISTINCT device_id) AS active_devices FROM ev GROUP BY ALL
""")
def m4_active_devices(spark, folder):
    return metrics.active_devices(read_events(spark, folder), "1 hour")


@query(f"""
WITH {EVENTS_SQL} SELECT date, count(DISTINCT device_id) AS devices, TRUE AS within FROM ev GROUP BY date
""")
def m4_devices_by_day(spark, folder):
    """Distinct devices of a day from the sketches of its hours, within 3 % of the exact count."""
    events = read_events(spark, folder)
    hours = metrics.device_sketches(events, "1 hour").withColumn("date", E.event_date("window_start"))
    days = durable(metrics.roll_up_devices(hours))
    exact = events.groupBy(E.event_date("timestamp").alias("date")).agg(F.count_distinct("device_id").alias("devices"))
    near = F.abs(F.col("active_devices") - F.col("devices")) <= F.greatest(F.lit(1.0), 0.03 * F.col("devices"))
    return keyed_join(exact, days, ["date"]).select("date", "devices", near.alias("within"))


@query("SELECT 4::BIGINT AS batches, count(*) AS input_rows, 0::BIGINT AS dropped_late FROM events")
def m9_batch_reports(spark, folder):
    """The reports of a stream of four batches, gathered as a table while it runs."""
    table = spark.read.parquet(f"{folder}/events.parquet")
    source = scratch_path(spark, "arrived")
    for number in range(SLICES):
        arrive(table, source, slice_of(), number)
    name, log = "reports-" + source[-8:], ProgressLog(every=2)
    spark.streams.addListener(log)
    try:
        events = contract_events(watched(spark, source, table.schema, maxFilesPerTrigger=str(FILES_OF_SLICE)))
        out, state = scratch_path(spark, "reported"), scratch_path(spark, "reported-state")
        run_stream(project.encode_events(events), out, state, trigger=CATCH_UP, name=name).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        log.flush()
    finally:
        spark.streams.removeListener(log)
    own = log.frame(spark).where((F.col("query") == name) & (F.col("input_rows") > 0))
    return own.agg(
        F.count_distinct("batch_id").alias("batches"), F.sum("input_rows").alias("input_rows"), F.sum("dropped_late").alias("dropped_late")
    )


@query(f"""
WITH {FAULTY_SQL}
SELECT count(*) AS decoded_rows, count(*) FILTER (WHERE NOT coalesce({VALID_SQL} AND event_id IS NOT NULL, FALSE)) AS invalid_rows
FROM faulty
""")
def m9_invalid_rows(spark, folder):
    """Decoded and invalid rows that the batches of a stream report on their way."""
    table = spark.read.parquet(f"{folder}/events.parquet")
    source = scratch_path(spark, "faulty")
    for number in range(SLICES):
        arrive(table, source, slice_of(), number)
    events = faulty_events(spark, folder, watched(spark, source, table.schema, maxFilesPerTrigger=str(FILES_OF_SLICE)))
    out, state = scratch_path(spark, "counted"), scratch_path(spark, "counted-state")
    stream = run_stream(project.encode_events(events), out, state, trigger=CATCH_UP)
    stream.awaitTermination()
    # Four batches and the last one without rows are within what a query remembers.
    return recent_progress(stream).agg(F.sum("decoded_rows").alias("decoded_rows"), F.sum("invalid_rows").alias("invalid_rows"))


SIZES_SQL = f"""
count(*) AS messages, round(avg(size) + {TIE}, 6) AS mean_bytes, quantile_disc(size, 0.5) AS p50_bytes,
quantile_disc(size, 0.95) AS p95_bytes
FROM (SELECT ts, CAST(strlen(props) AS BIGINT) AS size FROM events) AS sized
"""


def _sized(spark: SparkSession, folder: str) -> DataFrame:
    table = spark.read.parquet(f"{folder}/events.parquet")
    return table.select(F.col("ts").alias("timestamp"), F.col("props").cast("binary").alias("value"))


@query(f"SELECT {SIZES_SQL}")
def m5_message_sizes(spark, folder):
    return metrics.message_sizes(_sized(spark, folder)).withColumn("mean_bytes", _r("mean_bytes"))


@query(f"""
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
{SIZES_SQL} GROUP BY ALL
""")
def m5_message_sizes_by_window(spark, folder):
    return metrics.message_sizes(_sized(spark, folder), "1 hour").withColumn("mean_bytes", _r("mean_bytes"))


@query(f"""
WITH latest AS (
  SELECT CAST(event_id % 3 AS INTEGER) AS "partition", date_trunc('hour', ts) AS window_start,
         date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, max(event_id // 3) AS latest_offset
  FROM events GROUP BY ALL),
paired AS (
  SELECT *, latest_offset - lag(latest_offset) OVER series AS offset_growth,
         window_start - lag(window_start) OVER series AS passed
  FROM latest WINDOW series AS (PARTITION BY "partition" ORDER BY window_start))
SELECT "partition", window_start, window_end, latest_offset, offset_growth,
       round(offset_growth / (epoch_us(window_start) - epoch_us(window_start - passed)) * 1000000.0 + {TIE}, 6) AS offsets_per_second
FROM paired
""")
def m6_partition_offsets(spark, folder):
    messages = as_messages(read_events(spark, folder))
    return metrics.partition_offsets(messages, "1 hour").withColumn(
        "offsets_per_second", _r("offsets_per_second")
    )


def _gaps_sql(seconds: int) -> str:
    return f"""
SELECT device_type, gap_start, gap_end, round(gap_seconds + {TIE}, 6) AS gap_seconds FROM (
  SELECT event_type AS device_type, lag(ts) OVER series AS gap_start, ts AS gap_end,
         (epoch_us(ts) - epoch_us(lag(ts) OVER series)) / 1000000.0 AS gap_seconds
  FROM events WINDOW series AS (PARTITION BY event_type ORDER BY ts)) AS paired
WHERE gap_seconds > {seconds}
"""


@query(_gaps_sql(300))
def m7_silence_gaps(spark, folder):
    return metrics.silence_gaps(read_events(spark, folder), 300).withColumn("gap_seconds", _r("gap_seconds"))


@query("""
WITH last AS (SELECT event_type AS device_type, max(ts) AS gap_start FROM events GROUP BY ALL)
SELECT device_type, gap_start, CAST(NULL AS TIMESTAMP) AS gap_end,
       round((epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(gap_start)) / 1000000.0 + %s, 6) AS gap_seconds
FROM last
""" % TIE)
def m7_open_silences(spark, folder):
    """What has been silent since, seen from a later instant."""
    gaps = metrics.silence_gaps(read_events(spark, folder), 300, still_open=True, until=datetime(2024, 2, 1))
    return gaps.filter("gap_end IS NULL").withColumn("gap_seconds", _r("gap_seconds"))


@query(_gaps_sql(1800))
def m7_long_silence_gaps(spark, folder):
    return metrics.silence_gaps(read_events(spark, folder), 1800).withColumn("gap_seconds", _r("gap_seconds"))


@query(f"""
WITH {FAULTY_SQL}
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       count(*) FILTER (WHERE {REASONS_SQL} <> '') AS rejected, count(*) AS events,
       round(count(*) FILTER (WHERE {REASONS_SQL} <> '') / count(*) + {TIE}, 6) AS error_rate
FROM faulty GROUP BY ALL
""")
def m8_error_rates(spark, folder):
    rates = metrics.error_rates(faulty_events(spark, folder), quality.contract_rules(), "1 hour")
    return rates.withColumn("error_rate", _r("error_rate"))


def _total_sql(name: str, total: str, sql: str) -> str:
    return f"SELECT '{name}' AS report, count(*) AS \"rows\", CAST(sum({total}) AS BIGINT) AS total FROM ({sql}) AS t"


@query(f"WITH {EVENTS_SQL} " + " UNION ALL ".join([
    _total_sql("event_rates", "events", " UNION ALL ".join(
        f"SELECT count(*) AS events FROM ev GROUP BY {keys}" for keys in
        ("date_trunc('hour', ts), device_type, status", "date_trunc('hour', ts), device_type", "date_trunc('hour', ts), status", "date_trunc('hour', ts)")
    )),
    _total_sql("messages_per_minute", "events", "SELECT count(*) AS events FROM ev GROUP BY date_trunc('minute', ts)"),
    _total_sql("active_devices", "n", "SELECT count(DISTINCT device_id) AS n FROM ev GROUP BY date_trunc('hour', ts)"),
    _total_sql("message_sizes", "n", "SELECT count(*) AS n FROM ev GROUP BY date_trunc('hour', ts)"),
    _total_sql("partition_offsets", "n", "SELECT max(event_id // 3) AS n FROM events GROUP BY event_id % 3, date_trunc('hour', ts)"),
    _total_sql("silence_gaps", "CAST(round(gap_seconds * 1000000) AS BIGINT)", _gaps_sql(300)),
    # No identifier of the given table is a UUID.
    _total_sql("error_rates", "n", f"""SELECT count(*) FILTER (WHERE NOT regexp_full_match(event_id, '{CANONICAL_SQL}')) AS n
        FROM ev GROUP BY date_trunc('hour', ts)"""),
]))
def q6_stream_metrics(spark, folder):
    """All health reports of the messages: how many rows each has, and the sum of what it counts."""
    events = read_events(spark, folder).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    reports = stream_metrics(as_messages(events), "1 hour")
    counted = {
        "event_rates": "events", "messages_per_minute": "events", "active_devices": "active_devices", "message_sizes": "messages",
        "partition_offsets": "latest_offset", "silence_gaps": "CAST(round(gap_seconds * 1000000) AS BIGINT)", "error_rates": "rejected",
    }
    return reduce(DataFrame.unionByName, [
        reports[name].agg(F.count(F.lit(1)).alias("rows"), F.sum(F.expr(total)).cast("bigint").alias("total"))
        .select(F.lit(name).alias("report"), "rows", "total")
        for name, total in counted.items()
    ])


@query(f"""
WITH {EVENTS_SQL}, {_windows_sql('minute')}
SELECT {CALENDAR_SQL}, count(*) AS "rows", TRUE AS has_files FROM win GROUP BY ALL
""")
def m10_landed_files(spark, folder):
    """Rows of every hour, summed over its files; the number of files is the writer's choice."""
    landed = tables.landed_hours(spark, landed_windows(spark, folder))
    return landed.select(*PARTITION_COLUMNS, "rows", (F.col("files") > 0).alias("has_files"))
