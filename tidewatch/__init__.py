"""Event analytics on Spark: the public API in one place."""

from tidewatch.shared import durable, scratch_path, shared_folder
from tidewatch.operators.aggregate import (
    compute_daily_statistics,
    compute_percentiles,
    group_spread,
    non_null_counts,
    preview,
    qualified_spread,
    roll_up_percentiles,
    roll_up_windows,
    window_aggregates,
)
from tidewatch.operators.dedup import dedup_events
from tidewatch.operators.filters import drop_invalid_events, filter_qualified_devices, in_days, keep_inliers
from tidewatch.operators.joins import join_dimension, keyed_join
from tidewatch.operators.metrics import (
    active_devices,
    device_sketches,
    error_rates,
    event_rates,
    message_sizes,
    partition_offsets,
    roll_up_devices,
    silence_gaps,
    stream_silences,
    window_counts,
)
from tidewatch.operators.outliers import (
    detect_outliers_iqr,
    detect_outliers_percentile,
    detect_outliers_zscore,
    is_outlier_3sigma,
    remove_outliers,
)
from tidewatch.operators.project import (
    daily_window_rows,
    decode_events,
    decode_messages,
    encode_events,
    enrich_with_metadata,
    unpack_window,
    with_calendar_parts,
    with_event_date,
    with_event_time,
    with_map_entries,
)
from tidewatch.operators.quality import (
    contract_rules,
    ingest_rules,
    quality_report,
    split_valid,
    validate_no_nulls,
    validate_positive_values,
    validate_range,
    validate_results,
    validate_schema,
    with_validity,
)
from tidewatch.operators.quantiles import exact_quantiles, quantiles
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
from tidewatch.schema import EVENT_SCHEMA, MESSAGE_SCHEMA, WINDOW_SCHEMA, WIRE_SCHEMA
from tidewatch.session import build_session
from tidewatch.sources.bus import (
    publish_events,
    read_messages,
    stream_json_lines,
    stream_message_files,
    stream_messages,
)
from tidewatch.sources.tables import (
    compact_days,
    export_results,
    landed_hours,
    landing_problems,
    load_data,
    read_results,
    write_windows,
)
from tidewatch.streaming.progress import ProgressLog, recent_progress
from tidewatch.streaming.runner import CATCH_UP, LIVE, append_windows, run_stream

__all__ = [name for name in dir() if not name.startswith("_")]
