"""Column expressions: no frame, no action, no Python worker."""

from tidewatch.functions.event import (
    calendar_parts,
    duration_category,
    event_date,
    is_critical,
    is_uuid,
    map_entry,
    parse_event_time,
)
from tidewatch.functions.stats import beyond_sigma, discrete_rank, numeric, sample_mean, sample_sigma, within_sigma

__all__ = [
    "beyond_sigma",
    "calendar_parts",
    "discrete_rank",
    "duration_category",
    "event_date",
    "is_critical",
    "is_uuid",
    "map_entry",
    "numeric",
    "parse_event_time",
    "sample_mean",
    "sample_sigma",
    "within_sigma",
]
