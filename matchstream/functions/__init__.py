"""Column-level helpers (JVM-side expressions only, no UDFs)."""

from matchstream.functions.casts import int_or_zero, iso_timestamp
from matchstream.functions.format import alert_label, percent_text, window_bound_text
from matchstream.functions.parse import parse_json_events

__all__ = [
    "int_or_zero",
    "iso_timestamp",
    "alert_label",
    "percent_text",
    "window_bound_text",
    "parse_json_events",
]
