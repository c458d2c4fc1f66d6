"""Landed responses and arrivals as streams."""

from shelfmark.streaming.arrivals import (
    append_log,
    drain,
    first_in_log,
    merge_log,
    read_stream,
)
from shelfmark.streaming.live import latest_telemetry, live_counts, telemetry_query
from shelfmark.streaming.seen import seen_rows, update_seen

__all__ = [
    "append_log", "drain", "first_in_log", "latest_telemetry", "live_counts", "merge_log", "read_stream",
    "seen_rows", "telemetry_query", "update_seen",
]
