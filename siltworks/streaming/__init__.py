"""Streams: events conformed as they arrive."""

from siltworks.streaming.arrivals import arrivals_silver_stream, scan_arrivals, start_arrivals
from siltworks.streaming.events import (
    await_all,
    await_sink,
    events_silver_stream,
    late_rows,
    late_rows_of,
    scan_stream,
    start_events_sink,
    stream_session,
    untimed_events,
)
from siltworks.streaming.reports import BatchReport, batch_report

__all__ = [
    "BatchReport",
    "arrivals_silver_stream",
    "await_all",
    "await_sink",
    "batch_report",
    "events_silver_stream",
    "late_rows",
    "late_rows_of",
    "scan_arrivals",
    "scan_stream",
    "start_arrivals",
    "start_events_sink",
    "stream_session",
    "untimed_events",
]
