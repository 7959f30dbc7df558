"""The operators on streams."""

from .stream import (
    stream_collapse, stream_count_or_time, stream_debounce, stream_idempotent, stream_n_plus_one, stream_pipeline, stream_rate_cap, stream_window_closings, write_with_reports,
)

__all__ = [
    "stream_collapse", "stream_count_or_time", "stream_debounce", "stream_idempotent", "stream_n_plus_one", "stream_pipeline", "stream_rate_cap", "stream_window_closings", "write_with_reports",
]
