"""Readers and writers of log rows."""

from .lines import format_lines, parse_lines, read_log_lines, write_log_lines
from .payloads import batch_by_count, chunk_by_bytes, read_payloads, retain_newest, write_payloads
from .rows import read_log_stream, read_logs_jsonl, write_logs_jsonl, write_logs_parquet

__all__ = [
    "batch_by_count", "chunk_by_bytes", "format_lines", "parse_lines", "read_log_lines", "read_log_stream", "read_logs_jsonl", "read_payloads", "retain_newest",
    "write_log_lines", "write_logs_jsonl", "write_logs_parquet", "write_payloads",
]
