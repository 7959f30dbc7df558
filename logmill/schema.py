"""Schemas of the tables that the operators take."""

from __future__ import annotations

# Level names and numbers.
LEVELS = {"debug": 100, "info": 200, "notice": 250, "warning": 300, "error": 400, "critical": 500, "alert": 550, "emergency": 600}
ERROR = LEVELS["error"]

LOG_SCHEMA = """
    trace_id string, span_id string, parent_span_id string, origin string, level_name string, level int, channel string, message string,
    stacktrace string, caller_file string, caller_line int, caller_method string, uri string, http_method string, route_name string,
    route_action string, ip string, user_agent string, request_input string, user_id string, app_name string, app_env string, app_url string,
    git_sha string, job_class string, job_attempt int, queue_name string, connection_name string, duration_ms long, context string,
    breadcrumbs string, job_props string, measures array<struct<label: string, duration_ms: double, meta: string>>, memory_peak_mb int,
    extra string, count long, first_at timestamp, last_at timestamp, suppressed_count long, logged_at timestamp
"""
QUERY_SCHEMA = "trace_id string, span_id string, seq long, ts timestamp, connection string, sql string, time_ms double, caller string"
HTTP_SCHEMA = "trace_id string, span_id string, ts timestamp, method string, path string, status int, exception_class string, exception_file string"
CALL_SCHEMA = "span_id string, seq int, component string, method string, params string"
OPERATION_SCHEMA = "span_id string, seq int, type string, name string, root_fields array<string>"
OUTAGE_SCHEMA = "tripped_at timestamp, status int, reason string, cooldown_s int"
