"""Column functions."""

from .columns import (
    exception_class,
    glob_match,
    level_for_status,
    level_name,
    level_value,
    limit_str,
    normalize_sql,
    occurrences,
    sql_table,
    trace_url,
    uri_path,
)
from .sql import register_functions

__all__ = [
    "exception_class", "glob_match", "level_for_status", "level_name", "level_value", "limit_str", "normalize_sql", "occurrences", "register_functions",
    "sql_table", "trace_url", "uri_path",
]
