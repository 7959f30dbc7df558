"""The scalar functions as temporary SQL functions, which Spark inlines into the plan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import SparkSession

from ..schema import LEVELS
from .columns import SQL_PATTERNS, TABLE_PATTERN, TABLE_WORDS

_LEVELS = " ".join(f"WHEN '{k}' THEN {v}" for k, v in LEVELS.items())
_raw = lambda pattern: f'r"{pattern}"' if "'" in pattern else f"r'{pattern}'"
_NORMAL = reduce(lambda q, pattern: f"regexp_replace({q}, {_raw(pattern)}, '?')", SQL_PATTERNS[:3], "q")
_TABLES = ", ".join(f"nullif(regexp_extract(q, {_raw(TABLE_PATTERN.format(word))}, 1), '')" for word in TABLE_WORDS)
FUNCTIONS = {
    "level_value(name STRING) RETURNS INT": f"CASE lower(name) {_LEVELS} END",
    "level_for_status(status INT) RETURNS STRING": "CASE WHEN status >= 500 THEN 'error' WHEN status >= 400 THEN 'warning' WHEN status >= 300 THEN 'notice' ELSE 'info' END",
    "uri_path(uri STRING) RETURNS STRING": r"nullif(ltrim('/', regexp_replace(regexp_replace(regexp_replace(uri, r'(?s)^[^ ]* ', ''), r'(?s)^.*?://[^/]*', ''), r'(?s)[?#].*$', '')), '')",
    "normalize_sql(q STRING) RETURNS STRING": f"regexp_replace({_NORMAL}, {_raw(SQL_PATTERNS[3])}, 'IN (?)')",
    "sql_table(q STRING) RETURNS STRING": f"coalesce({_TABLES}, 'unknown')",
    "limit_str(t STRING, n INT) RETURNS STRING": "CASE WHEN char_length(t) > n THEN concat(left(t, n), '...') ELSE t END",
}


def register_functions(spark: SparkSession) -> None:
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
