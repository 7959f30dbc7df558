"""The given tables seen as log rows, statements, HTTP exchanges and snapshots: once in Spark and once, for comparison, in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_LOGS = """
    event_id AS seq, ts AS logged_at, concat('t', user_id, '-', cast(ts AS date)) AS trace_id,
    concat('t', user_id, '-', cast(ts AS date), '/', event_id % 3) AS span_id,
    CASE WHEN event_id % 3 <> 0 THEN concat('t', user_id, '-', cast(ts AS date), '/0') END AS parent_span_id,
    CASE event_id % 3 WHEN 0 THEN 'http' WHEN 1 THEN 'queue' ELSE 'schedule' END AS origin,
    CASE event_type WHEN 'error' THEN CASE WHEN value >= 100 THEN 500 ELSE 400 END WHEN 'purchase' THEN 250
         WHEN 'click' THEN CASE WHEN value >= 100 THEN 300 ELSE 200 END WHEN 'signup' THEN 200 ELSE 100 END AS level,
    concat(CASE event_type WHEN 'error' THEN 'job.failed' WHEN 'purchase' THEN 'job.completed' WHEN 'signup' THEN 'auth.login'
                           WHEN 'click' THEN 'event.dispatched' ELSE 'route.matched' END,
           ': S', k % 5, CASE WHEN event_type = 'error' THEN ' — boom' ELSE '' END) AS message,
    CASE WHEN event_type = 'error' THEN concat('E', k % 3, ': boom', chr(10), 'in app/Mod', k % 7, '.php:', k, chr(10), chr(10), '#0 {main}') END AS stacktrace,
    concat('app/Mod', k % 7, '.php') AS caller_file, k AS caller_line, concat('Mod', k % 7, '@', event_type) AS caller_method,
    concat('GET https://app.test/', event_type, '/', k % 10, '?e=', event_id) AS uri, 'GET' AS http_method,
    concat(event_type, '.', k % 10) AS route_name, cast(user_id AS string) AS user_id,
    CASE WHEN user_id % 5 = 0 THEN 'staging' ELSE 'production' END AS app_env,
    CASE WHEN ts < timestamp '2024-01-11' THEN 'aaaaaaa1' WHEN ts < timestamp '2024-01-21' THEN 'bbbbbbb2' ELSE 'ccccccc3' END AS git_sha,
    CASE WHEN event_id % 3 = 1 THEN concat('Job', k % 4) END AS job_class, cast(floor(value * 10) AS bigint) AS duration_ms,
    CASE WHEN event_id % 4 = 0 THEN k END AS memory_peak_mb, props AS context,
    cast(CASE WHEN event_id % 4 = 0 THEN 2 ELSE 1 END AS bigint) AS count, cast(CASE WHEN event_id % 11 = 0 THEN 2 END AS bigint) AS suppressed_count
"""

_QUERIES = """
    concat('o', l_orderkey) AS trace_id, concat('o', l_orderkey) AS span_id,
    concat('select * from part where p_partkey = ', l_partkey) AS sql, l_extendedprice / 100 AS time_ms, concat('c', l_suppkey % 2) AS connection,
    l_shipdate AS ts, concat('app/Repo', l_partkey % 9, '.php#', l_linenumber) AS caller,
    cast(l_linenumber AS bigint) * 1000000000000 + cast(l_partkey AS bigint) * 1000000 + l_suppkey AS seq
"""

_EXCHANGES = """
    event_id AS seq, ts, concat(event_type, '/', k % 10) AS path, CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method,
    CASE event_type WHEN 'error' THEN 500 + k % 4 WHEN 'click' THEN 400 + k % 30 WHEN 'view' THEN 200 WHEN 'signup' THEN 302 ELSE 201 END AS status,
    CASE WHEN event_type IN ('error', 'click') AND k % 2 = 0 THEN 'AccessDenied' END AS exception_class
"""

_SPARK_K = "cast(get_json_object(props, '$.k') AS int)"
_DUCK_K = "cast(props->>'$.k' AS int)"


def _duck(select: str) -> str:
    return select.replace("AS string)", "AS varchar)")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, name: str, select: str) -> DataFrame:
    rows = table(spark, sf_dir, name)
    rows = rows.selectExpr("*", f"{_SPARK_K} AS k") if name == "events" else rows
    rows.createOrReplaceTempView(f"_{name}_rows")
    return spark.sql(f"SELECT {select} FROM _{name}_rows")


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "events", _LOGS)


def storm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows with few users, one file and five lines, so that many are repeated."""
    return storm_of(logs(spark, sf_dir))


def storm_of(rows: DataFrame) -> DataFrame:
    return rows.selectExpr("* EXCEPT (user_id, caller_file, caller_line, stacktrace)", "cast(cast(user_id AS bigint) % 3 AS string) AS user_id", "'app/Storm.php' AS caller_file", "caller_line % 5 AS caller_line", "CASE WHEN stacktrace IS NOT NULL THEN 'E: boom' END AS stacktrace")


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "lineitem", _QUERIES)


def logs_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows as a stream over the table's files, with event times as timestamps."""
    rows = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/[e]vents.parquet")  # a pattern, so that one file will do
    rows.selectExpr("*", f"{_SPARK_K} AS k").createOrReplaceTempView("_events_stream")
    return spark.sql(f"SELECT {_LOGS} FROM _events_stream").selectExpr("* EXCEPT (logged_at)", "cast(logged_at AS timestamp) AS logged_at")


def statements_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.readStream.schema(table(spark, sf_dir, "lineitem").schema).parquet(f"{sf_dir}/[l]ineitem.parquet")
    rows.createOrReplaceTempView("_lineitem_stream")
    return spark.sql(f"SELECT {_QUERIES} FROM _lineitem_stream").selectExpr("* EXCEPT (ts)", "cast(ts AS timestamp) AS ts")


def exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "events", _EXCHANGES)


DUCK = {
    "logs": f"logs AS (SELECT {_duck(_LOGS)} FROM (SELECT *, {_DUCK_K} AS k FROM events))",
    "storm": "storm AS (SELECT * EXCLUDE (user_id, caller_file, caller_line, stacktrace), cast(cast(user_id AS bigint) % 3 AS varchar) AS user_id, 'app/Storm.php' AS caller_file, caller_line % 5 AS caller_line, CASE WHEN stacktrace IS NOT NULL THEN 'E: boom' END AS stacktrace FROM logs)",
    "statements": f"statements AS (SELECT {_QUERIES} FROM lineitem)",
    "exchanges": f"exchanges AS (SELECT {_EXCHANGES} FROM (SELECT *, {_DUCK_K} AS k FROM events))",
}


def duck(*views: str, recursive: bool = False) -> str:
    """WITH clause of views in DuckDB SQL."""
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(DUCK[v] for v in views) + "\n"
