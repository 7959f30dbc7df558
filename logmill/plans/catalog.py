"""Registered queries: each applies one operator to whole tables; beside it, DuckDB SQL for the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as X
from ..operators import analytics as A
from ..operators import dedup as D
from ..operators import derive as E
from ..operators import filters as L
from ..operators import redact as R
from ..operators import search as Q
from ..operators import traces as T
from ..operators.text_index import build_text_index
from ..operators.vector_index import build_vector_index
from ..sources import batch_by_count, chunk_by_bytes, format_lines, parse_lines, read_log_stream, read_logs_jsonl, read_payloads, retain_newest, write_logs_jsonl, write_logs_parquet, write_payloads
from ..streaming import stream_collapse, stream_count_or_time, stream_debounce, stream_idempotent, stream_n_plus_one, stream_pipeline, stream_rate_cap, stream_window_closings, write_with_reports
from ..scratch import drained, scratch_path
from . import views as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
N = "(coalesce(count, 1) + coalesce(suppressed_count, 0))"
PATH = r"nullif(ltrim(regexp_replace(regexp_replace(regexp_replace({0}, '^[^ ]* ', ''), '^.*?://[^/]*', ''), '[?#].*$', ''), '/'), '')"
LEVEL = "CASE level WHEN 100 THEN 'DEBUG' WHEN 200 THEN 'INFO' WHEN 250 THEN 'NOTICE' WHEN 300 THEN 'WARNING' WHEN 400 THEN 'ERROR' WHEN 500 THEN 'CRITICAL' END"
FP = "md5(concat(level, '|', CASE WHEN stacktrace IS NULL THEN '' ELSE split_part(stacktrace, ': ', 1) END, '|', caller_file, ':', caller_line, '|', message, '|', user_id))"
NORMAL = "regexp_replace(sql, '\\b\\d+\\b', '?', 'g')"


def register(sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


# ---- Sources and sinks ----

_ROW = "seq long, message string, level int, context string"
_ROWS = V.duck("logs") + "SELECT seq, message, level, context FROM logs"


@register(_ROWS)
def s1_jsonl_round_trip(spark, d):
    path = scratch_path(spark, "jsonl")
    write_logs_jsonl(V.logs(spark, d).select("seq", "message", "level", "context"), path)
    return read_logs_jsonl(spark, path, _ROW)


@register(_ROWS)
def s2_payload_round_trip(spark, d):
    path = scratch_path(spark, "payloads")
    write_payloads(chunk_by_bytes(V.logs(spark, d).select("seq", "message", "level", "context", "app_env"), 65_536, "app_env", ["seq"]).drop("app_env"), path, ["seq"])
    return read_payloads(spark, path, _ROW)


@register(_ROWS)
def s3_log_stream(spark, d):
    path = scratch_path(spark, "jsonl")
    write_logs_jsonl(V.logs(spark, d).select("seq", "message", "level", "context").repartition(3), path)
    return drained(read_log_stream(spark, path, 2, _ROW))


@register(V.duck("logs") + "SELECT seq, message, logged_at FROM logs WHERE logged_at >= timestamp '2024-01-10' AND logged_at < timestamp '2024-01-12'")
def s4_parquet_by_day(spark, d):
    path = scratch_path(spark, "by_day")
    write_logs_parquet(V.logs(spark, d).select("seq", "message", "logged_at"), path)
    return spark.read.parquet(path).where("logged_on between date '2024-01-10' and date '2024-01-11'").select("seq", "message", "logged_at")


@register(V.duck("logs") + "SELECT seq, (row_number() OVER (ORDER BY logged_at, seq) - 1) // 256 AS batch_no FROM logs")
def s5_batch_by_count(spark, d):
    return batch_by_count(V.logs(spark, d).select("logged_at", "seq"), ["logged_at", "seq"]).select("seq", "batch_no")


@register(V.duck("logs", recursive=True) + """, x AS (SELECT *, row_number() OVER (PARTITION BY app_env ORDER BY seq) AS k, sum(octet_length(encode(to_json(struct_pack(seq, trace_id, app_env, message, context))::varchar))) OVER (PARTITION BY app_env ORDER BY seq) AS s
        FROM (SELECT seq, trace_id, app_env, message, context FROM logs)),
    c AS (SELECT app_env, 0::bigint AS chunk_no, 1::bigint AS a, max(k) AS b FROM x WHERE s <= 65536 OR k = 1 GROUP BY 1
        UNION ALL SELECT c.app_env, c.chunk_no + 1, c.b + 1, max(x.k) FROM c JOIN x p ON p.app_env = c.app_env AND p.k = c.b JOIN x ON x.app_env = c.app_env AND x.k > c.b AND (x.s - p.s <= 65536 OR x.k = c.b + 1) GROUP BY c.app_env, c.chunk_no, c.b)
    SELECT seq, trace_id, x.app_env AS app_env, message, context, x.app_env AS chunk_key, chunk_no FROM x JOIN c ON c.app_env = x.app_env AND x.k BETWEEN c.a AND c.b""")
def s6_chunk_by_bytes(spark, d):
    return chunk_by_bytes(V.logs(spark, d).select("seq", "trace_id", "app_env", "message", "context"), 65_536, "app_env", ["seq"])


@register(V.duck("logs") + "SELECT count(*) AS n, min(seq) AS first, max(seq) AS last, arg_max(message, seq) AS last_message FROM logs GROUP BY user_id, seq % 2")
def s7_write_payloads(spark, d):
    path = scratch_path(spark, "documents")
    rows = V.logs(spark, d).select("seq", "message", F.col("user_id").alias("chunk_key"), (F.col("seq") % 2).alias("chunk_no"))
    write_payloads(rows, path, ["seq"])
    logs = F.from_json("value", "logs array<struct<seq: long, message: string>>")["logs"]
    return spark.read.text(path).select(F.size(logs).cast("long").alias("n"), logs[0]["seq"].alias("first"), F.element_at(logs, -1)["seq"].alias("last"), F.element_at(logs, -1)["message"].alias("last_message"))


@register(V.duck("logs") + "SELECT seq, logged_at FROM logs ORDER BY logged_at DESC, seq DESC LIMIT 5000")
def s8_retain_newest(spark, d):
    return retain_newest(V.logs(spark, d).select("seq", "logged_at"))


@register(V.duck("logs") + "SELECT seq, user_id FROM logs QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY logged_at DESC, seq DESC) <= 3")
def s8_retain_newest_by_user(spark, d):
    return retain_newest(V.logs(spark, d).select("seq", "logged_at", "user_id"), 3, "user_id").select("seq", "user_id")


@register(V.duck("logs") + f"SELECT date_trunc('second', logged_at) AS logged_at, 'app' AS channel, {LEVEL} AS level_name, message, context, cast(NULL AS varchar) AS extra FROM logs")
def s9_lines_round_trip(spark, d):
    rows = V.logs(spark, d).select("logged_at", F.lit("app").alias("channel"), X.level_name("level").alias("level_name"), "message", "context", F.lit(None).cast("string").alias("extra"))
    back = parse_lines(format_lines(rows))
    return back.withColumn("logged_at", F.col("logged_at").cast("timestamp_ntz"))


# ---- Projections and derived events ----


@register(V.duck("logs") + "SELECT seq, left(uri, 2048) AS uri, left(http_method, 8) AS http_method, context, count, date_trunc('millisecond', logged_at) AS logged_at FROM logs")
def e1_normalize_records(spark, d):
    return E.normalize_records(V.logs(spark, d)).select("seq", "uri", "http_method", "context", "count", "logged_at")


@register(V.duck("logs") + "SELECT seq, CASE WHEN seq % 2 = 0 THEN git_sha WHEN app_env = 'staging' THEN 'fffffff9' ELSE 'eeeeeee0' END AS git_sha FROM logs")
def e2_fill_identity(spark, d):
    rows = V.logs(spark, d).withColumns({"git_sha": F.when(F.col("seq") % 2 == 0, F.col("git_sha")), "app_name": F.lit("shop"), "app_url": F.lit(None).cast("string")})
    envs = rows.where("app_env = 'staging'").select("app_env").distinct().withColumn("git_sha", F.lit("fffffff9"))
    return E.fill_identity(rows, {"git_sha": "eeeeeee0"}, envs, on="app_env").select("seq", "git_sha")


@register(V.duck("logs") + f"SELECT seq, {LEVEL} AS level_name, level FROM logs")
def e3_levels(spark, d):
    named = V.logs(spark, d).select("seq", X.level_name("level").alias("level_name"))
    return named.select("seq", "level_name", X.level_value("level_name").alias("level"))


@register(V.duck("exchanges") + "SELECT status, CASE WHEN status >= 500 THEN 'error' WHEN status >= 400 THEN 'warning' WHEN status >= 300 THEN 'notice' ELSE 'info' END AS level_name, count(*) AS n FROM exchanges GROUP BY 1, 2")
def e4_level_for_status(spark, d):
    return V.exchanges(spark, d).groupBy("status", X.level_for_status("status").alias("level_name")).agg(F.count(F.lit(1)).alias("n"))


@register(f"SELECT page_id, {PATH.format('url')} AS path FROM pages")
def e5_uri_path(spark, d):
    return V.table(spark, d, "pages").select("page_id", X.uri_path("url").alias("path"))


@register(V.duck("logs") + """
    , calls AS (SELECT span_id, arg_max(concat(route_name, '::', caller_method), seq) AS label FROM logs WHERE level <= 200 GROUP BY 1)
    SELECT seq, CASE WHEN label IS NULL THEN uri ELSE concat('GET /livewire — ', label) END AS uri FROM logs LEFT JOIN calls USING (span_id)""")
def e6_group_uri_calls(spark, d):
    rows = V.logs(spark, d)
    calls = rows.where("level <= 200").select("span_id", "seq", F.col("route_name").alias("component"), F.col("caller_method").alias("method"), F.col("context").alias("params"))
    return E.group_uri_calls(rows.withColumn("route_action", F.lit(None).cast("string")), calls).select("seq", "uri")


@register(V.duck("logs") + """
    , ops AS (SELECT span_id, arg_min(concat('query ', caller_file, ', ', route_name), seq) AS label FROM logs WHERE NOT starts_with(caller_file, 'app/Mod3') GROUP BY 1)
    SELECT seq, CASE WHEN label IS NULL THEN uri ELSE concat('GET /graphql — ', label) END AS uri FROM logs LEFT JOIN ops USING (span_id)""")
def e7_group_uri_operations(spark, d):
    rows = V.logs(spark, d)
    first = F.when(F.col("caller_file").startswith("app/Mod3"), "__schema").otherwise(F.col("caller_file"))
    ops = rows.select("span_id", "seq", F.lit("query").alias("type"), F.lit(None).cast("string").alias("name"), F.array(first, "route_name").alias("root_fields"))
    return E.group_uri_operations(rows.withColumn("route_action", F.lit(None).cast("string")), ops).select("seq", "uri")


@register(V.duck("logs") + "SELECT seq, regexp_replace(uri, '/[0-9]+\\?.*$', '/{id}') AS uri FROM logs")
def e8_map_uri(spark, d):
    return E.map_uri(V.logs(spark, d), lambda u: F.regexp_replace(u, r"/[0-9]+\?.*$", "/{id}")).select("seq", "uri")


@register("""SELECT event_id AS seq, CASE WHEN event_type IN ('purchase', 'signup') THEN concat('{"k":"', props->>'$.k', '"}') END AS request_input FROM events""")
def e9_capture_input(spark, d):
    rows = V.table(spark, d, "events").select(F.col("event_id").alias("seq"), F.when(F.col("event_type").isin("purchase", "signup"), "POST").otherwise("GET").alias("http_method"), F.create_map(F.lit("k"), F.get_json_object("props", "$.k"), F.lit("_token"), F.lit("x")).alias("input"))
    return E.capture_input(rows).select("seq", "request_input")


@register(V.duck("logs") + """SELECT seq, concat('{"k":"', caller_line, '","user_label":"', user_id, '"}') AS extra FROM logs""")
def e10_promote_extra(spark, d):
    rows = V.logs(spark, d).select("seq", F.create_map(F.lit("k"), F.col("caller_line").cast("string"), F.lit("trace_id"), F.col("trace_id")).alias("extra_map"), F.col("user_id").alias("user_label"))
    return E.promote_extra(rows).select("seq", "extra")


@register(V.duck("logs") + "SELECT seq, caller_line AS k FROM logs")
def e11_filter_job_props(spark, d):
    props = F.create_map(F.lit("queue"), F.col("caller_line"), F.lit("k"), F.col("caller_line"), F.lit("tries"), F.lit(3))
    return V.logs(spark, d).select("seq", E.filter_job_props(props)["k"].alias("k"))


@register("SELECT doc_id, CASE WHEN length(text) > 200 THEN concat(left(text, 200), '...') ELSE text END AS summary, 2 AS tags FROM documents")
def e12_summarize_struct(spark, d):
    rows = V.table(spark, d, "documents").select("doc_id", F.struct("text", F.array("lang", "source").alias("tags")).alias("model"))
    done = E.summarize_struct(rows, "model")
    return done.select("doc_id", F.get_json_object("model_summary", "$.text").alias("summary"), F.get_json_object("model_summary", "$.tags_count").cast("int").alias("tags"))


@register(V.duck("logs") + "SELECT split_part(message, ': ', 1) AS event_kind, split_part(split_part(message, ': ', 2), ' — ', 1) AS subject, nullif(split_part(message, ' — ', 2), '') AS detail, count(*) AS n FROM logs GROUP BY 1, 2, 3")
def e13_classify_events(spark, d):
    return E.classify_events(V.logs(spark, d)).groupBy("event_kind", "subject", "detail").agg(F.count(F.lit(1)).alias("n"))


@register(V.duck("exchanges") + """
    SELECT seq, CASE WHEN exception_class IS NOT NULL THEN concat('http.rejected: ', status, ' ', method, ' ', path, ' — ', exception_class) ELSE concat('http.response: ', status, ' ', method, ' ', path) END AS message,
           CASE WHEN status >= 500 THEN 400 ELSE 300 END AS level
    FROM exchanges WHERE (exception_class IS NOT NULL AND status < 500) OR (exception_class IS NULL AND status >= 400)""")
def e14_http_events(spark, d):
    return E.http_events(V.exchanges(spark, d)).select("seq", "message", "level")


@register(V.duck("exchanges") + """
    SELECT seq, CASE WHEN status >= 503 THEN concat('http.connection_failed: GET https://api.test/', path) ELSE concat('http.error: ', status, ' GET https://api.test/', path) END AS message
    FROM exchanges WHERE status >= 400""")
def e15_http_client_errors(spark, d):
    calls = V.exchanges(spark, d).select("seq", F.when(F.col("status") < 503, F.col("status")).alias("status"), F.lit("GET").alias("method"), F.concat(F.lit("https://api.test/"), "path").alias("url"), F.lit("").alias("body"))
    return E.http_client_errors(calls).select("seq", "message")


@register(V.duck("exchanges") + "SELECT seq, CASE WHEN exception_class = 'AccessDenied' THEN 403 ELSE 500 END AS mapped_status FROM exchanges")
def e16_exception_status(spark, d):
    rows = V.exchanges(spark, d)
    mapping = rows.select("exception_class").where("exception_class is not null").distinct().withColumn("status", F.lit(403))
    return E.exception_status(rows, mapping).select("seq", "mapped_status")


@register(V.duck("statements") + """
    SELECT trace_id, seq, time_ms, includes_connect, concat('db.slow_query: ', sql) AS message FROM (
      SELECT *, row_number() OVER (PARTITION BY trace_id, span_id, connection ORDER BY ts, seq) = 1 AS includes_connect FROM statements)
    WHERE time_ms >= 500""")
def e17_slow_queries(spark, d):
    return E.slow_queries(V.statements(spark, d)).select("trace_id", "seq", "time_ms", "includes_connect", "message")


@register(V.duck("statements") + """
    SELECT regexp_replace(regexp_replace(regexp_replace(regexp_replace(q, '''.+?''', '?', 'g'), '"[^"]+?"', '?', 'g'), '\\b\\d+\\b', '?', 'g'), 'IN\\s*\\(\\?(?:,\\s*\\?)*\\)', 'IN (?)', 'gi') AS statement, count(*) AS n
    FROM (SELECT concat(sql, ' and "c" in (', connection, ', 1, 2) and x IN (', seq % 3, ', 7, 8) and y = ''it ', seq, '''') AS q FROM statements) GROUP BY 1""")
def e18_normalize_sql(spark, d):
    q = F.concat("sql", F.lit(' and "c" in ('), "connection", F.lit(", 1, 2) and x IN ("), (F.col("seq") % 3).cast("string"), F.lit(", 7, 8) and y = 'it "), F.col("seq").cast("string"), F.lit("'"))
    return V.statements(spark, d).groupBy(X.normalize_sql(q).alias("statement")).agg(F.count(F.lit(1)).alias("n"))


@register(V.duck("statements") + "SELECT CASE seq % 4 WHEN 0 THEN 'part' WHEN 1 THEN 'orders' WHEN 2 THEN 'users' ELSE 'unknown' END AS \"table\", count(*) AS n FROM statements GROUP BY 1")
def e19_sql_table(spark, d):
    q = F.when(F.col("seq") % 4 == 0, F.col("sql")).when(F.col("seq") % 4 == 1, F.lit('insert into "orders" values (1)')).when(F.col("seq") % 4 == 2, F.lit("update `users` set a = 1")).otherwise(F.lit("begin"))
    return V.statements(spark, d).groupBy(X.sql_table(q).alias("table")).agg(F.count(F.lit(1)).alias("n"))


@register("""
    WITH b AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 17 <> 0),
    a AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 13 <> 0)
    SELECT o_orderkey, CASE WHEN b.o_totalprice IS NULL THEN 'created' WHEN a.o_totalprice IS NULL THEN 'deleted' ELSE 'updated' END AS change,
           CASE WHEN b.o_totalprice IS NOT NULL AND a.o_totalprice IS NOT NULL THEN 'o_orderstatus,api_token' END AS changed,
           CASE WHEN a.o_totalprice IS NULL THEN NULL ELSE a.o_orderstatus END AS status_to,
           CASE WHEN b.o_totalprice IS NOT NULL AND a.o_totalprice IS NOT NULL THEN '********' END AS token_from, CASE WHEN a.o_totalprice IS NOT NULL THEN '********' END AS token_to
    FROM b FULL JOIN a USING (o_orderkey) WHERE b.o_totalprice IS NULL OR a.o_totalprice IS NULL OR a.o_orderstatus <> b.o_orderstatus""")
def e21_diff_snapshots(spark, d):
    orders = V.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.concat(F.lit("t"), "o_custkey").alias("api_token"))
    before, tenth = orders.where("o_orderkey % 17 <> 0"), F.col("o_orderkey") % 10 == 0
    after = orders.where("o_orderkey % 13 <> 0").withColumns({"o_orderstatus": F.when(tenth, "X").otherwise(F.col("o_orderstatus")), "api_token": F.when(tenth, "new").otherwise(F.col("api_token"))})
    found = E.diff_snapshots(before, after, ["o_orderkey"], model="Order", models=["Order"])
    return found.select("o_orderkey", "change", F.array_join("changed", ",").alias("changed"), F.col("to")["o_orderstatus"].alias("status_to"), F.col("from")["api_token"].alias("token_from"), F.col("to")["api_token"].alias("token_to"))


@register(V.duck("logs") + "SELECT CASE origin WHEN 'http' THEN 'request' WHEN 'schedule' THEN 'scheduled_task' END AS label, count(*) AS n, sum(duration_ms)::double AS total_ms FROM logs WHERE origin <> 'queue' GROUP BY 1")
def e22_request_measures(spark, d):
    return E.request_measures(V.logs(spark, d)).select(F.inline("measures")).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("duration_ms").alias("total_ms"))


@register(V.duck("logs") + "SELECT DISTINCT trace_id, concat('https://logs.test/traces/', trace_id, '?tab=1') AS url FROM logs")
def e23_trace_url(spark, d):
    return V.logs(spark, d).select("trace_id").distinct().select("trace_id", X.trace_url("trace_id", "https://logs.test/traces/%s?tab=1").alias("url"))


@register("SELECT doc_id, CASE WHEN length(text) > 80 THEN concat(left(text, 80), '...') ELSE text END AS short FROM documents")
def e24_limit_str(spark, d):
    return V.table(spark, d, "documents").select("doc_id", X.limit_str("text", 80).alias("short"))


# ---- Filters ----


@register(f"SELECT page_id FROM (SELECT page_id, {PATH.format('url')} AS path FROM pages) WHERE starts_with(path, 'en/') OR regexp_full_match(path, '.*/1.*5', 's') OR path = 'fr/825'")
def f1_glob_match(spark, d):
    return V.table(spark, d, "pages").where(X.glob_match(X.uri_path("url"), ["en/*", "*/1*5", "/fr/825", "", None])).select("page_id")


@register(V.duck("logs") + "SELECT seq FROM logs WHERE span_id NOT IN (SELECT span_id FROM logs WHERE uri LIKE 'GET https://app.test/signup/3?%')")
def f2_drop_ignored_uris(spark, d):
    return L.drop_ignored_uris(V.logs(spark, d), ["signup/3"]).select("seq")


@register(V.duck("logs") + "SELECT seq FROM logs WHERE NOT (message LIKE 'event.dispatched: %' AND (message LIKE '%: S1%' OR message LIKE '%: S3'))")
def f3_drop_ignored_events(spark, d):
    return L.drop_ignored_events(E.classify_events(V.logs(spark, d)), ["S1*", "S3"]).select("seq")


@register(V.duck("logs") + "SELECT seq FROM logs WHERE NOT (message LIKE 'job.%' AND coalesce(job_class = 'Job2', false))")
def f4_drop_internal_jobs(spark, d):
    return L.drop_internal_jobs(E.classify_events(V.logs(spark, d)), ["Job2"]).select("seq")


@register(V.duck("logs") + "SELECT seq FROM logs WHERE route_name NOT LIKE 'view.%'")
def f5_drop_ignored_commands(spark, d):
    rows = V.logs(spark, d).withColumn("command_name", F.when(F.col("route_name").startswith("view."), "queue:work").otherwise("app:sync"))
    return L.drop_ignored_commands(rows).select("seq")


@register(V.duck("logs") + "SELECT seq FROM logs WHERE NOT starts_with(message, 'auth.login: ')")
def f6_enabled_kinds(spark, d):
    return L.enabled_kinds(E.classify_events(V.logs(spark, d)), {"auth.login": False}).select("seq")


@register(V.duck("logs") + "SELECT seq FROM logs WHERE level >= 300")
def f7_min_level(spark, d):
    return L.min_level(V.logs(spark, d), "warning").select("seq")


@register(V.duck("logs") + "SELECT seq FROM logs WHERE level NOT IN (100, 200, 250) OR (level = 200 AND ('0x' || left(md5(seq::varchar), 8))::bigint / 4294967295.0::double < 0.4) OR level = 250")
def f8_sample_levels(spark, d):
    return L.sample_levels(V.logs(spark, d), {"debug": 0, "info": 0.4, "notice": "nonsense", "error": 5}).select("seq")


@register(V.duck("logs") + "SELECT seq FROM logs WHERE (level <> 200 OR ('0x' || left(md5('7|' || seq), 8))::bigint / 4294967295.0::double < 0.4) AND (message NOT LIKE 'route.matched%' OR ('0x' || left(md5('7|' || trace_id), 8))::bigint / 4294967295.0::double < 0.5)")
def u4_seeded_samples(spark, d):
    return L.sample_traces(L.sample_levels(V.logs(spark, d), {"info": 0.4}, seed=7), {"view/*": 0.5}, seed=7).select("seq")


@register(V.duck("logs") + "SELECT seq FROM logs WHERE message NOT LIKE 'route.matched%' OR ('0x' || left(md5(trace_id), 8))::bigint / 4294967295.0::double < 0.5")
def f9_sample_traces(spark, d):
    return L.sample_traces(V.logs(spark, d), {"view/*": 0.5, "*": 1.0}).select("seq")


@register(V.duck("logs") + "SELECT seq FROM logs WHERE logged_at >= timestamp '2024-01-30' - interval 864000 second")
def f10_drop_stale(spark, d):
    kept, _ = L.drop_stale(V.logs(spark, d), "2024-01-30 00:00:00", 864_000)
    return kept.select("seq")


def _outages(spark, d):
    return V.table(spark, d, "events").where("event_id % 500 = 0").select(F.col("ts").alias("tripped_at"), F.lit(7200).alias("cooldown_s"), (500 + F.col("event_id") % 4).alias("status"), F.col("event_type").alias("reason"))


_SHED = V.duck("logs") + ", o AS (SELECT ts FROM events WHERE event_id % 500 = 0), gone AS (SELECT seq, count FROM logs WHERE level < 400 AND EXISTS (SELECT 1 FROM o WHERE logged_at >= ts AND logged_at < ts + interval 7200 second)) "


@register(_SHED + "SELECT seq FROM logs WHERE seq NOT IN (SELECT seq FROM gone)")
def f11_shed_during_outage(spark, d):
    return L.shed_during_outage(V.logs(spark, d), _outages(spark, d))[0].select("seq")


@register(_SHED + """, stale AS (SELECT count(*) AS n FROM logs WHERE logged_at < timestamp '2024-01-20')
    SELECT concat('agent.dropped_rows: ', (SELECT sum(greatest(1, count)) FROM gone) + n, ' log rows were dropped client-side during an ingest outage') AS message, 300 AS level, c.status::int AS circuit_status, c.reason AS circuit_reason
    FROM stale, (SELECT arg_max(500 + event_id % 4, ts) AS status, arg_max(event_type, ts) AS reason FROM events WHERE event_id % 500 = 0 AND ts <= timestamp '2024-01-30') c""")
def f12_drop_report(spark, d):
    rows = V.logs(spark, d)
    tally = L.shed_during_outage(rows, _outages(spark, d))[1].unionByName(L.drop_stale(rows, "2024-01-30 00:00:00", 864_000)[1])
    circuit = L.circuit_state(_outages(spark, d), "2024-01-30 00:00:00")
    report = L.drop_report(tally, "2024-01-30 00:00:00", circuit=circuit)
    told = lambda key: F.get_json_object("context", f"$.circuit.{key}")
    return report.select("message", "level", told("status").cast("int").alias("circuit_status"), told("reason").alias("circuit_reason"))


@register(V.duck("statements") + "SELECT count(*) AS n FROM statements WHERE seq % 5 NOT IN (0, 1)")
def f13_drop_tooling_queries(spark, d):
    rows = V.statements(spark, d).withColumns({"sql": F.when(F.col("seq") % 5 == 0, "select * from log_entries").otherwise(F.col("sql")), "caller": F.when(F.col("seq") % 5 == 1, "db/migrations/x.php").otherwise(F.col("caller"))})
    return L.drop_tooling_queries(rows).agg(F.count(F.lit(1)).alias("n"))


@register(V.duck("logs") + "SELECT seq, 1 AS n, concat(replace(caller_file, 'app/', 'src/')) AS file FROM logs")
def f14_user_frames(spark, d):
    frames = F.array(F.struct(F.lit("/srv/vendor/a.php").alias("file")), F.struct(F.concat(F.lit("/srv/"), F.replace("caller_file", F.lit("app/"), F.lit("src/"))).alias("file")))
    rows = V.logs(spark, d).withColumn("frames", L.user_frames(frames, base="/srv"))
    return rows.select("seq", F.size("frames").alias("n"), F.col("frames")[0]["file"].alias("file"))


# ---- Redaction ----


@register("SELECT c_custkey, '********' AS api_key, '********' AS nested_token, left(c_name, 3) AS nested_name FROM customer")
def r1_redact_columns(spark, d):
    rows = V.table(spark, d, "customer").select("c_custkey", F.col("c_name").alias("api_key"), F.struct(F.col("c_name").alias("access_token"), F.left("c_name", F.lit(3)).alias("name")).alias("nested"))
    done = R.redact_columns(rows, [p for p in R.KEY_PATTERNS if p != "key"] + ["api_key"])
    return done.select("c_custkey", "api_key", F.col("nested.access_token").alias("nested_token"), F.col("nested.name").alias("nested_name"))


@register("""SELECT event_id, concat('{"user":{"password":"********","k":', props->>'$.k', '},"tokens":"********"}') AS context FROM events""")
def r2_redact_json(spark, d):
    text = F.concat(F.lit('{"user":{"password":"x","k":'), F.get_json_object("props", "$.k"), F.lit('},"tokens":[1,2]}'))
    return R.redact_json(V.table(spark, d, "events").select("event_id", text.alias("context")), ["context"])


@register("SELECT doc_id, regexp_replace(regexp_replace(text, '\\b[0-9]{16}\\b', '********', 'g'), '[A-Za-z0-9._-]+@[A-Za-z0-9.-]+', '********', 'g') AS text FROM documents")
def r3_mask_values(spark, d):
    return R.mask_values(V.table(spark, d, "documents").select("doc_id", "text"), ["text"], [r"\b[0-9]{16}\b", "[not-a-regex", r"[A-Za-z0-9._-]+@[A-Za-z0-9.-]+"])


@register("""SELECT 'text' AS "column", false AS name_matches, count(*) AS rows, count(*) FILTER (regexp_matches(text, '\\b[0-9]{16}\\b')) AS value_hits, 0 AS masked FROM documents
    UNION ALL SELECT 'token', true, count(*), 0, count(*) FILTER (doc_id % 2 = 0) FROM documents""")
def r4_sensitive_profile(spark, d):
    rows = V.table(spark, d, "documents").select("text", F.when(F.col("doc_id") % 2 == 0, R.MASK).otherwise("x").alias("token"))
    return R.sensitive_profile(rows, value_regexes=[r"\b[0-9]{16}\b"])


# ---- De-duplication ----


@register(V.duck("logs") + f"SELECT seq, {FP} AS fingerprint FROM logs")
def d1_fingerprint(spark, d):
    return V.logs(spark, d).select("seq", D.fingerprint().alias("fingerprint"))


_COLLAPSED = f"""collapsed AS (
    SELECT {FP} AS fingerprint, date_trunc('day', logged_at) AS w, arg_min(seq, (logged_at, seq)) AS seq, arg_min(level, (logged_at, seq)) AS level, min(logged_at) AS logged_at, sum(count)::bigint AS count,
           CASE WHEN sum(count) > 1 THEN min(logged_at) END AS first_at, CASE WHEN sum(count) > 1 THEN max(logged_at) END AS last_at
    FROM storm GROUP BY 1, 2)"""


@register(V.duck("logs", "storm") + ", " + _COLLAPSED + "SELECT fingerprint, seq, count, first_at, last_at FROM collapsed")
def d2_collapse(spark, d):
    return _collapsed(spark, d).select("fingerprint", "seq", "count", "first_at", "last_at")


def _collapsed(spark, d):
    rows = V.storm(spark, d).withColumn("day", F.date_trunc("day", "logged_at").cast("timestamp_ntz")).drop("suppressed_count")
    return D.collapse(rows, "day")


def _minutes(spark, d):
    """A day becomes a minute, so that a month of rows is half an hour."""
    us = F.floor(F.unix_micros(F.col("logged_at").cast("timestamp")) / 1440)
    return _collapsed(spark, d).select("seq", "level", "fingerprint", F.timestamp_micros(us).alias("logged_at"))


@register(V.duck("logs", "storm") + f""", f AS (SELECT *, {FP} AS fingerprint, epoch_us(logged_at) // 1440 AS us FROM storm WHERE level >= 300),
    n AS (SELECT *, us // 60000000 AS m, us // 30000000 AS s, row_number() OVER (PARTITION BY fingerprint, us // 60000000 ORDER BY us, seq) AS k FROM f),
    p AS (SELECT *, k <= 3 OR row_number() OVER (PARTITION BY fingerprint, m, s, k > 3 ORDER BY us, seq) = 1 AS pass FROM n),
    g AS (SELECT *, coalesce(sum(pass::int) OVER (PARTITION BY fingerprint ORDER BY us, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM p),
    h AS (SELECT *, sum((NOT pass)::int) OVER (PARTITION BY fingerprint, g) AS held FROM g)
    SELECT seq, nullif(held, 0)::bigint AS suppressed_count FROM h WHERE pass UNION ALL SELECT seq, NULL FROM storm WHERE level < 300""")
def d3_rate_cap_aligned(spark, d):
    us = F.floor(F.unix_micros(F.col("logged_at").cast("timestamp")) / 1440)
    rows = V.storm(spark, d).withColumn("fingerprint", D.fingerprint()).select("seq", "level", "fingerprint", F.timestamp_micros(us).alias("logged_at"))
    return D.rate_cap_aligned(rows, 3, 30).select("seq", "suppressed_count")


def _machine(rows: str, per_minute: int, sample_us: int) -> str:
    """The cap row by row, as a recursion over the rows (fingerprint, seq, us) of each fingerprint."""
    return f"""x AS (SELECT *, row_number() OVER (PARTITION BY fingerprint ORDER BY us, seq) AS k FROM {rows}),
    m AS (SELECT fingerprint, 0::bigint AS k, 0::bigint AS seq, 0::bigint AS hits, 0::bigint AS hits_end, 0::bigint AS slot_end, 0::bigint AS held, 0::bigint AS held_end, false AS pass, 0::bigint AS told FROM x WHERE k = 1
        UNION ALL SELECT fingerprint, k, seq, h, he, CASE WHEN h > {per_minute} AND NOT back THEN us + {sample_us} ELSE slot_end END, CASE WHEN NOT back THEN 0 WHEN us >= held_end THEN 1 ELSE held + 1 END,
            CASE WHEN back AND us >= held_end THEN us + 900000000 ELSE held_end END, NOT back, CASE WHEN us < held_end THEN held ELSE 0 END
        FROM (SELECT *, h > {per_minute} AND us < slot_end AS back FROM (SELECT x.fingerprint, x.k, x.seq, x.us, m.slot_end, m.held, m.held_end,
            CASE WHEN x.us >= m.hits_end THEN 1 ELSE m.hits + 1 END AS h, CASE WHEN x.us >= m.hits_end THEN x.us + 60000000 ELSE m.hits_end END AS he FROM m JOIN x ON x.fingerprint = m.fingerprint AND x.k = m.k + 1)))
    """


@register(V.duck("logs", "storm", recursive=True) + ", " + _COLLAPSED + ", u AS (SELECT fingerprint, seq, epoch_us(logged_at) // 1440 AS us FROM collapsed WHERE level >= 300), " + _machine("u", 1, 30_000_000)
          + "SELECT seq, nullif(told, 0) AS suppressed_count FROM m WHERE pass UNION ALL SELECT seq, NULL FROM collapsed WHERE level < 300")
def d4_rate_cap(spark, d):
    return D.rate_cap(_minutes(spark, d), 1, 30.0).select("seq", "suppressed_count")


@register(V.duck("logs") + f"SELECT sum{N}::bigint AS occurrences FROM logs")
def d5_occurrences(spark, d):
    return D.total_occurrences(V.logs(spark, d))


_DEBOUNCED = V.duck("logs", recursive=True) + """, p AS (SELECT user_id, arg_min(seq, (logged_at, seq)) AS seq, min(logged_at) AS t FROM logs GROUP BY 1
    UNION ALL SELECT l.user_id, arg_min(l.seq, (l.logged_at, l.seq)), min(l.logged_at) FROM p JOIN logs l ON l.user_id = p.user_id AND l.logged_at >= p.t + interval 86400 second GROUP BY 1) """
_WINDOWS = V.duck("logs", recursive=True) + """, x AS (SELECT seq, user_id, logged_at, row_number() OVER (PARTITION BY user_id ORDER BY logged_at, seq) AS k FROM logs),
    e AS (SELECT x.user_id, x.k, coalesce(least(x.k + 4, min(y.k)), x.k + 4) AS b FROM x LEFT JOIN x y ON y.user_id = x.user_id AND y.k > x.k AND y.k < x.k + 5 AND y.logged_at >= x.logged_at + interval 86400 second GROUP BY 1, 2),
    w AS (SELECT user_id, k AS a, b, 1::bigint AS window_no FROM e WHERE k = 1 UNION ALL SELECT e.user_id, e.k, e.b, w.window_no + 1 FROM w JOIN e ON e.user_id = w.user_id AND e.k = w.b + 1)
    SELECT x.seq, x.user_id, x.logged_at, w.window_no FROM x JOIN w ON w.user_id = x.user_id AND x.k BETWEEN w.a AND w.b"""


@register(_DEBOUNCED + "SELECT seq, user_id FROM p")
def d6_debounce(spark, d):
    return D.debounce(V.logs(spark, d), "user_id", 86_400).select("seq", "user_id")


@register(_WINDOWS)
def d7_count_or_time_windows(spark, d):
    return D.count_or_time_windows(V.logs(spark, d).select("seq", "user_id", "logged_at"), "user_id", 5, 86_400_000)


_CEILING = V.duck("logs", recursive=True) + """, x AS (SELECT seq, app_env, logged_at, message, row_number() OVER w AS k, sum(octet_length(encode(message))) OVER w AS s FROM logs WINDOW w AS (PARTITION BY app_env ORDER BY logged_at, seq)),
    c AS (SELECT app_env, 1::bigint AS window_no, 1::bigint AS a, least(100, min(k) FILTER (s >= 1500)) AS b FROM x GROUP BY 1
        UNION ALL SELECT c.app_env, c.window_no + 1, c.b + 1, least(c.b + 100, min(x.k) FILTER (x.s - p.s >= 1500)) FROM c JOIN x p ON p.app_env = c.app_env AND p.k = c.b JOIN x ON x.app_env = c.app_env AND x.k > c.b AND x.k <= c.b + 100 GROUP BY c.app_env, c.window_no, c.b)
    SELECT seq, x.app_env AS app_env, window_no FROM x JOIN c ON c.app_env = x.app_env AND x.k BETWEEN c.a AND c.b"""


@register(_CEILING)
def d7_window_ceiling(spark, d):
    """No count or time that would close a window: 100 rows or 1,500 bytes of messages do."""
    rows = V.logs(spark, d).select("seq", "app_env", "logged_at", "message")
    return D.count_or_time_windows(rows, "app_env", 10**6, 10**12, max_rows=100, max_bytes=1500, size=F.octet_length("message")).select("seq", "app_env", "window_no")


@register("SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1")
def d8_idempotent(spark, d):
    return D.idempotent(V.table(spark, d, "events"), "user_id", ["event_id"]).select("user_id", "event_id")


# ---- Aggregations ----


@register(V.duck("logs") + f"SELECT app_env, count(*) AS rows, sum{N}::bigint AS occurrences FROM logs WHERE level >= 300 GROUP BY 1")
def a1_count_logs(spark, d):
    return A.count_logs(V.logs(spark, d), F.col("level") >= 300, ["app_env"])


_SECTIONS = V.duck("logs") + f""", l AS (SELECT *, {N} AS n, CASE WHEN level >= 400 THEN {N} ELSE 0 END AS e, md5(concat(level, '|', split_part(stacktrace, ': ', 1), '|', caller_file, ':', caller_line, '|', message)) AS issue
      FROM logs WHERE logged_at >= timestamp '2024-01-05' AND logged_at < timestamp '2024-01-25'),
    s AS (
    SELECT 'total' AS section, NULL AS name, NULL AS key, sum(n)::bigint AS occurrences, sum(e)::bigint AS errors FROM l
    UNION ALL SELECT 'route', route_name, NULL, sum(n), sum(e) FROM l GROUP BY 2
    UNION ALL SELECT 'job', job_class, NULL, sum(n), sum(e) FROM l WHERE job_class IS NOT NULL GROUP BY 2
    UNION ALL SELECT 'deploy', git_sha, NULL, sum(n), sum(e) FROM l GROUP BY 2
    UNION ALL SELECT 'issue', concat('exception: ', message), issue, sum(n), sum(e) FROM l WHERE stacktrace IS NOT NULL GROUP BY 2, 3)
    SELECT section, name, occurrences::bigint AS occurrences, errors::bigint AS errors, (row_number() OVER (PARTITION BY section ORDER BY occurrences DESC, name, key))::int AS rank FROM s QUALIFY rank <= 5"""


@register(_SECTIONS)
def a2_traffic_overview(spark, d):
    return A.traffic_overview(V.logs(spark, d), ("2024-01-05", "2024-01-25"))


@register(_SECTIONS)
def a2_rollup_overview(spark, d):
    """The same from daily roll-ups; estimates of users and traces are left out here."""
    return A.overview_of_days(A.daily_rollup(V.logs(spark, d)), "2024-01-05", "2024-01-25").drop("users", "traces")


@register(V.duck("logs") + f"""SELECT 'exception' AS issue_kind, md5(concat(level, '|', split_part(stacktrace, ': ', 1), '|', caller_file, ':', caller_line, '|', message)) AS issue, min(message) AS message, sum{N}::bigint AS occurrences,
    min(logged_at) AS first_seen, max(logged_at) AS last_seen, count(DISTINCT user_id) AS users, count(DISTINCT trace_id) AS traces, arg_max(trace_id, (logged_at, seq)) AS sample_trace_id
    FROM logs WHERE stacktrace IS NOT NULL GROUP BY 1, 2 ORDER BY occurrences DESC, issue_kind, issue LIMIT 20""")
def a3_list_issues(spark, d):
    return A.list_issues(V.logs(spark, d))


@register(V.duck("logs") + "SELECT seq, logged_at, level, message, trace_id, user_id, caller_file, caller_line FROM logs WHERE level >= 400 ORDER BY logged_at DESC, seq DESC LIMIT 20")
def a4_list_recent_errors(spark, d):
    return A.list_recent_errors(V.logs(spark, d))


@register(V.duck("statements") + f"SELECT {NORMAL} AS statement, count(*) AS occurrences, arg_max(time_ms, (ts, trace_id, seq)) AS latest_ms, max(time_ms) AS slowest_ms, arg_max(connection, (ts, trace_id, seq)) AS connection, arg_max(caller, (ts, trace_id, seq)) AS caller FROM statements WHERE time_ms >= 500 GROUP BY 1")
def a5_list_slow_queries(spark, d):
    return A.list_slow_queries(V.statements(spark, d))


@register(V.duck("statements") + f""", s AS (SELECT {NORMAL} AS statement, trace_id, span_id, count(*) AS copies, max(ts) AS ts, min(caller) AS caller FROM statements GROUP BY 1, 2, 3)
    SELECT statement, count(*) AS occurrences, arg_max(copies, (ts, trace_id, span_id)) AS latest_duplicate_count, max(copies) AS duplicate_count, arg_max(caller, (ts, trace_id, span_id)) AS caller FROM s WHERE copies >= 5 GROUP BY 1""")
def a6_list_n_plus_one(spark, d):
    return A.list_n_plus_one(V.statements(spark, d))


@register(V.duck("logs") + f"SELECT caller_method AS symbol, sum{N}::bigint AS occurrences, count(DISTINCT user_id) AS users, count(DISTINCT trace_id) AS traces, arg_max(trace_id, (logged_at, seq)) AS sample_trace_id FROM logs WHERE level >= 400 GROUP BY 1 ORDER BY occurrences DESC, symbol LIMIT 10")
def a7_top_errored_symbols(spark, d):
    return A.top_errored_symbols(V.logs(spark, d))


@register(V.duck("logs") + f"SELECT concat(caller_file, ':', caller_line) AS symbol, sum{N}::bigint AS occurrences, count(DISTINCT user_id) AS users, count(DISTINCT trace_id) AS traces, arg_max(trace_id, (logged_at, seq)) AS sample_trace_id FROM logs WHERE level >= 400 AND caller_file LIKE '%Mod3%' GROUP BY 1 ORDER BY occurrences DESC, symbol LIMIT 10")
def a7_top_errored_lines(spark, d):
    return A.top_errored_symbols(V.logs(spark, d), "line", "Mod3")


def _measured(spark, d):
    """Cumulative snapshots: a span's n-th row holds its first n measures."""
    from pyspark.sql.window import Window as W

    one = F.struct(F.concat(F.lit("m"), (F.col("seq") % 4).cast("string")).alias("label"), F.col("duration_ms").cast("double").alias("duration_ms"), F.lit(None).cast("string").alias("meta"))
    w = W.partitionBy("trace_id", "span_id").orderBy("logged_at", "seq").rowsBetween(W.unboundedPreceding, 0)
    return V.logs(spark, d).withColumn("measures", F.collect_list(one).over(w))


@register(V.duck("logs") + "SELECT concat('m', seq % 4) AS label, quantile_cont(duration_ms::double, 0.5) AS p50, quantile_cont(duration_ms::double, 0.95) AS p95, count(*) AS n FROM logs GROUP BY 1")
def a8_analyze_measures(spark, d):
    return A.analyze_measures(_measured(spark, d))


@register(V.duck("statements") + f"""SELECT trace_id, {NORMAL} AS statement, 'part' AS "table", count(*) AS total, 'n+1' AS measure, 0.0::double AS measure_ms, 5 AS measure_count FROM statements GROUP BY 1, 2 HAVING count(*) >= 5""")
def a9_detect_n_plus_one(spark, d):
    found, first = A.detect_n_plus_one(V.statements(spark, d)), F.col("measures")[0]
    return found.select("trace_id", "statement", "table", "total", first["label"].alias("measure"), first["duration_ms"].alias("measure_ms"), F.get_json_object(first["meta"], "$.count").cast("int").alias("measure_count"))


@register(V.duck("logs") + "SELECT sum(duration_ms)::double AS total_ms, count(*) AS n FROM logs")
def a10_measure_totals(spark, d):
    return A.measure_totals(_measured(spark, d))


@register(V.duck("logs") + "SELECT trace_id, max(memory_peak_mb) AS memory_peak_mb FROM logs GROUP BY 1 HAVING max(memory_peak_mb) IS NOT NULL")
def a11_memory_peaks(spark, d):
    return A.memory_peaks(V.logs(spark, d))


@register(V.duck("logs") + f""", r AS (SELECT * FROM logs WHERE route_name = 'error.3'), t AS (SELECT trace_id, max(duration_ms) AS ms FROM r GROUP BY 1),
    e AS (SELECT message, sum{N}::double AS v FROM r WHERE level >= 400 GROUP BY 1 ORDER BY v DESC, message LIMIT 5), s AS (SELECT trace_id, ms::double AS v FROM t ORDER BY ms DESC, trace_id LIMIT 5)
    SELECT 'duration' AS section, 'p50' AS name, quantile_cont(ms::double, 0.5) AS value FROM t UNION ALL SELECT 'duration', 'p95', quantile_cont(ms::double, 0.95) FROM t UNION ALL SELECT 'duration', 'max', max(ms)::double FROM t
    UNION ALL SELECT 'error', message, v FROM e UNION ALL SELECT 'slow_trace', trace_id, v FROM s""")
def a12_route_performance(spark, d):
    return A.analyze_route_performance(V.logs(spark, d), "error.3")


@register(V.duck("logs") + "SELECT trace_id, max(duration_ms) AS duration_ms, max(memory_peak_mb) AS memory_peak_mb, count(*) AS entries FROM logs GROUP BY 1 HAVING max(duration_ms) >= 100 AND count(*) >= 2 ORDER BY duration_ms DESC, trace_id LIMIT 20")
def a13_list_slow_traces(spark, d):
    return A.list_slow_traces(V.logs(spark, d), min_duration_ms=100, min_entries=2)


@register(V.duck("logs") + """, k AS (SELECT trace_id, job_class, 1 + seq % 2 AS job_attempt, logged_at, CASE WHEN starts_with(message, 'job.failed') THEN 'f' WHEN starts_with(message, 'job.completed') THEN 'c' WHEN starts_with(message, 'auth.login') THEN 's' WHEN starts_with(message, 'route.matched') THEN 'd' WHEN starts_with(message, 'event.dispatched') THEN 'r' END AS kind FROM logs),
    g AS (SELECT trace_id, job_class, job_attempt, min(logged_at) FILTER (kind = 'd') AS d, min(logged_at) FILTER (kind = 's') AS s, max(logged_at) FILTER (kind = 'c') AS c, max(logged_at) FILTER (kind = 'f') AS f FROM k WHERE kind <> 'r' GROUP BY 1, 2, 3),
    r AS (SELECT trace_id, job_class, count(*) AS n FROM k WHERE kind = 'r' GROUP BY 1, 2)
    SELECT g.trace_id AS trace_id, g.job_class AS job_class, g.job_attempt::int AS job_attempt, CASE WHEN f IS NOT NULL AND (c IS NULL OR f > c) THEN 'failed' WHEN c IS NOT NULL THEN 'completed' WHEN s IS NOT NULL THEN 'lost' ELSE 'waiting' END AS outcome,
           (epoch_us(s) - epoch_us(d)) / 1e6 AS wait_s, (epoch_us(greatest(c, f)) - epoch_us(s)) / 1e6 AS run_s,
           row_number() OVER (PARTITION BY g.trace_id, g.job_class ORDER BY g.job_attempt) - 1 AS retries, coalesce(r.n, 0) AS retry_requests
    FROM g LEFT JOIN r ON r.trace_id = g.trace_id AND r.job_class IS NOT DISTINCT FROM g.job_class""")
def a14_job_lifecycle(spark, d):
    rows = E.classify_events(V.logs(spark, d)).withColumn("job_attempt", (1 + F.col("seq") % 2).cast("int"))
    kinds = {"auth.login": "job.started", "route.matched": "job.dispatched", "event.dispatched": "job.retrying"}
    kind = F.col("event_kind")
    for a, b in kinds.items():
        kind = F.when(F.col("event_kind") == a, b).otherwise(kind)
    return A.job_lifecycle(rows.withColumn("event_kind", kind))


@register("SELECT unnest(['cache.hit', 'mail.sent']) AS event_kind")
def a15_kind_coverage(spark, d):
    rows = E.classify_events(V.logs(spark, d))
    expected = spark.createDataFrame([("cache.hit",), ("mail.sent",), ("auth.login",), ("job.failed",)], "event_kind string")
    return A.kind_coverage(rows, expected)


@register(V.duck("logs") + f"SELECT quantile_cont(duration_ms / 1000.0::double, 0.5) AS delay_p50_s, quantile_cont(duration_ms / 1000.0::double, 0.95) AS delay_p95_s, count(*) AS rows, sum{N}::bigint AS occurrences, 0::bigint AS without_trace, min(logged_at) AS oldest, 0::bigint AS dropped FROM logs")
def a16_ingest_health(spark, d):
    arrived = F.col("logged_at") + F.make_dt_interval(secs=F.col("duration_ms") / 1000)
    out = A.ingest_health(V.logs(spark, d).withColumn("arrived_at", arrived))
    return out.withColumns({c: F.col(c) for c in out.columns})


@register(V.duck("logs") + f"SELECT CASE WHEN grouping(app_env) = 1 THEN '*' ELSE app_env END AS app_env, CASE WHEN grouping(level) = 1 THEN '*' ELSE {LEVEL} END AS level_name, CASE WHEN grouping(origin) = 1 THEN '*' ELSE origin END AS origin, sum{N}::bigint AS occurrences FROM logs GROUP BY ROLLUP (app_env, level, origin)")
def a17_rollup_levels(spark, d):
    return A.rollup_levels(V.logs(spark, d).withColumn("level_name", X.level_name("level")))


# ---- Traces ----


@register(V.duck("logs") + """SELECT trace_id, seq, split_part(message, ': ', 1) AS event_kind, (row_number() OVER w)::int AS position,
    (epoch_us(logged_at) - min(epoch_us(logged_at)) OVER (PARTITION BY trace_id)) / 1000 AS offset_ms, (epoch_us(logged_at) - lag(epoch_us(logged_at)) OVER w) / 1000 AS gap_ms FROM logs WINDOW w AS (PARTITION BY trace_id ORDER BY logged_at, seq)""")
def t1_trace_timeline(spark, d):
    return T.trace_timeline(V.logs(spark, d)).select("trace_id", "seq", "event_kind", "position", "offset_ms", "gap_ms")


@register(V.duck("logs") + f"SELECT trace_id, count(*) AS entries, max(memory_peak_mb) AS memory_peak_mb, min(logged_at) AS started_at, max(logged_at) AS ended_at, sum(CASE WHEN level >= 400 THEN {N} ELSE 0 END)::bigint AS errors, arg_min(message, (logged_at, seq)) FILTER (level >= 400) AS first_error FROM logs GROUP BY 1")
def t2_trace_summary(spark, d):
    return T.trace_summary(V.logs(spark, d))


@register(V.duck("logs") + f"""SELECT trace_id, 0::bigint AS part, concat('# Trace ', trace_id, chr(10), 'uri: ', arg_min(uri, (logged_at, seq)), chr(10), 'user: ', arg_min(user_id, (logged_at, seq)), chr(10), 'entries: ', count(*), chr(10), chr(10),
    string_agg(concat('- ', strftime(logged_at, '%Y-%m-%d %H:%M:%S.%g'), ' **', {LEVEL}, '** ', message, chr(10) || '  - context: ' || context, chr(10) || '```' || chr(10) || stacktrace || chr(10) || '```'), chr(10) ORDER BY logged_at, seq)) AS markdown
    FROM logs GROUP BY 1""")
def t3_trace_markdown(spark, d):
    return T.trace_markdown(V.logs(spark, d).withColumn("level_name", X.level_name("level")))


@register(V.duck("logs") + """, s AS (SELECT DISTINCT trace_id, span_id, parent_span_id FROM logs), p AS (SELECT s.trace_id, s.span_id, t.span_id AS parent FROM s LEFT JOIN s t ON t.trace_id = s.trace_id AND t.span_id = s.parent_span_id AND t.span_id <> s.span_id)
    SELECT trace_id, span_id, parent AS parent_span_id, coalesce(parent, span_id) AS root, CASE WHEN parent IS NULL THEN 0 ELSE 1 END AS depth, CASE WHEN parent IS NULL THEN span_id ELSE concat(parent, ' > ', span_id) END AS path FROM p""")
def t4_span_tree(spark, d):
    return T.span_tree(V.logs(spark, d))


@register(V.duck("logs") + """, x AS (SELECT seq AS job_id, trace_id, span_id FROM logs WHERE origin = 'http'), j AS (SELECT seq AS job_id FROM logs WHERE seq % 2 = 0)
    SELECT job_id, CASE WHEN span_id IS NULL THEN md5(concat('trace|', job_id)) ELSE trace_id END AS trace_id, span_id AS parent_span_id, md5(concat(job_id, '|', coalesce(span_id, ''))) AS span_id, 'queue' AS origin FROM j LEFT JOIN x USING (job_id)""")
def t5_link_jobs(spark, d):
    rows = V.logs(spark, d)
    sent = rows.where("origin = 'http'").select(F.col("seq").alias("job_id"), "trace_id", "span_id")
    return T.link_jobs(sent, rows.where("seq % 2 = 0").select(F.col("seq").alias("job_id"))).select("job_id", "trace_id", "parent_span_id", "span_id", "origin")


@register(V.duck("logs") + f"SELECT count(DISTINCT user_id) AS users, count(DISTINCT user_id) AS emails, count(DISTINCT route_name) AS routes, count(DISTINCT trace_id) AS traces, sum{N}::bigint AS occurrences FROM logs WHERE caller_file = 'app/Mod2.php' AND level >= 400")
def t6_who_was_affected(spark, d):
    rows = V.logs(spark, d).withColumn("extra", F.to_json(F.struct(F.struct(F.concat("user_id", F.lit("@x.test")).alias("email")).alias("user"))))
    return T.who_was_affected(rows, (F.col("caller_file") == "app/Mod2.php") & (F.col("level") >= 400))


@register(V.duck("logs") + "SELECT seq, d AS depth, split_part(stacktrace, ':', 1) AS class, 'boom' AS message, caller_file AS file, caller_line AS line, 1::bigint AS frames FROM logs, (SELECT unnest([0, 1]) AS d) WHERE stacktrace IS NOT NULL")
def t7_exception_chain(spark, d):
    rows = V.logs(spark, d).withColumn("stacktrace", F.concat("stacktrace", F.lit("\n\nCaused by: "), F.replace("stacktrace", F.lit("\n\n"), F.lit("\n"))))
    return T.exception_chain(rows)


@register(V.duck("logs") + "SELECT seq, caller_file, caller_line, concat(split_part(caller_method, '@', 1), '@handle') AS caller_method FROM logs")
def t8_top_user_frame(spark, d):
    trace = F.concat(F.lit("#0 /srv/vendor/x.php(3): Illuminate\\Log\\Logger->error()\n#1 /srv/"), "caller_file", F.lit("("), F.col("caller_line").cast("string"), F.lit("): Illuminate\\Bus\\Dispatcher->run()\n#2 [internal function]: App\\Jobs\\"), F.split_part("caller_method", F.lit("@"), F.lit(1)), F.lit("->handle()\n#3 {main}"))
    rows = V.logs(spark, d).select("seq", T.parse_frames(trace).alias("frames"))
    return T.top_user_frame(rows, base="/srv").drop("frames")


@register(V.duck("logs") + ", e AS (SELECT * FROM logs WHERE user_id = '8' AND level >= 400 QUALIFY row_number() OVER (PARTITION BY trace_id ORDER BY logged_at DESC, seq DESC) = 1) SELECT trace_id, seq, logged_at, message FROM e ORDER BY logged_at DESC, seq DESC LIMIT 10")
def t9_user_recent_errors(spark, d):
    return T.user_recent_errors(V.logs(spark, d), "8")


@register(V.duck("logs") + f""", m AS (SELECT concat(message, ' ', user_id) AS message, sum(CASE WHEN git_sha = 'aaaaaaa1' THEN {N} ELSE 0 END)::bigint AS b, sum(CASE WHEN git_sha = 'bbbbbbb2' THEN {N} ELSE 0 END)::bigint AS h FROM logs WHERE level >= 400 AND git_sha IN ('aaaaaaa1', 'bbbbbbb2') GROUP BY 1)
    SELECT message, CASE WHEN b = 0 THEN 'new' ELSE 'gone' END AS status, b + h AS occurrences FROM m WHERE (b = 0) <> (h = 0)""")
def t10_compare_deployments(spark, d):
    rows = V.logs(spark, d).withColumn("message", F.concat("message", F.lit(" "), "user_id"))
    return T.compare_deployments(rows, "aaaaaaa1", "bbbbbbb2")


@register(V.duck("logs") + "SELECT seq, message, trace_id FROM logs WHERE seq = 77")
def t11_get_log_entry(spark, d):
    return T.get_log_entry(V.logs(spark, d), 77).select("seq", "message", "trace_id")


@register(V.duck("logs") + "SELECT seq, concat('{\"name\":\"', c_name, '\"}') AS extra_user, c_name AS user_label FROM logs LEFT JOIN customer ON user_id = c_custkey::varchar")
def t12_attach_dimension(spark, d):
    dim = V.table(spark, d, "customer")
    return T.attach_dimension(V.logs(spark, d), dim, ("user_id", "c_custkey"), {"name": F.col("c_name")}, F.col("c_name")).select("seq", "extra_user", "user_label")


@register(V.duck("logs") + """, p AS (SELECT app_env, logged_at AS deployed_at, concat('sha', seq) AS sha FROM logs WHERE seq % 400 = 0)
    SELECT seq, coalesce(CASE WHEN seq % 3 = 0 THEN git_sha END, sha) AS git_sha FROM logs ASOF LEFT JOIN p ON logs.app_env = p.app_env AND logged_at >= deployed_at""")
def t13_deploy_at(spark, d):
    rows = V.logs(spark, d)
    deploys = rows.where("seq % 400 = 0").select("app_env", F.col("logged_at").alias("deployed_at"), F.concat(F.lit("sha"), F.col("seq").cast("string")).alias("git_sha"))
    return T.deploy_at(rows.withColumn("git_sha", F.when(F.col("seq") % 3 == 0, F.col("git_sha"))), deploys).select("seq", "git_sha")


# ---- Search ----


@register(V.duck("logs") + "SELECT seq, message FROM logs WHERE caller_method = 'Mod4@error'")
def q1_search_by_field(spark, d):
    return Q.search_by_field(V.logs(spark, d), "caller_method", "Mod4@error").select("seq", "message")


@register(V.duck("logs") + "SELECT seq FROM logs WHERE level >= 400 AND logged_at >= timestamp '2024-01-05' AND logged_at < timestamp '2024-01-25' AND (contains(caller_file, 'Mod5') OR contains(caller_method, 'Mod5') OR contains(stacktrace, 'Mod5') OR contains(message, 'Mod5'))")
def q2_search_advanced(spark, d):
    return Q.search_advanced(V.logs(spark, d), "error", since="2024-01-05", until="2024-01-25", mentions="Mod5").select("seq")


@register(V.duck("logs") + "SELECT seq FROM logs WHERE caller_line = 42")
def q3_search_by_json(spark, d):
    return Q.search_by_json(V.logs(spark, d), "context.k", "42").select("seq")


_INDEXES: dict[tuple[str, str, str], object] = {}


def _built(spark, d, name, build):
    """An index of a table: built once a session, then read by every search."""
    key = spark.sparkContext.applicationId, d, name
    if key not in _INDEXES:
        _INDEXES[key] = build(scratch_path(spark, name))
    return _INDEXES[key]


def _text_index(spark, d):
    return _built(spark, d, "text_index", lambda path: build_text_index(V.table(spark, d, "documents"), "doc_id", "text", path))


def _vector_index(spark, d):
    return _built(spark, d, "vector_index", lambda path: build_vector_index(V.table(spark, d, "embeddings"), path))


_BM25 = """r AS (SELECT doc_id, len(t) AS n, len(list_filter(t, lambda x: x = 'idiot')) AS f0, len(list_filter(t, lambda x: x = 'the')) AS f1
      FROM (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS t FROM documents)),
    s AS (SELECT count(*) AS docs, avg(n) AS mean, count(*) FILTER (f0 > 0) AS d0, count(*) FILTER (f1 > 0) AS d1 FROM r),
    b AS (SELECT doc_id, ln(1 + (docs - d0 + 0.5) / (d0 + 0.5)) * f0 * 2.2 / (f0 + 1.2 * (0.25 + 0.75 * n / mean)) + ln(1 + (docs - d1 + 0.5) / (d1 + 0.5)) * f1 * 2.2 / (f1 + 1.2 * (0.25 + 0.75 * n / mean)) AS score FROM r, s WHERE f0 > 0 OR f1 > 0)"""


@register("WITH " + _BM25 + " SELECT doc_id, round(score, 6) AS score FROM b ORDER BY b.score DESC, doc_id LIMIT 10")
def q4_search_text(spark, d):
    return _text_index(spark, d).search("The idiot").select(F.col("id").alias("doc_id"), F.round("score", 6).alias("score"))


@register("WITH " + _BM25 + " SELECT doc_id, round(score, 6) AS score FROM b ORDER BY b.score DESC, doc_id LIMIT 10")
def q4_search_scan(spark, d):
    """The same without an index, by one pass over all texts."""
    return Q.search_text(V.table(spark, d, "documents"), "The idiot", "doc_id", "text").select("doc_id", F.round("score", 6).alias("score"))


@register("""WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS t FROM documents),
    h AS (SELECT doc_id, len(list_filter(range(1, len(t)), lambda i: t[i] = 'of' AND t[i + 1] = 'the')) AS hits FROM t) SELECT doc_id, hits FROM h WHERE hits > 0""")
def q4_search_phrase(spark, d):
    return _text_index(spark, d).phrase("of the").select(F.col("id").alias("doc_id"), "hits")


_VECTOR = [((i * 37) % 11 - 5) / 7 for i in range(64)]
_COSINE = f"c AS (SELECT vec_id, list_cosine_similarity(embedding::double[], {_VECTOR}::double[]) AS score FROM embeddings)"


@register("WITH " + _COSINE + " SELECT vec_id, round(score, 6) AS score FROM c ORDER BY c.score DESC, vec_id LIMIT 10")
def q5_search_semantic(spark, d):
    return Q.search_semantic(V.table(spark, d, "embeddings"), _VECTOR).select("vec_id", F.round("score", 6).alias("score"))


@register()
def q5_search_neighbours(spark, d):
    """Approximate, so without SQL; its recall is measured when the index is built and tested against all rows."""
    return _vector_index(spark, d).search(_VECTOR).select(F.col("id").alias("vec_id"), F.round("score", 6).alias("score"))


@register("WITH " + _BM25 + ", " + _COSINE + """, l AS (SELECT doc_id AS id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM b QUALIFY r <= 50), v AS (SELECT vec_id AS id, row_number() OVER (ORDER BY score DESC, vec_id) AS r FROM c QUALIFY r <= 50),
    h AS (SELECT id, coalesce(1.0::double / (60 + l.r), 0) + coalesce(1.0::double / (60 + v.r), 0) AS score, CASE WHEN l.r IS NULL THEN 'semantic' WHEN v.r IS NULL THEN 'lexical' ELSE 'both' END AS source FROM l FULL JOIN v USING (id))
    SELECT id, source, round(score, 6) AS score FROM h ORDER BY h.score DESC, id LIMIT 10""")
def q6_search_hybrid(spark, d):
    lexical = _text_index(spark, d).search("The idiot", 50)
    semantic = Q.search_semantic(V.table(spark, d, "embeddings").withColumnRenamed("vec_id", "id"), _VECTOR, "id", k=50)
    return Q.search_hybrid(lexical, semantic, "id").select("id", "source", F.round("score", 6).alias("score"))


# ---- Streams: the tables as a stream, drained once; results are read back from the sink ----


@register(V.duck("logs") + "SELECT seq FROM logs WHERE level <> 100 AND (message NOT LIKE 'event.dispatched%' OR ('0x' || left(md5(trace_id), 8))::bigint / 4294967295.0::double < 0.5)")
def w1_stream_pipeline(spark, d):
    return drained(stream_pipeline(V.logs_stream(spark, d), {"debug": 0}, {"click/*": 0.5}, ["context"])).select("seq")


@register(V.duck("logs", "storm") + f""", g AS (SELECT {FP} AS fingerprint, time_bucket(interval 2 day, logged_at, timestamp '1970-01-01') AS w, arg_min(seq, (logged_at, seq)) AS seq, sum(count)::bigint AS count FROM storm GROUP BY 1, 2)
    SELECT fingerprint, seq, count FROM g WHERE w + interval 2 day <= (SELECT max(logged_at) - interval 60 second FROM storm)""")
def w2_stream_collapse(spark, d):
    return drained(stream_collapse(V.storm_of(V.logs_stream(spark, d)), "2 days", "1 minute")).select("fingerprint", "seq", "count")


@register(V.duck("logs", "storm", recursive=True) + f", u AS (SELECT {FP} AS fingerprint, seq, epoch_us(logged_at) AS us FROM storm WHERE level >= 300), " + _machine("u", 1, 86_400_000_000) + "SELECT seq, nullif(told, 0) AS suppressed_count FROM m WHERE pass")
def w3_stream_rate_cap(spark, d):
    from ..operators.dedup import fingerprint

    rows = V.storm_of(V.logs_stream(spark, d)).where("level >= 300").withColumn("fingerprint", fingerprint()).select("seq", "logged_at", "fingerprint")
    return drained(stream_rate_cap(rows, 1, 86_400)).select("seq", "suppressed_count")


@register(_DEBOUNCED + "SELECT seq, t AS logged_at, user_id FROM p")
def w4_stream_debounce(spark, d):
    out = drained(stream_debounce(V.logs_stream(spark, d).select("seq", "logged_at", "user_id"), "user_id", 86_400))
    return out.withColumn("logged_at", F.col("logged_at").cast("timestamp_ntz"))


@register(_WINDOWS)
def w5_stream_count_or_time(spark, d):
    out = drained(stream_count_or_time(V.logs_stream(spark, d).select("seq", "logged_at", "user_id"), "user_id", 5, 86_400_000))
    return out.withColumn("logged_at", F.col("logged_at").cast("timestamp_ntz"))


@register(V.duck("logs", recursive=True) + """, x AS (SELECT user_id, logged_at, row_number() OVER (PARTITION BY user_id ORDER BY logged_at, seq) AS k, count(*) OVER (PARTITION BY user_id) AS n FROM logs),
    e AS (SELECT x.user_id, x.k, x.n, x.logged_at AS t, min(y.k) FILTER (y.logged_at >= x.logged_at + interval 86400 second) AS f, max(y.logged_at) FILTER (y.k = x.k + 4) AS full_at
        FROM x LEFT JOIN x y ON y.user_id = x.user_id AND y.k > x.k AND y.k < x.k + 5 GROUP BY 1, 2, 3, 4),
    w AS (SELECT *, coalesce(f, k + 5) AS b FROM e WHERE k = 1 UNION ALL SELECT e.*, coalesce(e.f, e.k + 5) FROM w JOIN e ON e.user_id = w.user_id AND e.k = w.b)
    SELECT user_id, least(b, n + 1) - k AS rows, t AS opened_at, CASE WHEN f IS NULL AND full_at IS NOT NULL THEN full_at ELSE t + interval 86400 second END AS closed_at, CASE WHEN f IS NULL AND full_at IS NOT NULL THEN 'rows' ELSE 'time' END AS closed_by
    FROM w WHERE f IS NOT NULL OR full_at IS NOT NULL OR t + interval 86400 second <= (SELECT max(logged_at) - interval 60 second FROM logs)""")
def w5_stream_window_closings(spark, d):
    out = drained(stream_window_closings(V.logs_stream(spark, d).select("seq", "logged_at", "user_id"), "user_id", 5, 86_400_000)).drop("window_no")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("opened_at", "closed_at")})


@register("SELECT DISTINCT user_id::varchar AS user_id FROM events")
def d8_stream_idempotent(spark, d):
    return drained(stream_idempotent(V.logs_stream(spark, d).select("logged_at", "user_id"), "user_id", "60 days")).select("user_id")


@register(V.duck("statements") + f"SELECT trace_id, {NORMAL} AS statement, 5::bigint AS duplicate_count FROM statements GROUP BY 1, 2 HAVING count(*) >= 5")
def w6_stream_n_plus_one(spark, d):
    runs = V.statements_stream(spark, d).select("trace_id", "span_id", "sql", "ts", "seq")
    return drained(stream_n_plus_one(runs)).select("trace_id", "statement", "duplicate_count")


_LATE = V.duck("logs") + """SELECT seq, level, message FROM logs WHERE logged_at >= timestamp '2024-01-20'
    UNION ALL SELECT NULL, 300, concat('agent.dropped_rows: ', count(*), ' log rows were dropped client-side during an ingest outage') FROM logs WHERE logged_at < timestamp '2024-01-20'"""


@register(_LATE)
def w7_stream_late_reports(spark, d):
    path = scratch_path(spark, "late")
    rows = V.logs_stream(spark, d).select("seq", "logged_at", "level", "message")
    query = write_with_reports(rows, path, scratch_path(spark, "offsets"), lambda: "2024-01-30 00:00:00", 864_000).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.option("basePath", path).parquet(path).select("seq", "level", "message")


@register(_LATE)
def w8_replay(spark, d):
    """The last batch is delivered but not noted as done, as if its process had ended then, and is run again; a report callback always fails."""
    path, checkpoint = scratch_path(spark, "late"), scratch_path(spark, "offsets")
    rows = V.logs_stream(spark, d).select("seq", "logged_at", "level", "message")

    def broken(_: DataFrame) -> None:
        raise ValueError("no one listens")

    for _ in range(2):
        write_with_reports(rows, path, checkpoint, lambda: "2024-01-30 00:00:00", 864_000, on_report=broken).trigger(availableNow=True).start().awaitTermination()
        noted = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
        noted.getFileSystem(spark._jsc.hadoopConfiguration()).delete(noted, True)
    return spark.read.option("basePath", path).parquet(path).select("seq", "level", "message")
