"""Normalising rows and deriving events from raw activity."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from ..functions import level_for_status, level_value, limit_str
from .redact import KEY_PATTERNS, masked_text

# Lengths at which columns are cut.
CUTS = {"uri": 2048, "http_method": 8, "route_action": 512, "user_agent": 512}
# Keys of ``extra`` that have columns of their own.
PROMOTED = (
    "caller_file", "caller_line", "caller_method", "trace_id", "span_id", "origin", "app_name", "app_env", "app_url", "uri", "http_method", "route_name",
    "route_action", "ip", "user_agent", "user_id", "tenant_id", "user_context", "user_label", "git_sha", "duration_ms", "job_class", "job_attempt", "queue_name",
    "connection_name", "breadcrumbs", "job_props", "measures", "command_name", "command_args",
)
# Job properties that belong to the framework.
FRAMEWORK_PROPERTIES = (
    "connection", "queue", "delay", "afterCommit", "middleware", "chained", "chainConnection", "chainQueue", "chainCatchCallbacks", "backoff", "maxExceptions",
    "timeout", "failOnTimeout", "tries", "uniqueFor", "uniqueId", "deleteWhenMissingModels", "job", "messageGroup", "deduplicator", "batchId",
)
# Levels of the kinds of events.
TAXONOMY = {
    "debug": ("route.matched", "db.transaction.committed", "cache.miss", "cache.hit", "model.created", "model.updated", "livewire.call", "graphql.operation"),
    "info": (
        "job.dispatched", "job.started", "job.completed", "auth.login", "auth.logout", "auth.password_reset", "auth.email_verified", "mail.sending", "mail.sent",
        "notification.sent", "db.migration", "model.deleted", "event.dispatched",
    ),
    "notice": ("db.transaction.rolled_back",),
    "warning": ("job.retrying", "auth.failed", "db.slow_query"),
    "error": ("job.failed", "job.exception", "notification.failed", "http.error", "http.connection_failed", "schedule.failed"),
    "by status": ("http.response", "http.rejected"),
}
KINDS = tuple(k for kinds in TAXONOMY.values() for k in kinds)
# Status of an exception that is no HTTP exception.
EXCEPTION_STATUS = {"unauthenticated": 401, "forbidden": 403, "csrf": 419}


def normalize_records(df: DataFrame, mapping: Mapping[str, Column | str] | None = None) -> DataFrame:
    """Columns of the log schema from ``mapping`` (target: column); cut to their lengths, count 1, empty context and extra null, time in milliseconds."""
    for name, c in (mapping or {}).items():
        df = df.withColumn(name, F.col(c) if isinstance(c, str) else c)
    changes: dict[str, Column] = {c: F.left(F.col(c), F.lit(n)) for c, n in CUTS.items() if c in df.columns}
    for c in ("context", "extra", "job_props"):
        if c in df.columns:
            changes[c] = F.when(~F.col(c).isin("", "{}", "[]"), F.col(c))
    if "logged_at" in df.columns:
        changes["logged_at"] = F.date_trunc("millisecond", F.col("logged_at")).cast(df.schema["logged_at"].dataType)
    changes["count"] = F.coalesce("count", F.lit(1)).cast("long") if "count" in df.columns else F.lit(1).cast("long")
    return df.withColumns(changes)


def fill_identity(df: DataFrame, defaults: Mapping[str, str | None] | None = None, table: DataFrame | None = None, on: str = "app_name") -> DataFrame:
    """Fill app_name, app_env, app_url and git_sha where they are null, from a small ``table`` by ``on`` and then from ``defaults``."""
    names = ["app_name", "app_env", "app_url", "git_sha"]
    if table is not None:
        more = table.select(F.col(on).alias("_on"), *[F.col(c).alias(f"_{c}") for c in names if c != on and c in table.columns]).dropDuplicates(["_on"])
        df = df.join(more, F.col(on) == F.col("_on"), "left")
        df = df.withColumns({c[1:]: F.coalesce(c[1:], c) for c in more.columns if c != "_on"}).drop(*more.columns)
    return df.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in (defaults or {}).items() if c in names})


def group_uri_calls(df: DataFrame, calls: DataFrame, stored: int = 10) -> DataFrame:
    """Rows of spans that made component calls, named by the last one: uri and route_action; ``calls`` holds the first ``stored`` of a span.

    ``calls``: span_id, seq, component, method (null while the component is only hydrated), params. Strings longer than 256 are cut.
    """
    label = F.when(F.col("method").isNull(), F.col("component")).otherwise(F.concat("component", F.lit("::"), "method"))
    call = F.struct("seq", "component", "method", limit_str("params", 256, "…").alias("params"))
    first = W.partitionBy("span_id").orderBy("seq", "component", "method", "params")
    kept = calls.where("method is not null").withColumn("_k", F.row_number().over(first)).where(F.col("_k") <= stored)
    lists = kept.groupBy(F.col("span_id").alias("_s")).agg(F.sort_array(F.collect_list(call)).alias("calls"))  # ``stored`` at most
    spans = calls.groupBy(F.col("span_id").alias("_span")).agg(F.coalesce(F.max_by(label, F.when(F.col("method").isNotNull(), F.col("seq"))), F.max_by(label, F.col("seq"))).alias("_label"))
    spans = spans.join(lists, F.col("_span") == F.col("_s"), "left").select("_span", "_label", F.coalesce("calls", F.array().cast(lists.schema["calls"].dataType)).alias("calls"))
    out = df.join(spans, F.col("span_id") == F.col("_span"), "left")
    method = F.regexp_extract("uri", r"^(\S+) ", 1)
    return out.withColumns({
        "uri": F.when(F.col("_label").isNotNull(), F.concat(method, F.lit(" /livewire — "), "_label")).otherwise(F.col("uri")),
        "route_action": F.coalesce("_label", "route_action"),
    }).drop("_span", "_label")


def operation_label(type_: Column, name: Column, root_fields: Column, fields: int = 5) -> Column:
    return F.trim(F.concat(type_, F.lit(" "), F.coalesce(name, F.array_join(F.slice(root_fields, 1, fields), ", "), F.lit(""))))


def group_uri_operations(df: DataFrame, operations: DataFrame, prefix: str = "/graphql", stored: int = 10, fields: int = 5) -> DataFrame:
    """Rows of spans that ran operations, named by the first one. Operations whose first root field starts with ``__`` do not count."""
    known = operations.where(~F.coalesce(F.get("root_fields", F.lit(0)).startswith("__"), F.lit(False)))
    label = operation_label(F.col("type"), F.col("name"), F.col("root_fields"), fields)
    kept = known.select(F.col("span_id").alias("_span"), "seq", label.alias("label")).withColumn("_k", F.row_number().over(W.partitionBy("_span").orderBy("seq", "label")))
    spans = kept.where(F.col("_k") <= stored).groupBy("_span").agg(F.min_by("label", "seq").alias("_label"), F.sort_array(F.collect_list(F.struct("seq", "label"))).alias("operations"))
    method = F.regexp_extract("uri", r"^(\S+) ", 1)
    return df.join(spans, F.col("span_id") == F.col("_span"), "left").withColumns({
        "uri": F.when(F.col("_label").isNotNull(), F.concat(method, F.lit(f" {prefix} — "), "_label")).otherwise(F.col("uri")),
        "route_action": F.coalesce("_label", "route_action"),
    }).drop("_span", "_label")


def map_uri(df: DataFrame, fn: Callable[[Column], Column]) -> DataFrame:
    """``uri`` rewritten by ``fn``; where that gives null or an empty text it stays."""
    new = fn(F.col("uri"))
    return df.withColumn("uri", F.coalesce(F.nullif(F.left(new, F.lit(CUTS["uri"])), F.lit("")), "uri"))


def capture_input(df: DataFrame, column: str = "input", method: str = "http_method", redact: Callable[[Column], Column] | None = None) -> DataFrame:
    """``request_input``: the map ``column`` as JSON, cut at 4096 characters, for POST, PUT and PATCH; null if nothing is left."""
    left = F.map_filter(column, lambda k, _: ~k.isin("_token", "_method", "components"))
    left = redact(left) if redact else left
    return df.withColumn("request_input", F.when(F.upper(method).isin("POST", "PUT", "PATCH") & (F.size(left) > 0), F.left(F.to_json(left), F.lit(4096))))


def _without(entries: Column, key: str) -> Column:
    return F.map_filter(entries, lambda k, _: k != key)


def promote_extra(df: DataFrame, extra: str = "extra_map") -> DataFrame:
    """``extra`` as JSON text of the map ``extra`` without the promoted keys, with user, user_label and command columns put in where there are such."""
    out = F.map_filter(extra, lambda k, _: ~k.isin(*PROMOTED))
    for key, c in (("user", "user_context"), ("user_label", "user_label"), ("command_name", "command_name"), ("command_args", "command_args")):
        if c in df.columns:
            guard = F.col("user_context").isNotNull() if c == "user_label" and "user_context" in df.columns else F.col("command_name").isNotNull() if c == "command_args" else F.lit(True)
            value = F.col(c).cast("string")
            out = F.when(F.col(c).isNotNull() & guard, F.map_concat(_without(out, key), F.create_map(F.lit(key), value))).otherwise(out)
    return df.withColumn("extra", F.when(F.size(out) > 0, F.to_json(out)))


def filter_job_props(props: Column | str) -> Column:
    """The map without the framework's properties; null if nothing is left."""
    left = F.map_filter(props, lambda k, _: ~k.isin(*FRAMEWORK_PROPERTIES))
    return F.when(F.size(left) > 0, left)


def summarize_struct(df: DataFrame, name: str) -> DataFrame:
    """The struct ``name`` as flat JSON: strings cut at 200, arrays as ``<field>_count``, structs with an id as ``<field>_id``, nulls left out."""
    parts = []
    for field in df.schema[name].dataType.fields:
        c = F.col(name)[field.name]
        if isinstance(field.dataType, (T.ArrayType, T.MapType)):
            parts.append(F.when(c.isNotNull(), F.size(c)).alias(f"{field.name}_count"))
        elif isinstance(field.dataType, T.StructType):
            parts += [c[x].alias(f"{field.name}_{x}") for x in ("type", "id") if x in field.dataType.names]
        elif isinstance(field.dataType, T.StringType):
            parts.append(limit_str(c, 200).alias(field.name))
        else:
            parts.append(c.alias(field.name))
    return df.withColumn(f"{name}_summary", F.to_json(F.struct(*parts)))


def classify_events(df: DataFrame) -> DataFrame:
    """event_kind, subject and detail of ``message``: ``kind: subject — detail``; ``[n+1.detected]``; other bracketed texts are ``custom``; else null."""
    m = F.col("message")
    bracket = F.nullif(F.regexp_extract(m, r"(?s)^\[([^\]]+)\]", 1), F.lit(""))
    head = F.nullif(F.regexp_extract(m, r"(?s)^([a-z]+(?:\.[a-z_]+)+): ", 1), F.lit(""))
    kind = F.when(bracket == "n+1.detected", bracket).when(bracket.isNotNull(), F.lit("custom")).when(head.isin(*KINDS), head)
    rest = F.when(bracket == "n+1.detected", F.ltrim(F.regexp_replace(m, r"(?s)^\[[^\]]+\]", ""))).when(head.isin(*KINDS), F.regexp_replace(m, r"(?s)^[a-z]+(?:\.[a-z_]+)+: ", ""))
    plain = F.when(kind == "custom", bracket).otherwise(F.split_part(rest, F.lit(" — "), F.lit(1)))
    detail = F.when(F.instr(rest, " — ") > 0, F.regexp_replace(rest, r"(?s)^.*? — ", ""))
    return df.withColumns({"event_kind": kind, "subject": F.when(kind.isNotNull(), plain), "detail": detail})


def http_events(exchanges: DataFrame, min_status: int = 400) -> DataFrame:
    """One event of an exchange at most: rejected if an exception came with a status below 500, else a response of ``min_status`` or more."""
    line = F.format_string("%d %s %s", "status", "method", "path")
    rejected = F.col("exception_class").isNotNull() & (F.col("status") < 500)
    response = F.col("exception_class").isNull() & (F.col("status") >= min_status)
    name = level_for_status("status")
    return exchanges.where(rejected | response).withColumns({
        "message": F.when(rejected, F.concat(F.lit("http.rejected: "), line, F.lit(" — "), "exception_class")).otherwise(F.concat(F.lit("http.response: "), line)),
        "level": level_value(name), "level_name": F.upper(name),
    })


def http_client_errors(calls: DataFrame) -> DataFrame:
    """Failed outgoing calls: status of 400 or more, or no response. Urls are cut at 80 in the message and 200 in the context, bodies at 500."""
    failed = F.col("status").isNull()
    url = limit_str("url", 80)
    return calls.where(failed | (F.col("status") >= 400)).withColumns({
        "message": F.when(failed, F.concat(F.lit("http.connection_failed: "), "method", F.lit(" "), url)).otherwise(F.concat(F.lit("http.error: "), F.col("status").cast("string"), F.lit(" "), "method", F.lit(" "), url)),
        "level": level_value(F.lit("error")), "context_url": limit_str("url", 200), "body": limit_str("body", 500),
    })


def exception_status(df: DataFrame, mapping: DataFrame, default: int = 500) -> DataFrame:
    """``status`` of each row's exception_class by the small table ``mapping`` (exception_class, status); ``default`` if it is in none."""
    m = mapping.groupBy(F.col("exception_class").alias("_e")).agg(F.max("status").alias("_s"))
    return df.join(m, F.col("exception_class") == F.col("_e"), "left").withColumn("mapped_status", F.coalesce("_s", F.lit(default))).drop("_e", "_s")


def slow_queries(queries: DataFrame, threshold_ms: float = 500, skip: str = "log_entries") -> DataFrame:
    """Statements that took ``threshold_ms`` or more; includes_connect: the first one of its connection in its span, over all statements."""
    first = F.row_number().over(W.partitionBy("trace_id", "span_id", "connection").orderBy("ts", "seq")) == 1
    return queries.withColumn("includes_connect", first).where((F.col("time_ms") >= threshold_ms) & ~F.col("sql").contains(skip)).withColumns({
        "message": F.concat(F.lit("db.slow_query: "), limit_str("sql", 100)), "sql": limit_str("sql", 500)
    })


def diff_snapshots(
    before: DataFrame, after: DataFrame, keys: Sequence[str], limit: int = 200, model: str | None = None, models: Sequence[str] | None = None,
    key_patterns: Sequence[str] = KEY_PATTERNS, value_regexes: Sequence[str] = (),
) -> DataFrame:
    """Changes between two tables with unique keys: change (created, updated, deleted), changed columns, and both sides' changed values as maps.

    Values of columns whose name holds one of ``key_patterns`` are masked, in others what ``value_regexes`` find; then they are cut at ``limit``. That a
    secret changed is told, not what it was or is. With a list ``models`` only tables are compared whose name ``model`` is in it.
    """
    if models is not None and model not in models:
        before, after = before.limit(0), after.limit(0)
    values = [c for c in before.columns if c not in keys]
    text = lambda c: limit_str(masked_text(F.col(c).cast("string"), c[3:], key_patterns, value_regexes), limit)  # noqa: E731  after the prefix of its side
    b = before.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in values], F.lit(True).alias("_b"))
    a = after.select(*keys, *[F.col(c).alias(f"_a_{c}") for c in values], F.lit(True).alias("_a"))
    met = b.join(a, list(keys), "full")
    dirty = lambda c: ~F.col(f"_b_{c}").eqNullSafe(F.col(f"_a_{c}"))
    change = F.when(F.col("_b").isNull(), "created").when(F.col("_a").isNull(), "deleted").otherwise("updated")
    changed = F.array_compact(F.array(*[F.when(dirty(c), F.lit(c)) for c in values]))
    side = lambda s, on: F.map_from_entries(F.array_compact(F.array(*[F.when(on(c), F.struct(F.lit(c), text(f"_{s}_{c}"))) for c in values])))
    out = met.withColumns({"change": change, "changed": F.when(change == "updated", changed)})
    return out.where((F.col("change") != "updated") | (F.size("changed") > 0)).select(
        *keys, "change", "changed",
        F.when(F.col("change") == "updated", side("b", dirty)).alias("from"),
        F.when(F.col("change") == "updated", side("a", dirty)).when(F.col("change") == "created", side("a", lambda _: F.lit(True))).alias("to"),
        F.when(F.col("change") == "deleted", level_value(F.lit("info"))).otherwise(level_value(F.lit("debug"))).alias("level"),
    )


def request_measures(df: DataFrame) -> DataFrame:
    """``measures`` with the span's own duration at the end, named by its origin, where the span has ended."""
    label = F.when(F.col("origin") == "http", "request").when(F.col("origin") == "cli", "command").when(F.col("origin") == "schedule", "scheduled_task")
    own = F.struct(label.alias("label"), F.col("duration_ms").cast("double").alias("duration_ms"), F.lit(None).cast("string").alias("meta"))
    kind = "array<struct<label: string, duration_ms: double, meta: string>>"
    there = F.coalesce(F.col("measures"), F.array().cast(kind)) if "measures" in df.columns else F.array().cast(kind)
    return df.withColumn("measures", F.when(label.isNotNull() & F.col("duration_ms").isNotNull(), F.array_append(there, own)).otherwise(there))

