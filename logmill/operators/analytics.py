"""Aggregations over log rows. Every count is a sum of occurrences; an error is a row of level 400 or more."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import exception_class, normalize_sql, occurrences, sql_table
from ..schema import ERROR
from ..scratch import scratch_path
from .ranks import exact_percentiles


def _n() -> Column:
    return F.sum(occurrences())


def _errors() -> Column:
    return F.coalesce(F.sum(F.when(F.col("level") >= ERROR, occurrences())), F.lit(0).cast("long"))


def count_logs(df: DataFrame, filters: Column | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Rows and occurrences, in all or by columns."""
    return (df.where(filters) if filters is not None else df).groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.coalesce(_n(), F.lit(0).cast("long")).alias("occurrences"))


def _between(df: DataFrame, window: tuple[str | None, str | None] | None, column: str = "logged_at") -> DataFrame:
    """Rows of the times [since, until); an end that is None is open."""
    since, until = window or (None, None)
    kind = df.schema[column].dataType
    df = df.where(F.col(column) >= F.lit(since).cast(kind)) if since else df
    return df.where(F.col(column) < F.lit(until).cast(kind)) if until else df


def _sections(df: DataFrame, *more: Column) -> DataFrame:
    """section (total, route, job, deploy, issue), name, occurrences, errors and ``more``, all in one pass with grouping sets."""
    kind, key, text = _issue()
    issue = F.when(kind.isNotNull(), F.struct(F.concat(kind, F.lit(": "), text).alias("name"), key.alias("key")))
    rows = df.withColumns({"_n": occurrences(), "_issue": issue})
    names = ["route_name", "job_class", "git_sha", "_issue"]
    sums = [F.sum("_n").alias("occurrences"), F.coalesce(F.sum(F.when(F.col("level") >= ERROR, F.col("_n"))), F.lit(0).cast("long")).alias("errors")]
    sets = rows.groupingSets([[], *([F.col(c)] for c in names)], *names).agg(F.grouping_id().alias("_set"), *sums, *more)
    section = F.when(F.col("_set") == 15, "total").when(F.col("_set") == 7, "route").when(F.col("_set") == 11, "job").when(F.col("_set") == 13, "deploy").otherwise("issue")
    name = F.coalesce("route_name", "job_class", "git_sha", "_issue.name")
    found = sets.select(section.alias("section"), name.alias("name"), F.col("_issue.key").alias("_key"), *[c for c in sets.columns if c not in (*names, "_set")])
    return found.where((F.col("section") == "total") | F.col("name").isNotNull())


def _top(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("section").orderBy(F.desc("occurrences"), "name", "_key"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).drop("_key")


def traffic_overview(df: DataFrame, window: tuple[str | None, str | None] | None = None, k: int = 5) -> DataFrame:
    """section (total, route, job, deploy, issue), name, occurrences, errors, rank: the top ``k`` of a section among the rows of a window of time.

    An issue is open in the window if it has a row there; its name tells its kind and message.
    """
    return _top(_sections(_between(df, window)), k)


def daily_rollup(df: DataFrame) -> DataFrame:
    """The sections of each day with occurrences, errors, and users and traces as sketches; rows that add up over any days."""
    sketches = [F.hll_sketch_agg(F.coalesce(c, F.lit(""))).alias(n) for c, n in (("user_id", "users"), ("trace_id", "traces"))]
    by_day = df.withColumn("_day", F.to_date("logged_at"))
    kind, key, text = _issue()
    item = lambda section, name, key: F.struct(F.lit(section).alias("section"), name.alias("name"), key.alias("_key"))
    none = F.lit("")
    items = F.array(item("total", none, none), *[item(n, F.col(c), none) for n, c in (("route", "route_name"), ("job", "job_class"), ("deploy", "git_sha"))], item("issue", F.concat(kind, F.lit(": "), text), key))
    each = by_day.select("_day", "user_id", "trace_id", "level", occurrences().alias("_n"), F.explode(F.filter(items, lambda x: x["name"].isNotNull())).alias("x"))
    return each.groupBy(F.col("_day").alias("day"), "x.section", "x.name", F.col("x._key").alias("_key")).agg(F.sum("_n").alias("occurrences"), F.coalesce(F.sum(F.when(F.col("level") >= ERROR, F.col("_n"))), F.lit(0).cast("long")).alias("errors"), *sketches)


def overview_of_days(rollup: DataFrame, since: str | None = None, until: str | None = None, k: int = 5) -> DataFrame:
    """``traffic_overview`` of the days [since, until) from rows of ``daily_rollup``: counts are exact, users and traces estimates (some 2 percent)."""
    days = _between(rollup, (since, until), "day")
    sums = days.groupBy("section", "name", "_key").agg(
        F.sum("occurrences").alias("occurrences"), F.sum("errors").alias("errors"), F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users"), F.hll_sketch_estimate(F.hll_union_agg("traces")).alias("traces")
    )
    return _top(sums.withColumn("name", F.when(F.col("section") != "total", F.col("name"))), k)


def _issue() -> tuple[Column, Column, Column]:
    """Kind, key and message of a row's issue; the kind is null in rows that belong to none."""
    kind = F.when(F.col("message").startswith("[n+1.detected]"), "n_plus_one").when(F.col("message").startswith("db.slow_query: "), "slow_query").when(F.col("stacktrace").isNotNull(), "exception")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    key = F.md5(F.concat_ws("|", text("level"), exception_class("stacktrace"), F.concat(text("caller_file"), F.lit(":"), text("caller_line")), text("message")).cast("binary"))
    return kind, key, text("message")


def list_issues(df: DataFrame, k: int = 20, sort: str = "occurrences") -> DataFrame:
    """Issues (exceptions, N+1s, slow queries) by kind and fingerprint without the user: occurrences, first and last time, users, traces, a sample trace."""
    kind, key, _ = _issue()
    groups = df.withColumns({"issue_kind": kind, "issue": key}).where("issue_kind is not null").groupBy("issue_kind", "issue").agg(
        F.min("message").alias("message"), _n().alias("occurrences"), F.min("logged_at").alias("first_seen"), F.max("logged_at").alias("last_seen"),
        F.countDistinct("user_id").alias("users"), F.countDistinct("trace_id").alias("traces"), F.max_by("trace_id", F.struct("logged_at", "seq")).alias("sample_trace_id"),
    )
    return groups.orderBy(F.desc(sort), "issue_kind", "issue").limit(k)


def list_recent_errors(df: DataFrame, k: int = 20) -> DataFrame:
    return df.where(F.col("level") >= ERROR).orderBy(F.desc("logged_at"), F.desc("seq")).limit(k).select("seq", "logged_at", "level", "message", "trace_id", "user_id", "caller_file", "caller_line")


def list_slow_queries(queries: DataFrame, sort: str = "occurrences", min_duration_ms: float = 500, k: int = 20) -> DataFrame:
    """Per normalised statement: occurrences, latest and largest duration, caller and connection of the latest."""
    last = F.struct("ts", "trace_id", "seq")
    groups = queries.where(F.col("time_ms") >= min_duration_ms).groupBy(normalize_sql("sql").alias("statement")).agg(
        F.count(F.lit(1)).alias("occurrences"), F.max_by("time_ms", last).alias("latest_ms"), F.max("time_ms").alias("slowest_ms"),
        F.max_by("connection", last).alias("connection"), F.max_by("caller", last).alias("caller"),
    )
    return groups.orderBy(F.desc("occurrences" if sort == "occurrences" else "slowest_ms"), "statement").limit(k)


def detect_n_plus_one(queries: DataFrame, threshold: int = 5, order: Sequence[str] = ("ts", "seq")) -> DataFrame:
    """One report per trace, span and normalised statement that ran ``threshold`` times or more, from its ``threshold``-th run; with the true total.

    A report carries the measure ``n+1`` of 0 ms, which marks the span without adding to its time. The window keeps only the ``threshold`` first
    rows of a group in each task, before rows are exchanged; totals are counted apart and meet the reports, a row a group.
    """
    rows = queries.withColumn("statement", normalize_sql("sql"))
    by = ("trace_id", "span_id", "statement")
    told = rows.withColumn("_n", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("_n") == threshold)
    often = rows.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(F.count(F.lit(1)).alias("total")).where(F.col("total") >= threshold)
    met = told.join(often, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]))
    table = sql_table("sql")
    meta = F.struct(F.left("statement", F.lit(500)).alias("sql"), F.lit(threshold).alias("count"), "caller", "connection", "trace_id")
    measure = F.struct(F.lit("n+1").alias("label"), F.lit(0.0).alias("duration_ms"), F.to_json(meta).alias("meta"))
    place = F.element_at(F.split(F.replace("caller", F.lit(":"), F.lit("#")), "/"), -1)
    return met.select(
        "trace_id", "span_id", "statement", table.alias("table"), "caller", "connection", "time_ms", "total",
        F.concat(F.lit("[n+1.detected] "), table, F.lit(" — "), F.coalesce(place, F.lit("?"))).alias("message"), F.array(measure).alias("measures"),
    )


def list_n_plus_one(queries: DataFrame, threshold: int = 5, sort: str = "occurrences", k: int = 20) -> DataFrame:
    """Per normalised statement: in how many spans it ran ``threshold`` times or more, copies in the latest and in the worst of them, its caller."""
    spans = queries.groupBy(normalize_sql("sql").alias("statement"), "trace_id", "span_id").agg(F.count(F.lit(1)).alias("copies"), F.max("ts").alias("ts"), F.min("caller").alias("caller"))
    last = F.struct("ts", "trace_id", "span_id")
    groups = spans.where(F.col("copies") >= threshold).groupBy("statement").agg(
        F.count(F.lit(1)).alias("occurrences"), F.max_by("copies", last).alias("latest_duplicate_count"), F.max("copies").alias("duplicate_count"), F.max_by("caller", last).alias("caller")
    )
    return groups.orderBy(F.desc(sort), "statement").limit(k)


def top_errored_symbols(df: DataFrame, group_by: str = "method", path_contains: str | None = None, k: int = 10, approximate: bool = False) -> DataFrame:
    """Where errors come from: occurrences, users, traces and a sample trace of each method, file or line."""
    symbol = {"method": F.col("caller_method"), "file": F.col("caller_file"), "line": F.concat("caller_file", F.lit(":"), F.col("caller_line").cast("string"))}[group_by]
    rows = df.where(F.col("level") >= ERROR)
    rows = rows.where(F.col("caller_file").contains(path_contains)) if path_contains else rows
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    groups = rows.groupBy(symbol.alias("symbol")).agg(
        _n().alias("occurrences"), distinct("user_id").alias("users"), distinct("trace_id").alias("traces"), F.max_by("trace_id", F.struct("logged_at", "seq")).alias("sample_trace_id")
    )
    return groups.orderBy(F.desc("occurrences"), "symbol").limit(k)


def measure_snapshots(df: DataFrame) -> DataFrame:
    """One row per measure of a span: from the longest of its cumulative snapshots, so that none is counted once per later row."""
    longest = df.where(F.size("measures") > 0).groupBy("trace_id", "span_id").agg(F.max_by("measures", F.struct(F.size("measures"), "logged_at")).alias("measures"))
    return longest.select("trace_id", "span_id", F.inline("measures"))


def _percentiles(df: DataFrame, by: Sequence[str], value: str, wanted: Mapping[str, float], accuracy: int | None) -> DataFrame:
    """``by``, the percentiles and ``n``: exact, by ranks, or with ``accuracy`` from sketches of bounded size."""
    if accuracy is None:
        return exact_percentiles(df, by, value, wanted)
    return df.groupBy(*by).agg(*[F.percentile_approx(value, p, accuracy).cast("double").alias(c) for c, p in wanted.items()], F.count(value).alias("n"))


def analyze_measures(df: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Percentiles and number of each label's measures; with ``accuracy`` the percentiles are approximate, from sketches of bounded size.

    A label whose measures all lack a duration has null percentiles.
    """
    rows = measure_snapshots(df)
    if accuracy is not None:
        return _percentiles(rows, ["label"], "duration_ms", {"p50": 0.5, "p95": 0.95}, accuracy).drop("n").join(rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")), "label")
    path = scratch_path(df.sparkSession, "measures")
    rows.select("label", "duration_ms").write.parquet(path)
    rows = df.sparkSession.read.schema("label string, duration_ms double").parquet(path)
    found = exact_percentiles(rows, ["label"], "duration_ms", {"p50": 0.5, "p95": 0.95}).drop("n")
    counts = rows.groupBy(F.col("label").alias("_label")).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(found, F.col("label").eqNullSafe(F.col("_label")), "left").select(F.col("_label").alias("label"), "p50", "p95", "n")


def measure_totals(df: DataFrame) -> DataFrame:
    return measure_snapshots(df).agg(F.coalesce(F.sum("duration_ms"), F.lit(0.0)).alias("total_ms"), F.count(F.lit(1)).alias("n"))


def memory_peaks(df: DataFrame, by: Sequence[str] = ("trace_id",)) -> DataFrame:
    return df.groupBy(*by).agg(F.max("memory_peak_mb").alias("memory_peak_mb")).where("memory_peak_mb is not null")


def analyze_route_performance(df: DataFrame, route: str, k: int = 5, accuracy: int | None = None) -> DataFrame:
    """section, name, value: percentiles of the route's trace durations, its most frequent errors, its slowest traces."""
    rows = df.where(F.col("route_name") == route)
    traces = rows.groupBy("trace_id").agg(F.max("duration_ms").alias("ms")).where("ms is not null")
    most = traces.agg(F.max("ms").cast("double").alias("max"))
    stats = _percentiles(traces, [], "ms", {"p50": 0.5, "p95": 0.95}, accuracy).join(F.broadcast(most))  # one row each
    parts = stats.select(F.inline(F.array(*[F.struct(F.lit("duration").alias("section"), F.lit(c).alias("name"), F.col(c).alias("value")) for c in ("p50", "p95", "max")])))
    errors = rows.where(F.col("level") >= ERROR).groupBy(F.col("message").alias("name")).agg(_n().cast("double").alias("value")).orderBy(F.desc("value"), "name").limit(k)
    slowest = traces.select(F.col("trace_id").alias("name"), F.col("ms").cast("double").alias("value")).orderBy(F.desc("value"), "name").limit(k)
    return parts.unionByName(errors.select(F.lit("error").alias("section"), "name", "value")).unionByName(slowest.select(F.lit("slow_trace").alias("section"), "name", "value"))


def list_slow_traces(df: DataFrame, by: str = "duration", min_duration_ms: float = 0, min_memory_mb: float = 0, min_entries: int = 0, k: int = 20) -> DataFrame:
    groups = df.groupBy("trace_id").agg(F.max("duration_ms").alias("duration_ms"), F.max("memory_peak_mb").alias("memory_peak_mb"), F.count(F.lit(1)).alias("entries"))
    kept = groups.where((F.coalesce("duration_ms", F.lit(0)) >= min_duration_ms) & (F.coalesce("memory_peak_mb", F.lit(0)) >= min_memory_mb) & (F.col("entries") >= min_entries))
    return kept.orderBy(F.desc_nulls_last({"duration": "duration_ms", "memory": "memory_peak_mb", "entries": "entries"}[by]), "trace_id").limit(k)


def job_lifecycle(df: DataFrame) -> DataFrame:
    """Per trace, job and attempt: wait and run time in seconds and outcome (completed, failed, lost: started only, waiting: dispatched only).

    ``retries``: attempts of the job in its trace that came before; ``retry_requests``: how often its retry was asked for there (job.retrying, which
    names no attempt).
    """
    at = lambda kind: F.when(F.col("event_kind") == kind, F.col("logged_at"))
    job = ("trace_id", "job_class")
    rows = df.where(F.col("event_kind").isin("job.dispatched", "job.started", "job.completed", "job.failed", "job.retrying"))
    attempt = F.when(F.col("event_kind") != "job.retrying", F.col("job_attempt"))
    groups = rows.groupBy(*job, attempt.alias("job_attempt"), (F.col("event_kind") == "job.retrying").alias("_asked")).agg(
        F.min(at("job.dispatched")).alias("dispatched_at"), F.min(at("job.started")).alias("started_at"), F.max(at("job.completed")).alias("completed_at"), F.max(at("job.failed")).alias("failed_at"),
        F.count(F.lit(1)).alias("_n"),
    )
    inside = W.partitionBy(*job)
    groups = groups.withColumn("retry_requests", F.coalesce(F.sum(F.when(F.col("_asked"), F.col("_n"))).over(inside), F.lit(0).cast("long"))).where("not _asked")
    groups = groups.withColumn("retries", F.row_number().over(inside.orderBy("job_attempt")).cast("long") - 1)
    seconds = lambda a, b: (F.unix_micros(F.col(b).cast("timestamp")) - F.unix_micros(F.col(a).cast("timestamp"))) / 1e6
    outcome = F.when(F.col("failed_at").isNotNull() & (F.col("completed_at").isNull() | (F.col("failed_at") > F.col("completed_at"))), "failed").when(F.col("completed_at").isNotNull(), "completed").when(F.col("started_at").isNotNull(), "lost").otherwise("waiting")
    done = groups.withColumn("ended_at", F.greatest("completed_at", "failed_at"))
    return done.select(*job, "job_attempt", outcome.alias("outcome"), seconds("dispatched_at", "started_at").alias("wait_s"), seconds("started_at", "ended_at").alias("run_s"), "retries", "retry_requests")


def kind_coverage(df: DataFrame, expected: DataFrame, run_id: str | None = None) -> DataFrame:
    """Expected kinds (column event_kind) that no row has; with ``run_id`` only rows with that ``test_run_id`` in their context count."""
    rows = df.where(F.get_json_object("context", "$.test_run_id") == run_id) if run_id else df
    return expected.join(rows.select("event_kind").where("event_kind is not null").distinct(), "event_kind", "left_anti")


def ingest_health(df: DataFrame, arrived: str = "arrived_at", accuracy: int | None = None) -> DataFrame:
    """One row: delay percentiles in seconds, rows and occurrences, rows without a trace, oldest row, rows per drop reason as total."""
    delay = (F.unix_micros(F.col(arrived).cast("timestamp")) - F.unix_micros(F.col("logged_at").cast("timestamp"))) / 1e6
    dropped = F.when(F.col("message").startswith("agent.dropped_rows: "), F.get_json_object("context", "$.total").cast("long"))
    sums = df.agg(
        F.count(F.lit(1)).alias("rows"), _n().alias("occurrences"), F.count(F.when(F.col("trace_id").isNull(), 1)).alias("without_trace"), F.min("logged_at").alias("oldest"),
        F.coalesce(F.sum(dropped), F.lit(0).cast("long")).alias("dropped"),
    )
    delays = _percentiles(df.select(delay.alias("delay")), [], "delay", {"delay_p50_s": 0.5, "delay_p95_s": 0.95}, accuracy)
    return delays.drop("n").join(F.broadcast(sums))  # one row each


def rollup_levels(df: DataFrame, by: Sequence[str] = ("app_env", "level_name", "origin"), cube: bool = False) -> DataFrame:
    """Occurrences by the columns with subtotals; a column that is summed over is marked as ``*``."""
    groups = (df.cube if cube else df.rollup)(*by).agg(_n().alias("occurrences"), *[F.grouping(c).alias(f"_{c}") for c in by])
    return groups.select(*[F.when(F.col(f"_{c}") == 1, "*").otherwise(F.col(c)).alias(c) for c in by], "occurrences")


def errors_by(df: DataFrame, by: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*[c.alias(n) for n, c in by.items()]).agg(_n().alias("occurrences"), _errors().alias("errors"))
