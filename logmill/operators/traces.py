"""Traces, spans, exceptions, deploys, affected users."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import occurrences
from ..schema import ERROR
from ..scratch import removed, scratch_path
from .derive import classify_events
from .redact import KEY_PATTERNS, MASK, mask_values, redact_json

# Parts of class names and prefixes that are no application code.
SKIP_CLASSES = ("Facade", "Pipeline", "Container", "BoundMethod", "Dispatcher", "Router", "CallQueuedHandler", "Kernel", "Application", "RoutingServiceProvider")
SKIP_PREFIXES = ("Illuminate\\", "Symfony\\", "Monolog\\")


def _micros(c: str | Column) -> Column:
    return F.unix_micros((F.col(c) if isinstance(c, str) else c).cast("timestamp"))


def trace_timeline(df: DataFrame, trace_id: str | None = None) -> DataFrame:
    """Rows of a trace (or of each) in order, with offset from its start and gap to the row before in milliseconds, and their kind."""
    rows = df.where(F.col("trace_id") == trace_id) if trace_id is not None else df
    w = W.partitionBy("trace_id").orderBy("logged_at", "seq")
    us = _micros("logged_at")
    return classify_events(rows).select(
        "trace_id", "seq", "logged_at", "event_kind", "message", F.row_number().over(w).alias("position"),
        ((us - F.min(us).over(W.partitionBy("trace_id"))) / 1000).alias("offset_ms"), ((us - F.lag(us).over(w)) / 1000).alias("gap_ms"),
    )


def trace_summary(df: DataFrame) -> DataFrame:
    first_error = F.struct("logged_at", "seq")
    return df.groupBy("trace_id").agg(
        F.count(F.lit(1)).alias("entries"), F.max("memory_peak_mb").alias("memory_peak_mb"), F.min("logged_at").alias("started_at"), F.max("logged_at").alias("ended_at"),
        F.sum(F.when(F.col("level") >= ERROR, occurrences()).otherwise(0)).alias("errors"), F.min_by("message", F.when(F.col("level") >= ERROR, first_error)).alias("first_error"),
    )


def trace_markdown(df: DataFrame, key_patterns: Sequence[str] = KEY_PATTERNS, value_regexes: Sequence[str] = (), part_entries: int | None = 5000) -> DataFrame:
    """trace_id, part, markdown: metadata, request input, entries, stack traces and measures of each trace, with all secrets masked.

    A long trace is several rows of at most ``part_entries`` entries each, numbered by ``part`` from 0, so that a trace that does not end is never one
    text. With None there are no parts, and a trace is one text of any length.
    JSON columns are masked by key and value, plain texts by value, and in urls the values of sensitive query parameters.
    """
    json_columns = [c for c in ("context", "extra", "request_input", "job_props") if c in df.columns]
    texts = [c for c in ("message", "uri", "stacktrace") if c in df.columns]
    clean = mask_values(redact_json(df, json_columns, key_patterns, value_regexes), texts, value_regexes)
    if "uri" in texts:
        clean = clean.withColumn("uri", F.regexp_replace("uri", rf"(?i)([?&][^=&#]*(?:{'|'.join(key_patterns)})[^=&#]*=)[^&#]*", "$1" + MASK.replace("$", "\\$")))
    part = lambda label, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"\n  - {label}: "), F.col(c).cast("string"))).otherwise(F.lit(""))
    line = F.concat(F.lit("- "), F.date_format("logged_at", "yyyy-MM-dd HH:mm:ss.SSS"), F.lit(" **"), F.coalesce("level_name", F.lit("")), F.lit("** "), F.coalesce("message", F.lit("")))
    for label, c in (("context", "context"), ("input", "request_input"), ("extra", "extra")):
        line = F.concat(line, part(label, c)) if c in df.columns else line
    if "measures" in df.columns:
        line = F.concat(line, F.when(F.size("measures") > 0, F.concat(F.lit("\n  - measures: "), F.array_join(F.transform("measures", lambda m: F.concat(m["label"], F.lit(" "), m["duration_ms"].cast("string"), F.lit(" ms"))), ", "))).otherwise(F.lit("")))
    if "stacktrace" in df.columns:
        line = F.concat(line, F.when(F.col("stacktrace").isNotNull(), F.concat(F.lit("\n```\n"), "stacktrace", F.lit("\n```"))).otherwise(F.lit("")))
    head = F.concat_ws("\n", F.concat(F.lit("# Trace "), F.col("trace_id")), F.concat(F.lit("uri: "), F.coalesce("_uri", F.lit(""))), F.concat(F.lit("user: "), F.coalesce("_user", F.lit(""))), F.concat(F.lit("entries: "), F.col("_n").cast("string")))
    keys = ["trace_id"]
    if part_entries:
        keys.append("part")
        clean = clean.withColumn("part", F.floor((F.row_number().over(W.partitionBy("trace_id").orderBy("logged_at", "seq")) - 1) / part_entries).cast("long"))
    groups = clean.withColumn("_line", F.struct("logged_at", "seq", line.alias("line"))).groupBy(*keys).agg(
        F.sort_array(F.collect_list("_line")).alias("_lines"), F.min_by("uri", F.struct("logged_at", "seq")).alias("_uri"), F.min_by("user_id", F.struct("logged_at", "seq")).alias("_user"), F.count(F.lit(1)).alias("_n")
    )
    return groups.select(*keys, F.concat(head, F.lit("\n\n"), F.array_join(F.transform("_lines", lambda x: x["line"]), "\n")).alias("markdown"))


def span_edges(df: DataFrame) -> DataFrame:
    """trace_id, span_id, parent_span_id, one row a span; a parent that has no rows is null here, which makes its children roots."""
    spans = df.where("span_id is not null").groupBy("trace_id", "span_id").agg(F.min("parent_span_id").alias("parent_span_id"))
    there = spans.select(F.col("trace_id").alias("_trace"), F.col("span_id").alias("_parent"))
    met = spans.join(there, (F.col("trace_id") == F.col("_trace")) & (F.col("parent_span_id") == F.col("_parent")) & (F.col("span_id") != F.col("_parent")), "left")
    return met.select("trace_id", "span_id", F.col("_parent").alias("parent_span_id"))


def span_tree(df: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Spans with root, depth and path (down to ``max_depth``, if given); spans in a circle, and those below one, are in none.

    A span points at a span above it, first at its parent; each round it takes over where that one points to, so a depth of n takes about
    log2(n) rounds. Rounds are written to the shared folder; they end when one brings no further span to its root.
    """
    spark, made = df.sparkSession, []

    def written(rows: DataFrame) -> tuple[DataFrame, int]:
        """``rows`` in the shared folder, and how many of them are not at their root."""
        made.append(scratch_path(spark, "spans"))
        seen = Observation()
        rows.observe(seen, F.count(F.col("_at")).alias("below")).write.parquet(made[-1])
        return spark.read.schema(rows.schema).parquet(made[-1]), seen.get["below"]

    edges = span_edges(df)
    is_root = F.col("parent_span_id").isNull()
    rows, below = written(edges.select("trace_id", "span_id", "parent_span_id", F.col("parent_span_id").alias("_at"), F.when(is_root, F.col("span_id")).alias("root"), F.when(is_root, 0).otherwise(1).alias("depth"), F.col("span_id").alias("path")))
    while below:
        above = rows.select(F.col("trace_id").alias("_trace"), F.col("span_id").alias("_up"), F.col("_at").alias("_next"), F.col("root").alias("_root"), F.col("depth").alias("_depth"), F.col("path").alias("_path"))
        met = rows.where("_at is not null").join(above, (F.col("trace_id") == F.col("_trace")) & (F.col("_at") == F.col("_up")))
        moved = met.select("trace_id", "span_id", "parent_span_id", F.col("_next").alias("_at"), F.col("_root").alias("root"), (F.col("depth") + F.col("_depth")).alias("depth"), F.concat("_path", F.lit(" > "), "path").alias("path"))
        rows, left = written(rows.where("_at is null").unionByName(moved))
        removed(spark, made[-2])
        if left == below:
            break
        below = left
    out = rows.where("_at is null").drop("_at")
    return out if max_depth is None else out.where(F.col("depth") <= max_depth)


def link_jobs(dispatched: DataFrame, jobs: DataFrame) -> DataFrame:
    """``jobs`` (job_id and more) with the trace of their dispatcher (``dispatched``: job_id, trace_id, span_id), its span as parent, and a span of their own."""
    d = dispatched.select(F.col("job_id").alias("_job"), F.col("trace_id").alias("_trace"), F.col("span_id").alias("_span")).dropDuplicates(["_job"])
    met = jobs.join(d, F.col("job_id") == F.col("_job"), "left")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    own = F.md5(F.concat_ws("|", text("job_id"), text("_span")).cast("binary"))
    return met.withColumns({
        "trace_id": F.coalesce("_trace", F.md5(F.concat(F.lit("trace|"), text("job_id")).cast("binary"))), "parent_span_id": F.col("_span"), "span_id": own, "origin": F.lit("queue")
    }).drop("_job", "_trace", "_span")


def who_was_affected(df: DataFrame, where: Column) -> DataFrame:
    """Of the rows that ``where`` selects: users, traces and routes as numbers, occurrences, and the first users in order as a sample."""
    email = F.get_json_object("extra", "$.user.email") if "extra" in df.columns else F.lit(None).cast("string")
    rows = df.where(where)
    return rows.agg(
        F.countDistinct("user_id").alias("users"), F.countDistinct(email).alias("emails"), F.countDistinct("route_name").alias("routes"), F.countDistinct("trace_id").alias("traces"), F.coalesce(F.sum(occurrences()), F.lit(0).cast("long")).alias("occurrences")
    )


def exception_chain(df: DataFrame) -> DataFrame:
    """One row per exception of a stack trace: depth, class, message, file, line, number of frames."""
    rows = df.where("stacktrace is not null").select("seq", F.posexplode(F.split("stacktrace", "\n\nCaused by: ")).alias("depth", "part"))
    x = lambda p, i: F.regexp_extract("part", p, i)
    head, place = r"(?s)^([\w\\.]+): (.*?)\nin ", r"(?s)\nin ([^\n]+):(\d+)(?:\n|$)"
    return rows.select("seq", "depth", x(head, 1).alias("class"), x(head, 2).alias("message"), x(place, 1).alias("file"), x(place, 2).try_cast("int").alias("line"), F.regexp_count("part", F.lit(r"(?m)^#\d+ ")).cast("long").alias("frames"))


def parse_frames(stacktrace: Column | str) -> Column:
    """Frames of a stack trace's text: structs of file, line, class, function. Lines look like ``#0 file(line): Class->function()``."""
    lines = F.filter(F.split(stacktrace, "\n"), lambda x: x.rlike(r"^#\d+ "))
    part = lambda x, p, i: F.nullif(F.regexp_extract(x, p, i), F.lit(""))
    where, call = r"^#\d+ (.+?)\((\d+)\): ", r"^#\d+ (?:.+?\(\d+\)|\[internal function\]): ([\w\\]+)(?:->|::)([^(]+)\("
    return F.transform(lines, lambda x: F.struct(part(x, where, 1).alias("file"), part(x, where, 2).try_cast("int").alias("line"), part(x, call, 1).alias("class"), part(x, call, 2).alias("function")))


def top_user_frame(df: DataFrame, frames: str = "frames", ignore: Sequence[str] = ("/vendor/",), base: str = "") -> DataFrame:
    """caller_file, caller_line of the first frame outside ignored paths, and caller_method: the first application ``Class@function`` after it."""
    from functools import reduce

    is_user = lambda f: f["file"].isNotNull() & ~reduce(lambda a, b: a | b, [f["file"].contains(p) for p in ignore], F.lit(False))
    spots = F.transform(F.col(frames), lambda f, i: F.struct(i.alias("i"), is_user(f).alias("u"), f.alias("f")))
    first = F.get(F.filter(spots, lambda x: x["u"]), F.lit(0))
    skipped = lambda c: reduce(lambda a, b: a | b, [c.contains(p) for p in SKIP_CLASSES] + [c.startswith(p) for p in SKIP_PREFIXES])
    is_app = lambda f: f["class"].isNotNull() & f["function"].isNotNull() & ~f["function"].contains("{closure") & ~skipped(f["class"])
    after = F.get(F.filter(F.slice(F.col(frames), F.coalesce(F.col("_first.i"), F.lit(0)) + 2, F.lit(10_000)), is_app), F.lit(0))
    base = base.rstrip("/") + "/" if base else ""
    out = df.withColumn("_first", first).withColumn("_method", F.when(F.col("_first").isNotNull(), after))
    file = F.col("_first.f.file")
    short = F.when(file.startswith(base), F.substring(file, F.lit(len(base) + 1), F.length(file))).otherwise(file) if base else file
    method = F.when(F.col("_method.function") != "__invoke", F.concat(F.element_at(F.split(F.col("_method.class"), r"\\"), -1), F.lit("@"), F.col("_method.function")))
    return out.withColumns({"caller_file": short, "caller_line": F.col("_first.f.line"), "caller_method": method}).drop("_first", "_method")


def user_recent_errors(df: DataFrame, user_id: str, n: int = 10) -> DataFrame:
    """The latest error of each of the user's last ``n`` traces with errors."""
    rows = df.where((F.col("user_id") == user_id) & (F.col("level") >= ERROR))
    last = rows.withColumn("_k", F.row_number().over(W.partitionBy("trace_id").orderBy(F.desc("logged_at"), F.desc("seq")))).where("_k = 1")
    return last.orderBy(F.desc("logged_at"), F.desc("seq")).limit(n).select("trace_id", "seq", "logged_at", "message")


def compare_deployments(df: DataFrame, base_sha: str, head_sha: str) -> DataFrame:
    """Error messages that only one of two deploys has: status new or gone, with occurrences."""
    n = lambda sha: F.sum(F.when(F.col("git_sha") == sha, occurrences()).otherwise(0))
    groups = df.where((F.col("level") >= ERROR) & F.col("git_sha").isin(base_sha, head_sha)).groupBy("message").agg(n(base_sha).alias("b"), n(head_sha).alias("h"))
    return groups.where((F.col("b") == 0) != (F.col("h") == 0)).select("message", F.when(F.col("b") == 0, "new").otherwise("gone").alias("status"), (F.col("b") + F.col("h")).alias("occurrences"))


def get_log_entry(df: DataFrame, seq: int) -> DataFrame:
    return df.where(F.col("seq") == seq)


def attach_dimension(df: DataFrame, dim: DataFrame, on: tuple[str, str], attributes: Mapping[str, Column], label: Column, name: str = "user", small: int = 100_000) -> DataFrame:
    """``extra_<name>`` (JSON of the curated attributes) and ``<name>_label`` from the dimension's row; it is broadcast while it is ``small``."""
    left, right = on
    side = dim.select(F.col(right).cast("string").alias("_on"), F.to_json(F.struct(*[c.alias(n) for n, c in attributes.items()])).alias(f"extra_{name}"), label.alias(f"{name}_label")).dropDuplicates(["_on"])
    side = F.broadcast(side) if dim.count() <= small else side
    return df.join(side, F.col(left).cast("string") == F.col("_on"), "left").drop("_on")


def deploy_at(df: DataFrame, deploys: DataFrame, by: str = "app_env") -> DataFrame:
    """``git_sha`` of each row, or where it is null the sha of the last deploy (``by``, deployed_at, git_sha) at or before it.

    A deploy holds until the next one of its ``by``, of equal times the larger sha; it is a row for each day that it holds, so rows find theirs
    by a hash join on ``by`` and day. No task gets all rows of an environment.
    """
    seconds = lambda c: F.unix_micros(c.cast("timestamp"))
    last = df.agg(F.max(seconds(F.col("logged_at"))).alias("m")).first()["m"] or 0
    us, day = seconds(F.col("deployed_at")), 86_400_000_000
    marks = deploys.select(F.col(by).alias("_by"), us.alias("_from"), F.col("git_sha").alias("_sha"))
    ended = marks.withColumn("_to", F.coalesce(F.lead("_from").over(W.partitionBy("_by").orderBy("_from", "_sha")), F.greatest(F.lit(last + 1), F.col("_from"))))
    held = ended.where("_from < _to").withColumn("_day", F.explode(F.sequence(F.floor(F.col("_from") / day), F.floor(F.col("_to") / day))))
    at = seconds(F.col("logged_at"))
    met = df.join(held, (F.col(by) == F.col("_by")) & (F.floor(at / day) == F.col("_day")) & (at >= F.col("_from")) & (at < F.col("_to")), "left")
    return met.withColumn("git_sha", F.coalesce("git_sha", "_sha")).drop("_by", "_from", "_to", "_sha", "_day")
