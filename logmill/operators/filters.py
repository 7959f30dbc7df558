"""Filters, sampling and outage accounting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import glob_match, level_value, occurrences, uri_path
from ..schema import LEVELS

# Prefixes of framework events, of framework jobs, names of framework commands, parts of tooling statements.
EVENT_PREFIXES = (
    "eloquent.", "Illuminate\\", "Laravel\\", "SocialiteProviders\\", "Stancl\\", "Livewire\\", "Filament\\", "Nwidart\\", "creating:", "created:", "updating:",
    "updated:", "deleting:", "deleted:", "saving:", "saved:", "restoring:", "restored:", "replicating:", "trashed:", "forceDeleting:", "forceDeleted:",
    "bootstrapping:", "bootstrapped:",
)
JOB_PREFIXES = ("Illuminate\\Queue\\", "Illuminate\\Broadcasting\\", "Illuminate\\Events\\", "Laravel\\Scout\\", "Laravel\\Telescope\\")
COMMANDS = ("schedule:run", "schedule:finish", "package:discover", "queue:work", "queue:listen", "pail")
TOOLING_SQL = ("log_entries", "log_issues", "log_issue_occurrences", "log_embeddings", "pg_", "information_schema")
MIGRATION_CALLERS = ("/migrations/", "Migration")
# Kinds whose switch is off by default.
OFF_BY_DEFAULT = ("db.migration", "db.transaction.committed", "db.transaction.rolled_back", "cache.hit", "cache.miss", "schedule.failed")


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def _starts(c: Column, prefixes: Sequence[object]) -> Column:
    return F.coalesce(_any([c.startswith(p) for p in prefixes if isinstance(p, str) and p]), F.lit(False))


def drop_ignored_uris(df: DataFrame, patterns: Sequence[str] = ("broadcasting/auth",)) -> DataFrame:
    """Rows of spans none of whose rows has a uri that matches a pattern; a span is named by its id, a row without one stands for itself."""
    hit = glob_match(uri_path("uri"), patterns)
    spans = df.where(hit & F.col("span_id").isNotNull()).select(F.col("span_id").alias("_s")).distinct()
    return df.where(~hit).join(spans, F.col("span_id") == F.col("_s"), "left_anti")


def drop_ignored_events(df: DataFrame, patterns: Sequence[str] = (), prefixes: Sequence[str] = EVENT_PREFIXES, kind: str = "event_kind", subject: str = "subject") -> DataFrame:
    """Without dispatched events of the framework or of ``patterns``; rows of other kinds stay."""
    s = F.col(subject)
    ignored = (F.col(kind) == "event.dispatched") & (_starts(s, prefixes) | glob_match(s, patterns))
    return df.where(~F.coalesce(ignored, F.lit(False)))


def drop_internal_jobs(df: DataFrame, prefixes: object = (), kind: str = "event_kind", job: str = "job_class") -> DataFrame:
    """Without rows of ``job.*`` kinds whose class starts with a built-in or given prefix; ``prefixes`` that are no list are passed over."""
    more = prefixes if isinstance(prefixes, (list, tuple)) else ()
    internal = F.coalesce(F.col(kind).startswith("job."), F.lit(False)) & _starts(F.col(job), [*JOB_PREFIXES, *more])
    return df.where(~internal)


def drop_ignored_commands(df: DataFrame, command: str = "command_name", names: Sequence[str] = COMMANDS) -> DataFrame:
    return df.where(~F.coalesce(F.col(command).isin(*names), F.lit(False)))


def enabled_kinds(df: DataFrame, toggles: Mapping[str, bool] | None = None, kind: str = "event_kind") -> DataFrame:
    """Rows whose kind is not switched off; rows without a kind stay."""
    off = [k for k in {*OFF_BY_DEFAULT, *(toggles or {})} if not (toggles or {}).get(k, k not in OFF_BY_DEFAULT)]
    return df.where(~F.coalesce(F.col(kind).isin(*sorted(off)), F.lit(False))) if off else df


def min_level(df: DataFrame, name: str = "debug") -> DataFrame:
    return df.where(F.col("level") >= LEVELS[name.lower()])


def _rate(value: object) -> float:
    """Between 0 and 1; what is no number is 1."""
    try:
        return min(1.0, max(0.0, float(value)))  # type: ignore[arg-type]
    except (TypeError, ValueError):
        return 1.0


def fraction(text: Column | str) -> Column:
    """A stable number from 0 to 1 for a text, from the first 32 bits of its md5."""
    c = F.col(text) if isinstance(text, str) else text
    return F.conv(F.substring(F.md5(c.cast("string").cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(float(0xFFFFFFFF))


def _draw(key: str, seed: int | None) -> Column:
    """A stable number from 0 to 1 for a row's ``key``; another one for each ``seed``. A null key has none."""
    c = F.col(key).cast("string")
    return fraction(c if seed is None else F.concat(F.lit(f"{seed}|"), c))


def sample_levels(df: DataFrame, rates: Mapping[str, object], row_key: str = "seq", seed: int | None = None) -> DataFrame:
    """Keep each row with its level's probability; the draw is a hash of ``row_key`` and ``seed``, so retries agree and another seed draws anew."""
    drops = [(LEVELS[k.lower()], _rate(v)) for k, v in rates.items() if k.lower() in LEVELS and _rate(v) < 1]
    keep = F.lit(True)
    for value, rate in drops:
        keep = F.when(F.col("level") == value, F.lit(False) if rate <= 0 else _draw(row_key, seed) < rate).otherwise(keep)
    return df.where(keep)


def sample_traces(df: DataFrame, patterns: Mapping[str, object], row_key: str = "seq", seed: int | None = None) -> DataFrame:
    """Keep or drop whole traces by the first pattern that matches the row's path; a row with no path or match stays. ``seed`` as in ``sample_levels``."""
    path, keep = uri_path("uri"), F.lit(True)
    draw = F.coalesce(_draw("trace_id", seed), _draw(row_key, seed))
    for pattern, rate in reversed(list(patterns.items())):
        r = _rate(rate)
        keep = F.when(glob_match(path, [pattern]), F.lit(True) if r >= 1 else F.lit(False) if r <= 0 else draw < r).otherwise(keep)
    return df.where(keep)


def drop_stale(df: DataFrame, now: str, max_age_s: int = 0, recovery: bool | None = None, retry_max_age_s: int = 600) -> tuple[DataFrame, DataFrame]:
    """(kept, tally): rows whose last time is not before the cutoff; a missing or unreadable time stays. An age of 0 switches the filter off."""
    empty = df.sparkSession.createDataFrame([], "reason string, dropped long")
    if max_age_s <= 0:
        return df, empty
    age = max(max_age_s, retry_max_age_s) if recovery else max_age_s
    last = F.coalesce(*[F.try_to_timestamp(F.col(c).cast("string")) for c in ("last_at", "logged_at") if c in df.columns])
    stale = F.coalesce(last < F.to_timestamp(F.lit(now)) - F.make_interval(secs=F.lit(age)), F.lit(False))
    return df.where(~stale), df.where(stale).agg(F.lit("stale").alias("reason"), F.count(F.lit(1)).alias("dropped")).where("dropped > 0")


def shed_during_outage(df: DataFrame, outages: DataFrame, retain: str = "error") -> tuple[DataFrame, DataFrame]:
    """(kept, tally): rows below ``retain`` inside an outage [tripped_at, tripped_at + cooldown_s) go; the tally counts what they stand for.

    Outages are short and few beside the rows. Those that overlap are joined to disjoint intervals within each hour; rows meet them by the
    hour, so the interval join is a hash join whatever the number of outages.
    """
    span = outages.select(F.col("tripped_at").alias("a"), (F.col("tripped_at") + F.make_interval(secs=F.col("cooldown_s"))).alias("b"))
    low = F.coalesce(F.col("level") < LEVELS[retain], F.lit(False))
    hour = lambda c: F.unix_seconds(F.date_trunc("hour", F.col(c)).cast("timestamp"))
    hours = span.select("a", "b", F.explode(F.sequence(hour("a"), hour("b"), F.lit(3600).cast("long"))).alias("_hour"))
    w = W.partitionBy("_hour").orderBy("a", "b")
    steps = hours.withColumn("new", F.coalesce(F.col("a") > F.max("b").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(True)).cast("int"))
    side = steps.withColumn("g", F.sum("new").over(w)).groupBy("_hour", "g").agg(F.min("a").alias("a"), F.max("b").alias("b")).drop("g")
    inside = low & (hour("logged_at") == F.col("_hour")) & (F.col("logged_at") >= F.col("a")) & (F.col("logged_at") < F.col("b"))
    gone = df.join(side, inside, "left_semi")
    n = F.greatest(F.lit(1).cast("long"), F.coalesce("count", F.lit(1).cast("long")))
    return df.join(side, inside, "left_anti"), gone.agg(F.lit("low_severity").alias("reason"), F.sum(n).alias("dropped")).where("dropped > 0")


def circuit_state(outages: DataFrame, now: str) -> DataFrame:
    """One row with the ``circuit`` of the last outage (tripped_at, status, reason) that has begun at ``now``: status, reason and time; null if none has."""
    cols = {"status": "int", "reason": "string", "tripped_at": "timestamp"}
    state = F.struct(*[(F.col(c) if c in outages.columns else F.lit(None)).cast(kind).alias(c) for c, kind in cols.items()])
    begun = F.when(F.col("tripped_at").cast("timestamp") <= F.to_timestamp(F.lit(now)), F.col("tripped_at"))
    return outages.agg(F.max_by(state, begun).alias("circuit"))


def drop_report(tallies: DataFrame, now: str, channel: str = "logs", by: Sequence[str] = (), circuit: DataFrame | None = None) -> DataFrame:
    """One warning row for all ``tallies`` (reason, dropped), or for each group of ``by``; none if nothing was dropped.

    The context tells the counts, their total and, with the one row ``circuit`` (``circuit_state``), the outage that they belong to.
    """
    sums = tallies.groupBy(*by, "reason").agg(F.sum("dropped").alias("n")).where("n > 0")
    one = sums.groupBy(*by).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("reason", "n")))).alias("dropped"), F.sum("n").alias("total")).where("total > 0")
    told = ["dropped", "total"]
    if circuit is not None:
        one, told = one.join(F.broadcast(circuit.select("circuit"))), [*told, "circuit"]  # one row
    return one.select(
        *by, F.concat(F.lit("agent.dropped_rows: "), F.col("total").cast("string"), F.lit(" log rows were dropped client-side during an ingest outage")).alias("message"),
        F.lit(LEVELS["warning"]).alias("level"), F.lit("WARNING").alias("level_name"), F.lit(channel).alias("channel"), F.lit("internal").alias("origin"),
        F.to_json(F.struct(*told)).alias("context"), F.to_timestamp(F.lit(now)).alias("logged_at"),
    )


def with_drop_report(df: DataFrame, report: DataFrame) -> DataFrame:
    return report.unionByName(df, allowMissingColumns=True)


def drop_tooling_queries(queries: DataFrame) -> DataFrame:
    """Without statements of monitoring tables and of migrations; case counts."""
    tooling = _any([F.col("sql").contains(x) for x in TOOLING_SQL]) | F.coalesce(_any([F.col("caller").contains(x) for x in MIGRATION_CALLERS]), F.lit(False))
    return queries.where(~F.coalesce(tooling, F.lit(False)))


def user_frames(frames: Column | str, ignore: Sequence[str] = ("/vendor/",), base: str = "", most: int = 15) -> Column:
    """Of an array of frames (struct with file) the first ``most`` whose file holds no ignored part, files without the base path."""
    cut = F.slice(F.col(frames) if isinstance(frames, str) else frames, 1, most)
    kept = F.filter(cut, lambda f: f["file"].isNotNull() & ~_any([f["file"].contains(p) for p in ignore]))
    base = base.rstrip("/") + "/" if base else ""
    return F.transform(kept, lambda f: f.withField("file", F.when(f["file"].startswith(base), F.substring(f["file"], F.lit(len(base) + 1), F.length(f["file"]))).otherwise(f["file"]))) if base else kept


def level_or(df: DataFrame, default: str = "debug") -> DataFrame:
    """``level`` from ``level_name`` where it is null."""
    return df.withColumn("level", F.coalesce("level", level_value("level_name", LEVELS[default])))


def tally_occurrences(df: DataFrame) -> DataFrame:
    return df.agg(F.sum(occurrences()).alias("occurrences"))
