"""De-duplication, rate limiting and time windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import exception_class, occurrences
from ..schema import LEVELS
from ..scratch import scratch_path
from . import sequences
from .sequences import CountOrTime, Debounce, Flagged, sequential


def fingerprint() -> Column:
    """md5 of level, exception class, caller and message and user; absent parts are empty."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    caller = F.concat(text("caller_file"), F.lit(":"), text("caller_line"))
    return F.md5(F.concat_ws("|", text("level"), exception_class("stacktrace"), caller, text("message"), text("user_id")).cast("binary"))


def collapse(df: DataFrame, window: str = "span", order: Sequence[str] = ("logged_at", "seq"), enabled: bool = True) -> DataFrame:
    """One row per window and fingerprint: the first row's columns, ``count``, and first_at and last_at where that is over 1.

    ``window``: the name of a column, or a length such as ``2 seconds`` for clock-aligned windows of logged_at. Partial and final hash
    aggregation: only one row per group and task is shuffled. A null in the window's column is a window of its own.
    """
    if not enabled:
        return df
    key = F.col("span_id" if window == "span" else window) if window == "span" or window in df.columns else F.window("logged_at", window)["start"]
    kept = [c for c in df.columns if c not in ("count", "first_at", "last_at")]
    last = F.coalesce("last_at", "logged_at") if "last_at" in df.columns else F.col("logged_at")
    n = F.coalesce("count", F.lit(1)).cast("long") if "count" in df.columns else F.lit(1).cast("long")
    rows = df.select(F.struct(*kept).alias("_row"), F.struct(*order).alias("_order"), key.alias("_window"), fingerprint().alias("fingerprint"), n.alias("_n"), last.alias("_last"))
    groups = rows.groupBy("_window", "fingerprint").agg(F.min_by("_row", "_order").alias("_row"), F.sum("_n").alias("count"), F.max("_last").alias("_last"))
    return groups.select("_row.*", "fingerprint", "count", F.when(F.col("count") > 1, F.col("_row.logged_at")).alias("first_at"), F.when(F.col("count") > 1, F.col("_last")).alias("last_at"))


def rate_cap_aligned(df: DataFrame, per_minute: int = 60, sample_s: int = 30, min_level: str = "warning", order: Sequence[str] = ("logged_at", "seq")) -> DataFrame:
    """Clock-aligned rate cap on rows with a fingerprint: the first ``per_minute`` (one at least) of a minute pass, then the first of each
    sample slot.

    What is held back is added up in ``suppressed_count`` of the next row that passes. Rows below ``min_level`` pass unmetered. All is decided
    within a minute of a fingerprint; between minutes only what the last one held back at its end goes on, a row a minute.
    """
    minute, slot = F.date_trunc("minute", "logged_at"), F.floor(F.unix_timestamp(F.col("logged_at").cast("timestamp")) / sample_s)
    metered = df.where(F.col("level") >= LEVELS[min_level])
    free = df.where(~F.coalesce(F.col("level") >= LEVELS[min_level], F.lit(False)))
    by = [F.col(c) for c in order]
    inside = W.partitionBy("fingerprint", "_minute")
    rows = metered.withColumns({"_minute": minute, "_slot": slot}).withColumn("_n", F.row_number().over(inside.orderBy(*by)))
    over = F.col("_n") > max(1, per_minute)
    told = rows.withColumn("_pass", ~over | (F.row_number().over(W.partitionBy("fingerprint", "_minute", "_slot", over).orderBy(*by)) == 1))
    told = told.withColumn("_group", F.coalesce(F.sum(F.col("_pass").cast("int")).over(inside.orderBy(*by).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    held = F.count(F.when(~F.col("_pass"), 1))
    told = told.withColumns({"_held": held.over(W.partitionBy("fingerprint", "_minute", "_group")), "_passes": F.sum(F.col("_pass").cast("int")).over(inside)})
    ends = told.groupBy(F.col("fingerprint").alias("_f"), F.col("_minute").alias("_m")).agg(F.count(F.when(~F.col("_pass") & (F.col("_group") == F.col("_passes")), 1)).alias("_rest"))
    ends = ends.withColumn("_carried", F.lag("_rest").over(W.partitionBy("_f").orderBy("_m"))).where("_carried > 0").drop("_rest")
    first = F.col("fingerprint").eqNullSafe(F.col("_f")) & F.col("_minute").eqNullSafe(F.col("_m")) & (F.col("_n") == 1)
    out = told.where("_pass").join(ends, first, "left")
    n = F.when(F.col("_n") == 1, F.coalesce("_carried", F.lit(0).cast("long"))).otherwise(F.col("_held"))
    out = out.withColumn("suppressed_count", F.nullif(n, F.lit(0).cast("long"))).select(*[c for c in df.columns if c != "suppressed_count"], "suppressed_count")
    return out.unionByName(free.withColumn("suppressed_count", F.lit(None).cast("long")))


class RateCap:
    """The sequential cap of one fingerprint. Times are seconds. The counter lives 60 s from its first hit, a sample slot ``sample_s`` from its
    grant, the tally of held-back rows 900 s from its first one; the next row that passes takes the tally."""

    def __init__(self, per_minute: int = 60, sample_s: float = 30.0, state: tuple | None = None):
        self.per_minute, self.sample_s = max(1, per_minute), max(1, sample_s)
        self.hits, self.hits_end, self.slot_end, self.held, self.held_end = state or (0, 0.0, 0.0, 0, 0.0)

    def state(self) -> tuple:
        return self.hits, self.hits_end, self.slot_end, self.held, self.held_end

    def admit(self, now: float) -> tuple[bool, int]:
        """Whether the row passes, and how many held-back ones it stands for."""
        if now >= self.hits_end:
            self.hits, self.hits_end = 0, now + 60
        self.hits += 1
        if self.hits > self.per_minute:
            if now < self.slot_end:
                if now >= self.held_end:
                    self.held, self.held_end = 0, now + 900
                self.held += 1
                return False, 0
            self.slot_end = now + self.sample_s
        taken = self.held if now < self.held_end else 0
        self.held = 0
        return True, taken

    def admit_all(self, times: np.ndarray) -> np.ndarray:
        """``admit`` for rising times: -1 for a row that is held back, else how many it stands for. Runs of held-back rows are passed over."""
        out = np.full(len(times), -1, np.int64)
        i = 0
        while i < len(times):
            ok, n = self.admit(times[i])
            i += 1
            if ok:
                out[i - 1] = n
            else:
                end = i + int(np.searchsorted(times[i:], min(self.slot_end, self.hits_end, self.held_end)))
                self.hits, self.held, i = self.hits + end - i, self.held + end - i, end
        return out


def rate_cap(df: DataFrame, per_minute: int = 60, sample_s: float = 30.0, min_level: str = "warning", order: Sequence[str] = ("logged_at", "seq")) -> DataFrame:
    """The exact cap on collapsed rows (with ``fingerprint``): a sequential machine per fingerprint, over rows sorted by Spark.

    Rows of a fingerprint stream through their task in batches; nothing but the machine's few numbers is held. Fingerprints with over
    ``sequences.HOT`` rows are taken apart (``_cap_in_ranges``). Rows below ``min_level`` pass.
    """
    metered = df.where(F.col("level") >= LEVELS[min_level])
    free = df.where(~F.coalesce(F.col("level") >= LEVELS[min_level], F.lit(False)))
    names = [c for c in df.columns if c != "suppressed_count"]
    seconds = F.unix_micros(F.col("logged_at").cast("timestamp"))
    rows = metered.select(*names).withColumn("_us", seconds)
    hot = rows.groupBy(F.col("fingerprint").alias("_hot")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > sequences.HOT).select("_hot")
    some = not hot.isEmpty()
    one = F.col("fingerprint").eqNullSafe(F.col("_hot"))  # at most a fingerprint in ``HOT`` rows
    walked = rows.join(F.broadcast(hot), one, "left_anti") if some else rows
    capped = _walked(walked, "fingerprint", order, names, lambda: RateCap(per_minute, sample_s), lambda cap, times: cap.admit_all(times), "suppressed_count")
    if some:
        capped = capped.unionByName(_cap_in_ranges(rows.join(F.broadcast(hot), one, "left_semi"), order, names, per_minute, sample_s))
    capped = capped.withColumn("suppressed_count", F.nullif("suppressed_count", F.lit(0).cast("long")))
    return capped.unionByName(free.select(*names).withColumn("suppressed_count", F.lit(None).cast("long")))


def _cap_in_ranges(rows: DataFrame, order: Sequence[str], names: Sequence[str], per_minute: int, sample_s: float) -> DataFrame:
    """The cap as windows that follow each other, each of which ``sequential`` cuts into ranges. ``rows`` have ``_us``.

    Counters are windows of 60 s over all rows; what passes a counter's limit is over. Sample slots are windows over the rows that are over: the
    first of each passes, the others are held back. Tallies are windows of 900 s over those. A row that passes tells the rows held back since
    the last one that passed and in the last tally, if that has not ended.
    """
    by = [F.col(c) for c in order]
    plain = lambda df: df.drop("_opens", "_number", "_start")
    in_windows = lambda df, seconds: sequential(df, "fingerprint", order, Debounce(seconds), F.col("_us"))

    def kept(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(df.sparkSession, name)
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    counted = in_windows(rows, 60).withColumn("_over", F.row_number().over(W.partitionBy("fingerprint", "_number").orderBy(*by)) > max(1, per_minute))
    counted = kept(plain(counted), "counted")
    slots = kept(in_windows(counted.where("_over"), max(1, sample_s)), "slots")
    tallies = in_windows(plain(slots.where("not _opens")), 900)
    held = tallies.withColumns({"_tally": F.col("_number"), "_end": F.col("_start") + 900_000_000})
    none = {"_tally": F.lit(None).cast("long"), "_end": F.lit(None).cast("long")}
    passing = plain(counted.where("not _over").unionByName(plain(slots.where("_opens")))).withColumns(none)
    all_ = passing.withColumn("_pass", F.lit(1)).unionByName(plain(held).withColumn("_pass", F.lit(0)))
    told = kept(sequential(all_, "fingerprint", order, Flagged(), F.col("_us"), F.col("_pass")), "passes")
    groups = told.where("_pass = 0").groupBy("fingerprint", "_number", "_tally").agg(F.count(F.lit(1)).alias("_n"), F.max("_end").alias("_until"))
    last = groups.groupBy(F.col("fingerprint").alias("_f"), (F.col("_number") + 1).alias("_next")).agg(F.max_by(F.struct("_n", "_until"), "_tally").alias("_held"))
    met = told.where("_pass = 1").join(last, F.col("fingerprint").eqNullSafe(F.col("_f")) & (F.col("_number") == F.col("_next")), "left")
    taken = F.when(F.col("_us") < F.col("_held._until"), F.col("_held._n")).otherwise(F.lit(0)).cast("long")
    return met.select(*names, taken.alias("suppressed_count"))


def _walked(rows: DataFrame, key: str, order: Sequence[str], names: Sequence[str], start: Callable[[], object], walk: Callable[[object, np.ndarray], np.ndarray], column: str | None) -> DataFrame:
    """Rows that a sequential machine of each key takes, with its number as ``column``; a negative number is not taken.

    Rows (with ``_us``, the time in microseconds; null counts as 0) stream sorted through their task in batches, and the machine takes a key's
    times of a batch at once. A key is one sequence and so one task's work, but its rows are never held together.
    """
    sorted_rows = rows.select(*names, "_us").repartition(key).sortWithinPartitions(key, *order)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*names).schema.fields) + (f", `{column}` long" if column else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, machine = object(), start()
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = batch.column(key).dictionary_encode(null_encoding="encode")
            number = coded.indices.to_numpy()
            cuts = [0, *(np.flatnonzero(number[1:] != number[:-1]) + 1).tolist(), len(number)]
            times = pc.fill_null(batch.column("_us"), 0).to_numpy() / 1e6
            found = np.empty(len(number), np.int64)
            for a, b in zip(cuts, cuts[1:], strict=False):
                k = coded.dictionary[int(number[a])].as_py()
                if k != last:
                    last, machine = k, start()
                found[a:b] = walk(machine, times[a:b])
            full = pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(found)], names=[*names, "_found"]).filter(pa.array(found >= 0))
            yield full.rename_columns([*names, column]) if column else full.select(list(names))

    return sorted_rows.mapInArrow(run, kinds)


def total_occurrences(df: DataFrame) -> DataFrame:
    """Events that the rows stand for: their counts and what was held back."""
    return df.agg(F.sum(occurrences()).alias("occurrences"))


def _seconds_order(time: str, order: Sequence[str]) -> tuple[str, ...]:
    return (time, *(c for c in order if c != time))


def debounce(df: DataFrame, key: str, window_s: float = 10, time: str = "logged_at", order: Sequence[str] = ("seq",)) -> DataFrame:
    """First row of each key, then the first one after its marker of ``window_s`` seconds has gone, and so on. A null time counts as 1970.

    A key of many rows is cut into ranges that are walked apart (``sequential``).
    """
    found = sequential(df, key, _seconds_order(time, order), Debounce(window_s), F.unix_micros(F.col(time).cast("timestamp")))
    return found.where("_opens").drop("_opens", "_number", "_start")


def count_or_time_windows(
    df: DataFrame, key: str, max_count: int = 20, max_ms: float = 2000, time: str = "logged_at", order: Sequence[str] = ("seq",), max_rows: int = 100, max_bytes: int = 1 << 20, size: Column | None = None
) -> DataFrame:
    """``window_no`` of each row within its key: a window closes at ``max_count`` rows or ``max_ms`` after its first one; the row that closes it belongs to it.

    Whatever these say, ``max_rows`` rows or ``max_bytes`` bytes close it too. ``size``: a row's bytes, by default those of its JSON. A key of many rows
    is cut into ranges that are walked apart (``sequential``).
    """
    bytes_ = size if size is not None else F.octet_length(F.to_json(F.struct(*df.columns)))
    rule = CountOrTime(max_count, max_ms, max_rows, max_bytes)
    found = sequential(df, key, _seconds_order(time, order), rule, F.unix_micros(F.col(time).cast("timestamp")), F.coalesce(bytes_, F.lit(0)))
    return found.withColumnRenamed("_number", "window_no").drop("_opens", "_start")


def idempotent(df: DataFrame, id_col: str, order: Sequence[str] = ()) -> DataFrame:
    """The first row of each id by ``order`` (any one without it); rows with a null id are not the same event and all stay."""
    known = df.where(F.col(id_col).isNotNull())
    if order:
        ones = known.groupBy(F.col(id_col).alias("_id")).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_row")).select("_row.*")
    else:
        ones = known.dropDuplicates([id_col])
    return ones.unionByName(df.where(F.col(id_col).isNull()))
