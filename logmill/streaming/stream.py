"""Structured Streaming forms. Stateless operators run on streams as they are; the sequential ones keep a few numbers per key in the state store.

Event times are timestamps; cast TIMESTAMP_NTZ columns first. Within a micro-batch the rows of a key are sorted by time before the machine
sees them, so a key's rows of one micro-batch are held: bound it with ``maxFilesPerTrigger`` or the like. Across batches they are taken as
they arrive. States go by event time, behind the watermark; rows that are later than it are dropped by Spark, so report them first with
``write_with_reports``.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import normalize_sql
from ..operators.dedup import RateCap, fingerprint
from ..operators.filters import drop_report, drop_stale, sample_levels, sample_traces
from ..operators.redact import redact_json
from ..operators.sequences import CountOrTime, Debounce, State, walk

log = logging.getLogger(__name__)


def stream_pipeline(stream: DataFrame, rates: Mapping[str, object] | None = None, traces: Mapping[str, object] | None = None, redact: Sequence[str] = ("context", "extra"), row_key: str = "seq") -> DataFrame:
    """Sampling by level and trace, then redaction: what is dropped is never redacted. Shedding, collapse and cap follow on the result."""
    kept = sample_traces(sample_levels(stream, rates or {}, row_key), traces or {}, row_key)
    return redact_json(kept, [c for c in redact if c in stream.columns])


def stream_collapse(stream: DataFrame, window: str = "2 seconds", watermark: str = "1 minute", order: Sequence[str] = ("logged_at", "seq")) -> DataFrame:
    """One row per clock-aligned window and fingerprint once the watermark has passed it; columns as of the batch operator."""
    kept = [c for c in stream.columns if c != "count"]
    rows = stream.withWatermark("logged_at", watermark).withColumn("fingerprint", fingerprint())
    groups = rows.groupBy(F.window("logged_at", window), "fingerprint").agg(
        F.min_by(F.struct(*kept), F.struct(*order)).alias("_row"), F.sum(F.coalesce("count", F.lit(1)) if "count" in stream.columns else F.lit(1)).cast("long").alias("count"), F.max("logged_at").alias("_last")
    )
    return groups.select("_row.*", "fingerprint", "count", F.when(F.col("count") > 1, F.col("_row.logged_at")).alias("first_at"), F.when(F.col("count") > 1, F.col("_last")).alias("last_at"))


class _Machine:
    """A sequential rule of a key. ``parts``: its states, a name with the columns of each; ``columns``: what it adds to the rows that it takes."""

    parts: Mapping[str, str]
    columns: Mapping[str, str]

    def step(self, old: Mapping[str, tuple], us: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, dict[str, tuple]]:
        """(a number for each row, below 0 where it is not taken; the new states, each with the microsecond of its end at last)."""
        raise NotImplementedError


class _Keyed(StatefulProcessor):
    """Runs a machine for each key. Each state goes by itself once the watermark has passed its own end; a batch of late rows never shortens a life."""

    def __init__(self, machine: _Machine, order: Sequence[str]):
        self.machine, self.order = machine, list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.states = {name: handle.getValueState(name, f"{kinds}, until long") for name, kinds in self.machine.parts.items()}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = [b for b in rows if len(b)]
        if not frames:
            return
        old = {name: tuple(values) for name, state in self.states.items() if (values := state.get()) is not None}
        by, us, sizes = _in_order(frames, self.order)
        found = np.empty(len(by), np.int64)
        found[by], new = self.machine.step({n: v[:-1] for n, v in old.items()}, us, sizes)
        now = timerValues.getCurrentWatermarkInMs()
        for name, values in new.items():
            until = max(-(-values[-1] // 1000), old[name][-1] if name in old else 0, now + 1)
            self.states[name].update((*values[:-1], until))
            if name not in old or until != old[name][-1]:
                self.handle.registerTimer(until)
        at = 0
        for b in frames:
            here, at = found[at : at + len(b)], at + len(b)
            if (here >= 0).any():
                yield b.drop(columns=list(OWN))[here >= 0].reset_index(drop=True).assign(**{c: here[here >= 0] for c in self.machine.columns})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        for state in self.states.values():
            values = state.get()
            if values is not None and values[-1] <= now:
                state.clear()
        yield from ()

    def close(self) -> None:
        pass


OWN = ("micros_of_row", "bytes_of_row")  # columns that processors get besides the stream's


def _in_order(frames: Sequence[pd.DataFrame], order: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, microseconds, bytes) of all rows by ``order``. Keys are many and mostly have few rows, so this is numpy."""
    whole = lambda c: np.concatenate([b[c].to_numpy() for b in frames])
    us, sizes = whole("micros_of_row"), whole("bytes_of_row")
    by = np.lexsort([us if c == "logged_at" else whole(c) for c in reversed(order)]) if len(us) > 1 else np.zeros(1, np.int64)
    return by, us[by], sizes[by]


def _keyed(stream: DataFrame, key: str, processor: StatefulProcessor, schema: str, size: Column | None = None, watermark: str = "1 minute") -> DataFrame:
    """``stream`` through a processor of each key, by event time. States lie in RocksDB, which this state API asks for. The API hands rows on as named
    tuples, so column names must be identifiers that do not begin with an underscore."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    us = F.coalesce(F.unix_micros(F.col("logged_at").cast("timestamp")), F.lit(0).cast("long"))  # a null time counts as 1970
    sized = stream.withColumns(dict(zip(OWN, (us, (size if size is not None else F.lit(0)).cast("long")), strict=True)))
    return sized.withWatermark("logged_at", watermark).groupBy(key).transformWithStateInPandas(processor, schema, "Append", "EventTime")


def _sequential(stream: DataFrame, key: str, machine: _Machine, size: Column | None = None, order: Sequence[str] = ("logged_at", "seq")) -> DataFrame:
    added = "".join(f", {n} {kind}" for n, kind in machine.columns.items())
    return _keyed(stream, key, _Keyed(machine, order), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields) + added, size)


class _RateCap(_Machine):
    parts = {"counter": "hits long, ends double", "slot": "ends double", "tally": "held long, ends double"}
    columns = {"suppressed_count": "long"}

    def __init__(self, per_minute: int, sample_s: float):
        self.per_minute, self.sample_s = per_minute, sample_s

    def step(self, old, us, sizes):
        hits, slot, held = old.get("counter", (0, 0.0)), old.get("slot", (0.0,)), old.get("tally", (0, 0.0))
        cap = RateCap(self.per_minute, self.sample_s, (*hits, *slot, *held))
        found = cap.admit_all(us / 1e6)
        hits, hits_end, slot_end, held, held_end = cap.state()
        parts = {"counter": (hits, hits_end), "slot": (slot_end,), "tally": (held, held_end)}
        return found, {name: (*values, round(values[-1] * 1e6)) for name, values in parts.items() if values[-1] > 0}


def stream_rate_cap(stream: DataFrame, per_minute: int = 60, sample_s: float = 30.0) -> DataFrame:
    """The sequential cap on a stream with ``fingerprint``; ``suppressed_count`` is null where none was held back.

    The counter lives 60 s, the tally 900 s and a sample slot ``sample_s``; each is a state of its own that goes when its life is over.
    """
    out = _sequential(stream.drop("suppressed_count"), "fingerprint", _RateCap(per_minute, sample_s))
    return out.withColumn("suppressed_count", F.nullif("suppressed_count", F.lit(0).cast("long")))


class _Debounce(_Machine):
    parts = {"marker": "start long"}
    columns = {"is_passed": "long"}

    def __init__(self, window_s: float):
        self.rule = Debounce(window_s)

    def step(self, old, us, sizes):
        state = State(0, old["marker"][0], 1, 0) if old else State()
        opens, state = walk(self.rule, state, us, sizes)
        return np.where(opens, 1, -1), {"marker": (state.start, state.start + self.rule.us + 60_000_000)}


def stream_debounce(stream: DataFrame, key: str, window_s: float = 10) -> DataFrame:
    """The first event of a key passes, then the first one after ``window_s`` seconds, and so on; the marker goes after window + 60 s."""
    return _sequential(stream, key, _Debounce(window_s)).drop("is_passed")


class _CountOrTime(_Machine):
    parts = {"window": "number long, start long, rows long, size long"}
    columns = {"window_no": "long"}

    def __init__(self, rule: CountOrTime):
        self.rule = rule

    def step(self, old, us, sizes):
        state = State(*old["window"]) if old else State()
        before = state.number
        opens, state = walk(self.rule, state, us, sizes)
        return before + np.cumsum(opens), {"window": (*state, int(us[-1]) + max(60_000_000, self.rule.us))}


def stream_count_or_time(stream: DataFrame, key: str, max_count: int = 20, max_ms: float = 2000, max_rows: int = 100, max_bytes: int = 1 << 20) -> DataFrame:
    """``window_no`` of each row, by the rules of ``count_or_time_windows``; an idle key's state goes after its window's time, and with it the numbering
    starts anew."""
    size = F.octet_length(F.to_json(F.struct(*stream.columns)))
    return _sequential(stream, key, _CountOrTime(CountOrTime(max_count, max_ms, max_rows, max_bytes)), size)


class _Ticked(CountOrTime):
    """A window ends ``max_ms`` after its first row whether a row comes or not; a row that comes then opens the next one."""

    def after(self, at, start, rows, size, times, sums):
        n = len(times)
        old = np.searchsorted(times, start + self.us)
        heavy = np.maximum(np.searchsorted(sums[1:], sums[at] + self.bytes - size), at) + 1
        found = np.minimum(np.minimum(at + np.maximum(1, self.count - rows), heavy), np.where(old == n, n + 1, np.maximum(old, at + (rows == 0))))
        return np.minimum(found, n + 1)


class _Closings(StatefulProcessor):
    """One row for each window that closes: by a row that makes it full, or by a timer when its time is over."""

    def __init__(self, key: str, rule: _Ticked):
        self.key, self.rule = key, rule

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("window", "number long, start long, rows long, size long")

    def _told(self, key: tuple, closed: list[tuple[int, int, int, int, str]]) -> pd.DataFrame:
        out = pd.DataFrame(closed, columns=["window_no", "opened_at", "closed_at", "rows", "closed_by"])
        out[["opened_at", "closed_at"]] = out[["opened_at", "closed_at"]].apply(lambda c: pd.to_datetime(c, unit="us"))
        return out.assign(**{self.key: key[0]})[[self.key, "window_no", "rows", "opened_at", "closed_at", "closed_by"]]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = [b for b in rows if len(b)]
        if not frames:
            return
        _, us, sizes = _in_order(frames, ["logged_at"])
        state = State(*(self.state.get() or ()))
        opens, after = walk(self.rule, state, us, sizes)
        starts = np.flatnonzero(opens)
        first = [(state.number, state.start, state.rows)] if state.rows else []
        windows = first + [(state.number + 1 + i, int(us[s]), 0) for i, s in enumerate(starts.tolist())]
        ends = [*(starts.tolist() if first else starts.tolist()[1:]), len(us)]
        begins = ([0] if first else []) + starts.tolist()
        closed = []
        for i, ((number, start, held), begin, end) in enumerate(zip(windows, begins, ends, strict=True)):
            if i == len(windows) - 1 and after.rows:
                break  # open
            full = held + end - begin >= self.rule.count or (end > begin and us[end - 1] < start + self.rule.us and self._heavy(state if held else None, sizes[begin:end]))
            closed.append((number, start, int(us[end - 1]) if full else start + self.rule.us, held + end - begin, "rows" if full else "time"))
        if after.rows and after.start + self.rule.us <= timerValues.getCurrentWatermarkInMs() * 1000:
            closed.append((after.number, after.start, after.start + self.rule.us, after.rows, "time"))
            after = State(after.number)
        self.state.update(tuple(after))
        self.handle.registerTimer(-(-(after.start + self.rule.us) // 1000) if after.rows else max(timerValues.getCurrentWatermarkInMs(), int(us[-1]) // 1000) + 60_000)
        if closed:
            yield self._told(key, closed)

    def _heavy(self, state: State | None, sizes: np.ndarray) -> bool:
        return (state.size if state else 0) + int(sizes.sum()) >= self.rule.bytes

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        values, now = self.state.get(), expiredTimerInfo.getExpiryTimeInMs()
        if values is None:
            return
        state = State(*values)
        if not state.rows:
            self.state.clear()  # idle for a minute: the numbering starts anew
        elif state.start + self.rule.us <= now * 1000:
            self.state.update((state.number, 0, 0, 0))
            self.handle.registerTimer(now + 60_000)
            yield self._told(key, [(state.number, state.start, state.start + self.rule.us, state.rows, "time")])

    def close(self) -> None:
        pass


def stream_window_closings(stream: DataFrame, key: str, max_count: int = 20, max_ms: float = 2000, max_rows: int = 100, max_bytes: int = 1 << 20) -> DataFrame:
    """key, window_no, rows, opened_at, closed_at, closed_by (rows, time) of each window that has closed.

    A timer closes an idle window once the watermark is ``max_ms`` past its first row, although no further row of its key comes; a row that does come
    later opens the next one. The key's numbering goes a minute after its last window.
    """
    size = F.octet_length(F.to_json(F.struct(*stream.columns)))
    kind = stream.schema[key].dataType.simpleString()
    return _keyed(stream, key, _Closings(key, _Ticked(max_count, max_ms, max_rows, max_bytes)), f"`{key}` {kind}, window_no long, rows long, opened_at timestamp, closed_at timestamp, closed_by string", size)


SHARES = 4096  # of the keys of counts; a stream keeps the number that it began with


class _Counts(StatefulProcessor):
    """Tells the row with which a key has come ``threshold`` times. Keys are too many for a state each, so those of a share are one: their digests, counts
    and ends of life, packed. A timer at the earliest end takes out all keys whose life is over."""

    def __init__(self, threshold: int, life_s: float):
        self.threshold, self.life = threshold, round(life_s * 1e6)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("runs", "keys binary, counts binary, ends binary, due long")

    def _known(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, int | None]:
        keys, counts, ends, due = self.state.get() or (b"", b"", b"", None)
        return np.frombuffer(keys, np.uint64).reshape(-1, 2), np.frombuffer(counts, np.int64), np.frombuffer(ends, np.int64), due

    def _keep(self, keys: np.ndarray, counts: np.ndarray, ends: np.ndarray, due: int | None) -> None:
        first = int(ends.min())
        if due is None or first < due:
            due = first
            self.handle.registerTimer(due)
        self.state.update((keys.tobytes(), counts.tobytes(), ends.tobytes(), due))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = [b for b in rows if len(b)]
        if not frames:
            return
        keys, counts, ends, due = self._known()
        us, seq = (np.concatenate([b[c].to_numpy() for b in frames]) for c in (OWN[0], "seq"))
        come = np.frombuffer(b"".join(d for b in frames for d in b["run_key"]), np.uint64).reshape(-1, 2)
        both = np.concatenate([keys, come])
        order = np.lexsort((both[:, 1], both[:, 0]))
        first = np.append(True, (both[order][1:] != both[order][:-1]).any(1))
        code = np.empty(len(both), np.int64)
        code[order] = np.cumsum(first) - 1
        n, until = np.zeros((2, int(first.sum())), np.int64)
        n[code[: len(keys)]], until[code[: len(keys)]] = counts, ends
        own = code[len(keys) :]
        by = np.lexsort((seq, us, own))
        begins = np.searchsorted(own[by], np.arange(len(n)))
        hit = np.zeros(len(own), bool)
        hit[by] = n[own[by]] + 1 + np.arange(len(by)) - begins[own[by]] == self.threshold
        np.maximum.at(until, own, np.maximum(-(-(us + self.life) // 1000), timerValues.getCurrentWatermarkInMs() + 1))
        self._keep(both[order[first]], n + np.bincount(own, minlength=len(n)), until, due)
        at = 0
        for b in frames:
            here, at = hit[at : at + len(b)], at + len(b)
            if here.any():
                yield b.drop(columns=[*OWN, "run_key", "share_of_key"])[here].reset_index(drop=True).assign(duplicate_count=self.threshold)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        keys, counts, ends, _ = self._known()
        left = ends > timerValues.getCurrentWatermarkInMs()
        if left.any():
            self._keep(keys[left], counts[left], ends[left], None)
        else:
            self.state.clear()
        yield from ()

    def close(self) -> None:
        pass


def stream_n_plus_one(queries: DataFrame, threshold: int = 5, span_s: float = 600, shares: int = SHARES) -> DataFrame:
    """The ``threshold``-th run of a statement within a span (columns trace_id, span_id, sql, ts, seq); a count goes ``span_s`` after its last run.

    All columns go through Python workers, so select those that are wanted. A share's rows of a micro-batch are held, and its state is written anew with
    each batch that has a row of it.
    """
    rows, statement = queries.withColumnRenamed("ts", "logged_at"), normalize_sql("sql")
    keyed = rows.withColumn("run_key", F.unhex(F.md5(F.concat_ws("|", "trace_id", "span_id", statement).cast("binary"))))
    keyed = keyed.withColumn("share_of_key", F.pmod(F.xxhash64("run_key"), F.lit(shares)).cast("int"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", duplicate_count long"
    found = _keyed(keyed, "share_of_key", _Counts(threshold, span_s), schema)
    return found.select(*(F.col(f"`{c}`").alias("ts" if c == "logged_at" else c) for c in rows.columns), statement.alias("statement"), "duplicate_count")


def stream_idempotent(stream: DataFrame, id_col: str, life: str = "10 minutes") -> DataFrame:
    """Each event id once; ids are remembered for ``life`` of event time behind their row, across batches, then an id may come again. Rows
    without an id all pass."""
    known = stream.where(F.col(id_col).isNotNull()).withWatermark("logged_at", life).dropDuplicatesWithinWatermark([id_col])
    return known.unionByName(stream.where(F.col(id_col).isNull()))


def write_with_reports(stream: DataFrame, path: str, checkpoint: str, now: Callable[[], str], max_age_s: int, recovery: bool = False, retry_max_age_s: int = 600, on_report: Callable[[DataFrame], None] | None = None):
    """Each micro-batch without rows that are too old, with one report row for them, as Parquet in a folder named by the batch.

    A batch that is run again after a failure overwrites its own folder, so every row is there once. ``on_report`` gets the report rows; its
    failures are logged and stop nothing.
    """

    def deliver(batch: DataFrame, batch_id: int) -> None:
        at = now()
        batch = batch.persist()
        kept, tally = drop_stale(batch, at, max_age_s, recovery, retry_max_age_s)
        report = drop_report(tally, at)
        report.unionByName(kept, allowMissingColumns=True).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if on_report:
            try:
                on_report(report)
            except Exception:
                log.exception("report callback failed")
        batch.unpersist()

    return stream.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
