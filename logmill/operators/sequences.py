"""Windows that follow each other along the rows of a key: where one opens depends on where the last one did.

A rule tells from a window's first row, or from what an open window holds already, which row opens the next one. So a piece of a key's rows is a
map from the window that is open when it begins to the one that is open when it ends, and only its first rows, those that an open window may still
take, matter for that map. A key with many rows is cut into ranges; each is summarised by its map in a task of its own, the maps are composed
in order, a few numbers a range, and then every range is walked from its own entry. Other keys are walked as they are, streaming through
their task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import scratch_path

HOT = 1_000_000  # rows of a key; one with more is cut into ranges
HEADS = 4_000_000  # first rows of ranges, over all ranges, that are composed; with more, keys are walked uncut


class State(NamedTuple):
    """Windows opened so far, and of the open one, if any (``rows`` > 0): time of its first row in microseconds, its rows and bytes."""

    number: int = 0
    start: int = 0
    rows: int = 0
    size: int = 0


class Rule:
    """``after``: of windows that opened at the time ``start``, hold ``rows`` rows and ``size`` bytes and go on with row ``at``, the row that opens the next
    window; n (their number) if the last row closes them, n + 1 if they stay open. ``times`` rise; ``sums`` are sums of sizes before each row."""

    def after(self, at: np.ndarray, start: np.ndarray, rows: np.ndarray, size: np.ndarray, times: np.ndarray, sums: np.ndarray) -> np.ndarray:
        raise NotImplementedError


class Debounce(Rule):
    """The first row at ``window_s`` or more after the last opening opens anew."""

    def __init__(self, window_s: float):
        self.us = round(window_s * 1e6)

    def after(self, at, start, rows, size, times, sums):
        found = np.searchsorted(times, start + self.us)
        return np.where(found == len(times), len(times) + 1, np.maximum(found, at + (rows == 0)))


class CountOrTime(Rule):
    """The row that makes a window full, or finds it old, closes it and belongs to it. The ceiling of ``max_rows`` and ``max_bytes`` holds for any count."""

    def __init__(self, max_count: int = 20, max_ms: float = 2000, max_rows: int = 100, max_bytes: int = 1 << 20):
        self.count, self.us, self.bytes = max(1, min(max_count, max_rows)), round(max_ms * 1000), max_bytes

    def after(self, at, start, rows, size, times, sums):
        n = len(times)
        full = at + np.maximum(1, self.count - rows)
        old = np.maximum(np.searchsorted(times, start + self.us), at) + 1
        heavy = np.maximum(np.searchsorted(sums[1:], sums[at] + self.bytes - size), at) + 1
        return np.minimum(np.minimum(full, np.minimum(old, heavy)), n + 1)


class Chunks(Rule):
    """A row that would take a window over ``max_bytes`` opens the next one; a larger row is alone."""

    def __init__(self, max_bytes: int):
        self.bytes = max_bytes

    def after(self, at, start, rows, size, times, sums):
        found = np.searchsorted(sums, sums[at] + self.bytes - size, "right") - 1
        return np.where(found >= len(times), len(times) + 1, np.maximum(found, at + (rows == 0)))


class Flagged(Rule):
    """Every row of size 1 opens a window, and so does a key's first row."""

    def after(self, at, start, rows, size, times, sums):
        found = np.searchsorted(sums, sums[np.minimum(at + (rows == 0), len(times))] + 1) - 1
        return np.where(found >= len(times), len(times) + 1, found)


def _numbers(*values: int) -> tuple[np.ndarray, ...]:
    return tuple(np.array([v], np.int64) for v in values)


def walk(rule: Rule, state: State, times: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, State]:
    """(whether each row opens a window, the state behind the last row)."""
    n, sums = len(times), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    opens = np.zeros(n, bool)
    if not n:
        return opens, state
    every, zero = np.arange(n), np.zeros(n, np.int64)
    following = rule.after(every, times, zero, zero, times, sums).tolist()
    at = int(rule.after(*_numbers(0, state.start, state.rows, state.size), times, sums)[0]) if state.rows else 0
    last, starts = None, []
    while at < n:
        starts.append(at)
        last, at = at, following[at]
    opens[starts] = True
    number = state.number + len(starts)
    if at == n:
        return opens, State(number)
    if last is None:
        return opens, State(number, state.start, state.rows + n, state.size + int(sums[-1]))
    return opens, State(number, int(times[last]), n - last, int(sums[-1] - sums[last]))


class Piece(NamedTuple):
    """A range of a key's rows: their number and bytes, the first rows (time and size), and for a window that opens at each of these the state behind the
    last row; ``rows`` is -1 where no window is open then."""

    n: int
    size: int
    times: np.ndarray
    sizes: np.ndarray
    exits: np.ndarray


def piece(rule: Rule, times: np.ndarray, sizes: np.ndarray) -> Piece:
    """The map of a range. Its first rows are those up to the first that no window open before it can take."""
    n, sums = len(times), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    every, zero = np.arange(n), np.zeros(n, np.int64)
    following = rule.after(every, times, zero, zero, times, sums)
    head = int(min(n, rule.after(*_numbers(0, times[0], 1, 0), times, sums)[0] + 1))  # a window cannot be younger than one that opens just before
    nxt, end, many = following.tolist(), [0] * n, [0] * n
    for r in range(n - 1, -1, -1):
        if nxt[r] < n:
            end[r], many[r] = end[nxt[r]], many[nxt[r]] + 1
        else:
            end[r], many[r] = r, 1
    last, count = np.array(end), np.array(many)
    closed = following[last] == n
    exits = np.stack([count, times[last], np.where(closed, -1, n - last), sums[-1] - sums[last]])[:, :head]
    return Piece(n, int(sums[-1]), times[:head], sizes[:head], exits)


def through(rule: Rule, state: State, p: Piece) -> State:
    """The state behind a range that is entered with ``state``."""
    at = 0
    if state.rows:
        sums = np.concatenate([[0], np.cumsum(p.sizes)]).astype(np.int64)
        at = int(rule.after(*_numbers(0, state.start, state.rows, state.size), p.times, sums)[0])
        if at >= len(p.times):
            whole = len(p.times) == p.n
            if not whole:
                raise ValueError("a window reaches beyond the first rows of a range")
            return State(state.number) if at == p.n else State(state.number, state.start, state.rows + p.n, state.size + p.size)
    opened, start, rows, size = p.exits[:, at].tolist()
    return State(state.number + opened) if rows < 0 else State(state.number + opened, start, rows, size)


def _segments(column: pa.Array, *more: np.ndarray) -> Iterator[tuple[object, int, int]]:
    """(value, first, end) of stretches of equal values, which also end where a number of ``more`` changes."""
    coded = column.dictionary_encode(null_encoding="encode")
    number = coded.indices.to_numpy()
    new = number[1:] != number[:-1]
    for m in more:
        new = new | (m[1:] != m[:-1])
    cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(number)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield coded.dictionary[int(number[a])].as_py(), a, b


def sequential(df: DataFrame, key: str, order: Sequence[str], rule: Rule, time: Column | None = None, size: Column | None = None, dealt: bool = False) -> DataFrame:
    """``df`` with ``_opens`` (whether a row opens a window of its key), ``_number`` (of its window, from 1) and ``_start`` (microsecond of the window's first
    row), rows of a key by ``order``.

    ``time``: microseconds (null counts as 0), which must rise by ``order``; ``size``: bytes. With ``dealt`` rows stay in their tasks, each of which is a
    sequence.
    """
    names = df.columns
    rows = df.withColumns({"_us": F.coalesce(time, F.lit(0)).cast("long") if time is not None else F.lit(0).cast("long"), "_size": size.cast("long") if size is not None else F.lit(0).cast("long")})
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + ", `_opens` boolean, `_number` long, `_start` long"

    def walked(entries: Callable[[], dict]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, last, state = entries(), object(), State()
            for batch in batches:
                if not batch.num_rows:
                    continue
                place = batch.column("_range").to_numpy() if "_range" in batch.schema.names else np.zeros(batch.num_rows, np.int64)
                times, sizes = batch.column("_us").to_numpy(), batch.column("_size").to_numpy()
                opens, number, start = np.empty(len(times), bool), np.empty(len(times), np.int64), np.empty(len(times), np.int64)
                for k, a, b in _segments(batch.column(key), place):
                    if (k, int(place[a])) != last:
                        last = k, int(place[a])
                        state = known.get(last, State())
                    before = state
                    opens[a:b], state = walk(rule, state, times[a:b], sizes[a:b])
                    number[a:b] = before.number + np.cumsum(opens[a:b])
                    first = np.maximum.accumulate(np.where(opens[a:b], np.arange(b - a), -1))
                    start[a:b] = np.where(first < 0, before.start, times[a:b][np.maximum(first, 0)])
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(opens), pa.array(number), pa.array(start)], names=[*names, "_opens", "_number", "_start"])

        return run

    if dealt:
        return rows.sortWithinPartitions(key, *order).mapInArrow(walked(dict), kinds)
    plain = lambda part: part.repartition(key).sortWithinPartitions(key, *order).mapInArrow(walked(dict), kinds)
    hot = df.groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT).select("_hot")
    if hot.isEmpty():
        return plain(rows)
    spark = df.sparkSession
    one = F.col(key).eqNullSafe(F.col("_hot"))  # at most a key in ``HOT`` rows
    path, tasks = scratch_path(spark, "ranges"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.join(F.broadcast(hot), one, "left_semi").repartitionByRange(tasks, key, *order).withColumn("_range", F.spark_partition_id().cast("long")).write.parquet(path)
    ranged = spark.read.parquet(path)
    in_order = lambda part: part.repartition(tasks, "_range").sortWithinPartitions("_range", key, *order)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[object, int, np.ndarray, np.ndarray]] = []

        def sent() -> pa.RecordBatch:
            p = piece(rule, *(np.concatenate([h[i] for h in held]) for i in (2, 3)))
            data = [[held[0][0]], [held[0][1]], [p.n], [p.size], [p.times.tobytes()], [p.sizes.tobytes()], [np.ascontiguousarray(p.exits).tobytes()]]
            types = [key_type, pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(data, types, strict=True)], names=["key", "range", "n", "size", "times", "sizes", "exits"])

        key_type = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key_type = batch.column(key).type
            place, times, sizes = (batch.column(c).to_numpy() for c in ("_range", "_us", "_size"))
            for k, a, b in _segments(batch.column(key), place):
                if held and (k, int(place[a])) != held[0][:2]:
                    yield sent()
                    held.clear()
                held.append((k, int(place[a]), times[a:b], sizes[a:b]))
        if held:
            yield sent()

    narrow = ranged.select(*dict.fromkeys([key, *order]), "_range", "_us", "_size")
    summary = scratch_path(spark, "pieces")
    in_order(narrow).mapInArrow(told, f"key {df.schema[key].dataType.simpleString()}, range long, n long, size long, times binary, sizes binary, exits binary").write.parquet(summary)
    pieces = spark.read.parquet(summary)
    if (pieces.agg(F.sum(F.octet_length("times")).alias("b")).first()["b"] or 0) > 8 * HEADS:
        return plain(rows)
    entries, states = {}, {}
    for r in sorted(pieces.collect(), key=lambda r: r["range"]):  # a row a range and key
        state = states.get(r["key"], State())
        entries[r["key"], r["range"]] = state
        times, sizes, exits = (np.frombuffer(r[c], np.int64) for c in ("times", "sizes", "exits"))
        states[r["key"]] = through(rule, state, Piece(r["n"], r["size"], times, sizes, exits.reshape(4, -1)))
    shared = spark.sparkContext.broadcast(entries)
    return plain(rows.join(F.broadcast(hot), one, "left_anti")).unionByName(in_order(ranged).mapInArrow(walked(lambda: shared.value), kinds))
