"""Windows along the rows of a key: rules against the rows one by one, and keys cut into ranges."""

from __future__ import annotations

import datetime
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logmill.operators import dedup, sequences
from logmill.sources import chunk_by_bytes

T0 = datetime.datetime(2024, 1, 1)


def slowly(rule, rows):
    """Which of (microsecond, size) rows open a window."""
    out, start, n, size = [], None, 0, 0
    for t, s in rows:
        if isinstance(rule, sequences.Debounce):
            opens = start is None or t >= start + rule.us
        elif isinstance(rule, sequences.Flagged):
            opens = n == 0 or s == 1
        elif isinstance(rule, sequences.Chunks):
            opens = n == 0 or size + s > rule.bytes
        else:
            opens = n == 0
        if opens:
            start, n, size = t, 0, 0
        n, size = n + 1, size + s
        if isinstance(rule, sequences.CountOrTime) and (n >= rule.count or t - start >= rule.us or size >= rule.bytes):
            n = 0
        out.append(opens)
    return out


RULES = st.one_of(
    st.builds(sequences.Debounce, st.integers(1, 400)), st.builds(sequences.Chunks, st.integers(1, 60)), st.builds(sequences.Flagged),
    st.builds(sequences.CountOrTime, st.integers(1, 6), st.integers(1, 400_000), st.integers(1, 6), st.integers(1, 60)),
)


@settings(max_examples=400, deadline=None)
@given(RULES, st.lists(st.tuples(st.integers(0, 1500), st.integers(0, 30)), max_size=50), st.lists(st.integers(0, 50), max_size=4))
def test_rules_over_pieces(rule, rows, cuts):
    """Walked in pieces cut anywhere, and by maps of the pieces, as row by row."""
    rows = sorted((t * 1_000_000, s) for t, s in rows)
    rows = [(t, s % 2) for t, s in rows] if isinstance(rule, sequences.Flagged) else rows
    want = slowly(rule, rows)
    bounds = [0, *sorted(min(c, len(rows)) for c in cuts), len(rows)]
    state = mapped = sequences.State()
    got = []
    for a, b in zip(bounds, bounds[1:], strict=False):
        times, sizes = (np.array([r[i] for r in rows[a:b]], np.int64) for i in (0, 1))
        if b > a:
            mapped = sequences.through(rule, mapped, sequences.piece(rule, times, sizes))
        opens, state = sequences.walk(rule, state, times, sizes)
        got += opens.tolist()
        assert mapped == state
    assert got == want


def hot_rows(spark):
    rnd = random.Random(3)
    rows = [(i, "hot" if i % 5 else f"k{i % 3}" if i % 2 else None, T0 + datetime.timedelta(seconds=rnd.randrange(4000)), "m" * rnd.randrange(40)) for i in range(3000)]
    return spark.createDataFrame(rows, "seq long, user_id string, logged_at timestamp, message string").repartition(4)


@pytest.mark.parametrize("heads", [10**6, 0])
def test_a_hot_key_is_cut_into_ranges(spark, monkeypatch, heads):
    df = hot_rows(spark)
    makers = {
        "debounce": lambda: dedup.debounce(df, "user_id", 20).select("seq"),
        "windows": lambda: dedup.count_or_time_windows(df, "user_id", 7, 15_000, max_bytes=400).select("seq", "window_no"),
        "cap": lambda: dedup.rate_cap(df.selectExpr("*", "300 as level", "user_id as fingerprint"), 3, 15).select("seq", "suppressed_count"),
        "long cap": lambda: dedup.rate_cap(df.selectExpr("*", "300 as level", "user_id as fingerprint"), 1, 2000).select("seq", "suppressed_count"),
        "chunks": lambda: chunk_by_bytes(df, 900, "user_id", ["logged_at", "seq"]).select("seq", "chunk_no"),
    }
    plain = {n: sorted(map(tuple, f().collect())) for n, f in makers.items()}
    monkeypatch.setattr(sequences, "HOT", 500)
    monkeypatch.setattr(sequences, "HEADS", heads)  # with none, keys are walked uncut
    ranges, real = [], sequences.through
    monkeypatch.setattr(sequences, "through", lambda *x: ranges.append(1) or real(*x))
    for name, f in makers.items():
        ranges.clear()
        assert sorted(map(tuple, f().collect())) == plain[name], name
        assert (len(ranges) >= 4) == bool(heads)  # as many as there are tasks


def test_ceiling_of_windows(spark):
    df = spark.range(250).selectExpr("id as seq", "'u' as user_id", "timestamp '2024-01-01' as logged_at", "repeat('x', 10) as message")
    sizes = lambda **k: sorted(r["count"] for r in dedup.count_or_time_windows(df, "user_id", 10**6, 10**9, **k).groupBy("window_no").count().collect())
    assert sizes() == [50, 100, 100]
    assert sizes(max_bytes=1)[-1] == 1 and sizes(max_rows=7)[-1] == 7
