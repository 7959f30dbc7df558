"""Run-length grammars by recompression, with longest common extensions.

A sequence shrinks level by level: runs of one symbol become one symbol each (block compression); then symbols are dealt to two sides, and
every pair of a left one followed by a right one becomes one symbol (pair compression). Equal pieces get equal symbols, wherever they stand,
and whether two neighbours are joined depends on these two alone (a run: on where it ends). So equal substrings are parsed alike but for a
symbol at each end of a level.

An extension of two places therefore climbs: at each level one step brings both to the start of a symbol of the next level, as long as symbols
agree. At the first that differ it goes down again, with at most two steps a level. All queries of an array are taken together.
"""

from __future__ import annotations

import numpy as np

MIX = 0x9E3779B97F4A7C15


def _named(first: np.ndarray, second: np.ndarray, base: int) -> np.ndarray:
    """A number from ``base`` on for each distinct (first, second)."""
    _, name = np.unique(first.astype(np.int64) << 32 | second.astype(np.int64), return_inverse=True)
    return name + base


class Level:
    """Symbols of a level. ``start``: where the k-th one begins in the level below, with one entry more than symbols; ``runs``: whether it was
    made by block compression."""

    def __init__(self, symbol: np.ndarray, start: np.ndarray, runs: bool = False):
        self.symbol, self.start, self.runs = symbol, start, runs
        self.parent: np.ndarray | None = None  # set by the level above


class Grammar:
    """Of several sequences of small integers (0 and up), joined in ``values``; ``bounds`` says where they start, with the end. A mark between
    neighbours, other for each, takes part in no pair and no run; so nothing extends beyond a sequence."""

    def __init__(self, values: np.ndarray, bounds: np.ndarray):
        n, k = len(values), len(bounds) - 1
        self.shift = np.repeat(np.arange(1, k + 1), np.diff(bounds))  # marks before each value; one stands before the first sequence too
        symbol = np.empty(n + k + 1, np.int64)
        self.at = np.arange(n) + self.shift  # of the values among symbols
        marks = np.append(bounds[:-1] + np.arange(k), n + k)
        symbol[self.at] = values
        base = int(values.max(initial=-1)) + 1
        symbol[marks] = base + np.arange(k + 1)
        self.levels = [Level(symbol, np.arange(n + k + 2))]
        is_mark = np.zeros(n + k + 1, bool)
        is_mark[marks] = True
        turn, filled = 0, int((np.diff(bounds) > 0).sum())
        while len(symbol) > k + 1 + filled:  # more than one symbol somewhere; in each turn a quarter of all neighbours is expected to be joined
            symbol, is_mark = self._blocks(symbol, is_mark)
            symbol, is_mark = self._pairs(symbol, is_mark, turn)
            turn += 1

    def _above(self, symbol: np.ndarray, starts: np.ndarray, runs: bool) -> np.ndarray:
        below = self.levels[-1]
        first = np.zeros(len(below.symbol), np.int64)
        first[starts[1:]] = 1
        below.parent = np.cumsum(first)
        self.levels.append(Level(symbol, np.append(starts, len(first)), runs))
        return symbol

    def _blocks(self, symbol: np.ndarray, is_mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1]))
        if len(starts) == len(symbol):
            return symbol, is_mark
        length = np.diff(np.append(starts, len(symbol)))
        out = symbol[starts].copy()
        many = length > 1
        out[many] = _named(out[many], length[many], int(symbol.max()) + 1)
        return self._above(out, starts, True), is_mark[starts]

    def _pairs(self, symbol: np.ndarray, is_mark: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
        h = (symbol.astype(np.uint64) + np.uint64(turn + 1)) * np.uint64(MIX)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        left = (h >> np.uint64(63)).astype(bool)
        both = ~is_mark[1:] & ~is_mark[:-1]
        one, other = both & left[:-1] & ~left[1:], both & ~left[:-1] & left[1:]
        joins = one if one.sum() >= other.sum() else other  # the k-th symbol with the next; never two in a row
        at = np.flatnonzero(joins)
        if not len(at):
            return symbol, is_mark
        first = np.ones(len(symbol), bool)
        first[at + 1] = False
        starts = np.flatnonzero(first)
        out, place = symbol[starts].copy(), np.cumsum(first)[at] - 1
        out[place] = _named(symbol[at], symbol[at + 1], int(symbol.max()) + 1)
        return self._above(out, starts, False), is_mark[starts]

    def extension(self, a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
        """How many values from places ``a`` and ``b`` on agree; with ``back`` how many before them. ``a`` and ``b`` differ."""
        x, y = self.at[np.minimum(a, len(self.at) - 1)] if not back else self.at[a] - 1, self.at[np.minimum(b, len(self.at) - 1)] if not back else self.at[b] - 1
        return _extended(self.levels, x, y, back)


def _extended(levels: list[Level], x: np.ndarray, y: np.ndarray, back: bool) -> np.ndarray:
    """Symbols of the lowest level that agree from x and y on, in one direction. Going back, a symbol's end is what its start is going forth."""
    step = -1 if back else 1
    origin = x.copy()
    out = np.zeros(len(x), np.int64)
    halted = np.full(len(x), len(levels) - 1)  # the level at which a query met symbols that differ
    live, top = np.arange(len(x)), len(levels) - 1
    x, y = x.copy(), y.copy()
    for k in range(top):
        level, above = levels[k], levels[k + 1]
        edge = (lambda at, p, s=above.start: s[p + 1] - 1 == at) if back else (lambda at, p, s=above.start: s[p] == at)
        while True:  # until both stand at an edge of the level above, or differ
            i, j = x[live], y[live]
            same = level.symbol[i] == level.symbol[j]
            halted[live[~same]] = k
            live, i, j = live[same], i[same], j[same]
            p, q = level.parent[i], level.parent[j]
            inside = ~(edge(i, p) & edge(j, q))
            if not inside.any():
                x[live], y[live] = p, q
                break
            u, i, j, p, q = live[inside], i[inside], j[inside], p[inside], q[inside]
            go = 1  # out of a pair; out of runs by what is left of the shorter one
            if above.runs:
                go = np.minimum(i - above.start[p], j - above.start[q]) + 1 if back else np.minimum(above.start[p + 1] - i, above.start[q + 1] - j)
            x[u] += go * step
            y[u] += go * step
        if not len(live):
            break
    else:
        level = levels[top]
        while len(live):
            same = level.symbol[x[live]] == level.symbol[y[live]]
            live = live[same]
            x[live] += step
            y[live] += step
    for k in range(top, 0, -1):
        level, below = levels[k], levels[k - 1]
        down = np.flatnonzero(halted >= k)
        if not len(down):
            continue
        a, b = x[down], y[down]
        i, j = (level.start[a + 1] - 1, level.start[b + 1] - 1) if back else (level.start[a], level.start[b])
        # of two runs of one symbol the shorter one is common to both; of two symbols that share a part, the next parts differ
        common = np.minimum(level.start[a + 1] - level.start[a], level.start[b + 1] - level.start[b]) if level.runs else 1
        go = np.where(below.symbol[i] == below.symbol[j], common, 0) * step
        x[down], y[down] = i + go, j + go
    out[:] = np.abs(x - origin)
    return out
