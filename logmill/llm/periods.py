"""Runs of words that repeat with a period, in whole texts.

A run of period q that is at least three periods long holds two neighbouring multiples j of q, counted from the text's first word, at which the
words at j and j + q are equal. So for each q these places are tried, which are n * H(n / 3) in a text of n words (a harmonic sum). Where enough
neighbouring ones agree, a run-length grammar of the words (``recompression``) tells how far the words at j and j + q agree forth and back: that
is the whole run, at once and exactly. Runs that multiples of a period find again have the same start and length and go.

Texts are taken by themselves; nothing is shuffled. A grammar spans the texts of a batch of about ``WORDS`` words, or one longer text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .recompression import Grammar

LEAST, TIMES = 24, 3  # words of a run, and periods
WORDS = 200_000  # of the texts whose grammar is built at once
TRIED = 1 << 20  # places tried at once
find_words = re.compile("[^\x20\x09-\x0d]+").findall


def _groups(values: np.ndarray, bounds: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(place, period, end): neighbouring multiples of a period, from place to below end, with equal words a period on; as many as a run has at least."""
    n = np.diff(bounds)
    periods = np.where(n >= least, n // TIMES, 0)
    text = np.repeat(np.arange(len(n)), periods)
    q = np.arange(1, len(text) + 1) - np.repeat(np.cumsum(periods) - periods, periods)
    tries = (n[text] - 1) // q
    stop = np.cumsum(tries)
    a = 0
    while a < len(q):
        b = max(a + 1, int(np.searchsorted(stop, (stop[a - 1] if a else 0) + TRIED, "right")))
        t = tries[a:b]
        pair = np.repeat(np.arange(a, b), t)
        k = np.arange(len(pair)) - np.repeat(stop[a:b] - t - (stop[a] - t[0]), t)
        at = bounds[text[pair]] + k * q[pair]
        hit = np.flatnonzero(values[at] == values[at + q[pair]])
        owner = pair[hit]
        new = np.flatnonzero(np.append(True, (np.diff(hit) != 1) | (owner[1:] != owner[:-1])) if len(hit) else np.zeros(0, bool))
        size = np.diff(np.append(new, len(hit)))
        period = q[owner[new]]
        full = size >= np.maximum(TIMES - 1, (np.maximum(least, TIMES * period) - period) // period)
        place = at[hit[new[full]]]
        yield place, period[full], place + size[full] * period[full]
        a = b


def runs_of(values: np.ndarray, bounds: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs in sequences of numbers (0 and up) that are joined in ``values``, by start and period."""
    grammar, found = None, []
    for place, period, end in _groups(values, bounds, least):
        while len(place):
            grammar = grammar or Grammar(values, bounds)
            forth, back = grammar.extension(place, place + period), grammar.extension(place, place + period, back=True)
            length = back + forth + period
            whole = length >= np.maximum(least, TIMES * period)
            found.append(np.stack([place - back, length, period])[:, whole])
            place = place + (forth // period + 1) * period  # the next multiple that this run does not hold
            on = place < end
            place, period, end = place[on], period[on], end[on]
    start, length, period = np.concatenate([np.zeros((3, 0), np.int64), *found], axis=1)
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1])) if len(start) else np.zeros(0, bool)
    order = np.flatnonzero(first)[np.lexsort((period[first], start[first]))]
    return start[order], length[order], period[order]


def _numbered(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Words as numbers, equal for equal words, and where each text's words start, with the end."""
    coded = pa.array(chain.from_iterable(texts), pa.string()).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), np.cumsum([0, *map(len, texts)])


def _batches(ids: list, texts: list[str], edit: Callable[[object, list[str]], list[str]] | None) -> Iterator[tuple[int, list[list[str]]]]:
    """(number of the first text, words of some texts), about ``WORDS`` at a time."""
    first, held, size = 0, [], 0
    for k, text in enumerate(texts):
        words = find_words(text)
        held.append(edit(ids[k], words) if edit else words)
        size += len(words)
        if size >= WORDS:
            yield first, held
            first, held, size = k + 1, [], 0
    if held:
        yield first, held


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, edit: Callable[[object, list[str]], list[str]] | None = None) -> DataFrame:
    """One row per row of ``docs``: its id, ``runs`` (start, length, period; by start, then period) and ``collapsed``, the text's words without
    those that a run holds after its first period, with a space between.

    A run is a stretch of words with smallest period q, at least ``least`` words and three periods long, that no neighbouring word extends; runs
    may overlap. Words are runs of characters other than space and the controls U+0009 to U+000D. ``edit`` may change a text's words
    beforehand, by its id. Null counts as empty: no runs, an empty text. Ids may be null or repeat, every row gives its own; an empty table
    gives an empty result. Only the two named columns are read. A text of any length is one task's work and is held there.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    kind = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _batches(batch.column(0).to_pylist() if edit else [], batch.column(1).to_pylist(), edit):
                values, bounds = _numbered(texts)
                start, length, period = runs_of(values, bounds, least)
                gone = np.zeros(len(values) + 1, np.int64)
                np.add.at(gone, start + period, 1)
                np.add.at(gone, start + length, -1)
                kept = np.cumsum(gone)[:-1] == 0
                text = np.searchsorted(bounds, start, "right") - 1
                collapsed = []
                for k, words in enumerate(texts):
                    own = kept[bounds[k] : bounds[k + 1]]
                    collapsed.append(" ".join(words if own.all() else [words[i] for i in np.flatnonzero(own).tolist()]))
                spans = pa.StructArray.from_arrays([pa.array(start - bounds[text]), pa.array(length), pa.array(period)], fields=list(kind))
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), pa.int32()), spans)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), lists, pa.array(collapsed, pa.string())], names=["id", "runs", "collapsed"])

    plain = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    found = plain.mapInArrow(run, f"id {id_type}, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return found.withColumnRenamed("id", id_col)


def strongest(runs: str = "runs") -> Column:
    """Of a row's ``runs`` the one with the greatest length / period, compared as whole numbers; the first of equal ones; null if there are none."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
