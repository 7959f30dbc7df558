"""Toxicity scores from bags of subwords.

A word is the mean of the embeddings of its character n-grams and of itself, a text window the mean of its words, and a linear softmax
over that mean gives the class; embeddings and softmax are trained jointly in numpy. An unseen misspelling shares most of its n-grams with
a known word, and so its vector. Because all of it is a mean followed by a linear map, each n-gram has one number as its share in the
difference of the two classes; tasks get these numbers and need no other part of the model.

A text counts as its most toxic window of ``WINDOW`` words, so that a long text does not drown a passage. Training alternates: with the
present model each training text picks its window, then the model learns from the picked ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .bpe import LETTER, classes, code_points, span_hashes
from .common import dropped, fold, slices, small_batches, text_or_empty, written

BUCKETS = 1 << 17  # of hashed n-grams
WINDOW = 5  # words; a shorter text is filled up with zeros
NGRAMS = (3, 4, 5)
ROWS_PER_CLASS = 2_500  # labelled rows of each class that a fit takes at most
MIN_TEXTS = 3  # training texts that an n-gram must be in; one that is rarer, or new, counts as zero
FIT_BYTES = 64 << 20  # of the texts of each class that a fit takes at most; rows end before the one that would pass it


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, start and end of each word (run of letters and digits), and the bounds of each text's words."""
    cps, bounds = code_points([t.lower() for t in texts])
    inside = np.zeros(len(cps) + 1, bool)
    inside[:-1] = classes(cps) >= LETTER
    before = np.zeros(len(cps) + 1, bool)
    before[1:] = inside[:-1]
    edge = np.zeros(len(cps) + 1, bool)
    edge[bounds] = True
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    return cps, starts, ends, np.searchsorted(starts, bounds)


def subwords(cps: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For words as spans: the buckets of their n-grams (with a mark at both ends) and of themselves, and how many each word has."""
    size = ends - starts + 2
    bounds = np.concatenate([[0], np.cumsum(size)])
    flat = np.zeros(bounds[-1], np.uint32)
    word = np.repeat(np.arange(len(size)), size)
    k = np.arange(len(flat)) - bounds[word]
    flat[(k > 0) & (k < size[word] - 1)] = cps[np.repeat(starts, ends - starts) + np.arange(int((ends - starts).sum())) - np.repeat(np.cumsum(ends - starts) - (ends - starts), ends - starts)]
    flat[k == 0], flat[k == size[word] - 1] = 1, 2
    found, owner = [span_hashes(flat, bounds[:-1], bounds[1:])], [np.arange(len(size))]
    for n in NGRAMS:
        at = np.flatnonzero(k + n <= size[word])
        found.append(span_hashes(flat, at, at + n))
        owner.append(word[at])
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return (np.concatenate(found)[order] % np.uint64(BUCKETS)).astype(np.int64), np.bincount(owner, minlength=len(size))


class Words:
    """Distinct words of some texts as subword buckets, and each text as a row of their numbers. Texts are taken a few at a time."""

    def __init__(self, texts: list[str]):
        hashes, distinct, buckets, sizes, counts = [], [], [], [], []
        for a, b in slices(texts):
            cps, starts, ends, bounds = words_of(texts[a:b])
            found = span_hashes(cps, starts, ends)
            new, at = np.unique(found, return_index=True)
            sub, size = subwords(cps, starts[at], ends[at])
            hashes.append(found)
            distinct.append(new)
            buckets.append(sub.astype(np.int32))
            sizes.append(size)
            counts.append(np.diff(bounds))
        self.bounds = np.concatenate([[0], *map(np.cumsum, [np.concatenate(counts)] if counts else [])]).astype(np.int64)
        if len(hashes) <= 1:
            self.buckets, self.size = (buckets[0], sizes[0]) if buckets else (np.zeros(0, np.int32), np.zeros(0, np.int64))
            self.kind = np.searchsorted(distinct[0], hashes[0]) if hashes else np.zeros(0, np.int64)
        else:
            known, at = np.unique(np.concatenate(distinct), return_index=True)
            size = np.concatenate(sizes)
            first, self.size = (np.cumsum(size) - size)[at], size[at]
            take = np.repeat(first - (np.cumsum(self.size) - self.size), self.size) + np.arange(int(self.size.sum()))
            self.buckets = np.concatenate(buckets)[take]
            self.kind = np.concatenate([np.searchsorted(known, h).astype(np.int32) for h in hashes])
        self.first = np.cumsum(self.size) - self.size

    def texts_with(self) -> np.ndarray:
        """Of each bucket: how many of the texts have it."""
        out = np.zeros(BUCKETS, np.int64)
        for a, b in zip(self.bounds, self.bounds[1:], strict=False):
            kind = np.unique(self.kind[a:b])
            size = self.size[kind]
            out[np.unique(self.buckets[np.repeat(self.first[kind] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))])] += 1
        return out

    def word_scores(self, share: np.ndarray) -> np.ndarray:
        """Of each word in the texts: the mean of its subwords' shares."""
        if not len(self.size):
            return np.zeros(0)
        return (np.add.reduceat(share[self.buckets], self.first) / self.size)[self.kind]


def best_windows(scores: np.ndarray, bounds: np.ndarray, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Per text: the largest mean over a window, zeros filled up to ``width``, and the first word of that window. 0 for a text with no words."""
    out, where = np.zeros(len(bounds) - 1), bounds[:-1].copy()
    n = np.diff(bounds)
    if not len(scores):
        return out, where
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    last = np.repeat(bounds[1:], n)
    here = np.arange(len(scores))
    value = (sums[np.minimum(here + width, last)] - sums[here]) / width
    # only whole windows, or the first one of a text that is shorter
    value[(here + width > last) & (here != np.repeat(bounds[:-1], n))] = -np.inf
    full = n > 0
    out[full] = np.maximum.reduceat(value, bounds[:-1][full])
    first = np.flatnonzero(value == np.repeat(out, n))
    text = np.repeat(np.arange(len(n)), n)[first]
    where[text[::-1]] = first[::-1]
    return out, where


@dataclass
class Model:
    """``share``: of each bucket in the log-odds; ``slope`` and ``shift``: from a window's mean to the log-odds of its text."""

    share: np.ndarray
    slope: float
    shift: float

    def scores(self, texts: list[str]) -> np.ndarray:
        w = Words(texts)
        best, _ = best_windows(w.word_scores(self.share), w.bounds)
        return 1 / (1 + np.exp(-np.clip(self.slope * best + self.shift, -500, 500)))


def _bags(w: Words, spans: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, weights, bounds) of the instances that hold the words [a, b) of ``spans``; a word weighs 1/``width``."""
    n = spans[:, 1] - spans[:, 0]
    at = np.repeat(spans[:, 0], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    kind = w.kind[at]
    size = w.size[kind]
    sub = np.repeat(w.first[kind], size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    weight = np.repeat(1 / (np.repeat(width, n) * size), size)
    per = np.bincount(np.repeat(np.arange(len(n)), n), size, len(n)).astype(np.int64)
    return w.buckets[sub], weight.astype(np.float32), np.concatenate([[0], np.cumsum(per)])


def fit(texts: list[str], toxic: np.ndarray, prior: float | None = None, dim: int = 8, rounds: int = 8, epochs: int = 2, seed: int = 7) -> Model:
    """Train on whole texts first, then ``rounds`` times on the windows that the texts pick. ``prior``: share of toxic texts among all.

    With no texts, or texts of one class only, the model scores every text with (almost) that class's share.
    """
    y = np.asarray(toxic, np.int64)
    prior = float(np.clip(y.mean() if prior is None and len(y) else prior or 0.0, 1e-4, 1 - 1e-4))
    rng = np.random.default_rng(seed)
    base = np.log(prior / (1 - prior))
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(BUCKETS), 1.0, base)
    table = (rng.standard_normal((BUCKETS, dim)) * 0.1).astype(np.float32)
    soft = (rng.standard_normal((dim, 2)) * 0.1).astype(np.float32)
    bias = np.zeros(2, np.float32)
    g_table, g_soft = np.full((BUCKETS, 1), 1e-8, np.float32), np.full((dim, 2), 1e-8, np.float32)
    w = Words(texts)
    n = np.diff(w.bounds)
    common = (w.texts_with() >= MIN_TEXTS).astype(np.float32)[:, None]
    table *= common

    def learn(spans: np.ndarray, width: np.ndarray, times: int, rate: float) -> None:
        for _ in range(times):
            for part in np.array_split(rng.permutation(len(y)), -(-len(y) // 64)):
                ids, weight, bounds = _bags(w, spans[part], width[part])
                if not len(ids):
                    continue
                row = np.repeat(np.arange(len(part)), np.diff(bounds))
                used, ids = np.unique(ids, return_inverse=True)
                small = table[used]
                hidden = np.stack([np.bincount(row, weight * small[ids, j], len(part)) for j in range(dim)], 1).astype(np.float32)
                logit = hidden @ soft + bias
                p = np.exp(logit - logit.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(len(part)), y[part]] -= 1
                d_soft, d_hidden = hidden.T @ p / len(part), p @ soft.T
                d_small = np.stack([np.bincount(ids, weight * d_hidden[row, j], len(used)) for j in range(dim)], 1).astype(np.float32) / len(part)
                g_table[used] += (d_small**2).mean(1, keepdims=True)
                g_soft[...] += d_soft**2
                table[used] = small - rate * common[used] * d_small / np.sqrt(g_table[used])
                soft[...] -= rate * d_soft / np.sqrt(g_soft)
                bias[...] -= 0.05 * p.mean(0)

    spans = np.stack([w.bounds[:-1], w.bounds[1:]], 1)
    learn(spans, np.maximum(n, WINDOW), 2, 0.1)
    share = lambda: (table @ (soft[:, 1] - soft[:, 0])).astype(np.float64)
    for _ in range(rounds):
        _, where = best_windows(w.word_scores(share()), w.bounds)
        spans = np.stack([where, np.minimum(where + WINDOW, w.bounds[1:])], 1)
        learn(spans, np.full(len(y), WINDOW), epochs, 0.1)
    best, _ = best_windows(w.word_scores(share()), w.bounds)
    slope, shift = _logistic(best, y, prior)
    return Model(share(), slope, shift)


def _logistic(x: np.ndarray, y: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and shift of a logistic curve by Newton steps, classes weighted to ``prior``, with a weak pull towards zero."""
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    scale = max(1e-9, float(np.abs(x).mean()))
    a = np.stack([x / scale, np.ones(len(x))], 1)
    beta = np.array([0.0, np.log(prior / (1 - prior))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -50, 50)))
        grad = a.T @ (weight * (p - y)) + 1e-2 * beta
        hess = (a * (weight * p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1])


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int = ROWS_PER_CLASS, folds: int = 3, held_out: int = 1, fit_bytes: int = FIT_BYTES) -> tuple[list[str], np.ndarray, float]:
    """Texts and labels to train on, at most ``per_class`` rows and ``fit_bytes`` bytes of each class, and the share of toxic ones among all
    labelled rows.

    Only rows whose crc32(id as text) modulo ``folds`` is not ``held_out`` are read. A null label or id is no label; of repeated labels of
    an id the larger one counts, and of rows that share an id the one with the greatest text. Which rows are taken depends on a hash of the
    id alone; they are whole texts of any length, taken in that order until rows or bytes are full. Lengths decide that, so both bounds hold
    before any text moves.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", folds) != held_out)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    found = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(found.values())
    ids = None
    for kind in (0, 1):
        near = int(min(1.0, (1.2 * per_class + 100) / max(1, found.get(kind, 0))) * (1 << 30))  # so that tasks send little more than is taken
        part = known.where((F.col("toxic") == kind) & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < near)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        ids = part if ids is None else ids.unionByName(part)
    ids = ids.select(F.col("doc_id").alias("_id"), "toxic")
    of = lambda chosen: docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))  # noqa: E731  at most ``per_class`` of each class
    sizes = of(ids).groupBy("doc_id", "toxic").agg(F.max(F.octet_length("text").cast("long")).alias("n"))
    so_far = F.sum("n").over(W.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id"))
    within = written(sizes.withColumn("so_far", so_far).where(F.col("so_far") <= fit_bytes).select(F.col("doc_id").alias("_id"), "toxic"), "within")
    taken = of(within).groupBy("doc_id", "toxic").agg(F.max("text").alias("text")).collect()
    dropped(within)
    taken.sort(key=lambda r: r["doc_id"])
    return [r["text"] for r in taken], np.array([r["toxic"] for r in taken], np.int64), found.get(1, 0) / total if total else 0.0


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id and score, from 0 to 1. Null counts as empty and gets the score of a text with no words.

    Whole texts are scored, and the text is all that a score depends on. An empty table gives an empty result.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [shared.value.scores(texts[a:b]) for a, b in slices(texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(found) if found else np.zeros(0))], names=["id", "score"])

    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).mapInArrow(run, f"id {id_type}, score double").withColumnRenamed("id", id_col)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out (crc32(id as text) modulo 3 is 1), score, predicted (1 from ``threshold`` on), one row per row of ``docs``."""
    model = fit(*training_rows(docs, labels))
    return score(docs, model).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, with all their columns.

    Scores are computed once and joined to nothing: the text's score is a column beside it while the rows pass. A null text counts as empty and
    stays null; repeated rows go or stay together; ids are no part of it. An empty table gives an empty one, and with no labels no text is toxic.
    """
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(fit(*training_rows(docs, labels)))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            for a, b in slices(texts, 2_000_000):
                yield batch.slice(a, b - a).filter(pa.array(model.value.scores(texts[a:b]) < threshold))

    names = docs.columns
    return docs.mapInArrow(keep, docs.schema)
