"""Scoring texts with a log-bilinear language model.

Tokens are counted over all training texts by Spark. The model's symbols are the most frequent words and, for all other words, classes by
their last two characters; a word of a class gets the class's probability times its own share in the class, so every word, known or not,
has a probability. A symbol is predicted from the two before it: q = R[h1] C1 + R[h2] C2, score = q . T[w] + b[w].

Training is noise-contrastive estimation in numpy. Texts are dealt to shares of about ``SHARE_BYTES`` by a hash of id and text. Each share trains by
itself from common parameters, and the shares' parameters are averaged, weighted by their tokens (first after a small part of the texts, then
after all of them). A share takes its texts in a fixed order, so the model does not depend on how the table's rows lie in files and tasks.
Scoring normalises exactly: for each distinct context a batched matrix product gives all symbols' scores.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import code_points, distinct_spans, equal_spans, span_hashes
from .common import fold, most_frequent, partitions, slices, small_batches, text_or_empty, written

HEAD = 896  # words that are symbols of their own, with the end token
CLASSES = 128  # of all other words
SYMBOLS = HEAD + CLASSES
DIM = 24
TABLE = 1 << 17  # words whose counts tasks hold; all others' counts are joined
LONGEST = 64  # characters of such a word, which bounds their bytes
NOISE = 64  # noise symbols for each minibatch
BATCH = 4096
CHUNKS = 64  # of the parameters, when they are averaged
SHARE_BYTES = 16 << 20  # of the texts that are trained on one after the other
END = "\n"  # no word contains it
WARM = 16  # one text in so many is in the first round of training


@dataclass
class Tokens:
    """Tokens of a few texts: which distinct token each is, hash, span and class of the distinct ones (the last is the end, an empty span)."""

    kind: np.ndarray  # of each token: index into distinct
    distinct: np.ndarray
    spans: np.ndarray
    classes: np.ndarray  # of distinct
    bounds: np.ndarray  # of each text's tokens
    cps: np.ndarray
    text: str

    def words(self, at: np.ndarray) -> pa.Array:
        return pa.array([self.text[s:e] if s < e else END for s, e in self.spans[at].tolist()], pa.string())


def tail_classes(cps: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    last = cps[np.maximum(ends - 1, 0)].astype(np.uint64) if len(cps) else np.zeros(len(ends), np.uint64)
    prior = np.where(ends - starts > 1, cps[np.maximum(ends - 2, 0)] if len(cps) else 0, 0).astype(np.uint64)
    return ((last * np.uint64(0x9E3779B97F4A7C15) + prior * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(40)).astype(np.int64) % CLASSES


def end_hash() -> int:
    return int(span_hashes(np.array([ord(END)], np.uint32), np.array([0]), np.array([1]))[0])


def tokens_of(texts: list[str]) -> Tokens:
    """Words are runs without space, tab and line breaks, A-Z lower-cased; one end token closes each text."""
    cps, bounds = code_points(texts)
    cps = np.where((cps >= 65) & (cps <= 90), cps + np.uint32(32), cps)
    inside = np.zeros(len(cps) + 1, bool)
    inside[:-1] = (cps != 32) & ((cps < 9) | (cps > 13))
    before = np.zeros(len(cps) + 1, bool)
    before[1:] = inside[:-1]
    edge = np.zeros(len(cps) + 1, bool)
    edge[bounds] = True
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    words = np.searchsorted(starts, bounds)
    n = np.diff(words) + 1
    own = np.concatenate([[0], np.cumsum(n)])
    is_end = np.zeros(own[-1], bool)
    is_end[own[1:] - 1] = True
    hashes, at, words_kind = distinct_spans(cps, starts, ends)
    kind = np.full(own[-1], len(hashes), np.int64)
    kind[~is_end] = words_kind
    spans = np.zeros((len(hashes) + 1, 2), np.int64)
    spans[:-1, 0], spans[:-1, 1] = starts[at], ends[at]
    distinct = np.append(hashes, np.uint64(end_hash()))
    return Tokens(kind, distinct, spans, tail_classes(cps, spans[:, 0], spans[:, 1]), own, cps, cps.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass"))


def count_words(docs: DataFrame) -> DataFrame:
    """word, c, class: how often each token occurs in the texts of ``docs`` (column text), over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in slices(texts, 4_000_000):
                t = tokens_of(texts[a:b])
                yield pa.RecordBatch.from_arrays([t.words(np.arange(len(t.distinct))), pa.array(np.bincount(t.kind, minlength=len(t.distinct))), pa.array(t.classes.astype(np.int32))], names=["word", "c", "class"])

    return docs.select("text").mapInArrow(run, "word string, c long, class int").groupBy("word").agg(F.sum("c").alias("c"), F.max("class").alias("class"))


@dataclass
class Vocabulary:
    """Counts that every task holds: of the TABLE most frequent words, of the classes, and in all. Words are by rising hash, no two with
    the same; hashes find a word and characters decide."""

    hashes: np.ndarray
    cps: np.ndarray
    spans: np.ndarray  # of the words in cps, an empty one for the end
    counts: np.ndarray
    symbols: np.ndarray  # of the hashes: below HEAD, or -1 for a word that is only in its class
    class_mass: np.ndarray  # N + 0.5 (V + 1) of each class
    noise: np.ndarray  # share of each symbol in the training tokens
    total: int
    distinct: int

    def find(self, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Of the distinct tokens: count (-1 if it is not in the table) and symbol."""
        at = np.minimum(np.searchsorted(self.hashes, t.distinct), max(0, len(self.hashes) - 1))
        hit = (self.hashes[at] == t.distinct) & equal_spans(t.cps, *t.spans.T, self.cps, *self.spans[at].T) if len(self.hashes) else np.zeros(len(t.distinct), bool)
        count = np.where(hit, self.counts[at], -1) if len(self.hashes) else np.full(len(t.distinct), -1)
        symbol = np.where(hit, self.symbols[at], -1) if len(self.hashes) else np.full(len(t.distinct), -1)
        return count, np.where(symbol >= 0, symbol, HEAD + t.classes)


def vocabulary(counts: DataFrame) -> Vocabulary:
    all_ = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    top = most_frequent(counts.where(F.length("word") <= LONGEST), "c", TABLE).toPandas().sort_values(["c", "word"], ascending=[False, True], ignore_index=True)
    cps, bounds = code_points(list(top["word"]))
    hashes = span_hashes(cps, bounds[:-1], bounds[1:])
    spans = np.stack([bounds[:-1], np.where(top["word"] == END, bounds[:-1], bounds[1:])], 1)
    _, first = np.unique(hashes, return_index=True)  # a word with another one's hash is joined like a rare one
    first.sort()
    top, hashes, spans = top.iloc[first].reset_index(drop=True), hashes[first], spans[first]
    head = set(top["word"][: HEAD - 1]) | {END}
    mass = {r["class"]: (r["n"], r["v"]) for r in counts.where(~F.col("word").isin(list(head))).groupBy("class").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    number = {w: i for i, w in enumerate(sorted(head))}
    symbols = np.array([number.get(w, -1) for w in top["word"]], np.int64)
    order = np.argsort(hashes)
    noise = np.full(SYMBOLS, 0.5)
    np.add.at(noise, symbols[symbols >= 0], top["c"].to_numpy(np.float64)[symbols >= 0])
    class_mass = np.full(CLASSES, 0.5)
    for k, (n, v) in mass.items():
        class_mass[k] = n + 0.5 * (v + 1)
        noise[HEAD + k] += n
    return Vocabulary(hashes[order], cps, spans[order], top["c"].to_numpy(np.int64)[order], symbols[order], class_mass, noise / noise.sum(), all_["n"] or 0, all_["v"])


class LogBilinear:
    """Parameters as one vector of 32-bit floats: R, T (symbols x dim), C1, C2 (dim x dim), b."""

    def __init__(self, vector: np.ndarray):
        sizes = [SYMBOLS * DIM, SYMBOLS * DIM, DIM * DIM, DIM * DIM, SYMBOLS]
        self.vector = vector
        r, t, c1, c2, self.bias = np.split(vector, np.cumsum(sizes)[:-1])
        self.context, self.target, self.c1, self.c2 = r.reshape(SYMBOLS, DIM), t.reshape(SYMBOLS, DIM), c1.reshape(DIM, DIM), c2.reshape(DIM, DIM)

    @classmethod
    def start(cls, noise: np.ndarray, seed: int = 11) -> LogBilinear:
        rng = np.random.default_rng(seed)
        vector = (rng.standard_normal(2 * SYMBOLS * DIM + 2 * DIM * DIM + SYMBOLS) * 0.1).astype(np.float32)
        out = cls(vector)
        out.c1[...] = np.eye(DIM, dtype=np.float32)
        out.c2[...] = np.eye(DIM, dtype=np.float32) * 0.5
        out.bias[...] = np.log(noise)
        return out

    def __post(self) -> None:
        self.table1, self.table2 = self.context @ self.c1, self.context @ self.c2

    def prepare(self) -> LogBilinear:
        self.__post()
        self.log_z = np.full(SYMBOLS * SYMBOLS, np.nan, np.float32)
        return self

    def log10(self, one: np.ndarray, two: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """log10 probability of each symbol after the context (one before it, two before it), normalised over all symbols."""
        code = one * SYMBOLS + two
        new = np.unique(code[np.isnan(self.log_z[code])])
        for part in np.array_split(new, -(-len(new) // 1024)) if len(new) else []:
            logit = (self.table1[part // SYMBOLS] + self.table2[part % SYMBOLS]) @ self.target.T + self.bias
            top = logit.max(1)
            self.log_z[part] = np.log(np.exp(logit - top[:, None]).sum(1)) + top
        out = np.empty(len(symbol))
        for a in range(0, len(symbol), 1 << 16):
            s = slice(a, a + (1 << 16))
            q = self.table1[one[s]] + self.table2[two[s]]
            out[s] = np.einsum("ij,ij->i", q, self.target[symbol[s]]) + self.bias[symbol[s]] - self.log_z[code[s]]
        return out / np.log(10)


class Trainer:
    """Noise-contrastive estimation with steps scaled by past gradients."""

    def __init__(self, model: LogBilinear, noise: np.ndarray, seed: int, rate: float = 0.1):
        self.m, self.rng, self.rate, self.tokens = model, np.random.default_rng(seed), rate, 0
        self.cumulative, self.log_noise = np.cumsum(noise), np.log(NOISE * noise).astype(np.float32)
        self.past = np.full(len(model.vector), 1e-6, np.float32)
        self.grad = LogBilinear(np.zeros_like(model.vector))

    def learn(self, one: np.ndarray, two: np.ndarray, symbol: np.ndarray) -> None:
        order = self.rng.permutation(len(symbol))
        for a in range(0, len(order), BATCH):
            self.step(*(x[order[a : a + BATCH]] for x in (one, two, symbol)))
        self.tokens += len(symbol)

    def step(self, one: np.ndarray, two: np.ndarray, symbol: np.ndarray) -> None:
        m, g, n = self.m, self.grad, len(symbol)
        noise = np.minimum(np.searchsorted(self.cumulative, self.rng.random(NOISE)), SYMBOLS - 1)
        r1, r2 = m.context[one], m.context[two]
        q = r1 @ m.c1 + r2 @ m.c2
        t, tn = m.target[symbol], m.target[noise]
        true = np.einsum("ij,ij->i", q, t) + m.bias[symbol] - self.log_noise[symbol]
        false = q @ tn.T + (m.bias[noise] - self.log_noise[noise])
        d_true = -1 / (1 + np.exp(np.clip(true, -30, 30)))
        np.negative(np.clip(false, -30, 30, out=false), out=false)  # the largest array of a step: its logistic is taken in place
        np.add(np.exp(false, out=false), 1, out=false)
        d_false = np.reciprocal(false, out=false)
        dq = d_true[:, None] * t + d_false @ tn
        g.vector[...] = 0
        self._scatter(g.target, symbol, d_true[:, None] * q)
        np.add.at(g.target, noise, d_false.T @ q)
        g.bias[...] = np.bincount(symbol, d_true, SYMBOLS) + np.bincount(noise, d_false.sum(0), SYMBOLS)
        g.c1[...], g.c2[...] = r1.T @ dq, r2.T @ dq
        self._scatter(g.context, one, dq @ m.c1.T)
        self._scatter(g.context, two, dq @ m.c2.T)
        g.vector /= n
        self.past += g.vector**2
        m.vector -= self.rate * g.vector / np.sqrt(self.past)

    @staticmethod
    def _scatter(into: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
        for j in range(DIM):
            into[:, j] += np.bincount(rows, values[:, j], SYMBOLS)


def contexts(symbols: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols one and two places before each token; before a text's first token stand ends."""
    one, two = np.full(len(symbols), end), np.full(len(symbols), end)
    one[1:], two[2:] = symbols[:-1], symbols[:-2]
    one[bounds[:-1]] = end
    two[bounds[:-1]] = end
    second = bounds[:-1] + 1
    two[second[second < bounds[1:]]] = end
    return one, two


def _end_symbol(v: Vocabulary) -> int:
    at = np.flatnonzero(v.hashes == np.uint64(end_hash()))
    return int(v.symbols[at[0]]) if len(at) and v.symbols[at[0]] >= 0 else 0


def in_shares(texts: DataFrame) -> DataFrame:
    """share, text of ``texts`` (id, text), a share's texts together and in a fixed order. The number of shares follows from the texts' bytes."""
    size = texts.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0
    shares = size // SHARE_BYTES + 1
    dealt = texts.select("id", "text", F.xxhash64("id", "text").alias("at")).withColumn("share", F.pmod("at", F.lit(shares)))
    return dealt.repartition(min(shares, 20 * partitions(texts.sparkSession)), "share").sortWithinPartitions("share", "at", "text").select("share", "text")


def train_round(docs: DataFrame, shared: Broadcast, start: np.ndarray) -> np.ndarray:
    """One pass over the shares of ``docs`` (share, text): each trains from ``start``; the average of what they end with."""
    spark = docs.sparkSession
    begin = spark.sparkContext.broadcast(start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = shared.value
        end = _end_symbol(v)
        for share, texts in groupby(((s, t) for batch in batches for s, t in zip(*(c.to_pylist() for c in batch.columns), strict=True)), itemgetter(0)):
            trainer = Trainer(LogBilinear(begin.value.copy()), v.noise, share)
            for some in _runs(t for _, t in texts):
                t = tokens_of(some)
                symbols = v.find(t)[1][t.kind]
                trainer.learn(*contexts(symbols, t.bounds, end), symbols)
            parts = np.array_split(trainer.m.vector, CHUNKS)
            yield pa.RecordBatch.from_arrays([pa.array(range(CHUNKS), pa.int32()), pa.array([trainer.tokens] * CHUNKS, pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["chunk", "n", "part"])

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        weight: dict[int, int] = {}
        for batch in batches:
            for k, n, part in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(part, np.float32).astype(np.float64) * n
                weight[k] = weight.get(k, 0) + n
        keys = sorted(sums)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([weight[k] for k in keys], pa.int64()), pa.array([(sums[k] / weight[k]).astype(np.float32).tobytes() for k in keys], pa.binary())], names=["chunk", "n", "part"])

    schema = "chunk int, n long, part binary"
    rows = docs.select("share", "text").mapInArrow(run, schema).repartition(min(CHUNKS, partitions(spark)), "chunk").mapInArrow(average, schema).collect()  # one row a chunk
    if not rows:
        return start
    return np.concatenate([np.frombuffer(r["part"], np.float32) for r in sorted(rows, key=lambda r: r["chunk"])])


def _runs(texts: Iterator[str], limit: int = 2_000_000) -> Iterator[list[str]]:
    """Lists of about ``limit`` characters, one text at least, however batches fall."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


_prepared: dict[str, LogBilinear] = {}


def train(texts: DataFrame) -> tuple[DataFrame, Vocabulary, np.ndarray]:
    """Counts of all words of ``texts`` (id, text), what tasks hold of them, and the parameters of a model trained on all texts."""
    small_batches(texts.sparkSession)
    counts = written(count_words(texts), "counts")
    v = vocabulary(counts)
    shared = texts.sparkSession.sparkContext.broadcast(v)
    vector = LogBilinear.start(v.noise).vector
    vector = train_round(in_shares(texts.where(F.pmod(F.xxhash64("id", "text", F.lit(WARM)), F.lit(WARM)) == 0)), shared, vector)
    return counts, v, train_round(in_shares(texts), shared, vector)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_out: int = 1) -> DataFrame:
    """One row per row of ``docs``: its id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learning is from the rows whose crc32(id as text) modulo ``folds`` is not ``held_out``; a null id counts as the empty text there. A
    null text counts as empty, which is one end token. Equal rows each give their own. With no training rows, counts are 0 and the model
    is the starting one. An empty table gives an empty result. The same rows give the same model, but for the last bits of its averages, however
    they are dealt to files and tasks. Rows with equal id and text are of one share.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"), (fold(id_col, folds) == held_out).alias("held_out"))
    return score_with(rows, *train(rows.where(~F.col("held_out")))).withColumnRenamed("id", id_col)


def score_with(rows: DataFrame, counts: DataFrame, v: Vocabulary, vector: np.ndarray) -> DataFrame:
    """``score_texts`` of ``rows`` (id, text, held_out) with what ``train`` gave."""
    spark = rows.sparkSession
    shared, final, name = spark.sparkContext.broadcast(v), spark.sparkContext.broadcast(vector), uuid.uuid4().hex
    schema = f"row long, id {rows.schema["id"].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, base double, model double, words array<string>, freqs array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = shared.value
        end = _end_symbol(v)
        if name not in _prepared:  # normalisers found for one task serve the worker's next ones
            _prepared.clear()
            _prepared[name] = LogBilinear(final.value.copy()).prepare()
        model = _prepared[name]
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts, 2_000_000):
                t = tokens_of(texts[a:b])
                count, symbol = v.find(t)
                symbols, counts_ = symbol[t.kind], count[t.kind]
                text = np.repeat(np.arange(b - a), np.diff(t.bounds))
                found = counts_ >= 0
                log_c = np.where(found, np.log10(np.maximum(counts_, 0) + 0.5), 0.0)
                tail = symbols >= HEAD
                p = model.log10(*contexts(symbols, t.bounds, end), symbols)
                p += np.where(tail, log_c - np.log10(v.class_mass[np.maximum(symbols - HEAD, 0)]), 0.0)
                pair, freq = np.unique(text[~found] * max(1, len(t.distinct)) + t.kind[~found], return_counts=True)
                owner, kind = pair // max(1, len(t.distinct)), pair % max(1, len(t.distinct))
                used, place = np.unique(kind, return_inverse=True)
                offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=b - a))]), pa.int32())
                total = lambda x: pa.array(np.bincount(text, x, b - a))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row + np.arange(b - a)), batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(np.diff(t.bounds)),
                        pa.array(np.bincount(text, counts_ > 0, b - a).astype(np.int64)), total(log_c), total(p),
                        pa.ListArray.from_arrays(offsets, t.words(used).take(pa.array(place))), pa.ListArray.from_arrays(offsets, pa.array(freq.astype(np.int32))),
                    ],
                    names=["row", "id", "held_out", "n_tokens", "n_known", "base", "model", "words", "freqs"],
                )
                row += b - a

    scored = rows.select("id", "text", "held_out").mapInArrow(run, schema)
    once = lambda c: F.when(F.coalesce(F.col("pos"), F.lit(0)) == 0, F.col(c)).alias(c)
    kept = ["id", "held_out", "n_tokens", "n_known", "base", "model"]
    apart = scored.select("row", *kept, F.posexplode_outer(F.arrays_zip("words", "freqs")).alias("pos", "x"))
    apart = apart.select("row", *map(once, kept), F.coalesce(F.col("x.freqs"), F.lit(0)).alias("freq"), F.coalesce(F.col("x.words"), F.concat(F.lit("\n\n"), F.col("row").cast("string"))).alias("w"))
    rare = counts.select(F.col("word").alias("w"), "c")
    met = apart.join(rare, "w", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    add = F.sum(F.col("freq") * F.log10(F.col("c") + 0.5))
    out = met.groupBy("row").agg(
        F.max("id").alias("id"),
        F.max("held_out").alias("held_out"),
        F.max("n_tokens").alias("n_tokens"),
        (F.max("n_known") + F.sum(F.when(F.col("c") > 0, F.col("freq")).otherwise(0))).alias("n_known"),
        (F.max("base") + add).alias("base"),
        (F.max("model") + add).alias("score"),
    )
    share = float(np.log10(v.total + 0.5 * (v.distinct + 1)))
    return out.select("id", "held_out", "n_tokens", "n_known", F.lit(v.total).cast("long").alias("train_tokens"), (F.col("base") - F.col("n_tokens") * share).alias("base_score"), "score")
