"""Alignment of two tokenizers' tokens by the bytes they cover, with corpus-wide counts of the pairs that meet.

A text's tokens of a byte-level BPE (A) and of a sentencepiece model (B) cover the same bytes. Places where tokens of both end cut them into
groups; between any two neighbouring ends one A and one B token overlap, which is a link. How often a pair of ids is linked in all texts is
counted externally:

1. A task takes texts for a run of about ``RUN`` characters. The run's links are summed to pair-document records, and these to one count a pair.
   Pairs are dealt to radix partitions by a hash and sorted B-major in each. Records and counts are compressed (zstd) and written; a text is
   tokenized once.
2. A radix partition gets the runs' counts of its pairs. A k-way heap merge, in passes of at most ``FAN_IN`` runs, adds up equal pairs. As they
   come B-major, the maximum of each B id within the partition comes with them. The totals go back to the runs they came from.
3. A run's pair-document records take up the totals, and with the maxima of all partitions (at most one a B id, a bound set by the vocabulary,
   so they are broadcast) give their documents' sums.

A run holds a pair once, so a pair that a third of all links have is a row a run; no document's rows are sent to a pair.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_chars, fast_encoder, library, mixed
from .common import dropped, slices, text_or_empty, written

RUN = 4 << 20  # characters of the texts of a run
RADIX_BYTES, MOST_RADIX = 16 << 20, 1 << 14  # text whose pairs a radix partition gets, and most partitions
FAN_IN = 256  # runs that are merged at once
SEPARATORS = (",", "|", ";", "")  # behind a token: its side goes on, side B follows, a group follows, the text ends


@lru_cache(2)
def byte_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level BPE."""
    back, found = {c: b for b, c in enumerate(byte_chars())}, library(path)
    out = [b""] * (max(found.get_vocab().values()) + 1)
    for token, i in found.get_vocab(with_added_tokens=False).items():
        out[i] = bytes(back[c] for c in token)
    return out


@lru_cache(2)
def pieces(path: str):
    """The sentencepiece model in ``path`` and the bytes of each id: U+2581 is a space, a byte piece its byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return model, [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(model.id_to_piece(list(range(model.vocab_size()))))]


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as zstd, the bytes of equal weight together."""
    parts = [len(arrays).to_bytes(4, "little")]
    for a in arrays:
        parts += [a.dtype.str.encode().ljust(8), len(a).to_bytes(8, "little"), np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()]
    return zstandard.compress(b"".join(parts), 3)


def unpacked(block: bytes) -> list[np.ndarray]:
    raw, out, at = zstandard.decompress(block), [], 4
    for _ in range(int.from_bytes(raw[:4], "little")):
        kind, n = np.dtype(raw[at : at + 8].strip().decode()), int.from_bytes(raw[at + 8 : at + 16], "little")
        at += 16
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n).T).view(kind).reshape(n))
        at += n * kind.itemsize
    return out


class Aligned:
    """Texts with their tokens: ``a`` and ``b`` (ids of all texts), ``n_a`` and ``n_b`` (tokens of each text), ``n_groups``, ``n_links``, the groups as text,
    and the ids of each link (``link_a``, ``link_b``), text by text."""

    def __init__(self, texts: list[str], byte_path: str, piece_path: str):
        encode, of_a, (model, of_b) = fast_encoder(byte_path, plain=True), byte_tokens(byte_path), pieces(piece_path)
        a, b, self.n_a, self.n_b = [], [], np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for first, last in slices(texts):
            for k, (text, y) in enumerate(zip(texts[first:last], model.encode(texts[first:last], num_threads=1), strict=True), first):
                if not text:
                    continue
                raw, x = b" " + text.encode(), encode(" " + text)
                if b"".join(map(of_a.__getitem__, x)) == raw == b"".join(map(of_b.__getitem__, y)):
                    a.append(np.array(x, np.int64))
                    b.append(np.array(y, np.int64))
                    self.n_a[k], self.n_b[k] = len(x), len(y)
        self.a, self.b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (a, b))
        end_a, end_b = np.cumsum(_lengths(byte_path)[self.a]), np.cumsum(_lengths(piece_path)[self.b])
        size = int(end_a[-1]) if len(end_a) else 0
        is_a, is_b = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
        is_a[end_a], is_b[end_b] = True, True
        upto_a, upto_b = np.cumsum(is_a), np.cumsum(is_b)
        links, groups = np.flatnonzero(is_a | is_b), np.flatnonzero(is_a & is_b)
        self.link_a, self.link_b = self.a[upto_a[links] - is_a[links]], self.b[upto_b[links] - is_b[links]]
        ends = np.append(0, end_a)[np.cumsum(self.n_a)]  # of texts, in bytes
        self.n_links, self.n_groups = (np.diff(np.searchsorted(x, ends, "right"), prepend=0) for x in (links, groups))
        group_a, group_b = np.searchsorted(groups, end_a), np.searchsorted(groups, end_b)
        self.order = np.empty(len(self.a) + len(self.b), np.int64)  # ids and separators, as they are told
        vocabulary = max(len(of_a), len(of_b))
        after_a = np.where(group_a == np.append(group_a[1:], -1), 0, 1)
        after_b = np.where(group_b == np.append(group_b[1:], -1), 0, 2)
        after_b[np.cumsum(self.n_b)[self.n_b > 0] - 1] = 3
        self.order[np.arange(len(self.a)) + np.append(0, upto_b[groups])[group_a]] = after_a * vocabulary + self.a
        self.order[np.arange(len(self.b)) + upto_a[groups][group_b]] = after_b * vocabulary + self.b
        self.names = _names(vocabulary)

    def groups(self) -> Iterator[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        at = 0
        for n in (self.n_a + self.n_b).tolist():
            yield "".join(map(self.names.__getitem__, self.order[at : at + n].tolist()))
            at += n


@lru_cache(4)
def _lengths(path: str) -> np.ndarray:
    return np.array([len(t) for t in (byte_tokens(path) if path.endswith(".json") else pieces(path)[1])], np.int64)


@lru_cache(2)
def _names(vocabulary: int) -> list[str]:
    return [f"{i}{s}" for s in SEPARATORS for i in range(vocabulary)]


def heap_merged(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Runs of (rising keys, counts) as one, with counts of equal keys added up: a k-way heap merge, ``FAN_IN`` runs a pass."""

    def told(keys: np.ndarray, counts: np.ndarray, step: int = 1024) -> Iterator[tuple[int, int]]:
        for i in range(0, len(keys), step):
            yield from zip(keys[i : i + step].tolist(), counts[i : i + step].tolist(), strict=True)

    while len(runs) > 1:
        merged = []
        for i in range(0, len(runs), FAN_IN):
            keys, counts, last = [], [], None
            for key, n in heapq.merge(*(told(*r) for r in runs[i : i + FAN_IN])):
                if key == last:
                    counts[-1] += n
                else:
                    keys.append(key)
                    counts.append(n)
                    last = key
            merged.append((np.array(keys, np.int64), np.array(counts, np.int64)))
        runs = merged
    return runs[0]


def _spilled(plain: DataFrame, byte_path: str, piece_path: str, radix: int, digest: bool) -> DataFrame:
    """The runs of ``plain`` (id, text). Rows with ``records``: a run's documents with their records. Rows with ``block``: its counts of the pairs of a radix partition."""
    id_type = plain.schema["id"].dataType.simpleString()
    names = ["run", "radix", "block", "records", "ids", "stats", "groups"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        ids, texts, held = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                ids.append(i.as_py())
                texts.append(t)
                held += len(t)
                if held >= RUN:
                    yield spilled(number, ids, texts)
                    ids, texts, held, number = [], [], 0, number + 1
        if ids:
            yield spilled(number, ids, texts)

    def spilled(number: int, ids: list, texts: list[str]) -> pa.RecordBatch:
        x = Aligned(texts, byte_path, piece_path)
        pair, kind = np.unique(x.link_b << 32 | x.link_a, return_inverse=True)
        part = (mixed(pair.astype(np.uint64)) % np.uint64(radix)).astype(np.int64)
        order = np.argsort(part, kind="stable")  # a pair's number is its place by radix partition, then B-major
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        pair, part, kind = pair[order], part[order], place[kind]
        counts = np.bincount(kind, minlength=len(pair))
        record, n = np.unique(np.repeat(np.arange(len(texts)), x.n_links) * max(1, len(pair)) + kind, return_counts=True)
        owner, which = record // max(1, len(pair)), record % max(1, len(pair))
        records = packed(np.bincount(owner, minlength=len(texts)).astype(np.int32), np.diff(which, prepend=0).astype(np.int32), n.astype(np.int32), (pair >> 32).astype(np.int32))
        stats = np.stack([x.n_a, x.n_b, x.n_groups, x.n_links])
        groups = [(hashlib.sha256(g.encode()).hexdigest() if digest and g else g) for g in x.groups()]
        cuts = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part)) if len(part) else np.zeros(1, np.int64)
        blocks = [packed(np.diff(pair[s:e], prepend=0), counts[s:e].astype(np.int32)) for s, e in zip(cuts, cuts[1:], strict=False)]
        none = [None] * len(blocks)
        rows = [[number] * (1 + len(blocks)), [-1, *part[cuts[:-1]].tolist()], [None, *blocks], [records, *none], [ids, *none], [packed(stats.reshape(-1)), *none], [groups, *none]]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), None, pa.binary(), pa.list_(pa.string())]
        return pa.RecordBatch.from_arrays([pa.array(v, k) if k else pa.array(v, pa.list_(_arrow(id_type))) for v, k in zip(rows, kinds, strict=True)], names=names)

    return plain.mapInArrow(run, f"run long, radix int, block binary, records binary, ids array<{id_type}>, stats binary, groups array<string>")


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def _counted(blocks: DataFrame) -> DataFrame:
    """Of ``blocks`` (run, radix, block): to each one the totals of its pairs over all runs (run, radix, totals), and of each radix partition the largest
    total of each B id (b, top; run is null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for radix, own in groupby(rows, itemgetter(1)):
            runs, held = [], []
            for number, _, block in own:
                step, n = unpacked(block)
                runs.append(number)
                held.append((np.cumsum(step), n))
            keys, totals = heap_merged(held)
            if len(held) == 1:
                totals = totals.astype(np.int64)
            side = keys >> 32
            first = np.flatnonzero(np.append(True, side[1:] != side[:-1]))
            yield told([None], [radix], [None], [side[first].tolist()], [np.maximum.reduceat(totals, first).tolist()])
            for number, (own_keys, _) in zip(runs, held, strict=True):
                yield told([number], [radix], [packed(totals[np.searchsorted(keys, own_keys)])], [None], [None])

    def told(*columns: list) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds, strict=True)], names=["run", "radix", "totals", "b", "top"])

    met = blocks.repartition("radix").sortWithinPartitions("radix")
    return met.mapInArrow(run, "run long, radix int, totals binary, b array<long>, top array<long>")


def align_tokens(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """One row per row of ``docs``: its id, n_a, n_b, n_groups, n_links, n_best, count_sum and ``groups``.

    A: space and text by the byte-level BPE of ``byte_path``; B: the text by the sentencepiece model of ``piece_path``, which puts the space before it.
    Strings of special tokens are plain text. n_best counts links whose pair is as frequent as any pair of its B id, count_sum adds up
    the corpus-wide counts of the links' pairs. ``groups`` is ``a1,a2|b1;a3|b2,b3``, with ``digest`` the SHA-256 of that, made where the text is.

    Null counts as empty. Texts that are empty, or whose tokens' bytes are not those of space and text, have no tokens: zeros and an
    empty ``groups``. Ids (long, int or string) may be null or repeat, every row gives its own. Copies count each time. An empty table gives an
    empty result. Only the two named columns are read. A text of any length is one task's work.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    size = plain.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0
    spilled = written(_spilled(plain, byte_path, piece_path, min(MOST_RADIX, size // RADIX_BYTES + 1), digest), "runs")
    counted = written(_counted(spilled.where("block is not null").select("run", "radix", "block")), "totals")
    best = counted.where("run is null").select(F.explode(F.arrays_zip("b", "top")).alias("x")).groupBy("x.b").agg(F.max("x.top").alias("top")).toPandas()  # one a B id
    top = np.zeros(int(best["b"].max() if len(best) else -1) + 1, np.int64)
    top[best["b"].to_numpy(np.int64)] = best["top"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast(top)
    id_type = docs.schema[id_col].dataType.simpleString()

    def finish(own: pa.Table, back: pa.Table) -> pa.Table:
        back = back.sort_by("radix")
        totals = np.concatenate([np.zeros(0, np.int64), *(unpacked(x)[0] for x in back.column("totals").to_pylist())])
        row = {c: own.column(c)[0] for c in own.column_names}
        sizes, step, n, side = unpacked(row["records"].as_py())
        which, weight = np.cumsum(step), n.astype(np.int64)
        ends = np.append(0, np.cumsum(sizes))
        sums = [np.diff(np.append(0, np.cumsum(v))[ends]) for v in (weight * (totals == shared.value[side])[which], weight * totals[which])]
        stats = unpacked(row["stats"].as_py())[0].reshape(4, -1)
        return pa.table([row["ids"].values, *(pa.array(v) for v in (*stats, *sums)), row["groups"].values], names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])

    records = spilled.where("records is not null").select("run", "records", "ids", "stats", "groups")
    totals = counted.where("run is not null").select("run", "radix", "totals")
    kind = f"id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
    out = written(records.groupBy("run").cogroup(totals.groupBy("run")).applyInArrow(finish, kind), "aligned")
    dropped(spilled)
    dropped(counted)
    return out.withColumnRenamed("id", id_col)
