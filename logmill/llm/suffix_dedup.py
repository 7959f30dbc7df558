"""Removal of repeated passages, decided by sorted suffixes.

Every string of ``LENGTH`` bytes (a start) has an anchor: of its grams of ``GRAM`` bytes the one with the smallest hash, the first of equal
ones. Equal strings have equal anchors at equal places, so a start can be repeated only if its anchor's hash is. Neighbouring starts with
one anchor form a context, the bytes that they cover.

1. Rows with equal whole texts (md5) are one text; if it has ``LENGTH`` bytes, all of it is repeated.
2. All contexts meet at their anchor's hash, as a few numbers each. Unique anchors go. Hashes tell which contexts look equal, and so which
   ones need to be compared. Tasks sort what they see twice themselves and send one row of it, so a passage in a third of all documents is a
   row a task.
3. What looks equal sends its bytes to one place, where whole contexts are sorted as suffixes: those that are equal are repeated at all
   their starts. The contexts left over, at the ends of passages and at edits, send their bytes to their anchor, with one of each other
   context of it; there the suffixes at all their starts are sorted to a depth of ``LENGTH`` and neighbours are compared.
4. The repeated starts go back to their texts, where they are joined to spans.

So sorted bytes decide what is removed. Two contexts that look equal and are not would stop the job; their hashes have 128 bits together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import mixed, span_hashes
from .common import dropped, fresh, joined, partitions, slices, small_batches, text_or_empty, written
from .suffix_sort import big_endian_words, equal_groups, repeated

LENGTH = 200
GRAM = 64
CHUNK = 2 << 20  # starts of a text that are taken together
HOT = 20_000  # open contexts of one anchor; beyond, each start goes by a hash of its own string
HELD = 100_000  # contexts that a task compares among themselves
SORTED = 400_000  # starts that are sorted together; a whole context counts as ``WEIGHT`` of them
WEIGHT = 40
SMALL = 4_000_000  # keys that may be broadcast
FEW_COPIES = 1_000_000  # texts that several rows hold, of which there may be so many to be broadcast


def _window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values, from prefix and suffix minima of blocks."""
    n = len(keys) - width + 1
    full = -(-len(keys) // width) * width
    padded = np.full(full, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def contexts(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a text's bytes: anchor hash, context hash, first start, last start and anchor place of each context.

    Hashes are over mixed words of eight bytes, as a polynomial over the bytes themselves has equal values for some simple strings.
    """
    out = []
    for a in range(0, len(data) - length + 1, CHUNK):
        part = data[a : a + CHUNK + length - 1]
        at = np.arange(len(part) - gram + 1)
        words = mixed(big_endian_words(part))
        grams = span_hashes(words, at, at + gram - 7)
        keys = (grams & ~np.uint64(0xFFFFFF)) | at.astype(np.uint64)
        anchor = (_window_minima(keys, length - gram + 1) & np.uint64(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        last = np.append(first[1:], len(anchor)) - 1
        place = anchor[first]
        whole = span_hashes(words, first, last + length - 7) ^ mixed((place - first).astype(np.uint64))
        out.append((grams[place], whole, first + a, last + a, place + a))
    return tuple(map(np.concatenate, zip(*out, strict=True))) if out else tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))


def _packed(first: np.ndarray, last: np.ndarray, place: np.ndarray) -> np.ndarray:
    return first << 16 | (last - first) << 8 | (place - first)


FREE, SETTLED, KNOWN, NEW = 3, 2, 1, 0
META = "e long, h long, c long, k long, p long, flag int"


def _all_equal(data: np.ndarray, starts: np.ndarray, size: np.ndarray, bucket: np.ndarray) -> None:
    """Stops the job unless the ``size`` bytes of ``data`` at ``starts`` are equal in each of the numbered buckets."""
    n = int(bucket.max()) + 1 if len(bucket) else 0
    longest, shortest = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max)
    np.maximum.at(longest, bucket, size)
    np.minimum.at(shortest, bucket, size)
    if n and ((longest != shortest).any() or len(np.unique(equal_groups(data, starts, size, bucket)[1])) != n):
        raise ValueError("two different contexts have the same hashes")


def _meeting_rows(docs: DataFrame) -> DataFrame:
    """One row per context of ``docs`` (k, text): where it goes (e), anchor hash, context hash, text key, place, and what its task knows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        parts: list[np.ndarray] = []
        held = size = 0

        def settle() -> Iterator[pa.RecordBatch]:
            h, c, k, p, at = map(np.concatenate, zip(*found, strict=True))
            by = np.lexsort((c, h))
            h, c, k, p, at = h[by], c[by], k[by], p[by], at[by]
            new_h = np.append(True, h[1:] != h[:-1])
            new_c = new_h | np.append(True, c[1:] != c[:-1])
            of_c, of_h = np.cumsum(new_c) - 1, np.cumsum(new_h) - 1
            n_c, n_h = np.bincount(of_c)[of_c], np.bincount(of_h)[of_h]
            single = n_c == 1
            _all_equal(np.concatenate(parts), at[~single], (p[~single] >> 8 & 255) + LENGTH, np.cumsum(new_c[~single]) - 1)
            seen = np.cumsum(single) - single
            first_single = single & (seen == seen[np.flatnonzero(new_h)][of_h])
            flag = np.full(len(h), NEW, np.int32)
            e = h.copy()
            many = n_h > 1
            flag[many & single] = KNOWN
            other = many & single & ~first_single
            e[other] = mixed(h[other] + c[other] * np.uint64(3))
            flag[~single] = SETTLED
            rest = ~single & ~new_c
            flag[rest] = FREE
            e[rest] = mixed(k[rest].view(np.uint64) + p[rest].view(np.uint64) * np.uint64(5))
            for a in range(0, len(h), 100_000):
                s = slice(a, a + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(x[s].view(np.int64)) for x in (e, h, c, k, p)] + [pa.array(flag[s])], names=["e", "h", "c", "k", "p", "flag"])

        for batch in batches:
            ks = batch.column(0).to_numpy()
            texts = batch.column(1)
            for i in range(len(ks)):
                data = np.frombuffer(texts[i].as_py().encode("utf-8", "surrogatepass"), np.uint8)
                if len(data) < LENGTH:
                    continue
                h, c, first, last, place = contexts(data)
                found.append((h, c, np.full(len(h), ks[i]), _packed(first, last, place), first + size))
                parts.append(data)
                held += len(h)
                size += len(data)
                if held > HELD:
                    yield from settle()
                    found, parts, held, size = [], [], 0, 0
        if found:
            yield from settle()

    return docs.select("k", "text").mapInArrow(run, META)


def _met(rows: DataFrame) -> DataFrame:
    """Rows whose anchor is repeated: h, c, k, p, state (0: open, 1: settled, 2: settled, and the row that stands for its context at e), and
    ``meets``: whether it is settled because its hashes equal another task's, so that its bytes must be compared.

    Contexts of one anchor may meet at different e, so what is seen at one e does not tell whether another one has open contexts.
    """

    def decide(t: dict[str, np.ndarray], before: tuple, after: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        e, h, c = (np.concatenate([[x], t[n], [y]]) for n, x, y in zip("ehc", before, after, strict=True))
        same_h = (e[1:] == e[:-1]) & (h[1:] == h[:-1])
        same_c = same_h & (c[1:] == c[:-1])
        settled = (t["flag"] >= SETTLED) | same_c[:-1] | same_c[1:]
        alive = (t["flag"] >= KNOWN) | same_h[:-1] | same_h[1:]
        stands = settled & ~same_c[:-1] & (t["flag"] != FREE)  # a free row's task has sent a settled one besides
        return alive, np.where(stands, 2, np.where(settled, 1, 0)), same_c[:-1] | same_c[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = (0, 0, 0)
        before, waiting = none, None
        started = False

        def give(t: dict[str, np.ndarray], after: tuple | None) -> pa.RecordBatch:
            # a first or last row has no neighbour: one with another e stands for it
            left = before if started else (~t["e"][0], 0, 0)
            right = after or (~t["e"][-1], 0, 0)
            alive, state, meets = decide(t, left, right)
            return pa.RecordBatch.from_arrays([pa.array(t[n][alive]) for n in "hckp"] + [pa.array(state[alive].astype(np.int32)), pa.array(meets[alive])], names=["h", "c", "k", "p", "state", "meets"])

        for batch in batches:
            if not batch.num_rows:
                continue
            t = {n: batch.column(n).to_numpy() for n in ("e", "h", "c", "k", "p", "flag")}
            if waiting is not None:
                yield give(waiting, tuple(t[n][0] for n in "ehc"))
                before, started = tuple(waiting[n][-1] for n in "ehc"), True
            waiting = t
        if waiting is not None:
            yield give(waiting, None)

    spark = rows.sparkSession
    return rows.repartition(partitions(spark), "e").sortWithinPartitions("e", "h", "c").mapInArrow(run, "h long, c long, k long, p long, state int, meets boolean")


def _only(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose k is in ``keys``; by broadcast if there are few, which saves moving the other texts."""
    return docs.join(F.broadcast(keys) if keys.count() <= SMALL else keys, "k", "left_semi")


OPEN, BESIDE, WHOLE = 0, 1, 2  # why a context sends its bytes: it is open, is compared with open ones, or is compared as a whole


def _sent_contexts(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """x, data, k, first, n, alone, off: the bytes of open contexts, of one of each other context of their anchors (n is 0: only compared with), and
    of whole contexts that look equal to others (n is -1). ``off``: the anchor's place in data.

    A hot anchor's starts go one by one (alone), each by a hash of its own string.
    """
    left = marked.where("state = 0")
    anchors = written(left.select("h").distinct(), "anchors")
    stand = marked.where("state = 2").join(F.broadcast(anchors) if anchors.count() <= SMALL else anchors, "h", "left_semi")
    part = lambda df, role: df.select(F.col("h").alias("x"), "k", "p", F.lit(role).alias("role"))
    wanted = part(left, OPEN).unionByName(part(stand, BESIDE))
    hot = written(wanted.groupBy("x").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT).select("x", F.lit(True).alias("hot")), "hot")
    places = wanted.join(F.broadcast(hot) if hot.count() <= 100_000 else hot, "x", "left")
    whole = marked.where("meets").select(F.xxhash64("h", "c").alias("x"), "k", "p", F.lit(WHOLE).alias("role"), F.lit(False).alias("hot"))
    lists = places.unionByName(whole).groupBy("k").agg(F.collect_list(F.struct("x", "p", "role", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("places"))
    lists = written(lists, "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int32()]
        names = ["x", "data", "k", "first", "n", "alone", "off"]
        made = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for k, text, where in zip(*(batch.column(i) for i in range(3)), strict=True):
                k, data = k.as_py(), text.as_py().encode("utf-8", "surrogatepass")
                for x, p, role, hot in zip(*(where.values.field(i).to_pylist() for i in range(4)), strict=True):
                    first, n, off = p >> 16, (p >> 8 & 255) + 1, p & 255
                    if first + n + LENGTH - 1 > len(data):
                        raise ValueError("two different texts have the same key")
                    if hot:
                        part = np.frombuffer(data, np.uint8)[first : first + n + LENGTH - 1]
                        at = np.arange(len(part) - LENGTH + 1)
                        for i, own in enumerate(span_hashes(mixed(big_endian_words(part)), at, at + LENGTH - 7).view(np.int64).tolist()):
                            rows.append((own, data[first + i : first + i + LENGTH], k, first + i, 1 if role == OPEN else 0, True, None))
                        size += n * LENGTH
                    else:
                        rows.append((x, data[first : first + n + LENGTH - 1], k, first, (n, 0, -1)[role], role == WHOLE, off))
                        size += n + LENGTH
                    if size > 4_000_000:
                        yield made(rows)
                        rows, size = [], 0
            if rows:
                yield made(rows)

    return _only(docs, lists.select("k")).join(lists, "k").select("k", "text", "places").mapInArrow(run, "x long, data binary, k long, first long, n int, alone boolean, off int")


def _sorted_starts(rows: DataFrame, most: int = SORTED) -> DataFrame:
    """k, first, last: ranges of starts that are repeated, of the rows of ``_sent_contexts``. About ``most`` starts are sorted together, whole anchors always.

    Strings can be equal only if their anchors are at equal places, so starts are sorted by the place of their anchor (``off``, if known).
    """
    if "off" not in rows.columns:
        rows = rows.withColumn("off", F.lit(None).cast("int"))

    def decide(rows: list[tuple]) -> pa.RecordBatch:
        data = np.frombuffer(b"".join(r[1] for r in rows), np.uint8)
        size = np.array([len(r[1]) for r in rows])
        base = np.cumsum(size) - size
        n, x, k, first = (np.array([r[i] for r in rows]) for i in (4, 0, 2, 3))
        off = np.array([-1 if r[6] is None else r[6] for r in rows])
        new = np.append(True, (x[1:] != x[:-1]) | ((n[1:] < 0) != (n[:-1] < 0)))
        number = np.cumsum(new) - 1
        whole = n < 0
        alike = np.bincount(number)[number] > 1
        both = np.flatnonzero(whole & alike)
        _all_equal(data, base[both], size[both], np.unique(number[both], return_inverse=True)[1])
        both = both[n[both] == -1]
        part = np.flatnonzero(~whole)
        n_starts = size[part] - LENGTH + 1
        row = np.repeat(part, n_starts)
        within = np.arange(int(n_starts.sum())) - np.repeat(np.cumsum(n_starts) - n_starts, n_starts)
        place = np.where(off[row] < 0, 0, off[row] - within + 512)
        hit = repeated(data, base[row] + within, LENGTH, number[row] * 1024 + place) & (n[row] > 0)
        at = np.flatnonzero(hit)
        new = np.append(True, (row[at[1:]] != row[at[:-1]]) | (at[1:] != at[:-1] + 1)) if len(at) else np.zeros(0, bool)
        begin = at[new]
        end = at[np.append(new[1:], True)] if len(at) else at
        out = (
            np.concatenate([k[row[begin]], k[both]]), np.concatenate([first[row[begin]] + within[begin], first[both]]),
            np.concatenate([first[row[end]] + within[end], first[both] + size[both] - LENGTH]),
        )
        return pa.RecordBatch.from_arrays([pa.array(v.astype(np.int64)) for v in out], names=["k", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        starts = 0
        for batch in batches:
            for r in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                if starts > most and (r[0] != rows[-1][0] or (r[5] and rows[-1][5])):
                    last, met = rows[-1], len(rows) > 1 and rows[-2][0] == rows[-1][0]
                    yield decide(rows)
                    # rows that are alone and go to one place hold one string: of those that go on, one stays to compare with, and is
                    # still to be judged itself if it was the first
                    judged = 0 if last[4] >= 0 else -2
                    rows = [(*last[:4], judged if met else last[4], True, last[6])] if last[0] == r[0] else []
                    starts = len(rows)
                rows.append(r)
                starts += len(r[1]) - LENGTH + 1 if r[4] >= 0 else WEIGHT
        if rows:
            yield decide(rows)

    spark = rows.sparkSession
    return rows.repartition(partitions(spark), "x").sortWithinPartitions("x", "n").mapInArrow(run, "k long, first long, last long")


def merged_spans(first: np.ndarray, last: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Maximal spans [a, b) of bytes that are covered by strings starting in the ranges first..last."""
    by = np.argsort(first, kind="stable")
    a, b = first[by], last[by] + length
    reach = np.maximum.accumulate(b)
    new = np.append(True, a[1:] > reach[:-1])
    ends = reach[np.append(new[1:], True)]
    return np.stack([a[new], ends], 1)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows, copies): id, text, m (md5), k (64-bit key of the text) of every row of at least ``LENGTH`` bytes, and the m of texts that occur more
    than once there, with the largest id. Texts that share a 64-bit hash get other keys, so a key stands for one text."""
    small_batches(docs.sparkSession)
    plain = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).where(F.octet_length("text") >= LENGTH)
    keyed = plain.select("id", "text", F.md5(F.col("text").cast("binary")).alias("m"), F.xxhash64("text").alias("k"))
    texts = written(keyed.groupBy("m", "k").agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("n")), "texts")
    copies = written(texts.where("n > 1").select("m", "last", F.lit(True).alias("copied")), "copies")
    shared = texts.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k")
    clash = written(texts.join(shared, "k", "left_semi").select("m"), "clash")  # some hundred of 10**11 texts
    dropped(texts)
    if not clash.isEmpty():
        again = clash.select(F.col("m").alias("again"))
        keyed = keyed.join(F.broadcast(again), F.col("m") == F.col("again"), "left").withColumn("k", F.when(F.col("again").isNull(), F.col("k")).otherwise(F.xxhash64("m"))).drop("again")
    return keyed, copies


def _one_each(keyed: DataFrame, copies: DataFrame) -> DataFrame:
    """Rows of ``keyed`` whose text occurs once, and of others those with the largest id, with ``copied``.

    Beyond ``FEW_COPIES`` the md5 meet without the texts, hot ones by broadcast, and the texts move once, by the number of their row.
    """
    stays = F.col("copied").isNull() | F.col("id").eqNullSafe(F.col("last"))
    if copies.count() <= FEW_COPIES:
        return keyed.join(F.broadcast(copies), "m", "left").where(stays)
    rows = written(keyed.withColumn("row", F.monotonically_increasing_id()), "keyed")
    marks = joined(rows.select("row", "id", "m"), copies, "m", "left").where(stays).select("row", "copied")
    ones = written(rows.join(marks, "row"), "ones")
    dropped(rows)
    return ones


def repeated_ranges(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ones, copies, ranges): rows as of ``_keyed`` whose text occurs once, or is the last of its copies; the m of texts that occur more than
    once; and k, first, last of all repeated ranges of starts."""
    keyed, copies = _keyed(docs, id_col, text_col)
    ones = _one_each(keyed, copies)
    texts = ones.select("k", "text")
    marked = written(_met(_meeting_rows(texts)), "marked")
    found = _sorted_starts(_sent_contexts(texts, marked))
    settled = marked.where("state > 0 and not meets").select("k", F.expr("p >> 16").alias("first"), F.expr("(p >> 16) + ((p >> 8) & 255)").alias("last"))
    ranges = written(settled.unionByName(found), "starts")
    dropped(marked)
    return ones.where(F.col("copied").isNull()).select("m", "k", "text"), copies, ranges


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows with repeated bytes only: m (md5 of the text), n_removed (-1: the whole text), n_spans, kept (binary, what remains).

    One row per distinct text. Null counts as empty. Texts under ``LENGTH`` bytes never lose anything. A text of at least ``LENGTH`` bytes
    that several rows hold loses all of it. An empty table gives an empty result. A text's ranges come together in one row beside it; they
    are fewer than its bytes, so they are bounded by the text.
    """
    ones, copies, ranges = repeated_ranges(docs, id_col, text_col)
    lists = written(ranges.groupBy("k").agg(F.collect_list(F.struct("first", "last")).alias("ranges")), "ranges")
    dropped(ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["m", "n_removed", "n_spans", "kept"]
        for batch in batches:
            lengths = [len(t) for t in batch.column(1).to_pylist()]
            for a, b in slices([" " * n for n in lengths], 4_000_000):
                rows = []
                for m, text, where in zip(*(batch.column(i).slice(a, b - a) for i in range(3)), strict=True):
                    data = text.as_py().encode("utf-8", "surrogatepass")
                    first, last = (where.values.field(i).to_numpy() for i in range(2))
                    spans = merged_spans(first, last)
                    if spans[-1, 1] > len(data):
                        raise ValueError("two different texts have the same key")
                    kept, at = [], 0
                    for s, e in spans.tolist():
                        kept.append(data[at:s])
                        at = e
                    kept.append(data[at:])
                    rows.append((m.as_py(), int((spans[:, 1] - spans[:, 0]).sum()), len(spans), b"".join(kept)))
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    cut = _only(ones, lists.select("k")).join(lists, "k").select("m", "text", "ranges").mapInArrow(run, "m string, n_removed long, n_spans long, kept binary")
    out = written(cut.unionByName(copies.select("m", F.lit(-1).cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(b"").alias("kept"))), "removed")
    dropped(lists)
    return out


def repeat_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, n_bytes, n_removed, n_spans, kept_sha256. Cases as in ``remove_repeats``."""
    text = text_or_empty(text_col)
    done = remove_repeats(docs, id_col, text_col).select("m", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept"))
    rows = written(docs.select(F.col(id_col).alias("id"), F.md5(text.cast("binary")).alias("m"), F.sha2(text.cast("binary"), 256).alias("sha"), F.octet_length(text).cast("long").alias("n_bytes")), "digests")
    n = F.coalesce("n_removed", F.lit(0).cast("long"))
    return joined(rows, done, "m", "left").select(
        F.col("id").alias(id_col), "n_bytes", F.when(n < 0, F.col("n_bytes")).otherwise(n).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("kept", "sha").alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows of ``docs`` with their columns; the text without its repeated bytes, and n_chars, where there is one, its new length.

    A character that a removed span cuts goes with it. A null text stays null, and a text that loses all is empty.
    """
    own_m, own_kept = fresh(docs, "_m", "_kept")
    done = remove_repeats(docs, id_col, text_col).select("m", "kept")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.decode("utf-8", "ignore") for x in batch.column(1).to_pylist()], pa.string())], names=["m", "kept"])

    plain = done.mapInArrow(decode, "m string, kept string").toDF(own_m, own_kept)
    out = joined(docs.withColumn(own_m, F.md5(text_or_empty(text_col).cast("binary"))), plain, own_m, "left").withColumn(text_col, F.coalesce(own_kept, F.col(text_col)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
