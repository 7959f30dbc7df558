"""Context-triggered piecewise hashing of documents.

A rolling hash over the last bytes decides where chunks end; each chunk gives one character of the signature. A fingerprint holds the
signatures of two neighbouring block sizes, so texts of different lengths can still meet at a common one. Likeness comes from the edit
distance of signatures at a compatible block size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .bpe import mixed, span_hashes
from .common import partitions, slices, text_or_empty

ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
WINDOW = 7  # bytes that the rolling hash sees
SMALLEST = 3  # block size
LENGTH = 64  # characters that a signature has at most


def _rolling(data: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the last ``WINDOW`` bytes at each byte; bytes before the text's start count as zero."""
    h = np.zeros(len(data), np.uint64)
    for k in range(min(WINDOW, len(data))):
        h[k:] += (data[: len(data) - k].astype(np.uint64) + np.uint64(1)) * np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64))
    return (mixed(h) >> np.uint64(32)).astype(np.uint32)


def _signature(data: np.ndarray, ends: np.ndarray) -> str:
    """One character per chunk. Beyond ``LENGTH`` - 1 chunks, the last character stands for all that follows."""
    ends = ends[: LENGTH - 1]
    bounds = np.concatenate([[0], ends, [len(data)]]) if not len(ends) or ends[-1] < len(data) else np.concatenate([[0], ends])
    bounds = bounds.astype(np.int64)
    return ALPHABET[(span_hashes(data, bounds[:-1], bounds[1:]) >> np.uint64(58)).astype(np.int64)].tobytes().decode("ascii")


def fingerprint(text: str) -> str:
    """``block:signature:signature at twice the block``. Block sizes are 3 * 2**i; the largest one that gives at least half of the
    characters is taken, starting from the one that the length suggests. An empty text has block 3 and empty signatures."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if not len(data):
        return f"{SMALLEST}::"
    roll = _rolling(data)
    level = 0
    while SMALLEST * LENGTH << level < len(data):
        level += 1
    while True:
        block = SMALLEST << level
        near = np.flatnonzero(roll % np.uint32(block) == block - 1)
        if level == 0 or len(near) >= LENGTH // 2:
            break
        level -= 1
    far = near[roll[near] % np.uint32(2 * block) == 2 * block - 1]
    return f"{block}:{_signature(data, near + 1)}:{_signature(data, far + 1)}"


def _distances(a: list[str], b: list[str]) -> np.ndarray:
    """Edit distance (insertion, deletion 1; substitution 2) of many pairs at once, one row of the table at a time for all of them."""
    n = len(a)
    if not n:
        return np.zeros(0, np.int32)
    la, lb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    x, y = (np.array([list(s.encode("ascii").ljust(LENGTH, pad)) for s in t], np.uint8) for t, pad in ((a, b"\x01"), (b, b"\x02")))
    step = np.arange(LENGTH + 1, dtype=np.int32)
    row = np.tile(step, (n, 1))
    out = np.where(la == 0, lb, 0).astype(np.int32)
    for i in range(1, int(la.max(initial=0)) + 1):
        new = np.empty_like(row)
        new[:, 0] = i
        new[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + 2 * (x[:, i - 1, None] != y))
        row = np.minimum.accumulate(new - step, axis=1) + step  # insertions from the left
        done = la == i
        out[done] = row[done, lb[done]]
    return out


def likeness(a: list[str], b: list[str]) -> np.ndarray:
    """Between 0 and 1 for each pair of fingerprints: 1 for equal ones, else the best of the compatible block sizes; 0 if none is."""
    left, right, pair = [], [], []
    for k, (p, q) in enumerate(zip(a, b, strict=True)):
        bp, p1, p2 = p.split(":")
        bq, q1, q2 = q.split(":")
        bp, bq = int(bp), int(bq)
        for ok, s, t in ((bp == bq, p1, q1), (bp == bq, p2, q2), (bp == 2 * bq, p1, q2), (bq == 2 * bp, p2, q1)):
            if ok and s and t:
                left.append(s)
                right.append(t)
                pair.append(k)
    out = np.zeros(len(a))
    if pair:
        total = np.array([len(s) + len(t) for s, t in zip(left, right, strict=True)])
        np.maximum.at(out, np.array(pair), 1 - _distances(left, right) / total)
    out[[k for k, (p, q) in enumerate(zip(a, b, strict=True)) if p == q]] = 1.0
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id and fingerprint. Null counts as empty; no row moves between tasks."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fingerprint(t) for t in batch.column(1).to_pylist()], pa.string())], names=["id", "fingerprint"])

    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).mapInArrow(run, f"id {id_type}, fingerprint string").withColumnRenamed("id", id_col)


def with_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_range: int = 5_000, most_ranges: int = 100_000) -> DataFrame:
    """``range``, ``guest``, id, text in order: documents dealt to ranges of falling ids, each range followed by the next one's first row.

    Rows are in the order of falling id, null ids last, equal ids by text. The range bounds are ids: a list that has one for about
    ``per_range`` documents, and ``most_ranges`` at most. Only a range's first row is sent twice. The first row of all closes the last range.
    Ids are integers. All null ids are one range, as nothing tells their rows' order but the texts.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    ranges = int(min(most_ranges, max(1, rows.count() // per_range)))
    found = rows.select("id").where("id is not null").stat.approxQuantile("id", [k / ranges for k in range(1, ranges)], 0.2 / ranges) if ranges > 1 else []
    cuts = np.unique(np.array(found, np.int64))

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:  # range 0 holds the largest ids
        return pd.Series(len(cuts) - np.searchsorted(cuts, ids.to_numpy(), "right")).astype("int32")

    dealt = rows.withColumn("range", place(F.coalesce(F.col("id"), F.lit(-(2**63)))))
    firsts = dealt.groupBy("range").agg(F.max("id").alias("first")).orderBy("range").collect()  # one row a range
    sent = [(r["range"], r["first"], firsts[k - 1]["range"]) for k, r in enumerate(firsts)]
    to = F.broadcast(spark.createDataFrame(sent, "r int, first long, to int"))
    met = dealt.join(to, (F.col("range") == F.col("r")) & F.col("id").eqNullSafe(F.col("first")), "left")
    places = F.array(F.struct(F.col("range").alias("range"), F.lit(False).alias("guest")), F.struct(F.col("to").alias("range"), F.lit(True).alias("guest")))
    both = met.select("id", "text", F.explode(F.when(F.col("to").isNull(), F.slice(places, 1, 1)).otherwise(places)).alias("at")).select("at.range", "at.guest", "id", "text")
    tasks = max(1, min(ranges, 4 * partitions(spark)))  # ranges go round, so that each task gets as many
    return both.repartitionById(tasks, F.pmod(F.col("range"), F.lit(tasks))).sortWithinPartitions("range", "guest", F.desc_nulls_last("id"), "text")


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document beside its edited text: the last floor(n/2) code points replaced by the first as many (or all) of the next document.

    The next document is the one with the next smaller id; after the last comes the first. Null ids come last, equal ids in the order of
    their texts; null texts count as empty. A single document is its own next one; an empty table gives an empty result.
    Columns: the id, text, edited (text), fingerprint, edited_fingerprint, near_edited, near_next.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["id", "text", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    id_arrow = to_arrow_type(docs.schema[id_col].dataType)

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        ids, texts, edits, own, changed, following = map(list, zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, id_arrow), pa.array(texts, pa.string()), pa.array(edits, pa.string()), pa.array(own), pa.array(changed), pa.array(likeness(own, changed)), pa.array(likeness(own, following))], names=names
        )


    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, closed, out, size = None, -1, [], 0
        for batch in batches:
            places, guests, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            texts = batch.column(3)
            for a, b in slices(texts.to_pylist()):
                for k, text in enumerate(texts.slice(a, b - a).to_pylist(), a):
                    if places[k] == closed:
                        continue  # a further guest: rows that share the first id
                    own = fingerprint(text)
                    if waiting is not None and waiting[0] == places[k]:
                        _, i, t, f = waiting
                        n = len(t)
                        edited = t[: n - n // 2] + text[: n // 2]
                        out.append((i, t, edited, f, fingerprint(edited), own))
                        size += 2 * n
                    waiting = None if guests[k] else (places[k], ids[k], text, own)
                    closed = places[k] if guests[k] else closed
                    if size > 2_000_000:
                        yield flush(out)
                        out, size = [], 0
        if out:
            yield flush(out)

    moved = with_neighbours(docs, id_col, text_col)
    return moved.mapInArrow(run, f"id {id_type}, text string, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double").withColumnRenamed("id", id_col)
