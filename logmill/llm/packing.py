"""Packing documents into training windows by best-fit decreasing.

Overlong documents are first cut into full windows, which have their place where they are cut. Only the rests, each shorter than a window,
meet in blocks, where they are packed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import fast_encoder
from .common import slices, text_or_empty, written

BLOCK = 20_000  # rests that are packed together; the unfilled windows at a block's end are its only extra padding
FULL = 1 << 62  # full windows are numbered from here on: partition and place in it


def token_pieces(docs: DataFrame, path: str, window: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document as ids (the tokenizer's and ``end_id``), cut into full windows and a rest.

    Columns: the id, start, length, ids (binary, little-endian unsigned 32-bit integers), doc_tokens, spread (a number that deals
    documents out evenly, whatever their ids are), full (number of a full window, null for a rest). A null or empty text is one piece with
    the end id alone; of repeated rows each gives its own pieces. No row moves between tasks.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["id", "start", "length", "ids", "doc_tokens", "spread", "full"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = fast_encoder(path)
        row = TaskContext.get().partitionId() << 33
        number = FULL + (TaskContext.get().partitionId() << 40)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts, 2_000_000):
                owner, start, length, data, total, spread, full = [], [], [], [], [], [], []
                for i in range(a, b):
                    ids = np.array([*encode(texts[i]), end_id], "<u4")
                    row += 1
                    for s in range(0, len(ids), window):
                        part = ids[s : s + window]
                        owner.append(i)
                        start.append(s)
                        length.append(len(part))
                        data.append(part.tobytes())
                        total.append(len(ids))
                        spread.append(row)
                        full.append(number if len(part) == window else None)
                        number += len(part) == window
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(data, pa.binary()), pa.array(total, pa.int64()), pa.array(spread, pa.int64()), pa.array(full, pa.int64())],
                    names=names,
                )

    plain = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return plain.mapInArrow(run, f"id {id_type}, start long, length long, ids binary, doc_tokens long, spread long, full long").withColumnRenamed("id", id_col)


class OpenWindows:
    """Open windows by remaining capacity, in a segment tree: an inner node holds how many windows lie below it."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.width)
        self.at: list[list[int]] = [[] for _ in range(self.width)]

    def add(self, left: int, window: int) -> None:
        self.at[left].append(window)
        node = left + self.width
        while node:
            self.count[node] += 1
            node >>= 1

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Takes out the window with the least remaining capacity of ``need`` or more: (capacity, window)."""
        count, node = self.count, need + self.width
        while not count[node]:  # up to the first subtree at the right that holds one
            while node & 1:
                node >>= 1
                if not node:
                    return None
            node += 1
        while node < self.width:  # down to its leftmost leaf
            node *= 2
            if not count[node]:
                node += 1
        left = node - self.width
        window = self.at[left].pop()
        while node:
            count[node] -= 1
            node >>= 1
        return left, window


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each piece; the pieces are taken in the order of falling length, equal ones as they stand."""
    window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, made = OpenWindows(capacity), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        found = tree.tightest(need) if need < capacity else None
        if found is None:
            left, w = capacity, made
            made += 1
        else:
            left, w = found
        window[i], offset[i] = w, capacity - left
        if left > need:
            tree.add(left - need, w)
    return window, offset


def pack(pieces: DataFrame, capacity: int = 2048, block: int = BLOCK) -> DataFrame:
    """``pieces`` (columns length, spread and full, and any others) with sequence_id and offset in place of spread and full.

    Full windows pass as they are. Blocks of about ``block`` rests are packed each by itself; rests are dealt to blocks by ``spread``, so no
    id, source or length makes a block large. The number of blocks grows with the table. An empty table gives an empty result.
    """
    rests = pieces.where("full is null").drop("full")
    blocks = max(1, rests.count() // block)
    carried = [c for c in rests.columns if c != "spread"]
    schema = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in carried) + ", sequence_id long, offset long"

    def run(table: pa.Table) -> pa.Table:
        first = table.column("_block")[0].as_py()
        table = table.sort_by([("spread", "ascending"), ("start", "ascending")])
        window, offset = best_fit_decreasing(table.column("length").to_numpy(), capacity)
        out = table.select(carried)
        return out.append_column("sequence_id", pa.array(window + (first << 32))).append_column("offset", pa.array(offset))

    dealt = rests.withColumn("_block", F.pmod(F.xxhash64("spread"), F.lit(blocks)))
    whole = pieces.where("full is not null").select(*carried, F.col("full").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return dealt.groupBy("_block").applyInArrow(run, schema).unionByName(whole)


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """The pieces of all documents with their place, without ids: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Pieces are tokenised once and written without their ids before they are packed, so a lost executor costs no second tokenisation.
    """
    pieces = token_pieces(docs, path, capacity, end_id)
    return pack(written(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces"), capacity)
