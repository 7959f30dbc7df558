"""Token counts of whole texts without materialising ids.

A byte-level BPE encodes each pre-token by itself, so a text has as many tokens as its pre-tokens have pieces. Pieces are counted once for
each distinct pre-token and summed over the text's pre-token frequencies. The most frequent pre-tokens (a table of bounded size, counted
beforehand over all documents, none over ``LONGEST`` characters) are looked up where the text is read. All other pre-tokens meet by a shuffle on the pre-token itself: there
each distinct one is encoded once, and its pieces go back to the documents that hold it as sums. Hashes only find; characters decide.

Which pre-tokens are in the table decides only the way that a count takes, never the count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_level_starts, code_points, distinct_spans, equal_spans, library, span_hashes, specials
from .common import dropped, most_frequent, partitions, slices, text_or_empty, written

TABLE = 1 << 17  # pre-tokens in the table of frequent ones
LONGEST = 64  # characters of a pre-token in that table, which bounds its bytes; longer ones meet by the shuffle
HELD = 500_000  # distinct pre-tokens whose counts a task holds before it sends them


def _parts(texts: list[str], path: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts cut at added tokens: the parts, the text of each part, and the number of added tokens in each text."""
    special = specials(path)
    added = np.zeros(len(texts), np.int64)
    if not special.ids or not any(s in t for t in texts for s in special.ids):
        return texts, np.arange(len(texts)), added
    parts, owner = [], []
    for i, t in enumerate(texts):
        found = special.split(t)
        added[i] = len(found) // 2
        parts += found[::2]
        owner += [i] * len(found[::2])
    return parts, np.array(owner, np.int64), added


def pre_token_counts(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, "np.ndarray", str]:
    """For a few texts: (text, distinct pre-token, frequency) as three arrays, each distinct pre-token's hash and span, and the joined text."""
    parts, owner, added = _parts(texts, path)
    cps, bounds = code_points(parts)
    starts = byte_level_starts(cps, np.unique(bounds[:-1][np.diff(bounds) > 0]), path)
    ends = np.append(starts[1:], len(cps)) if len(starts) else starts
    hashes, at, kind = distinct_spans(cps, starts, ends)
    text = owner[np.searchsorted(bounds, starts, "right") - 1] if len(starts) else np.zeros(0, np.int64)
    pair, n = np.unique(text * max(1, len(hashes)) + kind, return_counts=True)
    spans = np.stack([starts[at], ends[at]]) if len(starts) else np.zeros((2, 0), np.int64)
    return np.stack([pair // max(1, len(hashes)), pair % max(1, len(hashes)), n]), hashes, spans, added, cps, "".join(parts)


def n_pieces(words: list[str], path: str) -> list[int]:
    """Of pre-tokens, each encoded by the library by itself; special strings cannot be among them."""
    return [len(e.ids) for e in library(path).encode_batch(words, add_special_tokens=False)] if words else []


def frequent_pre_tokens(docs: DataFrame, path: str, text_col: str = "text", table: int = TABLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of at most ``table`` pre-tokens, the most frequent ones of all documents, by rising hash: hashes, numbers of pieces, code points, and
    where each one starts and ends in these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            words, counts = list(seen), list(seen.values())
            for a in range(0, len(words), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(words[a : a + 50_000], pa.string()), pa.array(counts[a : a + 50_000], pa.int64())], names=["piece", "n"])
            seen.clear()

        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in slices(texts):
                (_, kind, n), hashes, spans, _, _, joined = pre_token_counts(texts[a:b], path)
                for (s, e), c in zip(spans.T.tolist(), np.bincount(kind, n, len(hashes)).astype(np.int64).tolist(), strict=True):
                    word = joined[s:e]
                    seen[word] = seen.get(word, 0) + c
                if len(seen) > HELD:
                    yield from sent()
        yield from sent()

    plain = docs.select(text_or_empty(text_col).alias("text"))
    counts = written(plain.mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n")).where("n > 1"), "pieces")
    words = sorted(most_frequent(counts.where(F.length("piece") <= LONGEST), "n", table).select("piece").toPandas()["piece"])
    dropped(counts)
    cps, bounds = code_points(words)
    hashes = span_hashes(cps, bounds[:-1], bounds[1:])
    order = np.argsort(hashes, kind="stable")
    return hashes[order], np.array(n_pieces(words, path), np.int64)[order], cps, bounds[:-1][order], bounds[1:][order]


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text", table: int = TABLE) -> DataFrame:
    """One row per row of ``docs``: its id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    A null text counts as empty: 0 bytes, 0 tokens. Ids may be null or repeat; every row gives its own. Strings of added tokens inside a
    text count as one token each, as the library takes them by default. An empty table gives an empty result. Only the two named
    columns are read.
    """
    spark = docs.sparkSession
    frequent = spark.sparkContext.broadcast(frequent_pre_tokens(docs, path, text_col, table))  # at most ``table`` pre-tokens
    id_type = docs.schema[id_col].dataType.simpleString()

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pieces, letters, begin, end = frequent.value
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts):
                (text, kind, n), hashes, spans, base, cps, joined = pre_token_counts(texts[a:b], path)
                at = np.minimum(np.searchsorted(known, hashes), max(0, len(known) - 1))
                hit = (known[at] == hashes) & equal_spans(cps, *spans, letters, begin[at], end[at]) if len(known) else np.zeros(len(hashes), bool)
                value = np.where(hit, pieces[at], 0) if len(known) else np.zeros(len(hashes), np.int64)
                base += np.bincount(text, n * value[kind], b - a).astype(np.int64)
                rare = np.flatnonzero(~hit)
                place = np.zeros(len(hashes), np.int64)
                place[rare] = np.arange(len(rare))
                words = pa.array([joined[s:e] for s, e in spans.T[rare].tolist()], pa.string())
                left = ~hit[kind]
                owner = text[left]
                rows_per = np.bincount(owner, minlength=b - a)
                # one row for the document itself, with no pre-token, and one for each rare pre-token in it
                own = pa.array(row + np.arange(b - a))
                yield pa.RecordBatch.from_arrays(
                    [own, batch.column(0).slice(a, b - a), pc.binary_length(pc.cast(batch.column(1).slice(a, b - a), pa.binary())).cast(pa.int64()), pa.array(base), _lists(words, place[kind[left]], rows_per), _numbers(n[left], rows_per)],
                    names=["row", "id", "n_bytes", "base", "pieces", "freqs"],
                )
                row += b - a

    plain = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    found = plain.mapInArrow(local, f"row long, id {id_type}, n_bytes long, base long, pieces array<string>, freqs array<int>")
    head = lambda c: F.when(F.coalesce(F.col("pos"), F.lit(0)) == 0, F.col(c)).alias(c)  # noqa: E731  once per document
    apart = found.select("row", "id", "n_bytes", "base", F.posexplode_outer(F.arrays_zip("pieces", "freqs")).alias("pos", "x"))
    apart = apart.select(
        "row", head("id"), head("n_bytes"), head("base"), F.coalesce(F.col("x.freqs"), F.lit(0)).alias("freq"),
        F.coalesce(F.col("x.pieces"), F.concat(F.lit("\n"), F.col("row").cast("string"))).alias("piece"),  # a document with no rare one goes anywhere
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n_last = None, 0
        for batch in batches:
            coded = batch.column("piece").dictionary_encode()
            words = coded.dictionary.to_pylist()
            new = [w for w in words if w != last]
            counts = n_pieces(new, path)
            value = np.array(counts if len(new) == len(words) else [n_last if w == last else counts[k - (k > words.index(last))] for k, w in enumerate(words)], np.int64)
            if len(words):
                last, n_last = words[coded.indices[-1].as_py()], int(value[coded.indices[-1].as_py()])
            add = value[coded.indices.to_numpy()] * batch.column("freq").to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), batch.column("n_bytes"), batch.column("base"), pa.array(add, pa.int64())], names=["row", "id", "n_bytes", "base", "add"])

    met = apart.repartition(partitions(spark), "piece").sortWithinPartitions("piece")
    counted = met.mapInArrow(encode, f"row long, id {id_type}, n_bytes long, base long, add long")
    summed = counted.groupBy("row").agg(F.max("id").alias(id_col), F.max("n_bytes").alias("n_bytes"), (F.max("base") + F.sum("add")).alias("n_tokens"))
    return summed.select(id_col, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _lists(words: pa.Array, at: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), words.take(pa.array(at)))


def _numbers(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values.astype(np.int32)))
