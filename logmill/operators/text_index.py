"""An inverted index in Parquet: postings by term, in blocks that tell their best possible score.

Each row of the indexed table gives one posting for each of its terms: frequency, length of the row's text, positions. Postings of a term are
sorted by their share of a score and cut into blocks; a block holds its largest frequency and shortest length, which bound the score that any of its
rows can get from the term, for any parameters of BM25. Blocks lie in folders by a hash of the term, so a search opens only those of its words.

Terms are lower-cased runs of letters and digits.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..scratch import removed, scratch_path, small_batches

BUCKETS, BLOCK = 64, 128  # folders, and postings of a block
SPLIT = 100_000  # postings of a term that one task sorts; a term with more is split by rows
TASK_BYTES = 32 << 20  # of postings that a task sorts
K1, B = 1.2, 0.75


def tokens(text: Column | str) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def words_of(query: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in query.lower()).split()


def _share(f, n, mean: Column | float, k1: float, b: float):
    """What a term adds to a score, but for its weight; more with frequency, less with length."""
    return f * (k1 + 1) / (f + k1 * (1 - b + b * n / mean))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the rows (id, row, t) of a batch one row for each term in ``t``, with lists of the rows that hold it: row, id, number of terms ``n``, frequency
    ``f``; ``at`` has the positions of all of them, ``f`` for each."""
    for batch in batches:
        lists = batch.column("t")
        n = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().dictionary_encode()
        if not len(flat):
            continue
        code, owner = flat.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(n)), n)
        at = np.arange(len(code)) - np.repeat(np.cumsum(n) - n, n)
        order = np.argsort(code * len(n) + owner, kind="stable")
        code, owner, at = code[order], owner[order], at[order].astype(np.int32)
        first = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])))
        code, owner, f = code[first], owner[first], np.diff(np.append(first, len(at))).astype(np.int32)
        begin = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        cuts, rows = np.append(begin, len(first)), pa.array(owner)
        many = [batch.column("row").take(rows), batch.column("id").take(rows), pa.array(n[owner].astype(np.int32)), pa.array(f)]
        lists = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values) for values in many]
        positions = pa.ListArray.from_arrays(pa.array(np.append(first, len(at))[cuts], pa.int32()), pa.array(at))
        yield pa.RecordBatch.from_arrays([flat.dictionary.take(pa.array(code[begin])), *lists, positions], names=["term", "row", "id", "n", "f", "at"])


def _blocks(batches: Iterator[pa.RecordBatch], mean: float, block: int) -> Iterator[pa.RecordBatch]:
    """Blocks of the runs (bucket, term, part, and the lists of ``_runs``), which come by term and part."""
    held = None  # runs of the last term and part, which the next batch may go on with
    for batch in batches:
        found = pa.Table.from_batches([batch])
        found = found if held is None else pa.concat_tables([held, found])
        begins = _begins(found)
        last = int(begins[-1]) if len(begins) else 0
        held = found.slice(last)
        if last:
            yield _cut(found.slice(0, last), begins[:-1], mean, block)
    if held is not None and held.num_rows:
        yield _cut(held, _begins(held), mean, block)


def _begins(runs: pa.Table) -> np.ndarray:
    """The first runs of each term and part."""
    if not runs.num_rows:
        return np.zeros(0, np.int64)
    term, part = runs.column("term").combine_chunks().dictionary_encode().indices.to_numpy(), runs.column("part").to_numpy()
    return np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (part[1:] != part[:-1])))


def _cut(runs: pa.Table, begins: np.ndarray, mean: float, block: int) -> pa.RecordBatch:
    of = {c: runs.column(c).combine_chunks() for c in runs.column_names}
    row, ids, n, f, at = (of[c].flatten() for c in ("row", "id", "n", "f", "at"))
    n, f = n.to_numpy(), f.to_numpy()
    long = np.diff(of["row"].offsets.to_numpy())
    group = np.repeat(np.searchsorted(begins, np.arange(runs.num_rows), "right") - 1, long)
    share = _share(f.astype(np.float64), n, mean, K1, B)
    order = np.lexsort((row.to_numpy(), -share, group))
    group, taken = group[order], pa.array(order)
    place = np.arange(len(group)) - np.searchsorted(group, np.arange(len(begins)))[group]
    first = np.flatnonzero(place % block == 0)
    positions = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(f)), pa.int32()), at).take(taken)
    each = pa.StructArray.from_arrays([row.take(taken), ids.take(taken), pa.array(f[order]), pa.array(n[order]), positions], names=["row", "id", "f", "n", "positions"])
    bounds = np.append(first, len(group))
    run = pa.array(begins[group[first]])
    told = {c: of[c].take(run) for c in ("bucket", "term", "part")} | {
        "block": pa.array((place[first] // block).astype(np.int32)), "max_f": pa.array(np.maximum.reduceat(f[order], first)), "min_n": pa.array(np.minimum.reduceat(n[order], first)),
        "size": pa.array(np.diff(bounds)), "postings": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), each),
    }
    return pa.RecordBatch.from_arrays(list(told.values()), names=list(told))


def build_text_index(df: DataFrame, id_col: str, text_col: str, path: str, buckets: int = BUCKETS, block: int = BLOCK, split: int = SPLIT) -> TextIndex:
    """Index every row of ``df`` under ``path``. A null text has no terms; ids may be null or repeat, each row has postings of its own.

    A batch of texts gives one row a term, with all its postings as lists. These rows move once, to the task that cuts their terms into blocks; there are as
    many tasks as let each sort its share in memory. Terms with over ``split`` postings, at most one in ``split``, are told by their counts and sorted in parts.
    """
    spark, raw = df.sparkSession, scratch_path(df.sparkSession, "postings")
    small_batches(spark)
    rows = df.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), tokens(text_col).alias("t"))
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(_runs, f"term string, row array<bigint>, id array<{kind}>, n array<int>, f array<int>, at array<int>")
    found.write.parquet(f"{raw}/runs")
    runs = spark.read.schema(found.schema).parquet(f"{raw}/runs")
    whole = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    found = runs.agg(whole(F.size("at")).alias("tokens"), whole(F.size("row")).alias("postings")).withColumn("docs", F.lit(df.count()))
    found.coalesce(1).write.parquet(f"{path}/stats")
    stats = spark.read.parquet(f"{path}/stats").first()
    mean = max(stats["tokens"], 1) / max(stats["docs"], 1)
    counts = runs.groupBy("term").agg(F.sum(F.size("row")).alias("df"))
    counts.where(F.col("df") > split).select("term", F.ceil(F.col("df") / split).alias("parts")).write.parquet(f"{raw}/hot")
    hot = spark.read.schema("term string, parts long").parquet(f"{raw}/hot")
    dealt = runs.join(F.broadcast(hot) if hot.count() <= split else hot, "term", "left").withColumn("part", F.pmod(F.xxhash64(F.element_at("row", 1)), F.coalesce("parts", F.lit(1))).cast("int"))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(24 * stats["postings"] + 4 * stats["tokens"]) // TASK_BYTES))
    salt = F.pmod(F.xxhash64("term", "part"), F.lit(-(-4 * tasks // buckets)))  # a task gets some folders' shares, not a bit of each folder
    moved = dealt.drop("parts").withColumn("bucket", F.pmod(F.crc32(F.col("term").cast("binary")), F.lit(buckets)).cast("int")).repartition(tasks, "bucket", salt).sortWithinPartitions("bucket", "term", "part")
    posting = f"struct<row: bigint, id: {kind}, f: int, n: int, positions: array<int>>"
    made = moved.mapInArrow(lambda batches: _blocks(batches, mean, block), f"bucket int, term string, part int, block int, max_f int, min_n int, size long, postings array<{posting}>")
    made.write.partitionBy("bucket").parquet(f"{path}/blocks")
    removed(spark, raw)
    return TextIndex(spark, path, buckets)


class TextIndex:
    """An index that ``build_text_index`` has written."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.schema, self.stats = spark.read.parquet(f"{path}/blocks").schema, spark.read.parquet(f"{path}/stats").first()

    def blocks(self, terms: Sequence[str]) -> DataFrame:
        """Blocks of some terms, from their folders alone."""
        folders = sorted({zlib.crc32(t.encode()) % self.buckets for t in terms})
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/blocks").where(F.col("bucket").isin(folders) & F.col("term").isin(*terms))

    def _empty(self, column: str, kind: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/blocks").select(F.inline("postings")).select("id", F.lit(None).cast(kind).alias(column)).limit(0)

    def search(self, query: str, k: int = 10, k1: float = K1, b: float = B) -> DataFrame:
        """The ``k`` best rows by BM25: id, score; ties go by id.

        The first blocks of each word give ``k`` rows that reach some score in part. A block whose bound, with the largest bounds of the other words,
        does not reach that holds no row of the result and is not read.
        """
        words = sorted(set(words_of(query)))
        blocks = self.blocks(words) if words else None
        if not words or k < 1:
            return self._empty("score", "double")
        docs, mean = self.stats["docs"], max(self.stats["tokens"], 1) / max(self.stats["docs"], 1)
        bound = _share(F.col("max_f"), F.col("min_n"), mean, k1, b)
        known = {r["term"]: r for r in blocks.groupBy("term").agg(F.sum("size").alias("df"), F.max(bound).alias("most")).collect()}  # a row a word
        weight = {w: math.log(1 + (docs - r["df"] + 0.5) / (r["df"] + 0.5)) for w, r in known.items()}
        if not known:
            return self._empty("score", "double")
        most = {w: weight[w] * known[w]["most"] for w in known}
        of = lambda values: reduce(lambda c, w: F.when(F.col("term") == w, F.lit(values[w])).otherwise(c), values, F.lit(None).cast("double"))
        scored = lambda read: self._scores(read, sorted(known), of(weight), mean, k1, b)
        place = F.row_number().over(W.partitionBy("term").orderBy(F.desc("_bound"), "part", "block"))
        heads = blocks.select("term", "part", "block", bound.alias("_bound")).withColumn("_r", place).where(F.col("_r") <= -(-k // BLOCK)).select("term", "part", "block")  # postings stay where they are
        first = scored(blocks.join(F.broadcast(heads), ["term", "part", "block"], "left_semi")).orderBy(F.desc("score"), "id").limit(k).agg(F.min("score").alias("s"), F.count(F.lit(1)).alias("n")).first()
        least = first["s"] if first["n"] >= k else 0.0
        total = sum(most.values())
        rest = of({w: total - most[w] for w in known})
        read = blocks.where(of(weight) * bound + rest >= F.lit(least - 1e-9))
        return scored(read).where(F.col("score") >= least - 1e-9).orderBy(F.desc("score"), "id").limit(k)

    def _scores(self, blocks: DataFrame, words: list[str], weight: Column, mean: float, k1: float, b: float) -> DataFrame:
        parts = blocks.select("term", weight.alias("w"), F.inline("postings")).select("term", "row", "id", (F.col("w") * _share(F.col("f"), F.col("n"), mean, k1, b)).alias("part"))
        sums = [F.coalesce(F.max(F.when(F.col("term") == w, F.col("part"))), F.lit(0.0)).alias(f"p{i}") for i, w in enumerate(words)]  # always added in one order
        return parts.groupBy("row").agg(F.first("id").alias("id"), *sums).select("id", reduce(lambda x, y: x + y, [F.col(f"p{i}") for i in range(len(words))]).alias("score"))

    def phrase(self, query: str, k: int | None = None) -> DataFrame:
        """Rows that hold the words one after the other: id, hits (how often); with ``k`` the ``k`` with most hits, ties by id."""
        words = words_of(query)
        if not words:
            return self._empty("hits", "long")
        met = self.blocks(sorted(set(words))).select("term", F.inline("postings"))
        at = met.groupBy("row").agg(F.first("id").alias("id"), *[F.max(F.when(F.col("term") == w, F.col("positions"))).alias(f"p{i}") for i, w in enumerate(words)])
        back = lambda i: F.transform(f"p{i}", lambda x: x - i)  # noqa: E731  where the phrase would begin
        found = at.select("id", F.size(reduce(F.array_intersect, [back(i) for i in range(len(words))])).cast("long").alias("hits")).where("hits > 0")
        return found.orderBy(F.desc("hits"), "id").limit(k) if k else found
