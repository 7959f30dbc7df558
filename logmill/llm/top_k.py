"""Exact top-k search by inner product: histograms of scores, refined until each query's k-th score is known.

Every query of a block is scored against every row, in blocks of rows inside tasks. No list of scores is kept; what tasks send are counts.

1. The scores of a query lie within the product of its norm and the largest norm of all. This range is cut into ``BINS`` bins, tasks count
   their rows in them, and the sums over all tasks tell the bin that holds the k-th score and how many scores lie above it. That bin is the
   next range, until bins are one wide: then the k-th score itself is known.
2. A last pass takes the rows with greater scores, of which there are less than k, and of those with the k-th score the ones with the smallest
   ids that are still wanted. A task sends at most as many of these as are wanted.

Within a task a bin below the task's own k-th row cannot hold the k-th of all and is not counted, so a task sends some k counts a query.
A block of queries is of bounded size (``BLOCK`` rows and ``BLOCK_BYTES``) and is broadcast; blocks follow each other, each over all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import dropped, removed, scratch_path, written

BINS = 256
BLOCK, BLOCK_BYTES = 4096, 16 << 20  # queries of a block, and bytes of their vectors
TOGETHER = 512  # queries whose scores are held at once
LIMIT = 1 << 62  # greater scores count as this


def quantised(flat: np.ndarray, sizes: np.ndarray, dims: int, scale: float) -> np.ndarray:
    """floor(scale * x) of vectors of the given sizes as rows of ``dims`` doubles; components that a vector lacks are 0."""
    out = np.zeros((len(sizes), dims))
    out[np.arange(dims) < sizes[:, None]] = np.floor(scale * flat.astype(np.float64))
    return out


def _rows_of(column: pa.Array, dims: int, scale: float) -> np.ndarray:
    return quantised(column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy()), dims, scale)


def scorer(queries: np.ndarray, largest: float) -> Callable[[np.ndarray], np.ndarray]:
    """rows -> integer inner products with ``queries`` (queries x rows), as floats that hold them exactly or as integers.

    Partial sums stay below the product of the norms, so 32-bit floats are exact below 2**24 and 64-bit ones below 2**53. Beyond, Python's
    integers are taken, and scores stop at ``LIMIT``.
    """
    bound = float(np.sqrt((queries**2).sum(1)).max(initial=0)) * largest * (1 + 1e-9)
    if bound < 1 << 53:
        kind = np.float32 if bound < 1 << 24 else np.float64
        q = queries.astype(kind)
        return lambda rows: q @ rows.astype(kind).T
    whole = np.vectorize(int, otypes=[object])
    q = whole(queries)
    return lambda rows: np.clip(q @ whole(rows).T, -LIMIT, LIMIT).astype(np.int64)


def _parts(n: int) -> Iterator[tuple[int, int]]:
    """Ranges of ``n`` rows: short ones first, which soon tell what need not be looked at."""
    a, step = 0, 256
    while a < n:
        yield a, min(n, a + step)
        a, step = a + step, min(4096, step * 4)


class Block:
    """Queries of a block with what is known of their k-th scores: it lies in [lo, hi), and ``above`` scores are hi or more."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, largest: float, need: int):
        self.rows, self.ids, self.vectors, self.largest, self.need = rows, ids, vectors, largest, need
        reach = np.sqrt((vectors**2).sum(1)) * largest * (1 + 1e-9) + 2
        top = np.minimum(reach, float(LIMIT)).astype(np.int64)
        self.lo, self.hi, self.above = -top, top + 1, np.zeros(len(rows), np.int64)
        self.narrowed()

    def narrowed(self) -> None:
        self.width = -(-(self.hi - self.lo) // BINS)

    @property
    def open(self) -> bool:
        return bool((self.hi - self.lo > 1).any())

    def choose(self, query: np.ndarray, bin_: np.ndarray, above: np.ndarray) -> None:
        """Take for each query the bin that holds its k-th score."""
        self.lo[query] += bin_ * self.width[query]
        self.hi[query] = np.minimum(self.hi[query], self.lo[query] + self.width[query])
        self.above[query] += above
        self.narrowed()


def _scored(block: Block, batch: pa.RecordBatch, dims: int, scale: float, floor: np.ndarray, top: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(a, b, query, row, score): scores of the batch's rows with floor <= score < top; all queries of [a, b) in a part. The own row is left out.
    ``floor`` may rise meanwhile."""
    vectors, own = _rows_of(batch.column("vector"), dims, scale), batch.column("row").to_numpy()
    where = {r: i for i, r in enumerate(block.rows.tolist())}
    mine = np.array([where.get(r, -1) for r in own.tolist()], np.int64)
    score = {q: scorer(block.vectors[q : q + TOGETHER], block.largest) for q in range(0, len(block.rows), TOGETHER)}
    for a, b in _parts(len(own)):
        for q, product in score.items():
            found = product(vectors[a:b])
            n = len(found)
            hit = (found >= floor[q : q + n, None]) & (found < top[q : q + n, None])
            self_at = np.flatnonzero((mine[a:b] >= q) & (mine[a:b] < q + n))
            hit[mine[a:b][self_at] - q, self_at] = False
            x, y = np.nonzero(hit)
            yield q, q + n, x + q, y + a, found[x, y].astype(np.int64)


def histograms(rows: DataFrame, block: Block, dims: int, scale: float) -> DataFrame:
    """query, bin, n: counts of ``rows`` (row, id, vector) in the bins of each query, of all tasks together."""
    shared = rows.sparkSession.sparkContext.broadcast(block)  # of bounded size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        n, need = len(block.rows), block.need - block.above
        counts, floor = np.zeros((n, BINS), np.int64), block.lo.copy()
        floor[block.hi - block.lo <= 1] = np.iinfo(np.int64).max  # known already
        for batch in batches:
            for a, b, query, _, score in _scored(block, batch, dims, scale, floor, block.hi):
                if len(query):
                    at = (query - a) * BINS + (score - block.lo[query]) // block.width[query]
                    counts[a:b] += np.bincount(at, minlength=(b - a) * BINS).reshape(-1, BINS)
                    down = np.cumsum(counts[a:b, ::-1], 1)
                    full = down[:, -1] >= need[a:b]
                    least = BINS - 1 - (down >= need[a:b, None]).argmax(1)
                    floor[a:b] = np.where(full, np.maximum(floor[a:b], block.lo[a:b] + least * block.width[a:b]), floor[a:b])
        query, bin_ = np.nonzero(counts)
        kept = block.lo[query] + bin_ * block.width[query] >= floor[query]
        query, bin_ = query[kept], bin_[kept]
        yield pa.RecordBatch.from_arrays([pa.array(query.astype(np.int32)), pa.array(bin_.astype(np.int32)), pa.array(counts[query, bin_])], names=["query", "bin", "n"])

    return rows.mapInArrow(run, "query int, bin int, n long").groupBy("query", "bin").agg(F.sum("n").alias("n"))


def _refined(rows: DataFrame, block: Block, dims: int, scale: float) -> None:
    """Narrow the ranges of ``block`` once; a row a query comes to the driver."""
    above = rows.sparkSession.createDataFrame([(i, int(a)) for i, a in enumerate(block.above.tolist())], "query int, above long")
    down = F.sum("n").over(W.partitionBy("query").orderBy(F.desc("bin")))
    met = histograms(rows, block, dims, scale).withColumn("down", down).join(F.broadcast(above), "query")
    held = met.where((F.col("down") + F.col("above") >= block.need) & (F.col("down") - F.col("n") + F.col("above") < block.need))
    found = held.select("query", "bin", (F.col("down") - F.col("n")).alias("greater")).toPandas()
    block.choose(found["query"].to_numpy(), found["bin"].to_numpy().astype(np.int64), found["greater"].to_numpy())


def _taken(rows: DataFrame, block: Block, dims: int, scale: float) -> DataFrame:
    """query_id, rank, id, score of the block, whose k-th scores are known."""
    shared = rows.sparkSession.sparkContext.broadcast(block)
    id_type = rows.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        kth, wanted = block.lo, block.need - block.above
        top = np.full(len(kth), np.iinfo(np.int64).max)
        none = np.zeros(0, np.int64)
        equal = [none, none, none.astype(bool)]  # query, id, whether it is null: of rows with the k-th score those that may be wanted
        for batch in batches:
            ids, absent = batch.column("id").cast(pa.int64()).fill_null(0).to_numpy(), batch.column("id").is_null().to_numpy(zero_copy_only=False)
            for _, _, query, row, score in _scored(block, batch, dims, scale, kth, top):
                more = score > kth[query]
                yield sent(query[more], ids[row[more]], absent[row[more]], score[more])
                if not more.all():
                    equal = [np.concatenate(x) for x in zip(equal, (query[~more], ids[row[~more]], absent[row[~more]]), strict=True)]
                    order = np.lexsort((equal[1], equal[2], equal[0]))
                    equal = [x[order] for x in equal]
                    first = np.searchsorted(equal[0], equal[0])
                    kept = np.arange(len(order)) - first < wanted[equal[0]]
                    equal = [x[kept] for x in equal]
        yield sent(*equal, kth[equal[0]])

    def sent(query: np.ndarray, ids: np.ndarray, absent: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(query.astype(np.int32)), pa.array(ids, mask=absent), pa.array(score)], names=["query", "id", "score"])

    names = rows.sparkSession.createDataFrame([(i, x) for i, x in enumerate(block.ids.tolist())], f"query int, query_id {id_type.simpleString()}")
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last()))
    found = rows.mapInArrow(run, "query int, id long, score long").withColumn("rank", rank).where(F.col("rank") <= block.need)
    return found.join(F.broadcast(names), "query").select("query_id", "rank", F.col("id").cast(id_type).alias("id"), "score")


def _query_blocks(queries: DataFrame, size: int) -> tuple[str, int]:
    """``queries`` (row, id, vector) written in a folder for each block of at most ``size`` rows: (path, number of blocks)."""
    spark = queries.sparkSession
    numbered = written(queries.withColumn("_at", F.monotonically_increasing_id()), "queries")
    part = F.shiftright("_at", 33).cast("int")
    sizes = sorted((r["part"], r["n"]) for r in numbered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())  # a row a task
    before = np.cumsum([0, *(n for _, n in sizes)]).tolist()
    places = spark.createDataFrame([(p, b) for (p, _), b in zip(sizes, before, strict=False)], "part int, before long")
    path = scratch_path(spark, "blocks")
    block = F.floor((F.col("before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))) / F.lit(size)).cast("int")
    numbered.withColumn("part", part).join(F.broadcast(places), "part").withColumn("block", block).select("row", "id", "vector", "block").write.partitionBy("block").parquet(path)
    dropped(numbered)
    return path, -(-before[-1] // size)


def top_k_products(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """query_id, rank (from 1), ``id_col``, score: the ``k`` rows with the greatest inner products of each row for which ``is_query`` holds; all,
    if there are fewer.

    Components count as floor(scale * x). Candidates are all rows but the query's own. Ties go to the smaller id (an integer), null ids last.
    Rows with a null vector, a null or non-finite component, or one whose product with ``scale`` is not finite, take no part. Vectors may
    differ in length: missing components count as 0, so an empty vector scores 0. A repeated id is as many rows: each of them is a query of its own
    and a candidate for the others, with ranks for each. A null ``is_query`` is no query. Scores beyond 2**62 count as 2**62. Empty tables, and
    a single row, give an empty result. Other columns are not read.
    """
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType.simpleString()
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double") * scale) == float("inf"))
    valid = vectors.where(F.col(vector_col).isNotNull() & ~F.exists(vector_col, odd))
    rows = written(valid.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("query")), "vectors")
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + F.pow(F.abs(x.cast("double") * scale) + 1, F.lit(2.0)))
    known = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dims"), F.sqrt(F.max(square)).alias("largest"), F.count(F.when(F.col("query"), 1)).alias("queries")).first()
    result = f"query_id {id_type}, rank int, id {id_type}, score long"
    need = min(k, known["n"] - 1)
    if need < 1 or not known["queries"]:
        dropped(rows)
        return spark.createDataFrame([], result).withColumnRenamed("id", id_col)
    dims = max(1, known["dims"])
    candidates = rows.select("row", "id", "vector")
    path, blocks = _query_blocks(rows.where("query").select("row", "id", "vector"), max(1, min(block, BLOCK_BYTES // (8 * dims))))
    out = scratch_path(spark, "top")
    for i in range(blocks):
        own = spark.read.schema(candidates.schema).parquet(f"{path}/block={i}").toArrow().combine_chunks()
        vector = own.column("vector").combine_chunks()
        ids = np.array(own.column("id").to_pylist(), object)
        state = Block(own.column("row").to_numpy(), ids, _rows_of(vector, dims, scale), known["largest"], need)
        while state.open:
            _refined(candidates, state, dims, scale)
        _taken(candidates, state, dims, scale).write.mode("append").parquet(out)
    dropped(rows)
    removed(spark, path)
    return spark.read.schema(result).parquet(out).withColumnRenamed("id", id_col)
