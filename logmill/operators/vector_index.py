"""Approximate nearest neighbours by cosine: inverted lists around centroids, with exact ranking of what is looked at.

Centroids are fitted to a bounded sample (``SAMPLE`` rows). Every row of the table is in the list of its nearest centroid; a list is a folder. A search
opens the lists of the centroids nearest to its vector. How many these are is measured when the index is built: for ``QUERIES`` sampled rows the
true neighbours are found over all rows, and as many lists are opened as hold the wanted share of them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .search import cosine

SAMPLE, QUERIES = 20_000, 64  # rows that centroids are fitted to, and rows whose neighbours are looked for to measure recall
MOST_LISTS = 1024


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.sqrt((vectors**2).sum(1, keepdims=True)), 1e-300)


def centroids_of(sample: np.ndarray, lists: int, rounds: int = 12, seed: int = 1) -> np.ndarray:
    """Spherical k-means. A centroid without rows takes the row that is farthest from its own."""
    rng, x = np.random.default_rng(seed), _unit(sample)
    found = x[rng.choice(len(x), lists, replace=False)]
    for _ in range(rounds):
        near = x @ found.T
        own = near.argmax(1)
        sums = np.zeros_like(found)
        np.add.at(sums, own, x)
        empty = np.flatnonzero(np.bincount(own, minlength=lists) == 0)
        sums[empty] = x[np.argsort(near.max(1), kind="stable")[: len(empty)]]
        found = _unit(sums)
    return found


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def build_vector_index(df: DataFrame, path: str, id_col: str = "vec_id", vector_col: str = "embedding", lists: int | None = None, k: int = 10, recall: float = 0.95, sample: int = SAMPLE) -> VectorIndex:
    """Index all rows of ``df`` under ``path``; ``recall`` of the ``k`` nearest is aimed at.

    Rows with a null or zero vector, or a null or non-finite component, are near nothing and left out; all other vectors must have one length.
    ``lists``: by default the square root of the number of rows, ``MOST_LISTS`` at most. A list that holds many rows is several files.
    """
    spark = df.sparkSession
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).where(F.col("vector").isNotNull() & ~F.exists("vector", odd) & F.exists("vector", lambda x: x != 0))
    total = rows.count()
    if not total:
        raise ValueError("no vector to index")
    share = min(1.0, 1.2 * sample / total)
    some = (rows.sample(share, seed=1) if share < 1 else rows).limit(sample).select("vector").toArrow().combine_chunks()  # at most ``sample`` rows
    known = _matrix(some.column("vector").combine_chunks())
    n = max(1, min(lists or int(total**0.5), MOST_LISTS, len(known)))
    centres = centroids_of(known, n)
    shared = spark.sparkContext.broadcast(centres)  # at most ``MOST_LISTS`` vectors

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = (_unit(_matrix(batch.column("vector"))) @ shared.value.T).argmax(1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32))], names=["id", "vector", "list"])

    kinds = f"id {rows.schema['id'].dataType.simpleString()}, vector {rows.schema['vector'].dataType.simpleString()}, list int"
    dealt = rows.mapInArrow(assign, kinds).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "list", F.xxhash64("id", "vector"))  # so a large list is dealt to several tasks
    dealt.write.partitionBy("list").parquet(f"{path}/lists")
    asked = known[np.random.default_rng(2).choice(len(known), min(QUERIES, len(known)), replace=False)]
    index = VectorIndex(spark, path, centres, 1, 0.0)
    index.probes, index.recall = index.measured(asked, k, recall)
    told = json.dumps({"centroids": centres.tolist(), "probes": index.probes, "recall": index.recall})
    spark.createDataFrame([(told,)], "value string").coalesce(1).write.text(f"{path}/centroids")
    return index


class VectorIndex:
    """An index that ``build_vector_index`` has written; ``recall`` is what ``probes`` lists gave in its measurement."""

    def __init__(self, spark: SparkSession, path: str, centres: np.ndarray, probes: int, recall: float):
        self.spark, self.path, self.centres, self.probes, self.recall = spark, path, centres, probes, recall

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> VectorIndex:
        told = json.loads(spark.read.text(f"{path}/centroids").first()["value"])
        return cls(spark, path, np.array(told["centroids"]), told["probes"], told["recall"])

    def _order(self, vectors: np.ndarray) -> np.ndarray:
        """The lists of each vector, nearest centroid first."""
        return np.argsort(-(_unit(vectors) @ self.centres.T), axis=1, kind="stable")

    def search(self, vector: Sequence[float], k: int = 10, probes: int | None = None) -> DataFrame:
        """id, score: the ``k`` nearest by cosine in the ``probes`` nearest lists; ties by id."""
        near = self._order(np.array([vector], float))[0][: probes or self.probes].tolist()
        rows = self.spark.read.parquet(f"{self.path}/lists").where(F.col("list").isin(near))
        return rows.select("id", cosine("vector", vector).alias("score")).orderBy(F.desc("score"), "id").limit(k)

    def measured(self, vectors: np.ndarray, k: int, wanted: float) -> tuple[int, float]:
        """(probes, recall): the least number of lists that hold the share ``wanted`` of the true ``k`` nearest of ``vectors``, found over all rows."""
        shared, size = self.spark.sparkContext.broadcast(_unit(vectors)), len(vectors)  # ``QUERIES`` vectors

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    near = shared.value @ _unit(_matrix(batch.column("vector"))).T
                    top = np.argpartition(-near, min(k, near.shape[1]) - 1, axis=1)[:, :k]
                    query = np.repeat(np.arange(size), top.shape[1]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(near[query, top.reshape(-1)]), batch.column("list").take(pa.array(top.reshape(-1)))], names=["query", "score", "list"])

        rows = self.spark.read.parquet(f"{self.path}/lists").select("vector", "list")
        ranked = rows.mapInArrow(best, "query int, score double, list int").withColumn("r", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "list")))
        found = ranked.where(F.col("r") <= k).select("query", "list").toPandas()  # ``k`` rows a query
        place = np.argsort(self._order(vectors), axis=1)
        needed = np.sort(place[found["query"].to_numpy(), found["list"].to_numpy()])
        probes = int(needed[int(np.ceil(wanted * len(needed))) - 1]) + 1
        return probes, float((needed < probes).mean())
