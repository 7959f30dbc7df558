"""Batches, size-bounded chunks and payload documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..operators.sequences import Chunks, sequential
from ..schema import LOG_SCHEMA
from ..scratch import scratch_path


def read_payloads(spark: SparkSession, path: str, schema: str = LOG_SCHEMA, whole: bool = False) -> DataFrame:
    """Documents ``{"logs": [...]}``, plain or gzipped, one row per log; a document that is no JSON has none.

    A document is a line, or with ``whole`` a file.
    """
    body = spark.read.text(path, wholetext=whole)
    return body.select(F.inline(F.from_json("value", f"logs array<struct<{schema.replace(chr(10), ' ')}>>")["logs"]))


def batch_by_count(df: DataFrame, order: list[str], n: int = 256) -> DataFrame:
    """``batch_no``: rows in the total order of ``order``, ``n`` to a batch.

    Rows are dealt to ranges of the order once and written with their range, numbered inside each; ranges meet only with their sizes, one
    row a range.
    """
    path = scratch_path(df.sparkSession, "ranges")
    df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    ranged = df.sparkSession.read.parquet(path)
    numbered = ranged.withColumn("_k", F.row_number().over(W.partitionBy("_range").orderBy(*order)))
    sizes = numbered.groupBy("_range").agg(F.max("_k").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    met = numbered.join(F.broadcast(before.drop("_n")), "_range")  # a row a range
    return met.withColumn("batch_no", F.floor((F.col("_before") + F.col("_k") - 1) / n).cast("long")).drop("_range", "_k", "_before")


def chunk_by_bytes(df: DataFrame, max_bytes: int = 524_288, key: str | None = None, order: list[str] | None = None) -> DataFrame:
    """``chunk_no``: rows of a key in order, a new chunk wherever the next row would pass ``max_bytes`` of JSON; a larger row is alone.

    Without a key each task's rows are a sequence of their own and chunks are named by task. A key of many rows is cut into ranges that are walked
    apart (``sequential``).
    """
    own = F.col(key).cast("string") if key else F.spark_partition_id().cast("string")
    rows = df.withColumn("chunk_key", own)
    found = sequential(rows, "chunk_key", order or [], Chunks(max_bytes), size=F.octet_length(F.to_json(F.struct(*df.columns))), dealt=not key)
    return found.withColumn("chunk_no", F.col("_number") - 1).drop("_opens", "_number", "_start")


def write_payloads(chunks: DataFrame, path: str, order: list[str] | None = None, mode: str = "append") -> None:
    """One document per chunk, a line each, gzipped. ``order``: columns that order a chunk's rows."""
    rows = [c for c in chunks.columns if c not in ("chunk_key", "chunk_no")]
    item = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order or [])], F.struct(*rows).alias("row"))
    logs = F.transform(F.sort_array(F.collect_list(item)) if order else F.collect_list(item), lambda x: x["row"])
    chunks.groupBy("chunk_key", "chunk_no").agg(logs.alias("logs")).select(F.to_json(F.struct("logs")).alias("value")).write.mode(mode).text(path, compression="gzip")


def retain_newest(df: DataFrame, n: int = 5000, by: str | None = None, order: tuple[str, ...] = ("logged_at", "seq")) -> DataFrame:
    """The newest ``n`` rows, or of each key of ``by``; 0 or less keeps all."""
    if n <= 0:
        return df
    newest = [F.desc(c) for c in order]
    if by is None:
        return df.orderBy(*newest).limit(n)
    return df.withColumn("_k", F.row_number().over(W.partitionBy(by).orderBy(*newest))).where(F.col("_k") <= n).drop("_k")
