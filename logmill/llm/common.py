"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import BATCH_BYTES, small_batches  # noqa: F401  also for the other modules of this subpackage


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is the one that the cluster names in ``spark.checkpoint.dir``; only where that is unset and all runs
    in one local process, as in tests, a new temporary folder is taken. On a cluster it must be set.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-logmill-")
        spark.conf.set("spark.checkpoint.dir", found)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read back, which cuts its lineage.

    A task that is lost later reads the table again instead of running the work above it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def dropped(df: DataFrame) -> None:
    """Remove a table of ``written`` once what was made of it is written itself."""
    removed(df.sparkSession, df._scratch)


def removed(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared one and all in it."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores put before it until no column of ``df`` has it in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        out.append(n)
        taken.add(n.lower())
    return out


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def fold(col: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def slices(texts: Sequence[str], limit: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Ranges [a, b) of ``texts`` with about ``limit`` characters each, one text at least."""
    a = size = 0
    for b, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield a, b
            a, size = b, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)


def joined(left: DataFrame, right: DataFrame, key: str, how: str = "inner", most: int = 1000) -> DataFrame:
    """``left``, a table that is cheap to read, joined with ``right``, which has a row a ``key``.

    Keys that more than one in ``most`` rows of ``left`` carry are at most ``most``; their rows of ``right`` are broadcast, so no task gets
    all of a hot key's rows. All other keys meet by a shuffle.
    """
    least = max(2, left.count() // most + 1)
    hot = written(left.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") >= least).select(key), "hot")
    many = left.join(F.broadcast(hot), key, "left_semi").join(F.broadcast(right.join(F.broadcast(hot), key, "left_semi")), key, how)
    return many.unionByName(left.join(F.broadcast(hot), key, "left_anti").join(right, key, how))


def most_frequent(df: DataFrame, count: str, most: int) -> DataFrame:
    """Rows of ``df`` with the largest ``count``, ``most`` at all: those in the highest classes of counts that fit in wholly.

    A class is a 64th of a power of two wide, so there are some thousand classes at most; only their sizes come to the driver. Unlike a
    sorted limit, no task sends ``most`` rows of its own.
    """
    level = F.floor(F.log2(F.col(count).cast("double")) * 64)
    sizes = df.where(F.col(count) > 0).groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("level")).collect()
    taken, least = 0, None
    for r in sizes:
        if taken + r["n"] > most:
            break
        taken, least = taken + r["n"], r["level"]
    return df.where(F.lit(False)) if least is None else df.where((F.col(count) > 0) & (level >= least))
