"""Where streams keep offsets, state and results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names for driver and executors; where it is unset and all is local, a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-logmill-")
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def removed(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared one and all in it."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


BATCH_BYTES = 4 << 20  # of an Arrow batch of texts


def small_batches(spark: SparkSession) -> None:
    """Have Arrow batches end at ``BATCH_BYTES``, so that a worker and the JVM beside it hold few texts at a time, however long these are."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(str(spark.conf.get(name)).lower().rstrip("b")) > BATCH_BYTES:
        spark.conf.set(name, BATCH_BYTES)


def drained(stream: DataFrame) -> DataFrame:
    """All that a stream over finished files gives: written to a Parquet sink and read back."""
    spark = stream.sparkSession
    path = scratch_path(spark, "stream")
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", scratch_path(spark, "offsets")).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
