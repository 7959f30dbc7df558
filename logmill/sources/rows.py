"""Log rows as JSON lines and as Parquet, in batches and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import LOG_SCHEMA


def read_logs_jsonl(spark: SparkSession, path: str, schema: str = LOG_SCHEMA, mode: str = "drop") -> DataFrame:
    """One JSON object per line; blank lines are no rows. ``drop`` loses lines that are no JSON, ``keep`` has them in ``_corrupt_record``."""
    if mode == "drop":
        return spark.read.schema(schema).json(path, mode="DROPMALFORMED")
    full = T._parse_datatype_string(schema).add("_corrupt_record", T.StringType())
    return spark.read.schema(full).json(path, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record")


def read_log_stream(spark: SparkSession, path: str, max_files: int = 1, schema: str = LOG_SCHEMA) -> DataFrame:
    """JSON-lines files of a folder as a stream, the oldest first; the checkpoint's offsets give each file to one batch only."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(path)


def write_logs_jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path, compression="gzip")


def write_logs_parquet(df: DataFrame, path: str, mode: str = "append") -> None:
    """Partitioned by the day of logged_at, so that time conditions prune folders."""
    df.withColumn("logged_on", F.to_date("logged_at")).write.mode(mode).partitionBy("logged_on").parquet(path)
