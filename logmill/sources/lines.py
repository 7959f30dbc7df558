"""The plain-text form: ``[time] channel.LEVEL: message {context} {extra}``; messages may go on over lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_lines(df: DataFrame, value: str = "value") -> DataFrame:
    """logged_at, channel, level_name, message, context, extra of records; text that is no record gives no row."""
    text = F.regexp_replace(value, r"^\[?", "[")
    head = r"(?s)^\[(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d(?:\.\d+)?)\] ([^.\s]+)\.([A-Z]+): (.*?)\s*$"
    x = lambda i: F.regexp_extract("_text", head, i)
    rows = df.select(text.alias("_text")).where(F.col("_text").rlike(head)).select(x(1).alias("t"), x(2).alias("channel"), x(3).alias("level_name"), x(4).alias("rest"))
    tail = r"(?s)^(.*?)(?: (\{\".*?\}))?(?: (\{\".*\}))?$"
    y = lambda i: F.nullif(F.regexp_extract("rest", tail, i), F.lit(""))
    return rows.select(F.try_to_timestamp("t").alias("logged_at"), "channel", "level_name", F.coalesce(y(1), F.lit("")).alias("message"), y(2).alias("context"), y(3).alias("extra"))


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """A record starts at a line that starts with ``[``; further lines belong to its message."""
    return parse_lines(spark.read.text(path, lineSep="\n["))


def format_lines(df: DataFrame) -> DataFrame:
    """One column, value; empty context and extra are left out."""
    part = lambda c: F.when(F.col(c).isNull() | F.col(c).isin("", "{}", "[]"), F.lit("")).otherwise(F.concat(F.lit(" "), F.col(c)))
    return df.select(F.concat(F.lit("["), F.date_format("logged_at", "yyyy-MM-dd HH:mm:ss"), F.lit("] "), "channel", F.lit("."), F.upper("level_name"), F.lit(": "), "message", part("context"), part("extra")).alias("value"))


def write_log_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    format_lines(df).write.mode(mode).text(path)
