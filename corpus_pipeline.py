"""From raw documents to packed training windows: five stages, each written as Parquet and read back as the next one's input.

A stage takes (spark, docs, sf_dir). All but the last return the columns of ``documents``. A null text counts as empty and stays null where its
row stays; ids may be null or repeat; an empty table gives an empty one. Ties and repeated rows are told at each stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from logmill.llm.common import dropped, written
from logmill.llm.exact_dedup import drop_exact_copies
from logmill.llm.near_dedup import drop_near_copies
from logmill.llm.packing import pack_documents
from logmill.llm.suffix_dedup import without_repeats
from logmill.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go; the classifier learns from the labelled ones among ``docs``. Equal texts score alike, so repeated rows
    go or stay together. With no labels none goes."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the row with the largest doc_id stays; null ids are the smallest. Of rows with equal id and
    text one stays. Null and empty texts are equal."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies, the row with the smallest doc_id stays; null ids go before it, and rows that share it all stay. Texts with no
    words are near to none."""
    return drop_near_copies(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes inside strings of 200 bytes that occur again go from the texts; every document stays. Nothing depends on the ids or on order."""
    return without_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 2048 tokens. A null or empty text is the one token at its end; each of repeated rows is packed."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("suffix_dedup", suffix_dedup), ("packing", packing)]

ORACLE_SQL = None  # a trained classifier, similarity classes and packing are beyond SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents`` of ``sf_dir``; the last one's result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, sf_dir), name)
        if hasattr(before, "_scratch"):
            dropped(before)
    return STAGES[-1][1](spark, docs, sf_dir)
