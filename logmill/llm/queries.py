"""The registered queries of this subpackage, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .align import align_tokens
from .codec import encode_and_decode
from .exact_dedup import exact_groups
from .fuzzy_hash import compare_with_edits
from .lm import score_texts
from .near_dedup import near_classes
from .packing import pack_documents
from .periods import periodic_runs, strongest
from .suffix_dedup import repeat_report
from .token_counts import count_tokens
from .top_k import top_k_products
from .toxicity import toxicity
from .warc import archive_and_read_back


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = archive_and_read_back(_table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = encode_and_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(_table(spark, sf_dir, "documents"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = compare_with_edits(_table(spark, sf_dir, "documents"))
    return both.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_report(_table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_table(spark, sf_dir, "documents"))


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k_products(_table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(20)) == 0, k=20, scale=64.0)


def made_periodic(doc_id: object, words: list[str]) -> list[str]:
    """The words of a document; of every tenth one by a hash of its id, those from some word on repeat with a period."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op13_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_table(spark, sf_dir, "documents"), edit=made_periodic).withColumn("best", strongest())
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_toxicity": op2_toxicity,
    "op3_packing": op3_packing,
    "op4_bpe_codec": op4_bpe_codec,
    "op5_token_counts": op5_token_counts,
    "op6_near_dedup": op6_near_dedup,
    "op7_fingerprints": op7_fingerprints,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_lm_scores": op10_lm_scores,
    "op11_alignment": op11_alignment,
    "op12_top_k": op12_top_k,
    "op13_periods": op13_periods,
}

ORACLE_SQL: dict[str, str] = {
    "op1_warc": """
        WITH p AS (
          SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
          FROM pages),
        g AS (
          SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
        FROM g""",
    "op9_exact_dedup": """
        WITH t AS (
          SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
          FROM documents)
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept,
               text_sha256
        FROM t""",
    "op12_top_k": """
        WITH v AS (
          SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS q
          FROM embeddings
          WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
          SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
          FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
        r AS (
          SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
          FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
}
