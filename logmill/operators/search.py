"""Exact, lexical, vector and fused search."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..schema import LEVELS
from ..scratch import removed, scratch_path


def search_by_field(df: DataFrame, field: str, value: object) -> DataFrame:
    return df.where(F.col(field) == value)


def search_advanced(df: DataFrame, level: str | None = None, route: str | None = None, since: str | None = None, until: str | None = None, mentions: str | None = None) -> DataFrame:
    """All given conditions; ``mentions`` is looked for in file, method, stack trace and message. Times are [since, until)."""
    tests = []
    if level:
        tests.append(F.col("level") >= LEVELS[level])
    if route:
        tests.append(F.col("route_name") == route)
    if since:
        tests.append(F.col("logged_at") >= F.lit(since).cast(df.schema["logged_at"].dataType))
    if until:
        tests.append(F.col("logged_at") < F.lit(until).cast(df.schema["logged_at"].dataType))
    if mentions:
        tests.append(reduce(lambda a, b: a | b, [F.coalesce(F.col(c).contains(mentions), F.lit(False)) for c in ("caller_file", "caller_method", "stacktrace", "message")]))
    return reduce(lambda d, t: d.where(t), tests, df)


def search_by_json(df: DataFrame, path: str, value: str) -> DataFrame:
    """``path``: column and keys, such as ``context.order_id``. Text that is no JSON has no values."""
    column, _, keys = path.partition(".")
    return df.where(F.get_json_object(column, "$." + keys) == value)


def _times(tokens: str, word: str):
    return F.size(F.filter(tokens, lambda t: t == word))


def search_text(df: DataFrame, query: str, id_col: str, text_col: str, k: int = 10, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """The ``k`` best rows by BM25: id, score. Words are lower-cased runs of letters and digits; ties go by id.

    One pass over all texts, for a query now and then; for many, ``build_text_index``. Texts are split once: length and frequency of each of the
    query's words go to a narrow table in the shared folder, statistics and scores come from that, and it is removed.
    """
    words = sorted({w for w in "".join(c if c.isalnum() else " " for c in query.lower()).split()})
    if not words:
        return df.select(id_col, F.lit(0.0).alias("score")).limit(0)
    tokens = F.filter(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: t != "")
    path = scratch_path(df.sparkSession, "words")
    df.select(id_col, tokens.alias("t")).select(id_col, F.size("t").alias("n"), *[_times("t", w).alias(f"f{i}") for i, w in enumerate(words)]).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    stats = rows.agg(F.count(F.lit(1)).alias("docs"), F.avg("n").alias("mean"), *[F.count(F.when(F.col(f"f{i}") > 0, 1)).alias(f"d{i}") for i in range(len(words))])
    met = rows.where(reduce(lambda x, y: x | y, [F.col(f"f{i}") > 0 for i in range(len(words))])).join(F.broadcast(stats))  # one row
    part = lambda i: F.log(1 + (F.col("docs") - F.col(f"d{i}") + 0.5) / (F.col(f"d{i}") + 0.5)) * F.col(f"f{i}") * (k1 + 1) / (F.col(f"f{i}") + k1 * (1 - b + b * F.col("n") / F.col("mean")))
    score = reduce(lambda x, y: x + y, [part(i) for i in range(len(words))])
    best = met.select(id_col, score.alias("score")).orderBy(F.desc("score"), id_col).limit(k)
    found = scratch_path(df.sparkSession, "found")
    best.write.parquet(found)
    removed(df.sparkSession, path)
    return df.sparkSession.read.schema(best.schema).parquet(found)


def cosine(vector: str, query: Sequence[float]):
    q = F.array(*[F.lit(float(x)) for x in query])
    dot = F.aggregate(F.zip_with(vector, q, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    norm = F.sqrt(F.aggregate(F.transform(vector, lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda s, x: s + x))
    size = sum(float(x) ** 2 for x in query) ** 0.5
    return F.try_divide(dot, norm * F.lit(size))


def search_semantic(df: DataFrame, vector: Sequence[float], id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10) -> DataFrame:
    """The ``k`` rows nearest by cosine: id, score; a null or zero vector is nowhere near."""
    return df.select(id_col, cosine(vector_col, vector).alias("score")).where("score is not null").orderBy(F.desc("score"), id_col).limit(k)


def search_hybrid(lexical: DataFrame, semantic: DataFrame, id_col: str, k: int = 10, c: int = 60) -> DataFrame:
    """Reciprocal rank fusion of two short rankings (id, score): id, score, source."""
    rank = lambda d: d.select(id_col, F.row_number().over(W.orderBy(F.desc("score"), id_col)).alias("r"))  # noqa: E731  both are top-k results
    a, b = rank(lexical).withColumnRenamed("r", "_a"), rank(semantic).withColumnRenamed("r", "_b")
    met = a.join(b, id_col, "full")
    share = lambda r: F.coalesce(1.0 / (c + F.col(r)), F.lit(0.0))
    source = F.when(F.col("_a").isNull(), "semantic").when(F.col("_b").isNull(), "lexical").otherwise("both")
    return met.select(id_col, (share("_a") + share("_b")).alias("score"), source.alias("source")).orderBy(F.desc("score"), id_col).limit(k)
