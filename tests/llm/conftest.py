from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def texts(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]


#: Nulls, empty and repeated texts and ids, ties, other scripts, special strings; with columns whose names clash.
ODD = [
    (1, None), (2, ""), (3, "a"), (3, "a"), (None, "null id"), (None, None), (4, "Copy Copy copy copy COPY copy"), (5, "copy copy copy copy copy copy"),
    (6, "don't we'll   x\n\n y <|endoftext|> z\t"), (7, "中文 Ωmega İstanbul ſ café café  x 😀" * 3), (8, "word " * 4000), (9, "\x1c\x85 ½ ²"), (10, "x" * 3000),
]


@pytest.fixture(scope="session")
def odd(spark):
    kind = "doc_id long, text string, id string, k long, h long, m string, row long, n int, base double"
    return spark.createDataFrame([(i, t, "x", 1, 1, "x", 1, 1, 0.5) for i, t in ODD], kind).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")
