"""Indexes of texts and vectors, and percentiles by ranks, against plain scans."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from logmill.operators import ranks, search
from logmill.operators.text_index import TextIndex, build_text_index
from logmill.operators.vector_index import VectorIndex, build_vector_index


@pytest.fixture(scope="module")
def docs(spark, sf):
    odd = [(-1, None), (-2, ""), (None, "the idiot of the house"), (7, "the the of the of the, OF THE"), (7, "the the of the of the, OF THE"), (-3, "Ünïcode wörds 中文 x1")]
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string")).repartition(3)


@pytest.fixture(scope="module")
def index(spark, docs, tmp_path_factory):
    return build_text_index(docs, "doc_id", "text", str(tmp_path_factory.mktemp("index") / "x"), buckets=8, block=4, split=40)


@pytest.mark.parametrize("query", ["the idiot", "of", "Wörds", "and the of in", "nosuchword", "nosuchword the", ""])
@pytest.mark.parametrize(("k", "k1", "b"), [(10, 1.2, 0.75), (3, 2.0, 0.1), (10_000, 1.2, 0.75)])
def test_bm25_by_index(docs, index, query, k, k1, b):
    want = [(r.doc_id, round(r.score, 9)) for r in search.search_text(docs, query, "doc_id", "text", k, k1, b).collect()]
    got = [(r.id, round(r.score, 9)) for r in index.search(query, k, k1, b).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_index_of_every_row(spark, docs, index):
    rows = docs.select(F.explode(F.array_distinct(F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: t != ""))).alias("t")).groupBy("t").count()
    blocks = spark.read.parquet(f"{index.path}/blocks")
    assert {r["t"]: r["count"] for r in rows.collect()} == {r["term"]: r["n"] for r in blocks.groupBy("term").agg(F.sum("size").alias("n")).collect()}
    assert blocks.agg(F.max("size")).first()[0] == 4 and blocks.where("term = 'the'").agg(F.max("part")).first()[0] > 0
    assert TextIndex(spark, index.path, 8).search("idiot", 3).collect() == index.search("idiot", 3).collect()


def test_only_folders_of_the_words_are_opened(index):
    files = {r[0].split("bucket=")[1].split("/")[0] for r in index.blocks(["idiot"]).select(F.input_file_name()).distinct().collect()}
    assert len(files) == 1
    assert "PartitionFilters: [bucket" in index.blocks(["idiot"])._jdf.queryExecution().toString().replace("isnotnull(bucket#", "bucket#")


def test_blocks_below_the_bound_are_not_read(index, monkeypatch):
    read, real = [], TextIndex._scores
    monkeypatch.setattr(TextIndex, "_scores", lambda self, blocks, *rest: read.append(blocks.count()) or real(self, blocks, *rest))
    index.search("the", 3).collect()
    assert read[-1] < index.blocks(["the"]).count()


@pytest.mark.parametrize("phrase", ["of the", "the of the", "idiot", "中文 x1", "no such", "the the"])
def test_phrases(docs, index, phrase):
    words, want = phrase.split(), []
    for r in docs.collect():
        t = [x for x in "".join(c if c.isalnum() else " " for c in (r.text or "").lower()).split()]
        n = sum(t[i : i + len(words)] == words for i in range(len(t)))
        want += [(r.doc_id, n)] if n else []
    assert sorted(((r.id, r.hits) for r in index.phrase(phrase).collect()), key=repr) == sorted(want, key=repr)
    best = sorted(want, key=lambda x: (-x[1], x[0] is not None, x[0]))[:2]
    assert [(r.id, r.hits) for r in index.phrase(phrase, 2).collect()] == best


def test_neighbours(spark, tmp_path):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    odd = spark.createDataFrame([(-1, None), (-2, [0.0] * 64), (-3, [float("nan")] * 64), (-4, [None] * 64)], rows.schema)
    built = build_vector_index(rows.union(odd), str(tmp_path / "v"))
    index = VectorIndex.read(spark, built.path)
    assert (index.probes, index.recall) == (built.probes, built.recall) and index.recall >= 0.95
    assert spark.read.parquet(f"{index.path}/lists").count() == rows.count()  # every row
    rng, found, all_ = np.random.default_rng(9), 0, 0
    vectors = [r.embedding for r in rows.where("vec_id % 97 = 0").collect()][:12] + rng.normal(size=(6, 64)).tolist()
    for v in vectors:
        exact = {r.vec_id for r in search.search_semantic(rows, v).collect()}
        near = index.search(v).collect()
        assert [r.score for r in near] == sorted((r.score for r in near), reverse=True)
        found, all_ = found + len(exact & {r.id for r in near}), all_ + len(exact)
    assert found / all_ >= 0.9, found / all_


def test_one_list_may_hold_most_rows(spark, tmp_path):
    rows = spark.range(3000).selectExpr("id as vec_id", "if(id < 2500, array(1.0D, 0.0D), array(cos(id), sin(id))) as embedding")
    index = build_vector_index(rows, str(tmp_path / "v"), lists=12)
    assert [r.id for r in index.search([1.0, 0.0], 5).collect()] == [0, 1, 2, 3, 4]
    files = spark.read.parquet(f"{index.path}/lists").select("list", F.input_file_name().alias("f")).groupBy("list").agg(F.countDistinct("f").alias("n"), F.count("*").alias("rows")).orderBy(F.desc("rows")).first()
    assert files["rows"] >= 2500 and files["n"] > 1


@pytest.mark.parametrize("few", [ranks.FEW, 0])
def test_percentiles_by_ranks(spark, monkeypatch, few):
    monkeypatch.setattr(ranks, "FEW", few)
    rng = np.random.default_rng(5)
    rows = [("normal", float(x)) for x in rng.normal(size=700)] + [("ties", float(x)) for x in rng.integers(0, 4, 500)] + [("wide", float(10.0 ** rng.integers(-300, 300))) for _ in range(300)]
    rows += [("few", 1.0), ("few", 2.0), (None, 5.0), ("nan", float("nan")), ("null", None), ("one", 3.0)] + [("same", 7.0)] * 200 + [("ends", -1.7e308), ("ends", 1.7e308)] * 50
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    wanted = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    want = df.where("not isnan(v)").groupBy("g").agg(*[F.percentile("v", p).alias(c) for c, p in wanted.items()], F.count("v").alias("n")).where("n > 0")
    got = ranks.exact_percentiles(df, ["g"], "v", wanted, small=20, bins=16)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.select("g", *wanted, "n").collect()), key=repr)
    all_ = ranks.exact_percentiles(df.where("g = 'normal'"), [], "v", wanted, small=20, bins=16).collect()
    assert [tuple(r) for r in all_] == [tuple(df.where("g = 'normal'").agg(*[F.percentile("v", p) for p in wanted.values()], F.count("v")).first())]
    assert [tuple(r) for r in ranks.exact_percentiles(df.limit(0), [], "v", wanted).collect()] == [(None, None, None, None, 0)]
    assert ranks.exact_percentiles(df.limit(0), ["g"], "v", wanted).collect() == []


def test_blocks_do_not_depend_on_batches(spark, index):
    """A batch of texts is one row a term, and a term's runs may lie in several Arrow batches; these end at 4 MiB."""
    import pyarrow as pa

    from logmill.operators import text_index

    texts = [["a", "b", "a"], [], ["b"], ["a"] * 5, ["c", "a"]]
    batch = pa.record_batch([pa.array([5, None, 7, 7, 9]), pa.array([10, 11, 12, 13, 14]), pa.array(texts)], names=["id", "row", "t"])
    runs = pa.Table.from_batches(text_index._runs([batch, batch.slice(2, 3)])).to_pandas()
    assert sorted(runs["term"]) == ["a", "a", "b", "b", "c", "c"] and runs["row"].map(len).sum() == 6 + 4
    found = pa.Table.from_pandas(runs.sort_values("term", kind="stable").assign(bucket=0, part=0), preserve_index=False)
    cut = lambda rows: pa.Table.from_batches(text_index._blocks(found.to_batches(max_chunksize=rows), 2.0, 2)).to_pylist()
    blocks = cut(1)
    assert blocks == cut(100) and [(b["term"], b["block"], b["size"]) for b in blocks] == [("a", 0, 2), ("a", 1, 2), ("a", 2, 1), ("b", 0, 2), ("b", 1, 1), ("c", 0, 2)]
    assert all(len(p["positions"]) == p["f"] <= b["max_f"] and p["n"] >= b["min_n"] for b in blocks for p in b["postings"])
    assert int(str(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")).lower().rstrip("b")) <= 4 << 20
