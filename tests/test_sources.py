from __future__ import annotations

import gzip
import json

from pyspark.sql import functions as F

from logmill import sources as S


def test_jsonl(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"message": "é", "logged_at": "2024-01-01 00:00:00.123"}\n\n{"broken\n{"message": "b", "count": 3}\n')
    assert sorted(r["message"] for r in S.read_logs_jsonl(spark, str(tmp_path)).collect()) == ["b", "é"]
    kept = S.read_logs_jsonl(spark, str(tmp_path), mode="keep").cache()
    assert kept.where("_corrupt_record is not null").count() == 1
    S.write_logs_jsonl(S.read_logs_jsonl(spark, str(tmp_path)), str(tmp_path / "out"))
    assert S.read_logs_jsonl(spark, str(tmp_path / "out")).count() == 2


def test_payloads(spark, tmp_path):
    with gzip.open(tmp_path / "p.json.gz", "wt") as f:
        json.dump({"logs": [{"message": "a", "level": 200}, {"message": "b"}]}, f)
    assert sorted(r["message"] for r in S.read_payloads(spark, str(tmp_path)).collect()) == ["a", "b"]


def test_batches(spark):
    df = spark.range(1, 6).select(F.col("id").alias("n"))
    assert {r["n"]: r["batch_no"] for r in S.batch_by_count(df, ["n"], 3).collect()} == {1: 0, 2: 0, 3: 0, 4: 1, 5: 1}
    assert sorted(r["n"] for r in S.retain_newest(df, 3, order=("n",)).collect()) == [3, 4, 5]
    assert S.retain_newest(df, 0).count() == 5


def test_chunks(spark, tmp_path):
    df = spark.createDataFrame([(i, "k", "x" * n) for i, n in enumerate((40, 40, 200, 10, 10))], "seq int, k string, message string")
    out = S.chunk_by_bytes(df, 160, "k", ["seq"])
    assert [r["chunk_no"] for r in out.orderBy("seq").collect()] == [0, 0, 1, 2, 2]
    S.write_payloads(out, str(tmp_path / "p"), ["seq"])
    docs = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "p")).collect()]
    assert sorted(len(d["logs"]) for d in docs) == [1, 2, 2]


def test_lines(spark, tmp_path):
    (tmp_path / "a.log").write_text('[2024-01-01 00:00:01] app.ERROR: first\nsecond line {"a":1}\n[2024-01-01 00:00:02] app.INFO: plain\n')
    got = sorted((r["level_name"], r["message"], r["context"]) for r in S.read_log_lines(spark, str(tmp_path / "a.log")).collect())
    assert got == [("ERROR", "first\nsecond line", '{"a":1}'), ("INFO", "plain", None)]


def test_parquet_is_pruned_by_day(spark, tmp_path):
    df = spark.sql("select 1 as seq, timestamp '2024-01-01 10:00:00' as logged_at union all select 2, timestamp '2024-01-02 10:00:00'")
    S.write_logs_parquet(df, str(tmp_path / "t"))
    one = spark.read.parquet(str(tmp_path / "t")).where("logged_on = date '2024-01-02'")
    assert one.count() == 1 and "PartitionFilters: [isnotnull(logged_on" in one._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
