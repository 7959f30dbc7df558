"""Streams over finished tables give what the batch operators give."""

from __future__ import annotations

from pyspark.sql import functions as F

from logmill.operators import dedup
from logmill.plans import QUERIES, views


def same(a, b, columns):
    return sorted(map(tuple, a.select(*columns).collect()), key=repr) == sorted(map(tuple, b.select(*columns).collect()), key=repr)


def test_debounce(spark, sf):
    assert same(QUERIES["w4_stream_debounce"](spark, sf), QUERIES["d6_debounce"](spark, sf), ["seq", "user_id"])


def test_windows(spark, sf):
    assert same(QUERIES["w5_stream_count_or_time"](spark, sf), QUERIES["d7_count_or_time_windows"](spark, sf), ["seq", "user_id", "window_no"])


def test_rate_cap(spark, sf):
    rows = views.storm(spark, sf).where("level >= 300").withColumn("fingerprint", dedup.fingerprint()).withColumn("logged_at", F.col("logged_at").cast("timestamp"))
    assert same(QUERIES["w3_stream_rate_cap"](spark, sf), dedup.rate_cap(rows, 1, 86_400), ["seq", "suppressed_count"])


def stream_of(spark, folder, batches):
    """A stream with a batch of (seq, second, fingerprint) rows from each file, the oldest file first."""
    import os

    kind = "seq long, logged_at timestamp, fingerprint string"
    for k, rows in enumerate(batches):
        path = f"{folder}/{k}"
        spark.createDataFrame(rows, kind).coalesce(1).write.json(path)
        name = next(f for f in os.listdir(path) if f.endswith(".json"))
        os.makedirs(f"{folder}/all", exist_ok=True)
        os.rename(f"{path}/{name}", f"{folder}/all/{k}.json")
        os.utime(f"{folder}/all/{k}.json", (1_700_000_000 + k, 1_700_000_000 + k))
    return spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).json(f"{folder}/all")


def at(seconds):
    import datetime

    return datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=seconds)


def ran(stream, folder):
    """All batches of ``stream``: its rows, and the folder of its states."""
    stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/states").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out").collect(), f"{folder}/states"


def states(spark, path, name):
    """Keys that still have the state ``name``."""
    return {tuple(r["key"])[0] for r in spark.read.format("statestore").option("path", path).option("stateVarName", name).load().collect()}


def batches(rnd, keys, n, parts, spread):
    """Rows by time, shuffled within each batch, with batches that overlap by less than the watermark's minute."""
    rows = sorted((rnd.randrange(spread), i) for i in range(n))
    size = n // parts
    cut = [[(i, at(t), rnd.choice(keys)) for t, i in rows[a : a + size]] for a in range(0, n, size)]
    for part in cut:
        rnd.shuffle(part)
    return cut


def test_debounce_over_batches(spark, tmp_path):
    """Batches in order of time with shuffled rows; markers go by themselves a minute after their window."""
    import random

    from logmill.streaming import stream_debounce

    parts = batches(random.Random(5), "abc", 240, 4, 3000) + [[(1000, at(9000), "z")], [(1001, at(9001), "z")]]
    rows, path = ran(stream_debounce(stream_of(spark, tmp_path, parts), "fingerprint", 50), tmp_path)
    want, end = set(), {}
    for i, t, k in sorted((r for p in parts for r in p), key=lambda r: (r[1], r[0])):
        if k not in end or (t - end[k]).total_seconds() >= 50:
            want.add(i)
            end[k] = t
    assert {r.seq for r in rows} == want and states(spark, path, "marker") == {"z"}


def test_parts_of_the_cap_expire_apart(spark, tmp_path):
    """Counter after 60 s, sample slot after its own length, tally after 900 s: each goes when its own life is over, with no further row of its key."""
    from logmill.streaming import stream_rate_cap

    storm = [(i, at(i / 10), "a") for i in range(40)]
    for until, left in ((90, {"counter", "slot", "tally"}), (130, {"slot", "tally"}), (400, {"tally"}), (1200, set())):
        folder = tmp_path / str(until)
        folder.mkdir()
        parts = [storm[:20], storm[20:], [(100, at(until), "other")], [(101, at(until), "other")]]
        rows, path = ran(stream_rate_cap(stream_of(spark, folder, parts), 3, 200), folder)
        assert len([r for r in rows if r.fingerprint == "a"]) == 4
        assert {name for name in ("counter", "slot", "tally") if "a" in states(spark, path, name)} == left, until


def test_a_late_batch_does_not_shorten_a_life(spark, tmp_path):
    from logmill.streaming import stream_debounce

    parts = [[(0, at(100), "a")], [(1, at(60), "a")], [(2, at(195), "other")], [(3, at(195), "other")]]
    rows, path = ran(stream_debounce(stream_of(spark, tmp_path, parts), "fingerprint", 10), tmp_path)
    assert 0 in {r.seq for r in rows} and "a" in states(spark, path, "marker")  # until 100 + 10 + 60 s, behind the watermark of 135


def test_n_plus_one_over_batches(spark, tmp_path):
    """The fifth run is told once although runs come in several batches out of order; a span's count goes after its life."""
    from logmill.streaming import stream_n_plus_one

    runs = [(i, at(t), "span") for i, t in enumerate((5, 1, 30, 20, 45, 60, 50))]
    parts = [runs[:3], runs[3:6], runs[6:], [(50, at(2000), "next")], [(51, at(2000), "next")]]
    queries = stream_of(spark, tmp_path, parts).selectExpr("seq", "logged_at as ts", "fingerprint as trace_id", "fingerprint as span_id", "concat('select ', seq) as sql")
    rows, path = ran(stream_n_plus_one(queries, 5, 600), tmp_path)
    assert [(r.seq, r.duplicate_count) for r in rows] == [(4, 5)] and len(states(spark, path, "runs")) == 1


def test_many_statements_share_states(spark, tmp_path):
    """300 keys over three batches lie in at most four states; each is told at its third run, whatever shares its state, and goes by its own life."""
    from logmill.streaming import stream_n_plus_one

    parts = [[(1000 * k + i, at(k), f"t{i}") for i in range(300) if i % (k + 2)] for k in range(5)]
    parts += [[(9000, at(2000), "next")], [(9001, at(2000), "t0")], [(9002, at(2001), "t0")]]
    queries = stream_of(spark, tmp_path, parts).selectExpr("seq", "logged_at as ts", "fingerprint as trace_id", "fingerprint as span_id", "concat('select ', seq) as sql")
    rows, path = ran(stream_n_plus_one(queries, 3, 600, shares=4), tmp_path)
    want = {r[2]: r[0] for i in range(300) if len(r3 := [r for p in parts[:5] for r in p if r[2] == f"t{i}"][:3]) == 3 for r in r3[2:]}
    assert {r.trace_id: r.seq for r in rows} == want and len(want) == len(rows) > 200
    left = spark.read.format("statestore").option("path", path).option("stateVarName", "runs").load().select("value.*").collect()
    assert len(left) <= 4 and sum(len(r["counts"]) // 8 for r in left) == 2  # next, and t0 anew


def test_windows_over_batches(spark, tmp_path):
    import random

    from logmill.streaming import stream_count_or_time

    parts = batches(random.Random(6), "ab", 200, 5, 900) + [[(1000, at(5000), "z")], [(1001, at(5000), "z")]]
    rows, path = ran(stream_count_or_time(stream_of(spark, tmp_path, parts), "fingerprint", 6, 20_000), tmp_path)
    plain = spark.createDataFrame([r for p in parts for r in p], "seq long, logged_at timestamp, fingerprint string")
    want = {(r.seq, r.window_no) for r in dedup.count_or_time_windows(plain, "fingerprint", 6, 20_000).collect()}
    assert {(r.seq, r.window_no) for r in rows} == want and states(spark, path, "window") == {"z"}


def test_a_timer_closes_an_idle_window(spark, tmp_path):
    """The last window of a key closes although no further row of it comes, and its state goes a minute later."""
    from logmill.streaming import stream_window_closings

    parts = [[(0, at(0), "a"), (1, at(3), "a")], [(2, at(5), "a"), (3, at(1), "b")], [(4, at(100), "other")], [(5, at(300), "other"), (6, at(300), "b")], [(7, at(300), "other")]]
    rows, path = ran(stream_window_closings(stream_of(spark, tmp_path, parts), "fingerprint", 3, 20_000), tmp_path)
    got = {(r.fingerprint, r.rows, (r.opened_at - at(0)).total_seconds(), (r.closed_at - at(0)).total_seconds(), r.closed_by) for r in rows}
    assert got == {("a", 3, 0, 5, "rows"), ("b", 1, 1, 21, "time"), ("other", 1, 100, 120, "time")}
    assert "a" not in states(spark, path, "window") and {"b", "other"} <= states(spark, path, "window")


def test_ids_are_remembered_for_a_time(spark, tmp_path):
    """An id that a later batch repeats goes once; after its life it may come again. Rows without an id all pass."""
    from logmill.streaming import stream_idempotent

    parts = [[(0, at(0), "a"), (1, at(1), "a"), (2, at(1), None)], [(3, at(30), "a"), (4, at(31), "b"), (5, at(31), None)], [(6, at(2000), "c")], [(9, at(2001), None)], [(7, at(2001), "a"), (8, at(2002), "c")]]
    rows, _ = ran(stream_idempotent(stream_of(spark, tmp_path, parts), "fingerprint", "10 minutes"), tmp_path)
    kept = {r.seq for r in rows}
    assert {2, 4, 5, 6, 7, 9} <= kept and len(kept & {0, 1}) == 1 and len(kept) == 7  # states go at the end of a batch


def test_rate_cap_over_batches(spark, tmp_path):
    """Held-back rows, a sample slot longer than the other lives, and state that goes from batch to batch."""
    import datetime
    import random

    from logmill.scratch import drained
    from logmill.streaming import stream_rate_cap

    rnd, start = random.Random(4), datetime.datetime(2024, 1, 1)
    times = sorted(rnd.choice((0, 0, 0, 1, 2)) * 1000 + rnd.randrange(1200) for _ in range(300))
    rows = [(i, start + datetime.timedelta(seconds=t), "ab"[i % 2]) for i, t in enumerate(times)]
    for sample_s in (30, 2500):
        got = {r.seq: r.suppressed_count for r in drained(stream_rate_cap(stream_of(spark, tmp_path / str(sample_s), [rows[a : a + 60] for a in range(0, 300, 60)]), 3, sample_s)).collect()}
        want = {}
        for f in "ab":
            cap = dedup.RateCap(3, sample_s)
            for i, t, g in rows:
                if g == f:
                    ok, n = cap.admit(t.timestamp())
                    if ok:
                        want[i] = n or None
        assert got == want and 0 < len(got) < 300 and any(got.values())


def test_a_lost_batch_is_written_again(spark, tmp_path):
    """Batches that were delivered but not noted as done overwrite their own folder; a callback that fails stops nothing."""
    import datetime
    import os

    from logmill.streaming import write_with_reports

    start = datetime.datetime(2024, 1, 1)
    stream = stream_of(spark, tmp_path, [[(10 * k + i, start + datetime.timedelta(hours=k), "x") for i in range(5)] for k in range(3)])
    out, offsets, heard = f"{tmp_path}/out", f"{tmp_path}/offsets", []

    def callback(report):
        heard.append(report.count())
        raise RuntimeError("broken")

    def run():
        rows = stream.selectExpr("seq", "logged_at", "300 as level", "fingerprint as message")
        write_with_reports(rows, out, offsets, lambda: "2024-01-01 02:00:00", 3600, on_report=callback).trigger(availableNow=True).start().awaitTermination()
        return sorted((r.seq is None, r.seq or 0) for r in spark.read.option("basePath", out).parquet(out).collect())

    first = run()
    assert [s for null, s in first if not null] == [10, 11, 12, 13, 14, 20, 21, 22, 23, 24] and sum(null for null, _ in first) == 1
    last = max(int(f) for f in os.listdir(f"{offsets}/commits") if f.isdigit())
    for f in (f"{offsets}/commits/{last}", f"{offsets}/commits/.{last}.crc"):
        if os.path.exists(f):
            os.remove(f)
    assert run() == first and len(heard) == 4
