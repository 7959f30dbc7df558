"""Golden rows: small cases with expected results written by hand."""

from __future__ import annotations

import datetime as dt

import pytest
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logmill import functions as X
from logmill.operators import analytics, dedup, derive, filters, redact, traces
from logmill.schema import CALL_SCHEMA, HTTP_SCHEMA, OPERATION_SCHEMA, OUTAGE_SCHEMA, QUERY_SCHEMA

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)
ROW = "seq long, logged_at timestamp, level int, message string, stacktrace string, caller_file string, caller_line int, user_id string, span_id string"


def at(s: float) -> dt.datetime:
    return T0 + dt.timedelta(seconds=s)


def rows(spark, *items, **same):
    base = {"level": 400, "message": "test", "stacktrace": None, "caller_file": "a.php", "caller_line": 1, "user_id": "1", "span_id": "s"} | same
    names = [f.split()[0] for f in ROW.split(", ")]
    return spark.createDataFrame([tuple((base | {"seq": i} | x)[n] for n in names) for i, x in enumerate(items)], ROW)


def one(spark, column, *values, kind="string"):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").orderBy("i").select(column).collect()]


def test_levels(spark):
    assert one(spark, X.level_value("v", 200), "DEBUG", "Emergency", "none", None) == [100, 600, 200, 200]
    assert one(spark, X.level_name("v"), 100, 250, 7, None, kind="int") == ["DEBUG", "NOTICE", None, None]


def test_uri_path(spark):
    uris = ["GET https://app.test/api/health?probe=1", "POST /livewire — pages.dashboard::poll", "/", "GET https://app.test", "//a/b#c", None, ""]
    assert one(spark, X.uri_path("v"), *uris) == ["api/health", "livewire — pages.dashboard::poll", None, None, "a/b", None, None]


@pytest.mark.parametrize(("pattern", "text", "hit"), [("api/health*", "api/health", True), ("livewire*", "livewire — x::y", True), ("a*c", "abbc", True), ("a*c", "abcd", False), ("/a", "a", True), ("*", "x", True), ("", "x", False), ("A", "a", False), ("a*b", "a\nb", True), ("a.c", "abc", False)])
def test_glob(spark, pattern, text, hit):
    assert one(spark, X.glob_match("v", [pattern, None, 3]), text) == [hit]


def test_normalize_sql(spark):
    q = ["select * from t where a = 'it''s' and b in (1, 2,3)", 'select "x" from "users" where id = 12 and v IN (?,?)', "a1 = 1"]
    assert one(spark, X.normalize_sql("v"), *q) == ["select * from t where a = ?? and b IN (?)", "select ? from ? where id = ? and v IN (?)", "a1 = ?"]
    assert one(spark, X.sql_table("v"), 'insert into "a" select 1', "update `b` set x = 1", "select 1 FROM c", "begin") == ["a", "b", "c", "unknown"]


def test_sql_functions(spark):
    X.register_functions(spark)
    r = spark.sql("select level_value('Error'), level_for_status(404), uri_path('GET https://a.b/c?d'), normalize_sql('x = 5'), sql_table('from t'), limit_str('abcdef', 3)").first()
    assert tuple(r) == (400, "warning", "c", "x = ?", "t", "abc...")


def test_collapse_storm(spark):
    out = dedup.collapse(rows(spark, *[{"logged_at": at(i)} for i in range(3)])).collect()
    assert [(r["count"], r["first_at"], r["last_at"]) for r in out] == [(3, at(0), at(2))]
    classes = [{"logged_at": at(0), "stacktrace": "RuntimeException: x"}, {"logged_at": at(0), "stacktrace": "LogicException: x"}]
    assert dedup.collapse(rows(spark, *classes)).count() == 2


def test_rate_cap(spark):
    df = rows(spark, *[{"logged_at": at(i)} for i in range(5)], {"logged_at": at(33)}, {"logged_at": at(200)}).withColumn("fingerprint", dedup.fingerprint())
    out = dedup.rate_cap(df, 2, 30).orderBy("seq").collect()
    assert [(r["seq"], r["suppressed_count"]) for r in out] == [(0, None), (1, None), (2, None), (5, 2), (6, None)]
    low = dedup.rate_cap(df.withColumn("level", F.lit(100)), 1, 30)
    assert low.count() == 7


def test_debounce_and_windows(spark):
    df = rows(spark, *[{"logged_at": at(s)} for s in (0, 3, 9.9, 10, 12, 30)])
    assert [r["seq"] for r in dedup.debounce(df, "user_id").orderBy("seq").collect()] == [0, 3, 5]
    df = rows(spark, *[{"logged_at": at(s)} for s in (0, 0.5, 2.1, 2.2, 2.3)])
    assert [r["window_no"] for r in dedup.count_or_time_windows(df, "user_id").orderBy("seq").collect()] == [1, 1, 1, 2, 2]
    assert [r["window_no"] for r in dedup.count_or_time_windows(df, "user_id", 2).orderBy("seq").collect()] == [1, 1, 2, 2, 3]


def test_sampling(spark):
    df = spark.range(200).select(F.col("id").alias("seq"), F.lit(200).alias("level"), F.concat(F.lit("trace-"), F.col("id").cast("string")).alias("trace_id"), F.lit("GET https://a.b/api/x").alias("uri"))
    assert 0 < filters.sample_traces(df, {"api/*": 0.5}).count() < 200
    assert filters.sample_traces(df, {"api/*": 0.0}).count() == 0
    assert filters.sample_traces(df, {"other": 0.0}).count() == 200
    assert filters.sample_levels(df, {"info": -1}).count() == 0
    assert filters.sample_levels(df, {"info": 5, "debug": 0}).count() == filters.sample_levels(df, {"info": "nonsense"}).count() == 200
    kept = {r.seq for r in filters.sample_levels(df, {"info": 0.3}).collect()}
    assert kept == {r.seq for r in filters.sample_levels(df, {"info": 0.3}).collect()}


def test_stale_and_reports(spark):
    df = spark.createDataFrame([(1, at(-300), None), (2, at(-1200), None), (3, at(-1200), at(0)), (4, None, None)], "seq int, logged_at timestamp, last_at timestamp")
    kept, tally = filters.drop_stale(df, str(T0), 60)
    assert {r.seq for r in kept.collect()} == {3, 4} and tally.first()["dropped"] == 2
    kept, _ = filters.drop_stale(df, str(T0), 60, recovery=True)
    assert {r.seq for r in kept.collect()} == {1, 3, 4}
    assert filters.drop_stale(df, str(T0), 0)[0].count() == 4
    tallies = spark.createDataFrame([("low_severity", 7), ("stale", 3)], "reason string, dropped long")
    report = filters.drop_report(tallies, str(T0)).collect()
    assert len(report) == 1 and "10 log rows" in report[0]["message"] and report[0]["context"] == '{"dropped":{"low_severity":7,"stale":3},"total":10}'
    assert filters.drop_report(tallies.limit(0), str(T0)).count() == 0


def test_outage(spark):
    out = spark.createDataFrame([(at(0), 429, "x", 10), (at(5), 429, "x", 10), (at(100), 500, "y", 5)], OUTAGE_SCHEMA)
    df = rows(spark, *[{"logged_at": at(s), "level": lv} for s, lv in ((-1, 200), (0, 200), (12, 300), (15, 200), (3, 400), (104, 100))]).withColumn("count", F.lit(2).cast("long"))
    kept, tally = filters.shed_during_outage(df, out)
    assert sorted(r.seq for r in kept.collect()) == [0, 3, 4] and tally.first()["dropped"] == 6


def test_outages_are_joined_by_the_hour(spark):
    out = spark.createDataFrame([(at(0), 429, "x", 9000), (at(60), 429, "x", 10), (at(8000), 500, "y", 2000)], OUTAGE_SCHEMA)
    df = rows(spark, *[{"logged_at": at(s), "level": 200} for s in (-1, 0, 3601, 8999, 9999, 10_000)]).withColumn("count", F.lit(2).cast("long"))
    kept, tally = filters.shed_during_outage(df, out)
    assert sorted(r.seq for r in kept.collect()) == [0, 5] and tally.first()["dropped"] == 8
    assert "SinglePartition" not in kept._jdf.queryExecution().executedPlan().toString()


def test_http_events(spark):
    make = lambda s, e: ("t", "s", T0, "GET", "p", s, e, None)
    df = spark.createDataFrame([make(500, None), make(302, None), make(403, "Denied"), make(500, "Denied")], HTTP_SCHEMA)
    assert sorted((r["message"], r["level_name"]) for r in derive.http_events(df).collect()) == [("http.rejected: 403 GET p — Denied", "WARNING"), ("http.response: 500 GET p", "ERROR")]
    assert derive.http_events(df, 300).where("level_name = 'NOTICE'").count() == 1


def test_slow_query_connect_and_n_plus_one(spark):
    df = spark.createDataFrame([("t", "s", 1, at(0), "c", "select 1", 1234.0, "x"), ("t", "s", 2, at(1), "c", "select 2", 1234.0, "x"), ("t", "s2", 3, at(2), "c", "select 3", 1234.0, "x")], QUERY_SCHEMA)
    assert [r["includes_connect"] for r in derive.slow_queries(df).orderBy("seq").collect()] == [True, False, True]
    many = spark.createDataFrame([("t", "s", i, at(i), "c", f"select * from users where id = {i}", float(i), f"f#{i}") for i in range(7)], QUERY_SCHEMA)
    r = analytics.detect_n_plus_one(many).collect()
    assert [(x["caller"], x["total"], x["message"]) for x in r] == [("f#4", 7, "[n+1.detected] users — f#4")]
    assert [(x["label"], x["duration_ms"]) for x in r[0]["measures"]] == [("n+1", 0.0)] and '"count":5' in r[0]["measures"][0]["meta"]


def test_calls_and_operations(spark):
    df = spark.createDataFrame([("s1", "POST https://a.b/livewire-x/update", None), ("s2", "GET /", None)], "span_id string, uri string, route_action string")
    calls = spark.createDataFrame([("s1", i, "pages.dash", "poll" if i else None, "x" * 300) for i in range(16)], CALL_SCHEMA)
    out = {r["span_id"]: r for r in derive.group_uri_calls(df, calls).collect()}
    assert out["s1"]["uri"] == "POST /livewire — pages.dash::poll" and len(out["s1"]["calls"]) == 10 and len(out["s1"]["calls"][0]["params"]) == 257
    assert out["s2"]["uri"] == "GET /" and out["s2"]["calls"] is None
    ops = spark.createDataFrame([("s1", 0, "query", None, ["__schema"]), ("s1", 1, "query", None, ["me", "settings"]), ("s1", 2, "mutation", "FooBar", ["x"])], OPERATION_SCHEMA)
    assert {r["span_id"]: r["route_action"] for r in derive.group_uri_operations(df, ops).collect()} == {"s1": "query me, settings", "s2": None}


def test_jobs_and_events(spark):
    df = spark.createDataFrame([("job.started", j, s) for j, s in (("Laravel\\Telescope\\X", ""), ("App\\Jobs\\N8n", ""), ("Illuminate\\Notifications\\Y", ""), ("Illuminate\\Queue\\Z", ""))] + [("event.dispatched", None, s) for s in ("App\\Ignored", "App\\Wild\\One", "App\\Kept", "eloquent.saved: x")], "event_kind string, job_class string, subject string")
    assert {r["job_class"] for r in filters.drop_internal_jobs(df, "oops").where("job_class is not null").collect()} == {"App\\Jobs\\N8n", "Illuminate\\Notifications\\Y"}
    assert {r["subject"] for r in filters.drop_ignored_events(df, ["App\\Ignored", "App\\Wild\\*"]).where("event_kind = 'event.dispatched'").collect()} == {"App\\Kept"}


def test_redaction(spark):
    df = spark.createDataFrame([("x", ("p", "n"), ["a 4242424242424242 b"], {"user.Token": "t", "name": "n"})], "api_key string, user struct<password: string, name: string>, notes array<string>, m map<string, string>")
    r = redact.redact_columns(df, value_regexes=[r"\b\d{16}\b", "[broken"]).first()
    assert r.asDict(True) == {"api_key": "********", "user": {"password": "********", "name": "n"}, "notes": ["a ******** b"], "m": {"user.Token": "********", "name": "n"}}
    texts = ['{"a":{"secret":[1,2]},"keyword":"x","l":["é"]}', '{"cut": "off', None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, context string")
    assert [r["context"] for r in redact.redact_json(df, ["context"]).orderBy("i").collect()] == ['{"a":{"secret":"********"},"keyword":"********","l":["é"]}', '{"cut": "off', None]


def test_measures_are_cumulative(spark):
    kind = "trace_id string, span_id string, logged_at timestamp, measures array<struct<label: string, duration_ms: double, meta: string>>"
    df = spark.createDataFrame([("t", "s", at(0), [("A", 1.0, None)]), ("t", "s", at(1), [("A", 1.0, None), ("B", 3.0, None)])], kind)
    assert analytics.measure_totals(df).first().asDict() == {"total_ms": 4.0, "n": 2}


def test_rounds_of_a_deep_chain(spark, monkeypatch):
    """A chain of 1,000 spans takes about ten rounds."""
    links = [("t", f"s{k}", f"s{k - 1}" if k else None) for k in range(1000)]
    df = spark.createDataFrame(links, "trace_id string, span_id string, parent_span_id string")
    rounds, real = [], traces.scratch_path
    monkeypatch.setattr(traces, "scratch_path", lambda *x: rounds.append(x) or real(*x))
    out = traces.span_tree(df).collect()
    assert {r["span_id"]: r["depth"] for r in out} == {f"s{k}": k for k in range(1000)} and len(rounds) <= 12
    assert next(r["path"] for r in out if r["span_id"] == "s2") == "s0 > s1 > s2" and all(r["root"] == "s0" for r in out)
    assert traces.span_tree(df, max_depth=3).count() == 4


def test_model_changes_are_masked(spark):
    kind = "id int, name string, api_key string, note string"
    before = spark.createDataFrame([(1, "a", "old", "card 4242424242424242"), (2, "b", "x", None), (4, "same", "k", "n")], kind)
    after = spark.createDataFrame([(1, "a" * 300, "new", "none"), (3, "c", "y", None), (4, "same", "k", "n")], kind)
    out = {r["id"]: r for r in derive.diff_snapshots(before, after, ["id"], value_regexes=[r"\b\d{16}\b"]).collect()}
    assert out[1]["changed"] == ["name", "api_key", "note"] and out[1]["from"] == {"name": "a", "api_key": "********", "note": "card ********"}
    assert out[1]["to"]["api_key"] == "********" and len(out[1]["to"]["name"]) == 203
    assert out[2]["to"] is None and out[3]["to"] == {"name": "c", "api_key": "********", "note": None} and set(out) == {1, 2, 3}
    assert derive.diff_snapshots(before, after, ["id"], model="User", models=["Order"]).count() == 0
    assert derive.diff_snapshots(before, after, ["id"], model="User", models=["User"]).count() == 3


def test_seeds_draw_anew(spark):
    df = spark.range(2000).selectExpr("id as seq", "200 as level", "concat('t', id) as trace_id", "'GET https://a.b/x' as uri")
    draws = [{r["seq"] for r in filters.sample_levels(df, {"info": 0.3}, seed=s).collect()} for s in (None, 1, 1, 2)]
    assert draws[1] == draws[2] and len({frozenset(d) for d in draws}) == 3 and all(500 < len(d) < 700 for d in draws)
    kept = [filters.sample_traces(df, {"x": 0.3}, seed=s).count() for s in (None, 1, 2)]
    assert all(500 < n < 700 for n in kept)


def test_circuit_of_a_report(spark):
    tally = spark.createDataFrame([("stale", 3)], "reason string, dropped long")
    outages = spark.createDataFrame([(at(0), 503, "down"), (at(50), 402, "later")], "tripped_at timestamp, status int, reason string")
    now = at(10).strftime("%Y-%m-%d %H:%M:%S")
    context = filters.drop_report(tally, now, circuit=filters.circuit_state(outages, now)).first()["context"]
    assert '"circuit":{"status":503,"reason":"down","tripped_at":' in context and '"total":3' in context
    assert "circuit" not in filters.drop_report(tally, now, circuit=filters.circuit_state(outages.limit(0), now)).first()["context"]


def test_rollups_add_up(spark, sf):
    from logmill.plans import views

    rows = views.logs(spark, sf)
    days = analytics.daily_rollup(rows)
    for since, until in ((None, None), ("2024-01-03", "2024-01-04"), ("2024-01-05", "2024-01-25")):
        window = (since, until)
        exact = {(r["section"], r["rank"]): (r["name"], r["occurrences"], r["errors"]) for r in analytics.traffic_overview(rows, window, k=7).collect()}
        out = analytics.overview_of_days(days, since, until, k=7).collect()
        assert {(r["section"], r["rank"]): (r["name"], r["occurrences"], r["errors"]) for r in out} == exact
    total = next(r for r in analytics.overview_of_days(days).collect() if r["section"] == "total")
    for column, got in (("user_id", total["users"]), ("trace_id", total["traces"])):
        true = rows.select(column).distinct().count()
        assert abs(got - true) <= 0.05 * true


def test_job_retries(spark):
    kind = "trace_id string, job_class string, job_attempt int, event_kind string, logged_at timestamp"
    rows = [("t", "J", 1, "job.started", at(0)), ("t", "J", 1, "job.failed", at(2)), ("t", "J", None, "job.retrying", at(3)), ("t", "J", 2, "job.started", at(4)), ("t", "J", 2, "job.completed", at(5)), ("t", "K", 1, "job.started", at(0))]
    out = {(r["job_class"], r["job_attempt"]): (r["outcome"], r["retries"], r["retry_requests"], r["run_s"]) for r in analytics.job_lifecycle(spark.createDataFrame(rows, kind)).collect()}
    assert out == {("J", 1): ("failed", 0, 1, 2.0), ("J", 2): ("completed", 1, 1, 1.0), ("K", 1): ("lost", 0, 0, None)}


def test_deep_spans(spark):
    links = [("t", f"s{k}", f"s{k - 1}" if k else None) for k in range(24)] + [("t", "x", "y"), ("t", "y", "x")]
    df = spark.createDataFrame(links, "trace_id string, span_id string, parent_span_id string")
    assert {r["span_id"]: r["depth"] for r in traces.span_tree(df).collect()} == {f"s{k}": k for k in range(24)}


def test_spans_and_jobs(spark):
    df = spark.createDataFrame([("t", "a", None), ("t", "b", "a"), ("t", "c", "b"), ("t", "d", "gone")], "trace_id string, span_id string, parent_span_id string")
    assert {r["span_id"]: (r["root"], r["depth"], r["path"]) for r in traces.span_tree(df).collect()} == {"a": ("a", 0, "a"), "b": ("a", 1, "a > b"), "c": ("a", 2, "a > b > c"), "d": ("d", 0, "d")}
    sent = spark.createDataFrame([(1, "t", "a")], "job_id int, trace_id string, span_id string")
    out = {r["job_id"]: r for r in traces.link_jobs(sent, spark.createDataFrame([(1,), (2,)], "job_id int")).collect()}
    assert out[1]["trace_id"] == "t" and out[1]["parent_span_id"] == "a" and out[1]["span_id"] != "a" and out[2]["parent_span_id"] is None


def test_top_user_frame(spark):
    frames = [("/srv/vendor/x.php", 1, "A", "b"), ("/srv/app/Y.php", 7, "Illuminate\\Z", "q"), ("/srv/app/Q.php", 8, "App\\Jobs\\Run", "handle")]
    df = spark.createDataFrame([(frames,), ([("/srv/app/Y.php", 7, None, None), ("z", 1, "App\\Go", "__invoke")],)], "frames array<struct<file: string, line: int, class: string, function: string>>")
    assert [(r["caller_file"], r["caller_line"], r["caller_method"]) for r in traces.top_user_frame(df, base="/srv").collect()] == [("app/Y.php", 7, "Run@handle"), ("app/Y.php", 7, None)]


def test_trace_markdown_masks(spark):
    df = spark.createDataFrame([("t", 1, T0, "INFO", "hello", '{"password":"p1"}', "GET https://a.b/?token=abc&x=1", "u")], "trace_id string, seq int, logged_at timestamp, level_name string, message string, context string, uri string, user_id string")
    text = traces.trace_markdown(df).first()["markdown"]
    assert "hello" in text and "p1" not in text and "abc" not in text and "x=1" in text


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 400), max_size=40), st.integers(1, 4), st.integers(1, 60))
def test_rate_cap_keeps_every_occurrence(times, per_minute, sample_s):
    """What passes and what is told to be held back, with what is still held, is what came (no tally is older than its life here)."""
    cap = dedup.RateCap(per_minute, sample_s)
    passed = told = 0
    for t in sorted(times):
        ok, n = cap.admit(float(t))
        passed += ok
        told += n
    assert passed + told + cap.held == len(times)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3000), max_size=60), st.integers(1, 4), st.integers(1, 1200), st.lists(st.integers(0, 60), max_size=3))
def test_machines_take_many_rows_as_they_take_one(times, count, seconds, cuts):
    """All machines over whole runs of times, cut anywhere, against the rows one by one."""
    times = np.array(sorted(times), float)
    parts = np.split(times, sorted(min(c, len(times)) for c in cuts))
    one, many = dedup.RateCap(count, seconds), dedup.RateCap(count, seconds)
    want = [n if ok else -1 for ok, n in (one.admit(t) for t in times)]
    assert np.concatenate([many.admit_all(p) for p in parts]).tolist() == want and one.state() == many.state()



def test_deep_and_plain_json_stays(spark):
    deep = "[" * 5000 + '"password"' + "]" * 5000
    texts = [deep, '{"k": 1,  "x": [1.0]}', '{"pass\\u0077ord": "p1"}', '{"Token": "t"}', "no json, a token", None]
    got = [r.c for r in redact.redact_json(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string"), ["c"]).orderBy("i").collect()]
    assert got == [deep, texts[1], '{"password":"********"}', '{"Token":"********"}', texts[4], None]


def test_flat_json_is_masked_as_any_other(spark):
    import json
    import random

    rnd = random.Random(2)
    names, values = ["a", "token", "apiKEY", "x secret y", "toKen", "kEy", "é", "", ",", "{", "passwor", "token,"], ["t", "", "a,b", "}", "{", 'x"y', "é\\n", 1, -20, 0, 10**30, 1.5, True, None, {"key": 1}, ["token"]]
    texts = [json.dumps({rnd.choice(names): rnd.choice(values) for _ in range(rnd.randint(0, 5))}, ensure_ascii=rnd.random() < 0.3, separators=rnd.choice([(",", ":"), (", ", ": ")])) for _ in range(400)]
    texts += ['{"token":01}', '{"token":"a"', '{"token":}', '{"token":"a"}x', '["token"]', '"token"', '{"token":"a","b":"' + "z" * 5000 + '"}', "{" + ",".join(f'"token{i}":{i}' for i in range(250)) + "}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    got = [r.c for r in redact.redact_json(df, ["c"]).orderBy("i").collect()]

    def walk(x):
        if isinstance(x, dict):
            return {k: redact.MASK if any(p in k.lower() for p in redact.KEY_PATTERNS) else walk(v) for k, v in x.items()}
        return [walk(v) for v in x] if isinstance(x, list) else x

    for text, out in zip(texts, got, strict=True):
        try:
            want = json.dumps(walk(json.loads(text)), ensure_ascii=False, separators=(",", ":"))
        except ValueError:
            want = text
        assert out == want or (out == text and not any(p in text.lower() for p in redact.KEY_PATTERNS) and "\\" not in text), text
    plan = redact.redact_json(df.where("c like '{%'"), ["c"])._jdf.queryExecution().toString()
    assert "regexp_replace" in plan
    flat = df.select(redact._flat_masked(F.col("c"), redact.KEY_PATTERNS, redact.MASK)[0].alias("f")).where("f").count()
    assert flat > 60


def test_approximate_percentiles(spark):
    df = spark.range(1000).selectExpr("cast(id as string) as trace_id", "id as duration_ms", "'r' as route_name", "100 as level", "'m' as message", "1 as count", "0 as suppressed_count")
    stats = {r["name"]: r["value"] for r in analytics.analyze_route_performance(df, "r", accuracy=10_000).where("section = 'duration'").collect()}
    assert abs(stats["p50"] - 500) <= 1 and abs(stats["p95"] - 950) <= 1 and stats["max"] == 999


def test_traces_in_parts(spark):
    df = spark.createDataFrame([("t", i, T0, "INFO", f"m{i}", "u") for i in range(5)], "trace_id string, seq int, logged_at timestamp, level_name string, message string, user_id string").withColumn("uri", F.lit("GET /x"))
    parts = {r.part: r.markdown for r in traces.trace_markdown(df, part_entries=2).collect()}
    assert sorted(parts) == [0, 1, 2] and "m2" in parts[1] and "m3" in parts[1] and "m4" not in parts[1]
