"""Operators with results that a few lines of Python can check."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from logmill.llm import codec, exact_dedup, fuzzy_hash, lm, packing, queries, token_counts, warc
from logmill.llm.bpe import byte_level_starts, code_points, distinct_spans, fast_encoder, forced_boundary_bpe, library, span_hashes, word_hashes

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def multiset(rows):
    return collections.Counter(rows)


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    got = queries.QUERIES[name](spark, sf)
    want = con.sql(f"select {', '.join(got.columns)} from ({queries.ORACLE_SQL[name]})").fetchall()
    assert multiset(map(tuple, got.collect())) == multiset(want)


def test_exact_dedup_odd(odd, none):
    rows = pairs(odd)
    digest = lambda t: hashlib.sha256((t or "").translate(A_Z).encode()).hexdigest()
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[digest(t)].append(i)
    last = {d: max((i for i in g if i is not None), default=None) for d, g in groups.items()}
    want = multiset((i, last[digest(t)], len(groups[digest(t)]), i == last[digest(t)], digest(t)) for i, t in rows)
    assert multiset(map(tuple, exact_dedup.exact_groups(odd).collect())) == want
    for filter_bytes in (1, 8, 1 << 20):  # up to one range for each half row
        assert multiset(map(tuple, exact_dedup.exact_groups(odd, filter_bytes=filter_bytes).collect())) == want
    joined = exact_dedup.mark_possible_repeats(exact_dedup.exact_groups(odd).select(F.unhex("text_sha256").alias("digest")), filter_bytes=8)
    assert joined.where("maybe").count() >= sum(len(g) for g in groups.values() if len(g) > 1)
    assert exact_dedup.exact_groups(none).count() == 0 and exact_dedup.drop_exact_copies(none).count() == 0
    stay = exact_dedup.drop_exact_copies(odd)
    assert stay.columns == odd.columns and multiset((r.doc_id, digest(r.text)) for r in stay.collect()) == multiset((last[d], d) for d in groups)


def test_encoders_agree(texts, odd):
    library_byte, library_word, own = library(BYTE), library(WORD), forced_boundary_bpe(WORD)
    for _, t in [*texts[:60], *pairs(odd)]:
        t = t or ""
        assert fast_encoder(BYTE)(t) == library_byte.encode(t, add_special_tokens=False).ids
        want = library_word.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == want and own.decode(want) == library_word.decode(want, skip_special_tokens=False)
        plain = t.replace("<|endoftext|>", "")
        if not plain:
            continue
        cps, bounds = code_points([plain])
        starts = byte_level_starts(cps, bounds[:-1])
        assert [plain[a:b] for a, b in zip(starts, [*starts[1:], len(plain)], strict=True)] == [plain[a:b] for _, (a, b) in library_byte.pre_tokenizer.pre_tokenize_str(plain)]


def test_every_character_as_the_library_takes_it():
    byte, word, own = library(BYTE), library(WORD), forced_boundary_bpe(WORD)
    for c in (c for c in range(0x30000) if not 0xD800 <= c < 0xE000):
        t = f"a{chr(c)}b"
        assert own.encode(t) == word.encode(t, add_special_tokens=False).ids, hex(c)
    wide = [f"a{chr(c)}b 1{chr(c)}{chr(c)} {chr(c)}." for c in range(0x80, 0x20000) if not 0xD800 <= c < 0xE000]
    cps, bounds = code_points(wide)
    starts = byte_level_starts(cps, bounds[:-1], BYTE)
    cuts = np.searchsorted(starts, bounds)
    for k, t in enumerate(wide):
        own_starts = (starts[cuts[k] : cuts[k + 1]] - bounds[k]).tolist()
        assert own_starts == [a for _, (a, _) in byte.pre_tokenizer.pre_tokenize_str(t)], t
        if k % 16 == 0:
            assert fast_encoder(BYTE)(t) == byte.encode(t, add_special_tokens=False).ids
    for t in ("Əliyev went ƏLİ", "Ɔkyena Ɛdi", "Ɛdi ɖe Ŋutɔ", "Əliyev 中 Ɔ \u1c89\ua7cb"):
        assert own.encode(t) == word.encode(t, add_special_tokens=False).ids


def test_very_long_texts(spark):
    tok, word, own = library(BYTE), library(WORD), forced_boundary_bpe(WORD)
    for t in (" " * 300_000 + "x", "é" * 200_000, "ab" * 100_000, "^" * 100_000 + "\n" * 20_000):
        assert fast_encoder(BYTE)(t) == tok.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == word.encode(t, add_special_tokens=False).ids
    long = "".join(f"{k} word{k % 977}'s " for k in range(250_000))
    docs = spark.createDataFrame([(1, long), (2, "short")], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, BYTE).collect()}
    assert got[1] == len(tok.encode(long, add_special_tokens=False).ids)
    pieces = packing.pack_documents(docs, BYTE).where("doc_id = 1").collect()
    assert sum(r.length for r in pieces) == got[1] + 1 and sorted(r.start for r in pieces) == list(range(0, got[1] + 1, 2048))
    coded = codec.encode_and_decode(docs, WORD).where("doc_id = 1").first()
    assert coded.n_tokens == len(word.encode(long, add_special_tokens=False).ids)


def thue_morse(n):
    """Two words of 2**n letters with the same value under any polynomial modulo 2**64, for n of 11."""
    a, b = "a", "e"
    for _ in range(n):
        a, b = a + b, b + a
    return a, b


def test_words_with_one_hash_are_told_apart(spark):
    one, other = thue_morse(11)
    cps, bounds = code_points([one, other, one])
    assert len(set(span_hashes(cps, bounds[:-1], bounds[1:]).tolist())) == 1
    hashes, at, kind = distinct_spans(cps, bounds[:-1], bounds[1:])
    assert len(hashes) == 2 and kind[0] == kind[2] != kind[1]
    assert len(set(word_hashes(cps, bounds[:-1], bounds[1:]).tolist())) == 2
    docs = spark.createDataFrame([(1, f"{one} x {other} {other}"), (2, one), (3, other), (4, f"{one} {one}")], "doc_id long, text string")
    tok = library(BYTE)
    for table in (0, 1, 100):
        got = token_counts.count_tokens(docs, BYTE, table=table)
        assert {(r.doc_id, r.n_tokens) for r in got.collect()} == {(i, len(tok.encode(t, add_special_tokens=False).ids)) for i, t in pairs(docs)}
    counts = {r.word: r.c for r in lm.count_words(docs).collect()}
    assert (counts[one], counts[other]) == (4, 3)
    found = {r.doc_id: r.n_known for r in lm.score_texts(docs, held_out=9).collect()}
    assert found == {1: 5, 2: 2, 3: 2, 4: 3}


def test_forced_boundaries_are_safe():
    own = forced_boundary_bpe(WORD)
    units = tuple("abcabcabcab") + ("c</w>",)
    assert own.merge(units) == own.merge_long(units)
    assert len(own.fragments_of("zqxjkvéé")) > 1


def test_codec(odd, none):
    tok = library(WORD)
    want = []
    for i, t in pairs(odd):
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), np.array(ids, "<u4").tobytes(), tok.decode(ids, skip_special_tokens=False)))
    got = [(r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in codec.encode_and_decode(odd, WORD).collect()]
    assert multiset(got) == multiset(want) and codec.encode_and_decode(none, WORD).count() == 0


@pytest.mark.parametrize("table", [4, 1 << 17])
def test_token_counts(odd, none, table):
    tok = library(BYTE)
    n = lambda t: len(tok.encode(t or "", add_special_tokens=False).ids)
    got = token_counts.count_tokens(odd, BYTE, table=table)
    assert multiset(map(tuple, got.collect())) == multiset((i, len((t or "").encode()), n(t), n(t) > 1024) for i, t in pairs(odd))
    assert token_counts.count_tokens(none, BYTE).count() == 0


def test_packing(spark, odd, none, sf):
    tok = library(BYTE)
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 60").select("doc_id", "text").union(odd.where("doc_id is null or doc_id in (1, 2, 8)").select("doc_id", "text"))
    out = packing.pack_documents(docs, BYTE).collect()
    ids = [(i, [*tok.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in pairs(docs)]
    want = multiset((i, s, len(x[s : s + 2048]), zlib.crc32(np.array(x[s : s + 2048], "<u4").tobytes()), len(x)) for i, x in ids for s in range(0, len(x), 2048))
    assert multiset((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out) == want
    windows = collections.defaultdict(list)
    for r in out:
        windows[r.sequence_id].append((r.offset, r.length))
    for parts in windows.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 2048
    assert len(windows) <= sum(len(x) for _, x in ids) / 2048 * 1.1 + 2
    assert packing.pack_documents(none, BYTE).count() == 0


def test_best_fit():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 65, 300)
    window, offset = packing.best_fit_decreasing(lengths, 64)
    left: list[int] = []
    for i in np.argsort(-lengths, kind="stable"):  # brute force: the tightest open window
        fits = [x for x in left if x >= lengths[i]]
        if fits:
            left.remove(min(fits))
        left.append((min(fits) if fits else 64) - lengths[i])
    assert len(left) == window.max() + 1 and sorted(64 - np.bincount(window, lengths).astype(int)) == sorted(left)
    assert (offset + lengths <= 64).all()


def test_warc_odd(spark, tmp_path):
    rows = [(1, "u", "x" * 1500), (2, None, "x" * 1500), (None, "u\r\nv", "x" * 1500), (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (2, "again", "x" * 1500), (None, None, "é" * 700), (None, None, "é" * 700)]
    pages = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, offset long, file string").repartition(3)
    folder = f"file://{tmp_path}/w"
    index = warc.write_archives(warc.plan_records(pages), folder, file_bytes=200)
    got = warc.read_archives(index, folder, stretch=100).collect()
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    want = []
    for i, _, t in rows:
        revisit = t == "x" * 1500 and i != 2
        want.append((i, len((t or "").encode()), sha(t), "revisit" if revisit else "response", 2 if revisit else None))
    assert multiset((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == multiset(want)
    some = warc.read_archives(index.where("page_id = 5"), folder).collect()
    assert [bytes(r.payload) for r in some] == [b"short"]
    assert warc.archive_and_read_back(pages.limit(0)).count() == 0


def test_coalesced_ranges():
    entries = [(0, 10), (10, 5), (100, 10), (111, 10)]
    assert list(warc.coalesced(entries, gap=5, span=1000)) == [(0, 15, [0, 1]), (100, 121, [2, 3])]
    assert [x[2] for x in warc.coalesced(entries, gap=1000, span=20)] == [[0, 1], [2], [3]]


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + 2 * (x != y)))
        row = new
    return row[-1]


def fingerprint_slowly(text):
    """Byte by byte: the hash of the last seven bytes ends a chunk, and a chunk's hash gives its character."""
    data, mask = text.encode(), (1 << 64) - 1
    if not data:
        return "3::"

    def mix(h):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            h = ((h ^ (h >> shift)) * factor) & mask
        return h

    roll = [mix(sum((data[i - k] + 1) * pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(min(7, i + 1))) & mask) >> 32 for i in range(len(data))]

    def signature(block):
        chunks, begin = [], 0
        for i, h in enumerate(roll):
            if h % block == block - 1 and len(chunks) < 63:
                chunks.append(data[begin : i + 1])
                begin = i + 1
        if begin < len(data):
            chunks.append(data[begin:])
        letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
        spans = [np.frombuffer(c, np.uint8) for c in chunks]
        return "".join(letters[int(span_hashes(c, np.array([0]), np.array([len(c)]))[0]) >> 58] for c in spans)

    block = 3
    while block * 64 < len(data):
        block *= 2
    while block > 3 and sum(h % block == block - 1 for h in roll) < 32:
        block //= 2
    return f"{block}:{signature(block)}:{signature(2 * block)}"


def test_fingerprints(texts, odd, none):
    assert fuzzy_hash._distances(["abc", "", "kitten", "x"], ["abd", "xy", "sitting", ""]).tolist() == [edit_distance(*p) for p in (("abc", "abd"), ("", "xy"), ("kitten", "sitting"), ("x", ""))]
    for t in ["", "a", "abc" * 40, "ä中😀" * 300, *[t for _, t in texts[:25]], *[t for _, t in texts if len(t) > 3000][:3]]:
        assert fuzzy_hash.fingerprint(t) == fingerprint_slowly(t)
    whole = [t for _, t in texts if len(t) > 500][:40]
    prints = [fuzzy_hash.fingerprint(t) for t in whole]
    edited = [fuzzy_hash.fingerprint(t[: len(t) // 3] + " new words here " + t[len(t) // 3 :]) for t in whole]
    near = fuzzy_hash.likeness(prints, edited)
    assert np.median(near) > 0.8 and np.median(fuzzy_hash.likeness(prints, prints[1:] + prints[:1])) < 0.35
    assert fuzzy_hash.likeness(prints, prints).tolist() == [1.0] * len(prints)
    rows = sorted(((i, t or "") for i, t in pairs(odd)), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = []
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        e = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        f = [fuzzy_hash.fingerprint(x) for x in (t, e, after)]
        want.append((i, t, e, f[0], f[1], *fuzzy_hash.likeness([f[0], f[0]], f[1:]).tolist()))
    for size in (2, 5000):
        import functools

        moved = functools.partial(fuzzy_hash.with_neighbours, per_range=size)
        keep, fuzzy_hash.with_neighbours = fuzzy_hash.with_neighbours, moved
        try:
            assert multiset(map(tuple, fuzzy_hash.compare_with_edits(odd).collect())) == multiset(want)
        finally:
            fuzzy_hash.with_neighbours = keep
    assert fuzzy_hash.compare_with_edits(none).count() == 0


def test_lm(odd, none, texts, spark):
    docs = spark.createDataFrame(texts[:150], "doc_id long, text string").union(odd.select("doc_id", "text"))
    rows = pairs(docs)
    tokens = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(A_Z)), "\n"]
    held = lambda i: zlib.crc32(str(i).encode() if i is not None else b"") % 5 == 1
    c = collections.Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = multiset((i, held(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t)), 5)) for i, t in rows)
    out = lm.score_texts(docs).collect()
    assert multiset((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in out) == want
    big = [r for r in out if r.held_out and r.n_tokens > 50 and r.doc_id not in (8, 10)]
    assert sum(r.score for r in big) > sum(r.base_score for r in big)
    assert lm.score_texts(none).count() == 0


def test_lm_is_normalised():
    model = lm.LogBilinear.start(np.full(lm.SYMBOLS, 1 / lm.SYMBOLS)).prepare()
    every = np.arange(lm.SYMBOLS)
    p = 10 ** model.log10(np.full(lm.SYMBOLS, 3), np.full(lm.SYMBOLS, 5), every)
    assert abs(p.sum() - 1) < 1e-4


def test_lm_scores_against_a_slow_version(odd, texts, spark):
    docs = spark.createDataFrame(texts[:120], "doc_id long, text string").union(odd.select("doc_id", "text")).coalesce(1)
    rows = docs.select(F.monotonically_increasing_id().alias("id"), F.coalesce("text", F.lit("")).alias("text"), F.lit(False).alias("held_out"))
    counts, v, vector = lm.train(rows)
    c = {r.word: (r["c"], r["class"]) for r in counts.collect()}
    symbol = {v.cps[a:b].astype("<u4").tobytes().decode("utf-32-le") if a < b else "\n": int(s) for (a, b), s in zip(v.spans, v.symbols, strict=True)}
    m = lm.LogBilinear(vector)
    context, target, bias = m.context.astype(float), m.target.astype(float), m.bias.astype(float)
    mass = np.full(lm.CLASSES, 0.5)
    for w, (n, k) in c.items():
        if symbol.get(w, -1) < 0:
            mass[k] += n + 0.5
    of = lambda w: symbol[w] if symbol.get(w, -1) >= 0 else lm.HEAD + int(lm.tokens_of([w]).classes[0])
    want = {}
    for r in rows.where("length(text) < 1500").collect():
        words = [*re.findall(r"[^\x20\x09-\x0D]+", r.text.translate(A_Z)), "\n"]
        total, one, two = 0.0, of("\n"), of("\n")
        for w in words:
            s = of(w)
            logit = (context[one] @ m.c1 + context[two] @ m.c2) @ target.T + bias
            total += logit[s] - np.log(np.exp(logit - logit.max()).sum()) - logit.max()
            if s >= lm.HEAD:
                total += np.log((c.get(w, (0, 0))[0] + 0.5) / mass[s - lm.HEAD])
            one, two = s, one
        want[r.id] = total / np.log(10)
    got = {r.id: r.score for r in lm.score_with(rows, counts, v, vector).select("id", "score").collect()}
    assert len(want) > 50 and all(abs(got[i] - x) < 1e-3 + 1e-6 * abs(x) for i, x in want.items())


def test_lm_does_not_depend_on_how_texts_are_dealt(spark, texts, monkeypatch):
    monkeypatch.setattr(lm, "SHARE_BYTES", 60_000)
    docs = spark.createDataFrame(texts + [(None, "no id"), (-1, None)], "doc_id long, text string")
    one, other = ({r.doc_id: r.score for r in lm.score_texts(docs.repartition(n)).collect()} for n in (2, 7))
    assert len(one) == len(texts) + 2 and all(abs(one[i] - other[i]) < 1e-3 + 1e-5 * abs(one[i]) for i in one)
