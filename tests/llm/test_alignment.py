"""Alignment of tokenizers, top-k products and periods of words against brute force."""

from __future__ import annotations

import collections
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from logmill.llm import align, periods, queries, top_k
from logmill.llm.bpe import byte_chars, library
from logmill.llm.recompression import Grammar

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def aligned_slowly(rows):
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of (id, text), a token at a time."""
    import sentencepiece

    back, plain, model = {c: b for b, c in enumerate(byte_chars())}, library(BYTE, plain=True), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    counts, found = collections.Counter(), []
    for i, text in rows:
        a = b = []
        if text:
            a = [(t, bytes(back[c] for c in plain.id_to_token(t))) for t in plain.encode(" " + text, add_special_tokens=False).ids]
            b = [(t, bytes([int(p[3:5], 16)]) if model.is_byte(t) else p.replace("▁", " ").encode()) for t in model.encode(text) for p in [model.id_to_piece(t)]]
            raw = b" " + text.encode()
            if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
                a = b = []
        spans = [[(t, e - len(x), e) for (t, x), e in zip(side, np.cumsum([len(x) for _, x in side]).tolist(), strict=True)] for side in (a, b)]
        links, x, y = [], 0, 0
        while x < len(a) and y < len(b):
            (p, _, end_p), (q, _, end_q) = spans[0][x], spans[1][y]
            links.append((p, q))
            x, y = x + (end_p <= end_q), y + (end_q <= end_p)
        both = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        told = ";".join("|".join(",".join(str(t) for t, s, e in side if s >= start and e <= end) for side in spans) for start, end in zip([0, *both], both, strict=False)) if len(both) < 3000 else None
        counts.update(links)
        found.append((i, len(a), len(b), len(both), links, told))
    best = collections.Counter()
    for (_, q), n in counts.items():
        best[q] = max(best[q], n)
    return [(i, n_a, n_b, g, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), told) for i, n_a, n_b, g, links, told in found]


def same_alignment(df, rows):
    want = collections.Counter(aligned_slowly(rows))
    untold = {w[:7] for w in want if w[7] is None}
    got = collections.Counter((*r[:7], None) if tuple(r[:7]) in untold else tuple(r) for r in df.collect())
    return got == want


MORE = [(11, "café ▁ x"), (12, "<s>[INST] <|endoftext|>"), (13, "é ​ ﬁ \u0000"), (14, "the cat " * 3), (15, " lead  and trail "), (16, "▁")]


def test_alignment_of_odd_texts(spark, odd):
    more = spark.createDataFrame(MORE, "doc_id long, text string")
    rows = odd.select("doc_id", "text").union(more)
    pairs = [(r.doc_id, r.text) for r in rows.collect()]
    assert same_alignment(align.align_tokens(odd.unionByName(more, allowMissingColumns=True), BYTE, PIECE), pairs)


def test_alignment_of_documents(spark, sf, texts, monkeypatch):
    monkeypatch.setattr(align, "RADIX_BYTES", 1 << 15)
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(5)
    got = align.align_tokens(docs, BYTE, PIECE, digest=True)
    want = {i: (*rest, hashlib.sha256(told.encode()).hexdigest() if told else told or "") for i, *rest, told in aligned_slowly(texts)}
    for r in got.collect():
        assert tuple(r)[1:7] == want[r.doc_id][:6]
        assert want[r.doc_id][6] in (r.groups, "") and (r.groups == "") == (r.n_a == 0)
    plain = {r.doc_id: r.groups for r in align.align_tokens(docs.limit(20), BYTE, PIECE).collect()}
    assert all(hashlib.sha256(g.encode()).hexdigest() == {r.doc_id: r.groups for r in got.collect()}[i] for i, g in plain.items() if g)


def test_alignment_of_nothing(spark, none):
    assert align.align_tokens(none, BYTE, PIECE).collect() == []
    only = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, align.align_tokens(only, BYTE, PIECE).collect())) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_runs_and_passes_of_the_merge(monkeypatch):
    rng = np.random.default_rng(0)
    runs = [np.unique(rng.integers(0, 500, n)) for n in (0, 1, 300, 2000, 50, 7, 900)]
    weights = [rng.integers(1, 9, len(k)) for k in runs]
    for fan_in in (2, 3, 256):
        monkeypatch.setattr(align, "FAN_IN", fan_in)
        keys, totals = align.heap_merged(list(zip(runs, weights, strict=True)))
        want = collections.Counter()
        for k, n in zip(runs, weights, strict=True):
            for a, b in zip(k.tolist(), n.tolist(), strict=True):
                want[a] += b
        assert dict(zip(keys.tolist(), totals.tolist(), strict=True)) == dict(want) and (np.diff(keys) > 0).all()
    a, b = rng.integers(-9, 9, 100), rng.integers(0, 9, 0).astype(np.int32)
    assert all((x == y).all() for x, y in zip(align.unpacked(align.packed(a, b)), (a, b), strict=True))


def products_slowly(rows, k, divisor):
    """(query_id, rank, vec_id, score) of (id, vector) rows."""
    fine = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (i, v) in enumerate(fine):
        if i is None or i % divisor:
            continue
        scored = sorted((-max(-top_k.LIMIT, min(top_k.LIMIT, sum(x * y for x, y in zip(v, w, strict=False)))), j is None, j or 0, j) for n, (j, w) in enumerate(fine) if n != at)
        out += [(i, rank, j, -s) for rank, (s, _, _, j) in enumerate(scored[:k], 1)]
    return collections.Counter(out)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<double>, row long, score double").repartition(3)


@pytest.mark.parametrize("block", [3, 4096])
def test_top_k(spark, block):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6).round(1)]) for i in range(90)] + [(i, [0.5] * 6) for i in range(200, 230)]
    rows += [(5, [0.1] * 6), (10, [0.2] * 6), (10, [0.2] * 6), (None, [3.0] * 6), (None, [0.5] * 6), (300, None), (301, [1.0, None]), (302, [float("nan")]), (303, [float("inf")] * 6), (305, []), (310, [1.0, 2.0]), (315, [9.0] * 8)]
    got = top_k.top_k_products(vectors(spark, rows), F.pmod("vec_id", F.lit(5)) == 0, k=7, block=block)
    assert collections.Counter(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == products_slowly(rows, 7, 5)


@pytest.mark.parametrize("size", [1e3, 1e7, 1e11, 1e200])
def test_large_products(spark, size):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=4) * size).tolist()) for i in range(40)]
    got = top_k.top_k_products(vectors(spark, rows), F.col("vec_id") < 6, k=5)
    want = products_slowly([(0 if i < 6 else i, v) for i, v in rows], 5, 100)
    assert sorted((r.rank, r.score) for r in got.collect()) == sorted((rank, s) for _, rank, _, s in want.elements())


def test_few_vectors(spark):
    mine = F.pmod("vec_id", F.lit(5)) == 0
    for rows in ([], [(5, [1.0])], [(5, None), (10, None)], [(1, [1.0]), (2, [1.0])]):
        assert top_k.top_k_products(vectors(spark, rows), mine).collect() == []
    rows = [(5, [1.0]), (6, [2.0]), (7, [2.0])]
    assert collections.Counter(map(tuple, top_k.top_k_products(vectors(spark, rows), mine, k=20).select("query_id", "rank", "vec_id", "score").collect())) == products_slowly(rows, 20, 5)


def runs_slowly(words, least=24):
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 3 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, q, length) for (s, length), q in found.items())


def random_words(rng, most):
    n, kinds = int(rng.integers(0, most)), int(rng.integers(1, 4))
    words = rng.integers(0, kinds, n).tolist()
    for _ in range(int(rng.integers(0, 3))):
        if n > 3:
            a = int(rng.integers(0, n))
            p, e = int(rng.integers(1, max(2, (n - a) // 3 + 1))), int(rng.integers(a, n)) + 1
            words = [words[i] if i < a or i >= e else words[a + (i - a) % p] for i in range(n)]
    return words


def test_runs_of_random_words(monkeypatch):
    rng = np.random.default_rng(3)
    for _ in range(150):
        texts = [random_words(rng, 90) for _ in range(int(rng.integers(1, 5)))]
        bounds = np.cumsum([0, *map(len, texts)])
        monkeypatch.setattr(periods, "TRIED", int(rng.choice([3, 50, 1 << 20])))
        start, length, period = periods.runs_of(np.concatenate([np.zeros(0, np.int64), *map(np.array, texts)]).astype(np.int64), bounds, 9)
        assert list(zip(start.tolist(), period.tolist(), length.tolist(), strict=True)) == [(int(b) + s, q, n) for b, t in zip(bounds, texts, strict=False) for s, q, n in runs_slowly(t, 9)]


def test_extensions():
    rng = np.random.default_rng(4)
    for _ in range(60):
        texts = [t for t in (random_words(rng, 60) for _ in range(3)) if len(t) > 1]
        if not texts:
            continue
        bounds, flat = np.cumsum([0, *map(len, texts)]), [w for t in texts for w in t]
        grammar, asked = Grammar(np.array(flat, np.int64), bounds), []
        for k, t in enumerate(texts):
            asked += [(int(bounds[k]), *rng.choice(len(t), 2, replace=False).tolist(), t) for _ in range(20)]
        a, b = (np.array([at + x[i] for at, *x in asked]) for i in (0, 1))
        forth, back = grammar.extension(a, b), grammar.extension(a, b, back=True)
        for (_, i, j, t), f, g in zip(asked, forth.tolist(), back.tolist(), strict=True):
            assert f == next((d for d in range(len(t)) if max(i, j) + d >= len(t) or t[i + d] != t[j + d]), 0)
            assert g == next((d for d in range(len(t)) if min(i, j) - d <= 0 or t[i - 1 - d] != t[j - 1 - d]), 0)


def periods_slowly(i, text):
    h = zlib.crc32(b"" if i is None else str(i).encode())
    words = queries.made_periodic(i, periods.find_words(text or ""))
    assert h % 10 == 0 or words == periods.find_words(text or "")
    runs = runs_slowly(words)
    gone = {k for s, q, n in runs for k in range(s + q, s + n)}
    best = None
    for s, q, n in runs:
        best = (s, n, q) if best is None or n * best[2] > best[1] * q else best
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (i, len(runs), *told, sha("".join(f"{s},{n},{q}\n" for s, q, n in runs)), sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


def test_periods_of_documents(spark, sf, texts):
    got = collections.Counter(map(tuple, queries.op13_periods(spark, sf).collect()))
    assert got == collections.Counter(periods_slowly(*x) for x in texts if len(x[1] or "") < 20_000) + collections.Counter({r: 1 for r in got if r[0] in {i for i, t in texts if len(t or "") >= 20_000}})


def test_periods_of_odd_texts(spark, odd, none):
    more = spark.createDataFrame([(20, "a b " * 12), (21, "a b " * 11 + "a"), (22, "x " * 23), (23, "x " * 24), (24, "  " * 30 + "y"), (25, "p q r s t u v w " * 3), (20, "k " * 30)], "doc_id long, text string")
    rows = odd.select("doc_id", "text").union(more)
    found = periods.periodic_runs(odd.unionByName(more, allowMissingColumns=True), edit=queries.made_periodic).withColumn("best", periods.strongest())
    got = collections.Counter((r.doc_id, tuple((x.start, x.period, x.length) for x in r.runs), r.collapsed) for r in found.collect())
    want = collections.Counter()
    for i, t in [(r.doc_id, r.text) for r in rows.collect()]:
        words = queries.made_periodic(i, periods.find_words(t or ""))
        runs = tuple(runs_slowly(words)) if len(set(words)) > 1 or not words else (((0, 1, len(words)),) if len(words) >= 24 else ())
        gone = {k for s, q, n in runs for k in range(s + q, s + n)}
        want[i, runs, " ".join(w for k, w in enumerate(words) if k not in gone)] += 1
    assert got == want
    assert periods.periodic_runs(none).collect() == []


def test_long_text_with_a_period(spark):
    words = [str(i) for i in range(3000)] + [str(i % 700) + "p" for i in range(40_000)] + ["z"] * 60_000
    doc = spark.createDataFrame([(1, "\n".join(words))], "doc_id long, text string")
    row = periods.periodic_runs(doc).first()
    assert [tuple(r) for r in row.runs] == [(3000, 40_000, 700), (43_000, 60_000, 1)] and len(row.collapsed.split()) == 3701
