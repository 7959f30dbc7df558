"""Near-duplicate documents by ProbMinHash signatures, banding and exact verification.

A document is its weighted set of five-word shingles (weight: how often a shingle occurs); similarity is the probability Jaccard of two such
sets, which is 1 minus a metric and equals the plain Jaccard if no shingle repeats. ProbMinHash lets every shingle arrive as a Poisson
process with its weight as rate, each arrival at a random register; a register keeps the shingle that comes first, and a shingle stops as
soon as it cannot be first anywhere. Two documents agree in a register with their similarity as probability.

1. Documents with the same words are one text from here on (copies, however many, cost nothing further).
2. Texts that agree in a band of registers share a bucket. A bucket is a star around its most central text, the first one: signatures prune the star, and the
   texts that the first one cannot speak for stay in the bucket for another round. No pairs within a bucket are made. A text and a first
   one are one row, with the list of their common buckets, however many these are.
3. Components of these stars are candidates only. Inside a component the shingle sets decide exactly: a search over unvisited texts
   finds a spanning forest of the links with similarity of the threshold or more. The triangle inequality says which texts need a look.
   Components too large for a task first lose, round by round, the texts that are linked to a pivot, wherever those texts lie.
4. Components of the verified links are the classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .bpe import code_points, mixed, word_hashes
from .common import dropped, fresh, joined, scratch_path, slices, small_batches, text_or_empty, written
from .graphs import components

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 32, 5  # a pair at 0.8 shares no bucket with probability (1 - 0.8**5)**32 = 3e-6
REGISTERS = BANDS * ROWS
WEAK, STRONG = 0.5, 0.83  # estimated similarity: a star keeps links from WEAK on; a text from STRONG on leaves the bucket. They differ by
# what similarity can change along a link (1 - THRESHOLD) and 3.3 standard errors, so a text that leaves needs no other one of the bucket
STAR_ROUNDS = 3
FEW = 1_000_000  # ids that may be broadcast
LARGEST, LARGEST_BYTES = 50_000, 64 << 20  # texts, and bytes of their sets, of a component that one task takes
PIVOTS = 32  # texts of a larger component that all others are compared with in a round
HOT = 1000  # a bucket with over one in so many rows is hot; there are at most as many


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes | None]]:
    """(text, shingle hash, weight), sorted by text and hash, and of each text a 128-bit key of its words (None: it has none).

    Words are lower-cased runs without white space. A text with one to four words is one shingle.
    """
    plain = [" ".join(t.lower().split()) for t in texts]
    keys = [xxhash.xxh3_128_digest(t.encode("utf-8", "surrogatepass")) if t else None for t in plain]
    cps, bounds = code_points(plain)
    space = cps == 32
    starts = np.flatnonzero(np.append(True, space[:-1]) if len(cps) else np.zeros(0, bool))
    starts = np.where(space[starts], starts + 1, starts) if len(cps) else starts
    first = np.zeros(len(cps) + 1, bool)
    first[starts] = True
    filled = np.diff(bounds) > 0
    first[bounds[:-1][filled]] = True
    if len(cps):
        after = np.flatnonzero(space) + 1
        first[after] = True
    first[len(cps)] = False
    starts = np.flatnonzero(first)
    word_bounds = np.searchsorted(starts, bounds)
    text = np.repeat(np.arange(len(plain)), np.diff(word_bounds))
    last_word = word_bounds[1:][text] - 1
    ends = np.where(np.arange(len(starts)) == last_word, bounds[1:][text], np.append(starts[1:], 0) - 1)
    n = np.diff(word_bounds)[text]
    k = np.arange(len(starts)) - word_bounds[:-1][text]
    begin = np.flatnonzero((k + WORDS <= n) | ((k == 0) & (n < WORDS)))
    stop = np.minimum(begin + WORDS - 1, last_word[begin])
    words = word_hashes(cps, starts, ends)
    hashes = (stop - begin + 1).astype(np.uint64)
    for i in range(WORDS):
        at = np.minimum(begin + i, len(words) - 1)
        hashes = np.where(begin + i <= stop, mixed(hashes * np.uint64(0x9FB21C651E98DF25) + words[at]), hashes)
    owner = text[begin]
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])) if len(owner) else np.zeros(0, bool))
    return owner[new], hashes[new], np.diff(np.append(new, len(owner))), keys


def prob_min_hash(text: np.ndarray, hashes: np.ndarray, weight: np.ndarray, n_texts: int) -> np.ndarray:
    """Signatures, texts x REGISTERS: the shingle that arrives first at each register; 0 in texts with no shingles."""
    best = np.full(n_texts * REGISTERS, np.inf)
    out = np.zeros(n_texts * REGISTERS, np.uint64)
    t, w, h, when, turn = text, weight.astype(np.float64), hashes, np.zeros(len(text)), 0
    worst = np.full(n_texts, np.inf)
    while len(t):
        turn += 1
        draw = mixed(h + np.uint64(turn * 0x9E3779B97F4A7C15 % (1 << 64)))
        when = when - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / w
        at = t * REGISTERS + (mixed(draw ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(REGISTERS)).astype(np.int64)
        np.minimum.at(best, at, when)
        won = best[at] == when
        out[at[won]] = h[won]
        if turn < 8 or turn % 8 == 0:
            worst = best.reshape(n_texts, REGISTERS).max(1)
        on = when < worst[t]
        t, w, h, when = t[on], w[on], h[on], when[on]
    return out.reshape(n_texts, REGISTERS)


def probability_jaccard(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Of two sets of sorted hashes ``a``, ``b`` with weights ``x``, ``y``: the sum over common i of 1 / sum_j max(x_j / x_i, y_j / y_i)."""
    both, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    xi, yi = x[i].astype(np.float64), y[j].astype(np.float64)
    order = np.argsort(xi / yi, kind="stable")
    xi, yi = xi[order], yi[order]
    ratio = xi / yi
    only_x, only_y = x.sum() - xi.sum(), y.sum() - yi.sum()
    cut = np.searchsorted(ratio, ratio, "left")  # elements with a smaller ratio count with y, all others with x
    ys, xs = np.concatenate([[0.0], np.cumsum(yi)]), np.concatenate([[0.0], np.cumsum(xi)])
    return float((1 / ((only_x + xs[-1] - xs[cut]) / xi + (only_y + ys[cut]) / yi)).sum())


class Sets:
    """Weighted sets of some texts with an index from shingles to texts."""

    def __init__(self, hashes: list[np.ndarray], weights: list[np.ndarray]):
        self.hashes, self.weights = hashes, weights
        self.size = np.array([len(h) for h in hashes])
        self.plain = np.array([bool((w == 1).all()) for w in weights])
        _, element = np.unique(np.concatenate(hashes), return_inverse=True)
        self.elements = np.split(element, np.cumsum(self.size)[:-1])
        order = np.argsort(element, kind="stable")
        self.texts = np.repeat(np.arange(len(hashes)), self.size)[order]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(element))])

    def similar(self, x: int, wanted: np.ndarray) -> np.ndarray:
        """Similarity of text ``x`` to every text; only right where ``wanted``."""
        own = self.elements[x]
        a, n = self.starts[own], self.starts[own + 1] - self.starts[own]
        at = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        common = np.bincount(self.texts[at], minlength=len(self.size))
        out = common / (self.size + self.size[x] - common)
        for u in np.flatnonzero(wanted & (common > 0) & ~(self.plain & self.plain[x])):
            out[u] = probability_jaccard(self.hashes[x], self.weights[x], self.hashes[u], self.weights[u])
        return out


def spanning_links(sets: Sets, threshold: float = THRESHOLD) -> list[tuple[int, int]]:
    """A spanning forest of all links of ``threshold`` or more.

    From the first unvisited text on, each found text is compared with unvisited ones; of these only such are looked at whose
    distance from the class's first text differs by no more than a link's length.
    """
    left, out = np.ones(len(sets.size), bool), []
    while left.any():
        root = int(np.flatnonzero(left)[0])
        left[root] = False
        from_root = 1 - sets.similar(root, left)
        queue = np.flatnonzero(left & (from_root <= 1 - threshold + 1e-12))
        left[queue] = False
        out += [(root, int(u)) for u in queue]
        todo = queue.tolist()
        todo.sort(key=lambda u: from_root[u])
        k = 0
        while k < len(todo) and left.any():
            x = todo[k]
            k += 1
            look = left & (np.abs(from_root - from_root[x]) <= 1 - threshold + 1e-9)
            if not look.any():
                continue
            found = np.flatnonzero(look & (sets.similar(x, look) >= threshold - 1e-12))
            left[found] = False
            out += [(x, int(u)) for u in found]
            todo += found.tolist()
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """id, key (of the words; null: none), bands (one hash each), mark (one byte of each register) for every row of ``docs`` (id, text, and
    any others, which are kept)."""
    others = [c for c in docs.columns if c not in ("id", "text")]
    schema = ", ".join([f"id {docs.schema['id'].dataType.simpleString()}, key binary, bands array<long>, mark binary", *(f"{c} {docs.schema[c].dataType.simpleString()}" for c in others)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts):
                text, hashes, weight, keys = shingles(texts[a:b])
                sig = prob_min_hash(text, hashes, weight, b - a)
                band = np.zeros((b - a, BANDS), np.uint64)
                for k in range(ROWS):
                    band = mixed(band * np.uint64(0x9FB21C651E98DF25) + sig[:, k::ROWS] + np.uint64(k + 1))
                band = mixed(band + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                mark = (mixed(sig) >> np.uint64(56)).astype(np.uint8)
                offsets = pa.array(np.arange(0, (b - a + 1) * BANDS, BANDS), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(keys, pa.binary()), pa.ListArray.from_arrays(offsets, pa.array(band.reshape(-1).view(np.int64))), pa.array([m.tobytes() for m in mark], pa.binary())]
                    + [batch.column(2 + i).slice(a, b - a) for i in range(len(others))],
                    names=["id", "key", "bands", "mark", *others],
                )

    return docs.select("id", "text", *others).mapInArrow(run, schema)


def _stars(members: DataFrame) -> DataFrame:
    """rid, first, buckets of ``members`` (rid, bucket): each text with the first ones of its buckets, a row for each of these and the list of
    the buckets where it is first. First ones, and texts alone in a bucket, have no row there.

    First in a bucket is the text that meets most others in all its buckets, so one speaks for most buckets of a group of near copies.
    """
    many = written(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    least = (many.agg(F.sum("n").alias("n")).first()["n"] or 0) // HOT + 1
    hot, other = many.where(F.col("n") >= least), many.where(F.col("n") < least)
    tagged = members.join(F.broadcast(hot), "bucket", "left")
    met = written(tagged.where("n is not null").unionByName(tagged.where("n is null").drop("n").join(other, "bucket")), "met")
    central = met.join(met.groupBy("rid").agg(F.sum("n").alias("others")), "rid").groupBy("bucket", "n").agg(F.min(F.struct(-F.col("others"), "rid"))["rid"].alias("first"))
    central = written(central, "central")
    few, rest = F.broadcast(central.where(F.col("n") >= least).drop("n")), central.where(F.col("n") < least).drop("n")
    of = met.where(F.col("n") >= least).drop("n").join(few, "bucket").unionByName(met.where(F.col("n") < least).drop("n").join(rest, "bucket"))
    return of.where("rid <> first").groupBy("rid", "first").agg(F.collect_list("bucket").alias("buckets"))


def _estimates(stars: DataFrame, marks: DataFrame) -> DataFrame:
    """``stars`` (rid, first, buckets) with ``likely``: the share of registers that agree (their bytes; chance agreement of 1/256 taken off)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, n = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, REGISTERS) for c in ("mark", "other"))
            same = ((m == n).mean(1) - 1 / 256) / (1 - 1 / 256)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("rid", "first", "buckets")), pa.array(same)], names=["rid", "first", "buckets", "likely"])

    met = joined(stars, marks.select(F.col("rid").alias("first"), F.col("mark").alias("other")), "first").join(marks, "rid")
    return met.select("rid", "first", "buckets", "mark", "other").mapInArrow(run, "rid long, first long, buckets array<long>, likely double")


def candidate_links(texts: DataFrame) -> DataFrame:
    """Links a, b whose components hold every pair of ``texts`` (rid, bands, mark) that shares a bucket and may reach the threshold.

    Rows are at most a text and bucket in each round, whatever the sizes of buckets.
    """
    link = lambda df: df.select(F.col("rid").alias("a"), F.col("first").alias("b"))
    members = texts.select("rid", F.explode("bands").alias("bucket"))
    found: DataFrame | None = None
    for _ in range(STAR_ROUNDS):
        stars = written(_stars(members), "stars")
        likely = written(_estimates(stars, texts.select("rid", "mark")), "likely")
        dropped(stars)
        kept = link(likely.where(F.col("likely") >= WEAK))
        found = kept if found is None else found.union(kept)
        members = written(likely.where(F.col("likely") < STRONG).select("rid", F.explode("buckets").alias("bucket")), "members")
        if members.isEmpty():
            break
    else:
        found = found.union(link(_stars(members)))  # what is left is not pruned
    return found.distinct()


def _shingle_sets(docs: DataFrame) -> DataFrame:
    """key, hashes, weights (both binary) for every text of ``docs`` (column text) that has words; copies within a task give one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[bytes] = set()  # keys of the texts that the task has sent
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in slices(texts):
                text, hashes, weight, keys = shingles(texts[a:b])
                cuts = np.searchsorted(text, np.arange(b - a + 1))
                new = [i for i in {k: i for i, k in enumerate(keys) if k and k not in done}.values()]
                done.update(keys[i] for i in new)
                rows = [(keys[i], hashes[cuts[i] : cuts[i + 1]].tobytes(), weight[cuts[i] : cuts[i + 1]].astype(np.uint32).tobytes()) for i in new]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.binary()) for k in range(3)], names=["key", "hashes", "weights"])

    return docs.select("text").mapInArrow(run, "key binary, hashes binary, weights binary")


def _search(table: pa.Table) -> pa.Table:
    table = table.sort_by("rid")
    rid = table.column("rid").to_numpy()
    sets = Sets([np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()], [np.frombuffer(x, np.uint32) for x in table.column("weights").to_pylist()])
    links = np.array(spanning_links(sets), np.int64).reshape(-1, 2)
    return pa.table({"a": rid[links[:, 0]], "b": rid[links[:, 1]]})


def _with(rows: DataFrame, table: DataFrame, size: int, salts: int = 64) -> DataFrame:
    """``rows`` with the columns of ``table``, which has a row a component: broadcast if its ``size`` bytes are few, else by component and salt, so that
    no task gets all rows of a component."""
    if size <= LARGEST_BYTES:
        return rows.join(F.broadcast(table), "component")
    salted = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(salts)).cast("int")).join(salted, ["component", "salt"]).drop("salt")


def _to_pivots(members: DataFrame, pivots: DataFrame) -> DataFrame:
    """``members`` (rid, component, hashes, weights) with ``far``: (pivot, d) for each pivot of their component, d being 1 minus the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = []
            for h, w, ps in zip(*(batch.column(c).to_pylist() for c in ("hashes", "weights", "pivots")), strict=True):
                own = np.frombuffer(h, np.uint64), np.frombuffer(w, np.uint32)
                far.append([{"pivot": p["pivot"], "d": 1 - probability_jaccard(*own, np.frombuffer(p["ph"], np.uint64), np.frombuffer(p["pw"], np.uint32))} for p in ps])
            kind = pa.list_(pa.struct([("pivot", pa.int64()), ("d", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("component"), pa.array(far, kind)], names=["rid", "component", "far"])

    size = pivots.agg(F.sum(F.octet_length("ph").cast("long") + F.octet_length("pw")).alias("n")).first()["n"] or 0
    lists = pivots.groupBy("component").agg(F.collect_list(F.struct("pivot", "ph", "pw")).alias("pivots"))  # at most ``PIVOTS`` a component
    return _with(members, lists, size).select("rid", "component", "hashes", "weights", "pivots").mapInArrow(run, "rid long, component long, far array<struct<pivot:long,d:double>>")


def _leaving(far: DataFrame, reach: float) -> DataFrame:
    """rid of the texts of ``far`` whose links to all texts outside their pivots' cluster are known: pivots, and texts that are too near to a pivot of
    their cluster to be linked to any text that is not in it. Pivots that share a linked text are of one cluster."""
    linked = F.transform(F.filter("far", lambda f: f["d"] <= reach + 1e-12), lambda f: f["pivot"])
    near = far.withColumn("linked", linked).where("size(linked) > 0")
    clusters = components(near.select(F.explode("linked").alias("a"), F.element_at("linked", 1).alias("b")).distinct())
    pivots = far.select("component", F.explode("far").alias("f")).select("component", F.col("f.pivot").alias("node")).distinct()
    named = pivots.join(clusters.withColumnRenamed("component", "cluster"), "node", "left")
    of = written(named.groupBy("component").agg(F.map_from_entries(F.collect_list(F.struct("node", F.coalesce("cluster", "node")))).alias("of")), "clusters")
    size = 32 * PIVOTS * of.count()
    own = F.array_min(F.transform(linked, lambda p: F.col("of")[p]))
    told = _with(far, of, size).withColumn("own", own)
    beyond = told.select("component", "own", "of", F.explode("far").alias("f")).where(~F.col("own").eqNullSafe(F.col("of")[F.col("f.pivot")]))
    least = beyond.groupBy("component", F.col("f.pivot").alias("pivot")).agg(F.min("f.d").alias("least")).groupBy("component").agg(F.map_from_entries(F.collect_list(F.struct("pivot", "least"))).alias("least"))
    least = written(of.select("component").join(least, "component", "left"), "least")
    inside = F.exists("far", lambda f: (F.col("of")[f["pivot"]] == F.col("own")) & (f["d"] < F.coalesce(F.col("least")[f["pivot"]], F.lit(2.0)) - reach - 1e-9))
    is_pivot = F.exists("far", lambda f: f["pivot"] == F.col("rid"))
    return _with(told, least, size).where(is_pivot | F.coalesce(inside, F.lit(False))).select("rid")


def _next_pivots(large: DataFrame, far: DataFrame | None, last: DataFrame | None) -> DataFrame:
    """component, pivot: of each component of ``large`` some texts taken by a hash of their number, and those nearest to one of the last pivots,
    among which is the original if the others are copies of one."""
    by = lambda *order: F.row_number().over(W.partitionBy("component").orderBy(*order))
    some = large.select("component", "rid").withColumn("n", by(F.xxhash64("rid"), "rid")).where(F.col("n") <= (PIVOTS if far is None else PIVOTS // 2)).select("component", F.col("rid").alias("pivot"))
    if far is None:
        return some
    least = far.select("rid", F.array_min(F.transform("far", lambda f: f["d"])).alias("d"))
    near = large.select("component", "rid").join(least, "rid").withColumn("n", by("d", "rid")).where(F.col("n") <= PIVOTS // 2)
    return some.union(near.select("component", F.col("rid").alias("pivot"))).distinct()


def _too_large(sets: DataFrame, largest: int) -> DataFrame:
    sizes = sets.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("hashes").cast("long") + F.octet_length("weights")).alias("bytes"))
    return sizes.where((F.col("n") > largest) | ((F.col("bytes") > LARGEST_BYTES) & (F.col("n") > 1))).select("component")


def verified_links(sets: DataFrame, threshold: float = THRESHOLD, largest: int = LARGEST) -> DataFrame:
    """Links a, b that span all pairs of ``threshold`` or more inside each component of ``sets`` (rid, component, hashes, weights).

    A component of over ``largest`` texts or ``LARGEST_BYTES`` goes through rounds in which every text is compared with up to ``PIVOTS`` pivots, by a
    join, in whatever task it lies. All links to pivots are kept, and the pivots leave with the texts around them that nothing outside can be
    linked to, by the triangle inequality. Every round adds its links, and the components that have become small, to tables in the shared folder.
    """
    reach = 1 - threshold
    hot = written(_too_large(sets, largest), "hot")
    if hot.isEmpty():
        dropped(hot)
        return sets.select("component", "rid", "hashes", "weights").groupBy("component").applyInArrow(_search, "a long, b long")
    spark = sets.sparkSession
    paths = {name: scratch_path(spark, name) for name in ("links", "small")}
    add = lambda df, name: df.write.mode("append").parquet(paths[name])
    read = lambda name: spark.read.parquet(paths[name])
    large = sets.join(hot, "component", "left_semi")
    add(sets.join(hot, "component", "left_anti").select("component", "rid", "hashes", "weights"), "small")
    far = pivots = None
    while True:
        before = far, pivots
        chosen = _next_pivots(large, *before)
        pivots = written(chosen.join(large.select("component", F.col("rid").alias("pivot"), F.col("hashes").alias("ph"), F.col("weights").alias("pw")), ["component", "pivot"]), "pivots")
        far = written(_to_pivots(large, pivots), "far")
        for done in (d for d in before if d is not None):
            dropped(done)
        pair = far.select("rid", F.explode("far").alias("f")).where((F.col("f.d") <= reach + 1e-12) & (F.col("rid") != F.col("f.pivot")))
        add(pair.select(F.col("f.pivot").alias("a"), F.col("rid").alias("b")), "links")
        leaving = written(_leaving(far, reach), "leaving")
        rest = written(large.join(leaving, "rid", "left_anti"), "large")
        still = written(_too_large(rest, largest), "hot")
        add(rest.join(still, "component", "left_anti").select("component", "rid", "hashes", "weights"), "small")
        large = written(rest.join(still, "component", "left_semi"), "large")
        for done in (leaving, rest, still):
            dropped(done)
        if large.isEmpty():
            break
    return read("small").groupBy("component").applyInArrow(_search, "a long, b long").union(read("links"))


def _with_digests(plain: DataFrame, digests: DataFrame, counted: DataFrame) -> DataFrame:
    """Rows of ``plain`` (text, digest) with one of ``digests``, one a text. Few digests are broadcast. Of more, those that over a thousandth of the rows
    ``counted`` have, at most a thousand, still are; only rows with any other one are shuffled."""
    if digests.count() <= FEW:
        return plain.join(F.broadcast(digests), "digest", "left_semi")
    least = max(2, counted.count() // 1000 + 1)
    hot = written(counted.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("digest"), "hot")
    many = plain.join(F.broadcast(hot.join(digests, "digest", "left_semi")), "digest", "left_semi")
    return many.union(plain.join(F.broadcast(hot), "digest", "left_anti").join(digests, "digest", "left_semi"))


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, largest: int = LARGEST) -> DataFrame:
    """One row per row of ``docs``: its id, class_id (smallest id of its class), class_size (rows), copies (rows with the same words).

    A class is a component of all links between texts of ``threshold`` or more. Null counts as empty; a text with no words is alone in its
    class. Null ids are ignored in class_id unless a class has no other. An empty table gives an empty result; only the two named
    columns are read.
    """
    return _classes(docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")), threshold, largest).drop("digest").withColumnRenamed("id", id_col)


def _classes(plain: DataFrame, threshold: float = THRESHOLD, largest: int = LARGEST) -> DataFrame:
    """``near_classes`` of ``plain`` (id, text), with ``digest`` of the text."""
    others = ["digest"]
    small_batches(plain.sparkSession)
    plain = plain.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))
    rows = written(signatures(plain), "signatures")
    named = rows.where("key is not null")
    texts = written(named.dropDuplicates(["key"]).select("key", "digest", "bands", "mark", F.monotonically_increasing_id().alias("rid")), "texts")
    links = written(candidate_links(texts.select("rid", "bands", "mark")), "candidates")
    groups = components(links)
    wanted = written(texts.join(groups, texts.rid == groups.node).select("key", "digest", "rid", "component"), "wanted")
    dropped(links)
    sets = _shingle_sets(_with_digests(plain, wanted.select("digest"), named)).groupBy("key").agg(F.first("hashes").alias("hashes"), F.first("weights").alias("weights"))
    sets = written(sets.join(wanted.select("key", "rid", "component"), "key").select("rid", "component", "hashes", "weights"), "sets")
    exact = written(verified_links(sets, threshold, largest), "verified")
    dropped(sets)
    classes = components(exact).select(F.col("node").alias("rid"), "component")
    labelled = texts.select("key", "rid").join(classes, "rid", "left").select("key", F.coalesce("component", "rid").alias("class"))
    per_text = written(named.groupBy("key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")).join(labelled, "key"), "labelled")
    per_class = per_text.groupBy("class").agg(F.min("first").alias("class_id"), F.sum("copies").alias("class_size"))
    found = written(joined(per_text, per_class, "class").where("class_size > 1").select("key", "class_id", "class_size", "copies"), "classes")
    for done in (texts, wanted, exact, per_text):
        dropped(done)
    with_class = joined(named.select("id", "key", *others), found, "key", "left")
    alone = rows.where("key is null").select("id", "key", *others).withColumns({"class_id": F.lit(None).cast(plain.schema["id"].dataType)} | {c: F.lit(None).cast("long") for c in ("class_size", "copies")})
    return with_class.unionByName(alone).select(
        "id", *others, F.when(F.col("class_size").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"), F.coalesce("copies", F.lit(1).cast("long")).alias("copies"),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns kept: of each class the one with the smallest id. Rows alone in their class stay.

    If several rows carry that id, or all ids of a class are null, these rows all stay. Rows go by id and digest of the text, so one that
    shares its id with a copy of another text stays.
    """
    own_id, own_digest = fresh(docs, "_id", "_digest")
    digest = F.unhex(F.md5(text_or_empty(text_col).cast("binary")))
    classes = _classes(docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")))
    going = classes.where((F.col("class_size") > 1) & ~F.col("id").eqNullSafe(F.col("class_id"))).select(F.col("id").alias(own_id), F.col("digest").alias(own_digest)).distinct()
    going = written(going, "going")
    on = F.col(id_col).eqNullSafe(F.col(own_id)) & (digest == F.col(own_digest))
    return docs.join(F.broadcast(going) if going.count() <= FEW else going, on, "left_anti")
