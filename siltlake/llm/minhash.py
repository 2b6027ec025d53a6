"""MinHash near-dedup: circulant MinHash, banding, exact Jaccard confirmation, components.

Texts become sets of 64-bit shingle hashes. Two permutations make the whole signature: the first
(sigma, a bijective mixer) places a shingle in a universe of 2**universe_bits positions, the second
(pi, a seeded table) is read at that place and at the places circularly after it, one for each
signature coordinate, so that a shingle's K values are one contiguous slice of the table.

What follows the banding never forms all pairs of a bucket:

1. Equal sets are one class; only its representative (the least doc_id) goes on.
2. In each bucket every member is compared with the bucket's least member only (a star).
3. Components of the confirmed links are labelled by alternating large-star and small-star steps, as
   joins, until nothing changes; nothing goes to the driver.
4. Links that a star misses join different components within one bucket. Only buckets whose members
   aren't all one component yet go on, one for each set of members. A bucket's members are dealt by size
   class and a hash into blocks of bounded size; pairs of its blocks are compared exactly, without the
   pairs of blocks inside the bucket's largest component and those whose sizes rule out the similarity.
   A block pair gives back a spanning forest of its links at most.
5. Components are merged over those links.

Tables that meet a table of many rows for one key (a class of thousands of copies, a hub, a bucket) are
written first, so that both sides of the join are plain exchanges, whose large partitions Spark splits
at run time. All intermediate tables are deleted; what stays is the result, a narrow table.

Sets of more than 2**universe_bits shingles share positions, and so signatures: that makes candidates
which the exact comparison dismisses.

A candidate is missed only if no band agrees: with 32 bands of 4, below 5e-8 at a similarity of 0.8.

Defined results: null text, or text without words: empty set, linked with nothing, its own component,
kept. Null doc_id: takes no part in links, component_id null, kept. Repeated doc_id: one row out for
each row in; the id is linked with whatever one of its texts is linked with.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltlake.llm.common import bloom_join, discard, materialise, slices


@dataclass(frozen=True)
class MinHashParams:
    words: int = 5
    percent: int = 80  # linked when 100 * intersection >= percent * union
    rows: int = 4
    bands: int = 32
    universe_bits: int = 20
    seed: int = 11
    block_rows: int = 512
    block_shingles: int = 150_000


class _WordHashes(dict):
    """Hash of a word, remembered for at most `bound` words."""

    bound = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _WordHashes()
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of `words` words. A-Z is lowered, words are
    separated by the six ASCII white-space characters; a text with fewer words is one shingle."""
    if not text:
        return np.empty(0, np.uint64)
    found = text.encode("utf-8", "surrogatepass").lower().split()
    h = np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))
    if not len(h):
        return h
    width = min(words, len(h))
    n = len(h) - width + 1
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = _mix(out * _M1 + h[i : i + n])
    return np.unique(out)


@functools.lru_cache(2)
def _windows(p: MinHashParams) -> np.ndarray:
    k = p.rows * p.bands
    table = np.random.default_rng(p.seed).permutation(1 << p.universe_bits).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([table, table[:k]]), k)


def signature(shingles: np.ndarray, p: MinHashParams) -> np.ndarray:
    """The K coordinates of circulant MinHash."""
    windows = _windows(p)
    at = (_mix(shingles + _M1) >> np.uint64(64 - p.universe_bits)).astype(np.int64)
    out = windows[at[0]].copy()
    for i in range(1, len(at), 1024):
        np.minimum(out, windows[at[i : i + 1024]].min(axis=0), out=out)
    return out


def band_hashes(sig: np.ndarray, p: MinHashParams) -> np.ndarray:
    out = np.arange(1, p.bands + 1, dtype=np.uint64) * _M3
    for column in sig.reshape(p.bands, p.rows).T.astype(np.uint64):
        out = _mix(out * _M1 + column)
    return out.view(np.int64)


def _signed(texts: Iterator[pa.RecordBatch], p: MinHashParams) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for b in slices(texts):
            n, k1, k2, bands = [], [], [], []
            for text in b.column(1).to_pylist():
                s = shingle_set(text, p.words)
                key = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
                n.append(len(s))
                k1.append(int(key[0]))
                k2.append(int(key[1]))
                bands.append(band_hashes(signature(s, p), p) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "n", "k1", "k2", "bands"],
            )


def _sets(texts: Iterator[pa.RecordBatch], p: MinHashParams) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for b in slices(texts):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingle_set(t, p.words).tobytes() for t in b.column(1).to_pylist()], pa.binary())], ["id", "shingles"])


def _confirmed(rows: Iterator[pa.RecordBatch], p: MinHashParams) -> Iterator[pa.RecordBatch]:
    for b in slices(rows, 64):
        ok = []
        for x, y in zip(b.column(2), b.column(3)):
            a, c = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            ok.append(len(a) > 0 and len(c) > 0 and _linked(_common(a, c), len(a), len(c), p.percent))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))


def _common(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _linked(common, n, m, percent: int):
    return 100 * common >= percent * (n + m - common)


def block_links(ids: list[int], comps: list[int], sides: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between different components and, where sides holds both 0
    and 1, between the two sides. Intersections are counted by a product of 0/1 matrices, over the
    shingles of two rows or more, a bounded number of columns at a time."""
    n = np.array([len(s) for s in sets])
    owner, flat = np.repeat(np.arange(len(sets)), n), np.concatenate(sets)
    _, code, df = np.unique(flat, return_inverse=True, return_counts=True)
    code = np.where(df > 1, np.cumsum(df > 1) - 1, -1)[code]
    owner, code = owner[code >= 0], code[code >= 0]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    left, right = (np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)) if sides.any() and not sides.all() else (np.arange(len(sets)),) * 2
    common = np.zeros((len(left), len(right)), np.float32)
    width = 4096
    for at in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        lo, hi = np.searchsorted(code, [at, at + width])
        part = np.zeros((len(sets), width), np.float32)
        part[owner[lo:hi], code[lo:hi] - at] = 1
        common += part[left] @ part[right].T
    root = {c: c for c in comps}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    out = []
    hit = _linked(common.astype(np.int64), n[left][:, None], n[right][None, :], percent)
    for i, j in zip(*np.nonzero(hit)):
        x, y = int(left[i]), int(right[j])
        a, b = find(comps[x]), find(comps[y])
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((ids[x], ids[y]))
    return out


def _blocks(rows: Iterator[pa.RecordBatch], p: MinHashParams) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, lo, hi): each run of equal keys is one pair of blocks."""
    key, held = None, []

    def done() -> list[tuple[int, int]]:
        if len({x[1] for x in held}) < 2:
            return []
        ids, comps, sides, sets = zip(*held)
        return block_links(ids, comps, np.array(sides), [np.frombuffer(s, np.uint64) for s in sets], p.percent)

    for b in slices(rows, 1024):
        out = []
        for bucket, lo, hi, side, i, comp, shingles in zip(*(c.to_pylist() for c in b.columns)):
            if (bucket, lo, hi) != key:
                out += done()
                key, held = (bucket, lo, hi), []
            held.append((i, comp, side, shingles))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], ["a", "b"])
    out = done()
    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges -> a table (id, label): the least id of each component, for every id that has an edge.
    Alternating large-star and small-star steps until nothing changes, a number of rounds that grows
    with the logarithm of the edges at most squared; each round's edges are written to the shared folder."""

    def stars(e: DataFrame) -> tuple[DataFrame, DataFrame]:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # every edge now goes from a larger id (a) to a smaller one (b)
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        joined = large.select(F.col("a").alias("u"), F.col("b").alias("v")).join(low, "u")
        small = joined.select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e"))
        return small.select("e.a", "e.b").where("a <> b").distinct(), least

    now = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    digest = None
    while True:
        after, least = stars(now)
        then, now = now, materialise(after, "edges")
        discard(then, least)
        mark = tuple(now.agg(F.count("*"), F.expr("coalesce(bit_xor(xxhash64(a, b)), 0)")).first())
        if mark == digest:
            break
        digest = mark
    roots = now.select(F.col("b").alias("id")).distinct().withColumn("label", F.col("id"))
    out = materialise(now.select(F.col("a").alias("id"), F.col("b").alias("label")).union(roots), "labels")
    discard(now)
    return out


def near_duplicates(documents: DataFrame, p: MinHashParams = MinHashParams()) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = materialise(docs.mapInArrow(lambda it: _signed(it, p), "doc_id long, n long, k1 long, k2 long, bands array<long>"), "signed")
    usable = signed.where("n > 0 and doc_id is not null")
    classes = materialise(usable.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")), "classes")
    # the bands travel with a class's first row only
    keyed = signed.select("doc_id", "n", F.when(F.expr("n > 0 and doc_id is not null"), F.col("k1")).alias("k1"), "k2", "bands")
    member = materialise(
        keyed.join(classes, ["k1", "k2"], "left").select("doc_id", "n", "rep", F.when(F.col("doc_id") == F.col("rep"), F.col("bands")).alias("bands")), "member")
    discard(signed, classes)
    buckets = member.where("bands is not null").select("rep", F.explode("bands").alias("bucket"))
    first = materialise(buckets.groupBy("bucket").agg(F.min("rep").alias("head"), F.max("rep").alias("tail")).where("head < tail").select("bucket", "head"), "first")
    shared = materialise(buckets.join(first, "bucket").select("bucket", "rep", "head"), "shared")
    discard(first)
    star = materialise(shared.where("rep <> head").select(F.col("head").alias("a"), F.col("rep").alias("b")).distinct(), "star")

    # only the texts of candidates need to move; Spark's Bloom filter drops the others before the exchange
    wanted = materialise(shared.select(F.col("rep").alias("doc_id")).distinct(), "wanted")
    with bloom_join(docs.sparkSession):
        sets = materialise(docs.join(wanted.where(f"doc_id >= {-(1 << 63)}"), "doc_id", "left_semi").select("doc_id", "text").mapInArrow(lambda it: _sets(it, p), "id long, shingles binary").where("length(shingles) > 0").withColumn("n", F.expr("length(shingles) div 8")), "sets")
    discard(wanted)
    pairs = star.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
    ratio = F.expr(f"100 * least(length(x), length(y)) >= {p.percent} * greatest(length(x), length(y))")
    links = materialise(pairs.where(ratio).select("a", "b", "x", "y").mapInArrow(lambda it: _confirmed(it, p), "a long, b long").distinct(), "links")
    linked = components(links).withColumnRenamed("label", "comp")
    discard(star, links)

    more = _missed(shared, linked, sets, p)
    of = lambda c: linked.select(F.col("id").alias(c), F.col("comp").alias("c" + c))
    between = more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    merged = components(between).select(F.col("id").alias("comp"), F.col("label").alias("final"))
    # an id of `merged` is a component or a document that no star links
    final = linked.join(merged, "comp", "left").select(F.col("id").alias("rep"), F.coalesce("final", "comp").alias("component"))
    alone = merged.join(linked, merged["comp"] == linked["id"], "left_anti").select(F.col("comp").alias("rep"), F.col("final").alias("component"))
    out = (
        member.select("doc_id", "n", "rep").join(final.union(alone), "rep", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
    out = materialise(out, "near-duplicates")
    discard(member, shared, sets, linked, more, merged)
    return out


def _missed(shared: DataFrame, linked: DataFrame, sets: DataFrame, p: MinHashParams) -> DataFrame:
    """A table (a, b): links between components that meet in a bucket, at least a spanning set of them."""
    rows = shared.join(linked.withColumnRenamed("id", "rep"), "rep", "left").select("bucket", F.col("rep").alias("id"), F.coalesce("comp", "rep").alias("comp"))
    rows = materialise(rows, "in-buckets")
    # the star compared a bucket of two; buckets of the same members are one
    mixed = rows.groupBy("bucket").agg(F.count("*").alias("size"), F.min("comp").alias("low"), F.max("comp").alias("high"), F.bit_xor(F.xxhash64("id")).alias("x"), F.sum(F.xxhash64(F.lit(1), "id").cast("decimal(20,0)")).alias("s"))
    mixed = materialise(mixed.where("low < high and size > 2").groupBy("size", "x", "s").agg(F.min("bucket").alias("bucket")).select("bucket"), "mixed")
    met = materialise(rows.join(mixed, "bucket", "left_semi"), "unsettled")
    parts = met.groupBy("bucket", "comp").agg(F.count("*").alias("size"))
    main = materialise(parts.groupBy("bucket").agg(F.max(F.struct("size", "comp"))["comp"].alias("main")), "main")
    # sizes within the similarity of each other lie in the same or the next class
    klass = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(101.0 / p.percent))).cast("int")
    own = met.join(main, "bucket").join(sets.select("id", "n"), "id").select("bucket", "id", "comp", (F.col("comp") == F.col("main")).cast("int").alias("main"), "n", klass.alias("klass"))
    own = materialise(own, "strewn")
    strata = own.groupBy("bucket", "main", "klass").agg(F.count("*").alias("size"), F.max("n").alias("longest"))
    cap = F.greatest(F.lit(1), F.least(F.lit(p.block_rows), F.floor(F.lit(p.block_shingles) / F.col("longest"))))
    strata = materialise(strata.select("bucket", "main", "klass", F.ceil(F.col("size") / cap).cast("int").alias("blocks")), "strata")
    code = lambda main, k, block: (F.col(main).cast("long") * 4096 + F.col(k)) * (1 << 40) + F.col(block)
    other = strata.select("bucket", F.col("main").alias("main2"), F.col("klass").alias("klass2"), F.col("blocks").alias("blocks2"))
    placed = materialise(own.join(strata, ["bucket", "main", "klass"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("long")).drop("blocks"), "placed")
    asked = (
        placed.join(other, "bucket").where("main + main2 < 2 and abs(klass - klass2) <= 1")
        .withColumn("block2", F.explode(F.sequence(F.lit(0), F.col("blocks2") - 1)))
        .select("bucket", code("main", "klass", "block").alias("mine"), code("main2", "klass2", "block2").alias("theirs"), "id", "n", "comp")
        .select("bucket", F.least("mine", "theirs").alias("lo"), F.greatest("mine", "theirs").alias("hi"), (F.col("mine") > F.col("theirs")).cast("int").alias("side"), "id", "n", "comp")
    )
    full = asked.join(sets, ["id", "n"]).select("bucket", "lo", "hi", "side", "id", "comp", "shingles")
    full = full.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
    out = materialise(full.mapInArrow(lambda it: _blocks(it, p), "a long, b long"), "missed")
    discard(rows, mixed, met, main, own, strata, placed)
    return out


#: The same for sets of two words, exactly: a set of n shingles and one linked with it share one of the
#: n - ceil(0.8 n) + 1 rarest shingles of each.
SQL_TWO_WORDS = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D\x20]+'), lambda w: w <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 2 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) WHEN len(w) = 1 THEN w ELSE [] END AS s FROM words
), reps AS (
  SELECT min(doc_id) AS rep, list_sort(s) AS s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY 2, 3
), rows AS (SELECT rep, n, unnest(s) AS x FROM reps
), ranked AS (
  SELECT rep, n, x, row_number() OVER (PARTITION BY rep ORDER BY df, x) AS pos FROM (SELECT *, count(*) OVER (PARTITION BY x) AS df FROM rows)
), prefix AS (SELECT rep, n, x FROM ranked WHERE pos <= n - ceil(0.8 * n) + 1
), cand AS (
  SELECT DISTINCT a.rep AS a, b.rep AS b FROM prefix a JOIN prefix b ON a.x = b.x AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), links AS (
  SELECT a, b FROM cand JOIN reps p ON p.rep = a JOIN reps q ON q.rep = b
  WHERE 100 * len(list_intersect(p.s, q.s)) >= 80 * (p.n + q.n - len(list_intersect(p.s, q.s)))
), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT rep AS start, rep AS node FROM reps UNION SELECT r.start, e.b FROM reach r JOIN edges e ON r.node = e.a
), comp AS (SELECT node AS rep, min(start) AS c FROM reach GROUP BY node)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(c.c, s.doc_id) AS component_id, s.doc_id = coalesce(c.c, s.doc_id) AS kept
FROM sets s LEFT JOIN reps r ON list_sort(s.s) = r.s LEFT JOIN comp c ON c.rep = r.rep
"""
