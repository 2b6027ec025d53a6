"""Exact top-k search: an impact-ordered, score-at-a-time index over integer vectors.

Rows are dealt at random into shards of bounded size, one shard to a task. Every query row, a stated
set, goes to each shard; a shard's rows come first, its queries are streamed after them in blocks, so
that memory holds one shard's rows and one block's scores.

A segment is the postings of one dimension in one shard. Its impact on a query is the greatest share
of a score that it can hold, |q_d| times the dimension's greatest |component|, quantised to `levels`
steps of the query's greatest impact. Segments are processed by descending quantised impact, for a
block of queries at once (a matrix product whose factor is 0 where a segment isn't a query's turn).
After every `look_every` segments the `few` rows that score best so far are scored exactly, and the
k-th of these scores is the threshold. What a row may still gain is at most the length of the query's
rest times the length of the row's own rest (Cauchy-Schwarz), so rows whose score and gain lie below
the threshold are proven out. A first look comes before any segment, at the longest rows. Once at most
an `open_share` of the rows is left for every query of the block, these possible members are scored
exactly and the rest of the segments isn't read. Without that proof all segments are. The k best of
each shard meet in a window over (query, shard winners), at most k rows a shard.

Sums are of integers in the narrowest floating type that holds every one of them exactly, by a bound
proven from the greatest components; where none does, whole numbers of any size score all rows.

Defined results: vectors that are null, empty or hold null or non-finite components take no part, nor
do null ids. Shorter vectors count as padded with zeros. Rows with the query's own id are never its
candidates; of rows that repeat a query's id the least vector is the query. Repeated candidate rows
each take a rank. Ties go to the smaller vec_id. Scores beyond 64 bits are ranked within their shard by
their exact value and given as the nearest 64-bit number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TopKParams:
    k: int = 5
    scale: int = 256
    query_modulus: int = 50
    shard_rows: int = 16384
    levels: int = 16  # quantised impacts
    look_every: int = 8  # segments of a query between two looks at the bound
    few: int = 32  # rows whose exact scores make the threshold
    block: int = 256  # queries that are searched together
    open_share: float = 1 / 16  # of a shard's rows: so many possible members are scored at once


def _type_for(n_dims: int, a: int, b: int):
    """The narrowest type in which sums of n_dims products up to a * b are exact."""
    most = n_dims * max(a, b, 1) ** 2
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object


class ImpactIndex:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, p: TopKParams):
        self.ids, self.exact, self.p = ids.astype(np.int64), vectors, p
        self.segments = range(vectors.shape[1])
        self.greatest = np.abs(vectors).max(axis=0)
        self.most = int(self.greatest.max())
        self.kind = None

    def _as(self, kind) -> None:
        if self.kind is not kind:
            self.kind = kind
            self.vectors = self.exact.astype(kind)
            self.squares = self.vectors**2
            self.norms = self.squares.sum(axis=1)
            self.longest = np.argsort(-self.norms, kind="stable")

    def turns(self, queries: np.ndarray) -> np.ndarray:
        """Of each query and segment: between which looks, from 0, the segment is processed."""
        impact = np.abs(queries).astype(np.float64) * self.greatest.astype(np.float64)
        quantised = np.ceil(impact / np.maximum(impact.max(axis=1, keepdims=True), 1) * self.p.levels)
        place = np.argsort(np.argsort(-quantised, axis=1, kind="stable"), axis=1, kind="stable")
        return place // self.p.look_every

    def search(self, query_id: int, q: np.ndarray) -> tuple[list[tuple[int, int]], int]:
        """(score, vec_id) of the k best, and how many segments were processed."""
        found, done = self.search_block(np.array([query_id]), q[None, :])
        return [(score, i) for _, i, score in found], done

    def search_block(self, ids: np.ndarray, queries: np.ndarray) -> tuple[list[tuple[int, int, int]], int]:
        """(query, row's id, score) of each query's k best, and how many segments were processed for each."""
        kind = _type_for(queries.shape[1], self.most, int(np.abs(queries).max(initial=0)))
        if kind is object:
            return self._exhaust(ids, queries), len(self.segments)
        self._as(kind)
        p, n, q = self.p, len(self.ids), queries.astype(kind)
        own = [np.flatnonzero(self.ids == i) for i in ids]
        few = min(n, max(p.few, p.k) + max((len(x) for x in own), default=0))
        allowed = max(p.open_share * n, few)
        turn = self.turns(queries)
        partial, rest, left = None, None, (q**2).sum(axis=1)

        def members(i: int, seeds: np.ndarray, bound: np.ndarray) -> np.ndarray:
            seeds = seeds[~np.isin(seeds, own[i])]
            if len(seeds) < p.k:
                return np.arange(n)
            threshold = np.partition(self.vectors[seeds] @ q[i], -p.k)[-p.k]
            return np.flatnonzero(bound >= threshold)

        def gain(of: np.ndarray, i: int) -> np.ndarray:
            return np.sqrt(of.clip(0) * max(left[i], 0)) * kind(1 + 1e-5) + 1  # makes up for the root's rounding

        def look(at_most: float) -> list[np.ndarray] | None:
            found = []
            seeds = None if partial is None else np.argpartition(partial, n - few, axis=1)[:, n - few :]
            for i in range(len(q)):
                rows = members(i, self.longest[:few], gain(self.norms, i)) if partial is None else members(i, seeds[i], partial[i] + gain(rest[i], i))
                if len(rows) > at_most:
                    return None
                found.append(rows)
            return found

        done, rows = 0, look(allowed)
        for at in range(int(turn.max()) + 1):
            if rows is not None:
                break
            if partial is None:
                partial, rest = np.zeros((len(q), n), kind), np.tile(self.norms, (len(q), 1))
            now = turn == at
            used = now.any(axis=0)
            factor = np.where(now, q, 0)[:, used]
            partial += factor @ self.vectors[:, used].T
            rest -= now[:, used].astype(kind) @ self.squares[:, used].T
            left = left - (factor**2).sum(axis=1)
            done += int(now[0].sum())
            rows = look(allowed if at < turn.max() else n)
        out = []
        for i, found in enumerate(rows):
            found = found[~np.isin(found, own[i])]
            scores = (self.vectors[found] @ q[i]).astype(np.int64)
            order = np.lexsort((self.ids[found], -scores))[: p.k]
            out += [(int(ids[i]), int(self.ids[found[j]]), int(scores[j])) for j in order]
        return out, done

    def _exhaust(self, ids: np.ndarray, queries: np.ndarray) -> list[tuple[int, int, int]]:
        rows, out = self.exact.astype(object), []
        for i, q in zip(ids.tolist(), queries.astype(object)):
            best = sorted((-s, j) for s, j in zip((rows @ q).tolist(), self.ids.tolist()) if j != i)[: self.p.k]
            out += [(i, j, max(-(1 << 63), min((1 << 63) - 1, -s))) for s, j in best]
        return out


def integer_vectors(lists: pa.Array, dims: int, scale: int) -> np.ndarray:
    """floor(scale * x), exactly; of Python integers where 63 bits can't hold one."""
    offsets = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
    values = values[offsets[0] : offsets[-1]]
    if len(values) and np.abs(values).max() * scale >= 2.0**62:
        # from 2**53 on a double is a whole number
        flat = np.array([int(x) * scale if abs(x) >= 2.0**53 else math.floor(x * scale) for x in values.tolist()], object)
    else:
        flat = np.floor(scale * values).astype(np.int64)
    offsets = offsets - offsets[0]
    if len(offsets) > 1 and (np.diff(offsets) == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(lists), dims), flat.dtype)
    for i, (s, e) in enumerate(zip(offsets, offsets[1:])):
        out[i, : e - s] = flat[s:e]
    return out


def _fit(vectors: np.ndarray, width: int) -> np.ndarray:
    return np.pad(vectors, ((0, 0), (0, max(0, width - vectors.shape[1]))))[:, :width]


def _searched(batches: Iterator[pa.RecordBatch], p: TopKParams) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (shard, is_query): a shard's vectors, then its queries."""
    shard, held, index = None, [], None
    for b in batches:
        out = []
        keys, kinds = b.column(0).to_numpy(), b.column(1).to_numpy()
        cuts = [0, *(np.flatnonzero((np.diff(keys) != 0) | (np.diff(kinds) != 0)) + 1).tolist(), b.num_rows]
        for s, e in zip(cuts, cuts[1:]):
            if s == e:
                continue
            if keys[s] != shard:
                shard, held, index = keys[s], [], None
            part = b.slice(s, e - s)
            ids, lists = part.column(2).to_numpy(), pa.concat_arrays([part.column(3)])
            vectors = integer_vectors(lists, int(np.diff(lists.offsets.to_numpy()).max(initial=0)), p.scale)
            if not kinds[s]:
                held.append((ids, vectors))
                continue
            if index is None and held:
                width = max(v.shape[1] for _, v in held)
                index = ImpactIndex(np.concatenate([i for i, _ in held]), np.concatenate([_fit(v, width) for _, v in held]), p)
                held = []
            if index is not None:
                vectors = _fit(vectors, index.exact.shape[1])
                for at in range(0, len(ids), p.block):
                    out += index.search_block(ids[at : at + p.block], vectors[at : at + p.block])[0]
        yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], pa.int64()) for c in range(3)], ["query_id", "vec_id", "score"])


def top_k(embeddings: DataFrame, p: TopKParams = TopKParams()) -> DataFrame:
    """query_id, rank, vec_id, score."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    fine = "vec_id is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    rows = rows.where(fine)
    shards = max(1, math.ceil(rows.count() / p.shard_rows))
    queries = rows.where(F.col("vec_id") % p.query_modulus == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    vectors = rows.select(F.pmod(F.xxhash64("vec_id", "embedding", F.monotonically_increasing_id()), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("is_query"), "vec_id", "embedding")
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("is_query"), "vec_id", "embedding")
    met = vectors.union(asked).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "is_query")
    found = met.mapInArrow(lambda it: _searched(it, p), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= p.k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
