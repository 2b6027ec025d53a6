"""op2's proof and its limits: how much of the index is read, numbers beyond 64 bits, one shard to a task."""

import numpy as np
from pyspark.sql import functions as F

from siltlake.llm import topk
from siltlake.llm.common import read_table
from tests.llm.test_topk import brute


def test_share_of_segments_on_random_vectors():
    # unit vectors in 64 dimensions without any structure: nothing is harder to prune
    x = np.random.default_rng(1).normal(size=(4000, 64))
    vectors = np.floor(256 * x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.int64)
    ids = np.arange(4000)
    index = topk.ImpactIndex(ids, vectors, topk.TopKParams())
    found, done = index.search_block(ids[:80], vectors[:80])
    assert done / len(index.segments) <= 0.75
    for i in range(80):
        scores = vectors @ vectors[i]
        want = [(i, int(j), int(scores[j])) for j in np.lexsort((ids, -scores)) if j != i][:5]
        assert [x for x in found if x[0] == i] == want


def test_structure_is_used():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(50, 64))
    x = centres[rng.integers(0, 50, 4000)] + 0.15 * rng.normal(size=(4000, 64))
    vectors = np.floor(256 * x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.int64)
    index = topk.ImpactIndex(np.arange(4000), vectors, topk.TopKParams())
    assert index.search_block(np.arange(40), vectors[:40])[1] / len(index.segments) <= 0.4


def test_turns_follow_quantised_impact():
    vectors = np.array([[4, -90, 7, 0], [1, 30, -7, 0]])
    index = topk.ImpactIndex(np.arange(2), vectors, topk.TopKParams(look_every=1))
    assert index.turns(np.array([[50, 1, 3, 9]])).tolist() == [[0, 1, 2, 3]]
    assert index.turns(np.array([[1, 5, 60, 9]])).tolist() == [[2, 0, 1, 3]]


def test_whole_numbers_of_any_size(spark):
    rows = [(0, [1e30, 1.0]), (1, [1e30, 3.0]), (2, [2e30, -1.0]), (3, [-1e30, 5.0]), (4, [1e308, 0.0]), (5, [1.0, 1.0]), (50, [3.0e9, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(df).collect()}
    clamp = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    whole = [(i, [int(x) * 256 for x in v]) for i, v in rows]
    for q in (0, 50):
        v = dict(whole)[q]
        best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q)[:5]
        # what is clamped to one score goes by vec_id
        assert [got[q, k + 1] for k in range(5)] == sorted(((i, clamp(-s)) for s, i in best), key=lambda x: (-x[1], x[0]))


def test_a_shard_is_one_task(spark, sf_dir):
    df = read_table(spark, sf_dir, "embeddings")
    p = topk.TopKParams(shard_rows=32)
    seen = []
    was = topk._searched

    def watched(it, p):
        from pyspark import TaskContext

        import pyarrow as pa

        batches = list(it)
        shards = {s for b in batches for s in b.column(0).to_pylist()}
        for b in was(iter(batches), p):
            yield b
        yield pa.RecordBatch.from_arrays([pa.array([-1 - TaskContext.get().partitionId()] * len(shards)), pa.array(sorted(shards), pa.int64()), pa.array([1 << 40] * len(shards))], ["query_id", "vec_id", "score"])

    topk._searched = watched
    try:
        seen = topk.top_k(df, p).where("query_id < 0").collect()
    finally:
        topk._searched = was
    n = -(-df.count() // 32)
    assert sorted(r.vec_id for r in seen) == list(range(n)) and len({r.query_id for r in seen}) == n


def test_many_equal_vectors(spark):
    df = spark.range(600).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 == 0, F.array(F.lit(0.5), F.lit(0.25))).otherwise(F.array(F.rand(1), F.rand(2))).alias("embedding"))
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), topk.TopKParams(shard_rows=100)).collect()}
    assert got == brute(rows)
