import math

import numpy as np

from siltlake.llm import topk
from siltlake.llm.common import read_table


def brute(rows, modulus=50, k=5):
    fine = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for i in sorted({i for i, _ in fine if i % modulus == 0}):
        q = min(v for j, v in fine if j == i)
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in fine if j != i)[:k]
        for r, (s, j) in enumerate(scores):
            out[i, r + 1] = (j, -s)
    return out


def test_whole_table(spark, sf_dir):
    df = read_table(spark, sf_dir, "embeddings")
    want = brute([(r.vec_id, r.embedding) for r in df.collect()])
    for p in (topk.TopKParams(), topk.TopKParams(shard_rows=64, few=8, look_every=16)):
        assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(df, p).collect()} == want


def test_stops_on_proof():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-20, 20, (4000, 16))
    vectors[7] = vectors[11] = 120
    ids = np.arange(4000)
    index = topk.ImpactIndex(ids, vectors, topk.TopKParams(k=1, few=16, look_every=16))
    found, done = index.search(7, vectors[7])
    assert found == [(int(vectors[7] @ vectors[11]), 11)] and done < len(index.segments)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (50, [1.0]), (1, None), (2, []), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, 0.5]), (6, [1.0, 0.5]), (7, [-1.0, 2.0, 9.0]), (None, [1.0, 1.0]), (0, [2.0, 0.5])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    got = sorted(map(tuple, topk.top_k(df).collect()))
    assert [x for x in got if x[0] == 50] == [(50, 1, 0, 131072), (50, 2, 0, 65536), (50, 3, 6, 65536), (50, 4, 6, 65536), (50, 5, 7, -65536)]
    assert [x[2] for x in got if x[0] == 0] == [6, 6, 50, 7]
    assert topk.top_k(df.limit(0)).count() == 0
