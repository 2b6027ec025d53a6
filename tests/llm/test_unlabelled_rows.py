import numpy as np
from pyspark.sql import functions as F

from siltlake.llm import quality


def test_every_unlabelled_row_is_learned_from(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(3, 1, (600, quality.N_STATS)), rng.normal(3, 1, (9000, quality.N_STATS))])
    y = [1] * 600 + [-1] * 9000
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in zip(y, x)], "y int, x array<double>")
    p = quality.QualityParams(steps=40)
    local = quality.fit_nnpu(x[:600], x[600:], 0.8, p)
    for parts in (3, 7):
        model = quality._fit_rows(rows.repartition(parts), len(y), 0.8, p)
        assert np.array_equal(model.edges, local.edges) and np.array_equal(model.weights, local.weights) and model.bias == local.bias


def test_the_bound_is_for_labelled_rows_only(spark):
    words = "tea with milk and a long walk by the sea".split()
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *(F.element_at(F.array(*map(F.lit, words)), (F.col("id") * k % 10 + 1).cast("int")) for k in range(1, 30)), F.col("id").cast("string")).alias("text"))
    labels = docs.select("doc_id", F.when(F.col("doc_id") < 100, 1).when(F.col("doc_id") < 120, 0).alias("quality"))
    seen = []
    was = quality._fit_rows
    quality._fit_rows = lambda rows, n, prior, p: seen.append((rows.where("y = 1").count(), rows.where("y = -1").count(), n)) or was(rows, n, prior, p)
    try:
        quality.train(docs, labels, quality.QualityParams(bound=20, steps=3))
    finally:
        quality._fit_rows = was
    free = docs.where("doc_id >= 120").where(~quality.held_out(F.col("doc_id"))).count()
    assert seen[0][1] == free > 20 and seen[0][0] <= 20 and seen[0][2] == sum(seen[0][:2])
