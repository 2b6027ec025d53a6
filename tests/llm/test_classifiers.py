import os

import numpy as np
import pytest

from siltlake.llm import quality, toxicity
from siltlake.llm.common import read_table

SF = os.environ.get("TEST_LLM_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("module, label, least", [(quality, "quality", 0.93), (toxicity, "toxic", 0.93)])
def test_held_out_accuracy(spark, module, label, least):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    scored = module.score_documents(docs, module.train(docs, labels))
    rows = scored.where("held_out").join(labels.select("doc_id", label), "doc_id").collect()
    assert scored.count() == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.predicted == r[label] for r in rows]) >= least
    # the same model again: nothing depends on the order of partitions
    again = module.score_documents(docs, module.train(docs.repartition(7), labels.repartition(3)))
    assert {r.doc_id: round(r.score, 9) for r in scored.collect()} == {r.doc_id: round(r.score, 9) for r in again.collect()}


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_edges(spark, module, label):
    docs = spark.createDataFrame([(1, None, "s"), (2, "", "s"), (None, "a fine text", "s"), (3, "word " * 60_000, "s"), (3, "word " * 60_000, "s")], "doc_id long, text string, score string")
    none = spark.createDataFrame([(1, None), (None, 1), (2, 7)], f"doc_id long, {label} int")
    rows = module.score_documents(docs, module.train(docs, none)).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    some = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], f"doc_id long, {label} int")
    assert module.score_documents(docs, module.train(docs, some)).count() == 5
    assert module.score_documents(docs.limit(0), module.train(docs.limit(0), some)).count() == 0


def test_risk_keeps_unlabelled_positives():
    rng = np.random.default_rng(0)
    good = rng.normal(0, 1, (3000, quality.N_STATS))
    bad = rng.normal(0, 1, (400, quality.N_STATS))
    bad[:, [3, 4, 5]] += 6  # junk shows in several statistics
    model = quality.fit_nnpu(good[:1200], np.concatenate([good[1200:], bad]), 0.82)
    assert (model.scores(good) >= 0.3).mean() > 0.95 and (model.scores(bad) < 0.3).mean() > 0.95


def test_grammar():
    m = toxicity.ToxicityModel({"idiot": 4.0, "worthless": 4.0}, {"lowe": 3.0})
    plain = m.clauses("the idiot came")[0]
    assert m.clauses("you are an idiot")[0] > plain > m.clauses("he said nothing of an idiot")[0]
    assert m.clauses("this is not an idiot")[0] < plain
    assert m.clauses("i will kill you")[0] == m.threat_weight and m.clauses("kill the lights") == [] and m.clauses("hello, world") == []
    assert m.clauses("ein Loweisch hier. und noch was") == [3.0]
    assert len(m.clauses("idiot. fine. worthless")) == 2
    assert set(s for s, _ in toxicity.GRAMMAR) == set(t[0] for t in toxicity.GRAMMAR.values())
