from siltlake.llm import toxicity
from siltlake.llm.common import held_out
from pyspark.sql import functions as F


def test_unlike_documents_with_one_common_word_all_count(spark):
    # "a" to "zz" hold no insult; every document shares most of these words, so the least hash too
    common = "the of and to in that was for with as on by from at his her its our one all"
    ids = [r.id for r in spark.range(200).where(~held_out(F.col("id"))).collect()]
    rows = [(i, f"{common} {'grumpf' if i % 2 else 'tea'} {'x' * (i % 13 + 2)}{chr(97 + i % 26)}{chr(97 + i // 26)}") for i in ids]
    rows += [(1000 + i, rows[0][1]) for i in range(50)]  # copies count once
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids] + [(1000 + i, rows[0][0] % 2) for i in range(50)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert model.words.get("grumpf", 0) >= toxicity.ToxicityParams().least_odds
    assert "tea" not in model.words
