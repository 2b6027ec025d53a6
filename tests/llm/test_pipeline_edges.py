"""The stages on tables that are empty, hold repeated ids, long texts and clashing columns; what is left on disk."""

import os

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from siltlake.functions.shared import shared_root  # noqa: E402
from siltlake.llm import common  # noqa: E402

SF = os.environ.get("TEST_LLM_SF_DIR", "/root/testdata/sf0.01")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_an_id_with_several_texts(spark):
    a, b = "one two three four five six seven", "some other text of a few more words here"
    rows = [(5, a, "en", "x", 1), (5, b, "en", "y", 2), (5, b, "en", "x", 2), (7, b, "en", "z", 3), (8, None, "en", "z", 0), (8, "", "en", "a", 0), (9, "x y", None, None, 1)]
    out = corpus_pipeline.drop_copies(spark, spark.createDataFrame(rows, SCHEMA), SF)
    got = sorted((r.doc_id, r.text or "") for r in out.collect())
    # one row for each text: of b's rows one stays, whichever of 5 and 7 it goes by
    assert [t for _, t in got if t == a] == [a] and [t for _, t in got if t == b] == [b]
    assert [i for i, t in got if t == a] == [5] and got.count((8, "")) == 1 and (9, "x y") in got and len(got) == 4
    again = corpus_pipeline.drop_copies(spark, spark.createDataFrame(rows[::-1], SCHEMA).repartition(3), SF)
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))


def test_stages_on_odd_tables(spark):
    rows = [(1, "word " * 50_000, "en", "s", 250_000, 1.0, 2, "k"), (2, None, None, None, None, None, None, None), (None, "tea and a walk by the sea", "en", "s", 3, 0.5, 1, "z"), (3, "a" * 300_000, "en", "s", 1, 0.1, 0, "q")]
    docs = spark.createDataFrame(rows, SCHEMA + ", row double, bands int, digest string")
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, SF)
            assert out.columns == table.columns, name
            n = out.count()
            assert n <= table.count() and (n == 0) == (table.count() == 0) or name == "quality"
    assert corpus_pipeline.pack(spark, docs.limit(0), SF).count() == 0


def test_nothing_is_left_but_the_result(spark, sf_dir):
    root = f"{shared_root(spark)}/siltlake"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    out = corpus_pipeline.run(spark, sf_dir)
    left = set(os.listdir(root)) - before
    assert len(left) == 1 and next(iter(left)).startswith("pipeline-packing") and out.count() > 0
    common.discard(out)
    assert not set(os.listdir(root)) - before


def test_no_local_folder_on_a_cluster():
    class Context:
        master = "spark://somewhere:7077"

    class Conf:
        def get(self, *_):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Session())
