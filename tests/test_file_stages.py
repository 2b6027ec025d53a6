import importlib
import logging

from siltlake.config import Config, JsonColumn, ParquetConfig
from siltlake.observe import Registry
from siltlake.plans import ingest
from siltlake.sinks.files import STAGES


def test_each_file_tells_its_stages(spark, tmp_path):
    rows = spark.range(50).selectExpr("""'{"e":"a","p":{"k":1}}' as value""", "0 as partition", "id as offset", "current_timestamp() as timestamp")
    p = ParquetConfig(schema={"e": "utf8", "p": "json"}, json_columns=[JsonColumn("p", 4, 2)], rows_per_file=20)
    done = ingest.write(rows, Config(key_prefix="e={{e}}/", sinks={"out": {"type": "filesystem", "path": str(tmp_path)}}, parquet=p))
    assert len(done) == 3
    for w in done:
        assert len(w["wall"]) == len(w["cpu"]) == len(STAGES) and min(w["wall"] + w["cpu"]) >= 0 and sum(w["wall"]) > 0
    r = Registry()
    r.flushed(done, "batch")
    text = r.text()
    for stage in STAGES:
        assert f'siltlake_stage_seconds_count{{stage="file_{stage}"}} 3' in text and f'siltlake_file_cpu_seconds{{stage="{stage}"}}' in text


def test_only_absent_parts_are_left_out_in_silence(caplog, tmp_path, monkeypatch):
    entry = importlib.import_module("__spark_entry__")
    (tmp_path / "needs_absent.py").write_text("import no_such_module_here\n")
    (tmp_path / "needs_llm.py").write_text("from siltlake.llm_that_is_gone import queries\n")
    monkeypatch.syspath_prepend(tmp_path)
    with caplog.at_level(logging.WARNING):
        assert entry._if_there("siltlake.llm_that_is_gone.queries") is None and entry._if_there("needs_llm") is None and entry._if_there("no_pipeline_here") is None
        assert not caplog.records
        assert entry._if_there("needs_absent") is None
    assert "no_such_module_here" in caplog.text
