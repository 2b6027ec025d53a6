import hashlib
import re

from siltlake.llm import secrets
from siltlake.llm.common import read_table


def plain_base(text):
    out = []
    for m in re.finditer(r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def test_base_spans_of_the_whole_table(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = secrets.scan_documents(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = plain_base(texts[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in spans) for i in range(3)]
        text = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) - {""} <= set(r.spans.split(","))
    assert any(r.spans for r in rows)


def test_novelty_tells_keys_from_identifiers():
    key = "the access credential is Zq7vK2mXw9RtB4nLpE8sYc3H for all"
    word = "the access credential is authentication_backend2 for all"
    assert secrets.written(secrets.novel_spans(key, [])) == "novel:25:49"
    assert secrets.novel_spans(word, []) == []
    assert secrets.novel_spans("a place without any such word Zq7vK2mXw9RtB4nLpE8sYc3H", []) == []
    again = "Zq7vK2mXw9RtB4nLpE8sYc3H " + key
    assert secrets.novel_spans(again, []) == []  # foretold by what stands before it


def test_edges(spark):
    rows = [(1, None, 1), (2, "", 1), (None, 'é🙂 API_KEY: "abcdefghijkl" x', 1), (3, "token=" + "a" * 200_000, 1), (3, "token=" + "a" * 200_000, 1), (4, "ſecret=abcdefghijklm toKen=abcdefghijklm", 1)]
    got = secrets.scan_documents(spark.createDataFrame(rows, "doc_id long, text string, spans int")).collect()
    assert [(r.doc_id, r.spans) for r in got] == [(1, ""), (2, ""), (None, "assign:3:25"), (3, "assign:0:200006,hex:6:200006"), (3, "assign:0:200006,hex:6:200006"), (4, "assign:21:40")]
    assert secrets.scan_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_redaction_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "a password=0123456789abcdef b", "en", "s", 29), (2, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    out = secrets.redact_documents(docs)
    assert out.columns == docs.columns
    assert [tuple(r) for r in out.collect()] == [(1, "a [SECRET] b", "en", "s", 12), (2, None, None, None, None)]
