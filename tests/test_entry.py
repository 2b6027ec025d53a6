"""Every engine query with SQL equals it on the small tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from siltlake import queries


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f).removesuffix('.parquet')} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    want = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(repr, map(tuple, df.select(names).collect()))) == sorted(map(repr, want.fetchall()))


def test_flush_bytes_equals_a_sequential_pass(spark, sf_dir):
    from siltlake.streaming import buffer

    rows = sorted((r.partition, r.offset, len(r.value.encode())) for r in queries.messages(spark, sf_dir).collect())
    want = {}
    for p in range(4):
        mine = [(o, n) for q, o, n in rows if q == p]
        for (o, _), f in zip(mine, buffer.flush_bytes([n for _, n in mine], 200, 16_384)):
            want.setdefault((f"p={p}", f), []).append(o)
    got = {(r.path, r.flush): (r.events, r.first, r["last"]) for r in queries.flush_bytes(spark, sf_dir).collect()}
    assert got == {k: (len(v), min(v), max(v)) for k, v in want.items()}


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["path", "messages", "first", "last"] and df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
