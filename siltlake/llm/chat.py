"""Chat formatting: cumulative-snapshot collapse.

A chat log often holds a conversation once for every turn. Each turn is hashed, and a rolling
polynomial hash of a conversation's first i turns, in two lanes modulo 2**61 - 1, stands for that
prefix. A conversation whose whole hash is a longer conversation's prefix hash is its snapshot; of
equal conversations the one with the least conv_id stays. Anti-joins retain the maximal ones, whose
turns are then rendered.

No task needs a whole conversation. The narrow turn rows (no text) are range-partitioned by
(conv_id, turn, role, digest), so a long conversation spans tasks. Each task sums up its last
conversation by (rows, hash): one row a task, from which the driver works out what precedes each task's
first conversation, a prefix sum over tasks. A second pass then writes every turn's prefix hash.
Prefix hashes that many conversations share are aggregated before they meet.

Defined results: rows that repeat a turn (same conversation, turn, role and text) count once. Turns of
a conversation are in order of turn (null first), then role, then the text's digest. Rows without
conv_id take no part. Null roles render as "unknown", null texts as empty. Control marks within texts
are broken up, so that text can't open or close a turn. One row per turn of each retained conversation
is returned: conv_id, turn, role, rendered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake.functions.shared import reliable
from siltlake.llm.common import discard, materialise

P = (1 << 61) - 1
BASES = (1_000_003 * 48_271 + 12_345, 6_364_136_223_846_793 % P)
KEY = ["conv_id", "turn", "role", "digest"]


def _lanes(role: str | None, digest: str) -> tuple[int, int]:
    h = hashlib.blake2b(f"{'-' if role is None else '+' + role}\x00{digest}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
    return int.from_bytes(h[:8], "big") % P, int.from_bytes(h[8:], "big") % P


def _prefixes(batches: Iterator[pa.RecordBatch], before: dict[int, tuple[int, int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """(conv_id, position, hash, hash) of each row; before: what precedes a task's first conversation."""
    conv, n, a, b = None, 0, 0, 0
    for batch in batches:
        for c, role, digest in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
            if c != conv:
                n, a, b = before.get(TaskContext.get().partitionId(), (0, 0, 0)) if conv is None else (0, 0, 0)
                conv = c
            x, y = _lanes(role, digest)
            n, a, b = n + 1, (a * BASES[0] + x + 1) % P, (b * BASES[1] + y + 1) % P
            yield c, n, a, b


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first, last = None, None
    for row in _prefixes(batches, {}):
        first, last = row if first is None else first, row
    if last:
        row = (TaskContext.get().partitionId(), first[0], *last)
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in row], ["part", "first", "last", "n", "a", "b"])


def _hashed(batches: Iterator[pa.RecordBatch], before: dict) -> Iterator[pa.RecordBatch]:
    held = []

    def out() -> pa.RecordBatch:
        columns = list(zip(*held)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["conv_id", "n", "a", "b"])

    for row in _prefixes(batches, before):
        held.append(row)
        if len(held) == 4096:
            yield out()
            held = []
    yield out()


def carried(summaries: list[tuple[int, int, int, int, int, int]]) -> dict[int, tuple[int, int, int]]:
    """What precedes the first conversation of each task, from (task, first, last, n, a, b) of each, in order."""
    out, conv, state = {}, None, (0, 0, 0)
    for part, first, last, n, a, b in sorted(summaries):
        if first == conv:
            out[part] = state
        if first == last and first == conv:  # one conversation runs through the task
            m, x, y = state
            state = (m + n, (x * pow(BASES[0], n, P) + a) % P, (y * pow(BASES[1], n, P) + b) % P)
        else:
            state = (n, a, b)
        conv = last
    return out


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, n, a, b: the hash of each conversation's first n turns. turns: KEY columns, distinct."""
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = reliable(turns.select(*KEY).repartitionByRange(parts, *KEY).sortWithinPartitions(*KEY))
    before = carried([tuple(r) for r in dealt.mapInArrow(_summaries, "part long, first long, last long, n long, a long, b long").collect()])
    return dealt.mapInArrow(lambda it: _hashed(it, before), "conv_id long, n long, a long, b long")


def maximal(conversations: DataFrame) -> DataFrame:
    """conv_id of the conversations that no other one continues or, with a lesser id, repeats."""
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.coalesce(F.md5(F.col("text").cast("string")), F.lit("")).alias("digest"))
    turns = turns.where("conv_id is not null").distinct()
    hashed = materialise(prefix_hashes(turns), "prefixes")
    lengths = hashed.groupBy("conv_id").agg(F.max("n").alias("length"))
    whole = materialise(hashed.groupBy("conv_id").agg(F.max(F.struct("n", "a", "b")).alias("w")).select("conv_id", "w.*"), "whole")
    # a prefix that is not whole belongs to a longer conversation
    inner = hashed.join(lengths, "conv_id").where("n < length").select("n", "a", "b").distinct()
    kept = whole.groupBy("n", "a", "b").agg(F.min("conv_id").alias("conv_id"))
    return kept.join(inner, ["n", "a", "b"], "left_anti").select("conv_id")


def _safe(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<|"), F.lit("< |")), F.lit("|>"), F.lit("| >"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, rendered of every turn of the maximal conversations."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).distinct()
    kept = materialise(maximal(conversations), "maximal")
    role = F.coalesce(F.col("role"), F.lit("unknown"))
    rendered = F.concat(F.lit("<|im_start|>"), _safe(role), F.lit("\n"), _safe(F.coalesce("text", F.lit(""))), F.lit("<|im_end|>\n"))
    return rows.join(kept, "conv_id", "left_semi").select("conv_id", "turn", role.alias("role"), rendered.alias("rendered"))


SQL = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL
), p AS (
  SELECT conv_id,
    count(*) OVER w AS n,
    string_agg(sha256(coalesce('+' || role, '-') || chr(1) || coalesce(md5(text), '')), ',') OVER w AS prefix,
    count(*) OVER (PARTITION BY conv_id) AS length
  FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, coalesce(md5(text), '') ROWS UNBOUNDED PRECEDING)
), whole AS (SELECT prefix, min(conv_id) AS conv_id FROM p WHERE n = length GROUP BY prefix),
kept AS (SELECT conv_id FROM whole WHERE prefix NOT IN (SELECT prefix FROM p WHERE n < length))
SELECT conv_id, turn, coalesce(role, 'unknown') AS role,
  '<|im_start|>' || replace(replace(coalesce(role, 'unknown'), '<|', '< |'), '|>', '| >') || chr(10)
  || replace(replace(coalesce(text, ''), '<|', '< |'), '|>', '| >') || '<|im_end|>' || chr(10) AS rendered
FROM t WHERE conv_id IN (SELECT conv_id FROM kept)
"""
