"""Secret scans: fixed patterns, and dictionary-primed zstandard novelty.

The patterns give the base spans. Novelty adds spans of kind `novel`. Its candidates are runs of
[A-Za-z0-9+/_.=-] that begin at most `reach` characters after a word that speaks of secrets or access;
a run that holds such words is cut at them, so that a candidate never contains one. Candidates have 12
characters or more and mix at least two of digits, capitals and small letters.

A candidate is measured by its marginal compressed bytes: a zstandard compressor primed with a
dictionary compresses the surrounding text without and with the candidate, and the difference says
how much the surroundings and the dictionary foretell of it. Words, paths and identifiers cost little;
keys cost nearly their entropy. A candidate that costs at least `threshold` of its length and `unit`
bytes more, and lies outside every base span, is reported, and with it every other place of the same
string. Its other places close after such a word or in a base span are left out of the surroundings, so that a
repeated key doesn't foretell itself; a place without such a word still does.

The dictionary is a short fixed piece of code and configuration and, after it, the corpus's own
identifier words: letter runs, which keys hardly have, counted over all documents; the
`dictionary_words` in most documents are kept, the most frequent nearest to the text.

Every step is linear in the text: runs, sensitive words and base spans are each found once, a candidate
is measured once against bounded surroundings, and all places of what is found come from one pass of an
automaton (of overlapping places the leftmost, then the longest).

Defined results: null text is an empty text, which has no spans. All rows are kept as they come,
repeats and null ids too. Texts are scanned whole; only word counts are shuffled.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltlake.llm.common import slices

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
HINT = re.compile(r"password|passwd|secret|token|api_?key", re.IGNORECASE | re.ASCII)
SENSITIVE = re.compile(r"pass(?:word|wd|phrase)|secret|token|api.?key|credential|private.?key|bearer|authorization|auth|access|pwd|clave|contrase|mot de passe|passwort|schl(?:ü|ue)ssel|geheim", re.IGNORECASE)
RUN = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
IDENTIFIER_WORD = re.compile(r"[A-Z]?[a-zß-öø-ÿ]{3,24}|[A-Z]{4,24}")

#: What configuration files and programs commonly hold near secrets: the fixed part of the dictionary.
CODE = "\n".join([
    "import os", "from config import settings", "def get_client(self, region, endpoint):", "return self.session.client(service_name)", "if __name__ == '__main__':",
    "public static final String PASSWORD = System.getenv(\"DB_PASSWORD\");", "const apiKey = process.env.API_KEY;", "export AWS_ACCESS_KEY_ID=", "export AWS_SECRET_ACCESS_KEY=",
    "aws_secret_access_key = ", "aws_session_token = ", "client_id: your-client-id-here", "client_secret: your-client-secret-here", "password: changeme", "token: xxxxxxxxxxxxxxxxxxxxxxxx",
    "Authorization: Bearer ", "Authorization: Basic ", "https://example.com/api/v1/users?access_token=", "http://localhost:8080/index.html", "postgresql://user:password@localhost:5432/database",
    "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----", "username = admin", "private_key_path = /etc/ssl/private/server.key", "/usr/local/lib/python3/site-packages/",
    "authentication_backend", "credential_provider_chain", "access_control_allow_origin", "token_expiration_seconds", "password_reset_required", "secret_manager_client",
    "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "1234567890", "getAccessToken", "setApiKey", "readPassword", "isAuthenticated", "credentials.json", "id_rsa.pub",
    "the and of to in that is was for with as on by this from not are be it an or at", "der die das und ist ein nicht mit von zu", "le la les des et est un une que pour dans", "el la los las de que y en un una por con para",
]).encode()

#: What comes before the surroundings, so that literals are coded by the letter frequencies of code: the fixed part
#: backwards, which no match foretells.
LETTERS = CODE[:640][::-1]


@dataclass(frozen=True)
class SecretParams:
    before: int = 160  # characters of surroundings on either side
    after: int = 80
    reach: int = 48  # the sensitive word ends at most so many characters before the candidate
    threshold: float = 0.7  # marginal bytes for each byte of the candidate
    unit: float = 1.0  # and bytes that any string costs which nothing foretells whole
    level: int = 19  # below, literals change their coding with the candidate, which blurs its cost
    dictionary_words: int = 4096


@functools.lru_cache(4)
def _compressor(level: int, dictionary: bytes) -> zstandard.ZstdCompressor:
    primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    primed.precompute_compress(level=level)
    return zstandard.ZstdCompressor(level=level, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False)


def _without(text: str, low: int, high: int, places: list[int], n: int) -> str:
    """text[low:high], a line feed in the place of each string of n characters that starts at one of places."""
    out = []
    for at in places[bisect.bisect_right(places, low - n) : bisect.bisect_left(places, high)]:
        out.append(text[low : max(low, at)])
        low = min(high, at + n)
    return "\n".join([*out, text[low:high]])


def _marginal(text: str, start: int, end: int, p: SecretParams, others: list[int], dictionary: bytes) -> int:
    """Bytes that text[start:end] adds to its compressed surroundings. What starts at `others`, more places of the
    same string in order, is no part of these."""
    c, n = _compressor(p.level, dictionary), end - start
    around = LETTERS + _without(text, max(0, start - p.before), start, others, n).encode("utf-8", "surrogatepass") + b"\n" + _without(text, end, min(len(text), end + p.after), others, n).encode("utf-8", "surrogatepass")
    return len(c.compress(around + b"\n" + text[start:end].encode())) - len(c.compress(around))


def novelty(text: str, start: int, end: int, p: SecretParams, others: list[int] = [], dictionary: bytes = CODE) -> float:
    """Marginal compressed bytes of text[start:end] against its surroundings and the dictionary, as a share of its bytes."""
    return _marginal(text, start, end, p, others, dictionary) / (end - start)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, index in KINDS, end), sorted."""
    out = []
    if HINT.search(text):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


class Covered:
    """Whether a stretch meets any of some spans."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.starts, self.ends = [], []
        for start, _, end in sorted(spans):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meets(self, start: int, end: int) -> bool:
        k = bisect.bisect_left(self.starts, end)
        return k > 0 and self.ends[k - 1] > start


def _mixed(run: str) -> bool:
    return any(c.isdigit() for c in run) + any("a" <= c <= "z" for c in run) + any("A" <= c <= "Z" for c in run) >= 2


def candidates(text: str, words: list[tuple[int, int]], reach: int) -> list[tuple[int, int]]:
    """(start, end) of the runs, or pieces of them, that begin close after a sensitive word; words: their spans, in order."""
    out, begins, ends = [], [s for s, _ in words], [e for _, e in words]
    for m in RUN.finditer(text, begins[0]) if words else ():
        start, end = m.span()
        first, last = bisect.bisect_left(ends, start + 1), bisect.bisect_left(begins, end)
        at = start if first and start - ends[first - 1] <= reach else None
        for s, e in words[first:last]:  # words that meet the run
            if at is not None and s > at:
                out.append((at, s))
            at = e
        if at is not None and at < end:
            out.append((at, end))
    trimmed = []
    for start, end in out:
        run = text[start:end]
        run = run if run.endswith("==") else run.rstrip(".=")
        bare = run.lstrip("=._-")
        start += len(run) - len(bare)
        if len(bare) >= 12 and _mixed(bare):
            trimmed.append((start, start + len(bare)))
    return trimmed


def _places(text: str, run: str, low: int, high: int) -> list[int]:
    """Where the string stands within text[low:high], from the left without overlap."""
    out, at = [], text.find(run, low, high)
    while at >= 0:
        out.append(at)
        at = text.find(run, at + len(run), high)
    return out


def _all_places(text: str, strings: set[str]) -> dict[str, list[int]]:
    """Where the strings stand, from the left; of overlapping ones the leftmost and then the longest."""
    out = {s: [] for s in strings}
    if strings:
        a = ahocorasick.Automaton()
        for s in strings:
            a.add_word(s, s)
        a.make_automaton()
        for end, s in a.iter_long(text):
            out[s].append(end - len(s) + 1)
    return out


def novel_spans(text: str, base: list[tuple[int, int, int]], p: SecretParams = SecretParams(), dictionary: bytes = CODE) -> list[tuple[int, int, int]]:
    words = [m.span() for m in SENSITIVE.finditer(text)]
    if not words:
        return []
    covered = Covered(base)
    wanted = [(s, e) for s, e in candidates(text, words, p.reach) if not covered.meets(s, e)]
    if not wanted:
        return []
    ends = [e for _, e in words]

    def close(at: int) -> bool:
        k = bisect.bisect_right(ends, at)
        return k > 0 and at - ends[k - 1] <= p.reach

    taken, found = [], set()
    for start, end in wanted:
        run, n = text[start:end], end - start
        if run not in found:
            near = _places(text, run, max(0, start - p.before - n), start) + _places(text, run, end, end + p.after + n)
            others = [x for x in near if close(x) or covered.meets(x, x + n)]
            if _marginal(text, start, end, p, others, dictionary) < p.threshold * n + p.unit:
                continue
        taken.append((start, 3, end))
        found.add(run)
    own = Covered(taken)
    for run, at in _all_places(text, found).items():
        taken += [(s, 3, s + len(run)) for s in at if not own.meets(s, s + len(run)) and not covered.meets(s, s + len(run))]
    return sorted(taken)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def scan(text: str, p: SecretParams = SecretParams(), dictionary: bytes = CODE) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    base = base_spans(text)
    return base, novel_spans(text, base, p, dictionary)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count: Counter = Counter()

    def out() -> pa.RecordBatch:
        b = pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], ["word", "n"])
        count.clear()
        return b

    for b in slices(batches):
        for text in b.column(0).to_pylist():
            count.update(set(IDENTIFIER_WORD.findall(text or "")))
        if len(count) > 200_000:
            yield out()
    yield out()


def corpus_dictionary(documents: DataFrame, p: SecretParams = SecretParams()) -> bytes:
    """The compressor's dictionary for these documents: CODE, and the words that most documents hold."""
    counts = documents.select(F.col("text").cast("string").alias("text")).mapInArrow(_word_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counts.where("n > 1")
    for groups in (1024, 16):  # what is left of a group is bounded, so no task and not the driver gets more with more words
        rank = F.row_number().over(Window.partitionBy(F.pmod(F.xxhash64("word"), F.lit(groups))).orderBy(F.desc("n"), "word"))
        top = top.withColumn("rank", rank).where(F.col("rank") <= p.dictionary_words).drop("rank")
    top = top.orderBy(F.desc("n"), "word").limit(p.dictionary_words).select("word").collect()
    return "\n".join([CODE.decode(), *(r.word for r in reversed(top))]).encode()


def _scanned(batches: Iterator[pa.RecordBatch], p: SecretParams, dictionary: bytes) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        rows = []
        for text in b.column(1).to_pylist():
            base, novel = scan(text or "", p, dictionary)
            count = [sum(k == i for _, k, _ in base) for i in range(3)]
            rows.append((*count, hashlib.sha256(written(base).encode()).hexdigest(), written(base + novel), len(novel)))
        columns = list(zip(*rows))
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3]), pa.array(columns[4]), pa.array(columns[5], pa.int64())], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel"])


def scan_documents(documents: DataFrame, p: SecretParams = SecretParams()) -> DataFrame:
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dictionary = corpus_dictionary(docs, p)
    return docs.mapInArrow(lambda it: _scanned(it, p, dictionary), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long")


def redact(text: str | None, p: SecretParams = SecretParams(), dictionary: bytes = CODE) -> str | None:
    """The text with every span replaced by [SECRET]; overlapping spans are one."""
    if not text:
        return text
    base, novel = scan(text, p, dictionary)
    out, at = [], 0
    for start, _, end in sorted(base + novel):
        if start >= at:
            out += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_documents(documents: DataFrame, p: SecretParams = SecretParams()) -> DataFrame:
    """The same columns and rows; `text` is redacted, and `n_chars`, where there is one, counted again."""
    names, dictionary = documents.columns, corpus_dictionary(documents, p)
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            clean = [redact(t, p, dictionary) for t in b.column(at).to_pylist()]
            columns = list(b.columns)
            columns[at] = pa.array(clean, b.schema.field(at).type)
            if "n_chars" in names:
                k = names.index("n_chars")
                columns[k] = pa.array([None if t is None else len(t) for t in clean], b.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    return documents.mapInArrow(run, documents.schema)
