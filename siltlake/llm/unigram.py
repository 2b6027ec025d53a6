"""SentencePiece encoding and decoding, and token counts, by a unigram model.

Pieces stand in a double-array trie over characters. Encoding is Viterbi: the best score of a prefix
is the maximum over the pieces that end there; a character that is no piece costs `unknown` less
than the least score and becomes its UTF-8 bytes. Text is prefixed with a space, spaces become the
marker U+2581, and decoding undoes both.

The public vocabulary files hold merge ranks and no log probabilities. A piece's log score here is
the Zipf-Mandelbrot law at its rank, ln(1 / (rank + 2.7)) less the logarithm of the sum over all
pieces; the law is a parameter and nothing is trained.

No piece holds a marker after another character, so a best path can be cut before every run of
markers: texts are encoded by pre-token (a run of markers and the run of other characters after it)
and the ids of pre-tokens are remembered, about as many as `bound` at once and none of more than `longest`
characters, so that the memory's bytes are bounded too; what was not asked for while half of it filled
is forgotten. Pre-tokens not yet known are encoded together: each step of the Viterbi recursion is
taken for all of them at once, in arrays. Longer ones, and those of a batch that adds few, are encoded
one by one.

Token counts need no path. The distinct pre-tokens of a batch are gone through in sorted order,
which walks their trie depth first: the forward scores, the token counts and the pieces under way at
each depth stay on a stack, so a prefix that pre-tokens share is computed once; counts are stored at
the terminals.

Defined results: null and empty text: no ids, count 0, decodes to the empty text. A marker character
in the text decodes to a space. Null or no ids decode to the empty text, control pieces to nothing, bytes
that are no UTF-8 and ids that are null or outside the vocabulary to U+FFFD. All rows are kept as they
come; nothing is shuffled.
"""

from __future__ import annotations

import functools
import math
import re
import sys
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltlake.llm.common import slices
from siltlake.llm.packing import Memory

MARK = "▁"
PRETOKEN = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Characters of texts whose unknown pre-tokens are encoded together; the most pre-tokens in one array and the
#: fewest, as below that many the calls on arrays cost more than going through the pre-tokens one by one.
TOGETHER = 1 << 18
ROWS, FEWEST = 4096, 256


class DoubleArray:
    """Trie of strings in two arrays: the child of node s by code c is base[s] + c, if check[base[s] + c] is s."""

    def __init__(self, words: Iterable[tuple[str, int]]):
        words = sorted(words)
        often = Counter(c for w, _ in words for c in w)
        self.codes = {c: i + 1 for i, (c, _) in enumerate(sorted(often.items(), key=lambda x: (-x[1], x[0])))}
        self.base, self.check, self.value, after = [], [], [], []  # after[i]: a slot at or behind i, towards the next free one

        def room(n: int) -> None:
            more = n + 2 - len(after)
            if more > 0:
                more = max(more, len(after), 1024)
                after.extend(range(len(after), len(after) + more))
                self.base += [0] * more
                self.check += [-1] * more
                self.value += [-1] * more

        def next_free(i: int) -> int:
            room(i)
            end = i
            while after[end] != end:
                end = after[end]
                room(end)
            while after[i] != end:
                after[i], i = end, after[i]
            return end

        def take(i: int, parent: int) -> None:
            self.check[i] = parent
            after[i] = i + 1

        room(0)
        take(0, 0)
        hint = 1
        todo = [(0, 0, len(words), 0)]  # node, range of words below it, depth
        while todo:
            node, lo, hi, depth = todo.pop()
            if lo < hi and len(words[lo][0]) == depth:
                self.value[node] = words[lo][1]
                lo += 1
            groups, at = [], lo
            while at < hi:
                c, end = words[at][0][depth], at
                while end < hi and words[end][0][depth] == c:
                    end += 1
                groups.append((self.codes[c], at, end))
                at = end
            if not groups:
                continue
            groups.sort()
            first, most = groups[0][0], groups[-1][0]
            slot, tries = next_free(max(first + 1, hint if len(groups) > 1 else 1)), 0
            while True:
                b = slot - first
                room(b + most)
                if all(self.check[b + c] < 0 for c, _, _ in groups):
                    break
                slot, tries = next_free(slot + 1), tries + 1
            if tries > 100:
                hint = max(hint, slot - 50)
            self.base[node] = b
            for c, _, _ in groups:
                take(b + c, node)
            todo += [(b + c, x, y, depth + 1) for c, x, y in groups]
        room(max(self.base) + len(self.codes) + 1)

    def step(self, node: int, code: int) -> int:
        to = self.base[node] + code
        return to if self.check[to] == node and to else -1

    def get(self, word: str) -> int:
        node = 0
        for c in word:
            node = self.step(node, self.codes[c]) if c in self.codes else -1
            if node < 0:
                return -1
        return self.value[node]


def zipf(ranks: list[int]) -> list[float]:
    weights = [1 / (r + 2.7) for r in ranks]
    total = math.log(sum(weights))
    return [math.log(w) - total for w in weights]


class Unigram:
    def __init__(self, pieces: list[str], scores: dict[int, float], bytes_at: list[int], unknown: float = 10.0, bound: int = 300_000, longest: int = 64):
        """pieces: by id; scores: of the ids that text may become; bytes_at: the ids of the 256 bytes."""
        self.scores, self.bytes_at, self.bound, self.longest = scores, bytes_at, bound, longest
        if any(MARK in pieces[i].lstrip(MARK) for i in scores):
            raise ValueError("a piece holds a marker inside; texts can't be cut into pre-tokens")
        self.trie = DoubleArray((pieces[i], i) for i in scores)
        self.score_at = [scores.get(v, 0.0) for v in self.trie.value]
        self.lost = min(scores.values()) - unknown
        self.text_of = [p.replace(MARK, " ").encode() for p in pieces]
        for value, i in enumerate(bytes_at):
            self.text_of[i] = bytes([value])
        self.arrays = tuple(np.array(x, np.int32) for x in (self.trie.base, self.trie.check, self.trie.value))
        self.reached = np.array([scores.get(v, -math.inf) for v in self.trie.value])
        self.code_of = np.zeros(sys.maxunicode + 1, np.int32)
        self.code_of[list(map(ord, self.trie.codes))] = list(self.trie.codes.values())
        self.byte_ids = np.array(bytes_at, "<i4")
        self.memory = Memory(bound)
        self.counted: dict[str, int] = {}

    def viterbi(self, word: str) -> list[int]:
        """Ids of the best path; of equal scores the one whose last piece is longer."""
        base, check, value, score_at, codes = self.trie.base, self.trie.check, self.trie.value, self.score_at, self.trie.codes
        n = len(word)
        best, back = [0.0] + [-math.inf] * n, [(0, -1)] * (n + 1)
        at = [codes.get(c, 0) for c in word]
        for i in range(n):
            here, node, single = best[i], 0, False
            for j in range(i, n):
                code = at[j]
                to = base[node] + code
                if not code or check[to] != node:
                    break
                node = to
                if value[node] >= 0:
                    single |= j == i
                    if (s := here + score_at[node]) > best[j + 1]:
                        best[j + 1], back[j + 1] = s, (i, value[node])
            if not single and (s := here + self.lost) > best[i + 1]:
                best[i + 1], back[i + 1] = s, (i, -1)
        out: list[int] = []
        while n:
            i, piece = back[n]
            out += [piece] if piece >= 0 else [self.bytes_at[x] for x in reversed(word[i:n].encode("utf-8", "surrogatepass"))]
            n = i
        return out[::-1]

    def viterbi_together(self, words: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of the path that `viterbi` finds for each word, none of which is empty."""
        base, check, value = self.arrays
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-lengths, kind="stable")  # the words that reach a place come first
        sizes = lengths[order]
        most, n = int(sizes[0]), len(words)
        points = np.zeros((n, most), np.uint32)
        points[np.arange(most) < sizes[:, None]] = np.frombuffer("".join([words[k] for k in order]).encode("utf-32-le", "surrogatepass"), "<u4")
        at = np.ascontiguousarray(self.code_of[points].T)  # 0, the code of no character, leads nowhere
        best = np.full((most + 1, n), -math.inf)
        best[0] = 0.0
        back, piece = np.zeros((most + 1, n), np.int32), np.full((most + 1, n), -1, np.int32)
        reach = np.searchsorted(-sizes, -np.arange(most))  # words longer than i
        for i in range(most):
            here = best[i, : reach[i]]
            rows, node, single, j = np.arange(reach[i]), np.zeros(reach[i], np.int32), [], i
            while j < most:
                to = base[node] + at[j, rows]
                going = np.flatnonzero(check[to] == node)
                if not len(going):
                    break
                rows, node, j = rows[going], to[going], j + 1
                score = here[rows] + self.reached[node]
                better = np.flatnonzero(score > best[j, rows])
                r = rows[better]
                best[j, r], back[j, r], piece[j, r] = score[better], i, value[node[better]]
                if j == i + 1:
                    single = rows[value[node] >= 0]
            score = here + self.lost
            score[single] = -math.inf
            r = np.flatnonzero(score > best[i + 1, : reach[i]])
            best[i + 1, r], back[i + 1, r], piece[i + 1, r] = score[r], i, -1
        ends, rows, j = np.zeros((n, most + 1), bool), np.arange(n), sizes
        while len(rows):
            ends[rows, j] = True
            j = back[j, rows]
            rows, j = rows[j > 0], j[j > 0]
        row, j = np.nonzero(ends)
        ids = piece[j, row]
        lost = ids < 0
        if lost.any():
            chars = points[row[lost], j[lost] - 1]
            width = np.ones(len(ids), np.int64)
            width[lost] += sum((chars >= x).astype(np.int64) for x in (0x80, 0x800, 0x10000))
            row, ids, lost = row.repeat(width), ids.repeat(width), lost.repeat(width)
            raw = chars.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
            ids[lost] = self.byte_ids[np.frombuffer(raw, np.uint8)]
        raw, out = ids.astype("<i4").tobytes(), [b""] * n
        upto = (np.bincount(row, minlength=n).cumsum() * 4).tolist()
        for k, start, end in zip(order.tolist(), [0, *upto], upto):
            out[k] = raw[start:end]
        return out

    def forward_counts(self, words: Iterable[str]) -> dict[str, int]:
        """Tokens of each word. Shared prefixes are computed once."""
        base, check, value, score_at, codes = self.trie.base, self.trie.check, self.trie.value, self.score_at, self.trie.codes
        best, count, active, out, last = [0.0], [0], [[]], {}, ""
        for word in sorted(words):
            depth, most = 0, min(len(last), len(word))
            while depth < most and last[depth] == word[depth]:
                depth += 1
            del best[depth + 1 :], count[depth + 1 :], active[depth + 1 :]
            for i in range(depth, len(word)):
                code, going, top, tokens, single = codes.get(word[i], 0), [], -math.inf, 0, False
                if code:
                    for start, node in (*active[i], (i, 0)):  # older starts first
                        to = base[node] + code
                        if check[to] == node:
                            going.append((start, to))
                            if value[to] >= 0:
                                single |= start == i
                                if (s := best[start] + score_at[to]) > top:
                                    top, tokens = s, count[start] + 1
                if not single and (s := best[i] + self.lost) > top:
                    top, tokens = s, count[i] + len(word[i].encode("utf-8", "surrogatepass"))
                best.append(top)
                count.append(tokens)
                active.append(going)
            out[word] = count[len(word)]
            last = word
        return out

    @staticmethod
    def pretokens(text: str) -> list[str]:
        if not text:
            return []
        if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
            return PRETOKEN.findall(MARK + text.replace(" ", MARK))
        return (MARK + text.replace(" ", " " + MARK)).split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        out, at = [], 0
        while at < len(texts):
            self.memory.turn()
            of, found, size = self.memory.of, [], 0
            while at < len(texts) and size < TOGETHER:
                found.append(list(map(of, self.pretokens(texts[at]))))
                size += len(texts[at])
                at += 1
            self._learn()
            out += map(b"".join, found)
        return out

    def _learn(self) -> None:
        asked = self.memory.new.asked
        short = sorted((w for w in asked if len(w) <= self.longest), key=len)
        alone = lambda w: np.array(self.viterbi(w), "<i4").tobytes()
        for k in range(0, len(short), ROWS):
            some = short[k : k + ROWS]
            self.memory.learn(some, self.viterbi_together(some) if len(some) >= FEWEST else list(map(alone, some)))
        for w in asked:
            if len(w) > self.longest:
                asked[w] += alone(w)

    @property
    def known(self) -> dict[str, bytes]:
        return self.memory.new

    def _forget_long(self, memory: dict, words: Iterable[str]) -> None:
        for w in words:
            if len(w) > self.longest:
                del memory[w]

    def decode(self, ids: Iterable[int]) -> str:
        text = b"".join(map(self.text_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text

    def decode_any(self, ids: Iterable[int | None] | None) -> str:
        """decode() of ids that may be none of the vocabulary's."""
        n = len(self.text_of)
        text = b"".join(self.text_of[i] if i is not None and 0 <= i < n else b"\xef\xbf\xbd" for i in ids or ()).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text

    def counts(self, texts: list[str]) -> list[int]:
        if len(self.counted) > self.bound:
            self.counted = {}
        split = [self.pretokens(t) for t in texts]
        new = set().union(*split) - self.counted.keys() if split else set()
        self.counted.update(self.forward_counts(new))
        out = [sum(map(self.counted.__getitem__, words)) for words in split]
        self._forget_long(self.counted, new)
        return out


@functools.lru_cache(1)
def load(path: str) -> Unigram:
    """The pieces of a SentencePiece file, with scores from the ranks that it holds."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    ranks = {i: r for r, i in enumerate(sorted(normal, key=lambda i: (-sp.get_score(i), i)))}
    scores = dict(zip(normal, zipf([ranks[i] for i in normal])))
    return Unigram(["" if sp.is_control(i) else sp.id_to_piece(i) for i in range(n)], scores, [sp.piece_to_id(f"<0x{v:02X}>") for v in range(256)])


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = load(path)
    for b in slices(batches, 128):
        texts = [t or "" for t in b.column(1).to_pylist()]
        ids = model.encode(texts)
        flat = np.frombuffer(b"".join(ids), "<i4")
        ends = [0, *accumulate(len(x) // 4 for x in ids)]
        same = [model.decode(flat[s:e].tolist()) == t for s, e, t in zip(ends, ends[1:], texts)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(np.diff(ends).astype(np.int64)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)), pa.array(same, pa.bool_())], ["doc_id", "n_tokens", "ids", "round_trip"])


def _counted(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = load(path)
    for b in slices(batches, 256):
        n = model.counts([t or "" for t in b.column(1).to_pylist()])
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])


def _decoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = load(path)
    for b in slices(batches, 128):
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([model.decode_any(x) for x in b.column(1).to_pylist()], pa.string())], ["doc_id", "text"])


def _docs(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode_documents(documents: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids, round_trip (the ids decode to the text)."""
    path = path or public_tokenizers.path("piece_bpe_32k.model")
    return _docs(documents).mapInArrow(lambda it: _encoded(it, path), "doc_id long, n_tokens long, ids array<int>, round_trip boolean")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text: of the ids that encode_documents gives, or any others."""
    path = path or public_tokenizers.path("piece_bpe_32k.model")
    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return rows.mapInArrow(lambda it: _decoded(it, path), "doc_id long, text string")


def count_tokens(documents: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens: as many as encode_documents gives."""
    path = path or public_tokenizers.path("piece_bpe_32k.model")
    return _docs(documents).mapInArrow(lambda it: _counted(it, path), "doc_id long, n_tokens long")
