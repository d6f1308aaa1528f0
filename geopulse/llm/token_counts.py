"""Token counts of texts under a unigram vocabulary, by dynamic programming shared along a trie.

The distinct pre-tokens of some megabytes of text form a trie. A node is a prefix, and its forward score (the log
probability of the prefix over all its segmentations), its best segmentation and that one's number of tokens depend on
the prefix alone, so they are computed once however many pre-tokens share it, a depth at a time over all nodes. Each
pre-token keeps the values of its last node, and a text sums the values of its pre-tokens.

Pieces are byte strings of a public rank file; the probability of a piece falls with its rank by Zipf's law. Every
single byte is a piece, so every text has a segmentation. Among segmentations of equal score the one with fewer
tokens counts. Null and empty texts have no tokens and score 0.
"""

from __future__ import annotations

import base64
import functools
import math
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopulse.llm.common import texts, tokenizer_file

#: Rank offset of Zipf's law (Mandelbrot's form).
OFFSET = 2.7
#: Longer pre-tokens are not put in the trie but go through the same recurrence one by one.
DEPTH = 48
PORTION_CHARS = 4 << 20


@dataclass(frozen=True)
class Pieces:
    """Log probabilities of byte strings, and the same by length for look-ups of whole arrays."""

    score: dict[bytes, float]
    longest: int
    hashed: dict[int, np.ndarray]  # by length: sorted hashes
    scores: dict[int, np.ndarray]
    rows: dict[int, np.ndarray]  # the bytes, to compare
    seen: np.ndarray  # a bitmap of the leading bits of all hashes
    coin: np.ndarray  # a random number for each byte
    pattern: regex.Pattern


_BASE = np.uint64(0x9E3779B97F4A7C15)
_SEEN_BITS = 22


def unigram(ranks: dict[bytes, int], pattern: str, offset: float = OFFSET) -> Pieces:
    norm = math.log(sum(1 / (r + offset) for r in ranks.values()))
    score = {piece: -math.log(r + offset) - norm for piece, r in ranks.items()}
    coin = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
    by_size: dict[int, list[bytes]] = defaultdict(list)
    for piece in score:
        by_size[len(piece)].append(piece)
    hashed, scores, rows = {}, {}, {}
    seen = np.zeros(1 << _SEEN_BITS, bool)
    for size, own in by_size.items():
        table = np.frombuffer(b"".join(own), np.uint8).reshape(-1, size)
        h = np.zeros(len(own), np.uint64)
        for j in range(size):
            h = h * _BASE + coin[table[:, j]]
        order = np.argsort(h)
        hashed[size], rows[size] = h[order], table[order]
        scores[size] = np.array([score[own[i]] for i in order])
        seen[(h >> np.uint64(64 - _SEEN_BITS)).astype(np.int64)] = True
    return Pieces(score, max(by_size), hashed, scores, rows, seen, coin, regex.compile(pattern))


@functools.lru_cache(maxsize=2)
def load(name: str, offset: float = OFFSET) -> Pieces:
    import public_tokenizers

    with open(name if "/" in name else tokenizer_file(name), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return unigram(ranks, public_tokenizers.PATTERN, offset)


def segment(word: bytes, pieces: Pieces) -> tuple[float, float, int]:
    """Forward score, best score and its number of tokens of one pre-token."""
    total, best = [0.0], [(0.0, 0)]
    for end in range(1, len(word) + 1):
        sums, top = [], None
        for start in range(max(0, end - pieces.longest), end):
            s = pieces.score.get(word[start:end])
            if s is not None:
                sums.append(total[start] + s)
                way = (best[start][0] + s, best[start][1] - 1)
                top = way if top is None or way > top else top
        high = max(sums)
        total.append(high + math.log(sum(math.exp(x - high) for x in sums)))
        best.append(top)
    return total[-1], best[-1][0], -best[-1][1]


def trie_scores(words: list[bytes], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Forward score and token count of each word; the words are sorted, distinct, not empty and at most ``DEPTH`` long."""
    n = len(words)
    forward, tokens = np.zeros(n), np.zeros(n, np.int64)
    if not n:
        return forward, tokens
    size = np.fromiter(map(len, words), np.int64, n)
    deep = int(size.max())
    table = np.frombuffer(b"".join([w.ljust(deep, b"\0") for w in words]), np.uint8).reshape(n, deep)
    differ = np.column_stack((table[1:] != table[:-1], np.ones(n - 1, bool)))
    shared = np.concatenate(([-1], np.minimum(differ.argmax(axis=1), np.minimum(size[1:], size[:-1]))))
    powers = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(deep, _BASE))), dtype=np.uint64)
    # Per depth: the node of every word that reaches it, the hash of the prefix and the node's values.
    node = [np.zeros(n, np.int64)]
    hashes = [np.zeros(n, np.uint64)]
    total, best, count = [np.zeros(1)], [np.zeros(1)], [np.zeros(1, np.int64)]
    for d in range(1, deep + 1):
        reach = np.flatnonzero(size >= d)
        fresh = shared[reach] < d
        own = np.zeros(n, np.int64)
        own[reach] = np.cumsum(fresh) - 1
        node.append(own)
        hashes.append(hashes[-1] * _BASE + pieces.coin[table[:, d - 1]])
        rep = reach[fresh]  # one word for each node
        sums, tops, counts = np.full(len(rep), -np.inf), np.full(len(rep), -np.inf), np.zeros(len(rep), np.int64)
        for length in range(1, min(d, pieces.longest) + 1):
            if length not in pieces.hashed:
                continue
            h = hashes[d][rep] - hashes[d - length][rep] * powers[length]
            maybe = np.flatnonzero(pieces.seen[(h >> np.uint64(64 - _SEEN_BITS)).astype(np.int64)])
            if not len(maybe):
                continue
            known = pieces.hashed[length]
            at = np.minimum(np.searchsorted(known, h[maybe]), len(known) - 1)
            hit = known[at] == h[maybe]
            maybe, at = maybe[hit], at[hit]
            same = (table[rep[maybe], d - length : d] == pieces.rows[length][at]).all(axis=1)
            maybe, at = maybe[same], at[same]
            before = node[d - length][rep[maybe]]
            s = pieces.scores[length][at]
            sums[maybe] = np.logaddexp(sums[maybe], total[d - length][before] + s)
            way, steps = best[d - length][before] + s, count[d - length][before] + 1
            better = (way > tops[maybe]) | ((way == tops[maybe]) & (steps < counts[maybe]))
            chosen = maybe[better]
            tops[chosen], counts[chosen] = way[better], steps[better]
        total.append(sums)
        best.append(tops)
        count.append(counts)
        ends = np.flatnonzero(size == d)
        forward[ends], tokens[ends] = sums[own[ends]], counts[own[ends]]
    return forward, tokens


def count(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", *, offset: float = OFFSET, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_pretokens, n_tokens, score``: tokens of the best segmentations, and the summed forward score."""

    def run(batches):
        pieces = load(vocabulary, offset)
        for batch in batches:
            numbers, tokens, scores = [], [], []
            for part in _portions(texts(batch.column(1))):
                split = [pieces.pattern.findall(x) for x in part]
                words = sorted({w.encode() for found in split for w in found})
                short = [w for w in words if len(w) <= DEPTH]
                forward, counts = trie_scores(short, pieces)
                value = dict(zip(short, zip(forward.tolist(), counts.tolist(), strict=True), strict=True))
                for w in words:
                    if len(w) > DEPTH:
                        score, _, n = segment(w, pieces)
                        value[w] = (score, n)
                value = {w.decode(): v for w, v in value.items()}
                for found in split:
                    numbers.append(len(found))
                    got = [value[w] for w in found]
                    scores.append(math.fsum([s for s, _ in got]))
                    tokens.append(sum([n for _, n in got]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(numbers, pa.int64()), pa.array(tokens, pa.int64()), pa.array(scores, pa.float64())],
                ["doc_id", "n_pretokens", "n_tokens", "score"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long, score double")


def _portions(rows: list[str]):
    held, size = [], 0
    for text in rows:
        held.append(text)
        size += len(text)
        if size >= PORTION_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held
