"""Byte-level BPE over rank files: a minimal perfect hash for whole pre-tokens, a heap for the rest.

The distinct pre-tokens of some megabytes of text go through a minimal perfect hash of the vocabulary at once; an entry's
bytes are compared, so a foreign pre-token is never taken for one. A miss starts as linked single bytes, and a heap
yields the adjacent pair of lowest rank, leftmost first, until no pair is in the vocabulary. Decoding concatenates
the bytes of the ids.

Null and empty texts have no ids. Texts need not be short: a pre-token of n bytes costs O(n log n). Every task holds
the vocabulary, its index and a bounded cache of misses, whatever the table's size.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopulse.llm.common import texts, tokenizer_file

#: Pre-tokens remembered by a worker; later ones are resolved again when they recur, which changes no result.
REMEMBERED = 600_000
#: Bits per key of each level of the perfect hash.
SPREAD = 2
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


class PerfectHash:
    """Minimal perfect hash of fixed keys: levels of bits, each keeping the keys that are alone in their bit.

    A key's place is the number of set bits before its own. Look-ups are arrays; a key that was not indexed gets
    some place or -1, so callers compare the key stored there.
    """

    def __init__(self, keys: pa.Array):
        hashed = _hash64(keys)
        if len(np.unique(hashed)) != len(hashed):
            raise ValueError("two keys share a 64-bit hash")
        self.bits: list[np.ndarray] = []
        self.ranks: list[np.ndarray] = []
        left, placed = hashed, 0
        while len(left):
            slots = _slot(left, len(self.bits), SPREAD * len(left))
            alone = np.bincount(slots, minlength=SPREAD * len(left)) == 1
            self.bits.append(alone)
            self.ranks.append(placed + np.cumsum(alone) - alone)
            placed += int(alone.sum())
            left = left[~alone[slots]]
        order = np.argsort(self._place(hashed))
        self.keys, self.order = keys.take(pa.array(order)), order

    def _place(self, hashed: np.ndarray) -> np.ndarray:
        place, open_ = np.full(len(hashed), -1, np.int64), np.arange(len(hashed))
        for level, (alone, ranks) in enumerate(zip(self.bits, self.ranks, strict=True)):
            slots = _slot(hashed[open_], level, len(alone))
            hit = alone[slots]
            place[open_[hit]] = ranks[slots[hit]]
            open_ = open_[~hit]
        return place

    def find(self, keys: pa.Array) -> np.ndarray:
        """The original position of each key, -1 for one that is not indexed."""
        place = self._place(_hash64(keys))
        stored = self.keys.take(pa.array(place, mask=place < 0))
        same = pc.fill_null(pc.equal(stored, keys), False).to_numpy(zero_copy_only=False)
        return np.where(same, self.order[place], -1)


def _hash64(keys: pa.Array) -> np.ndarray:
    """A 64-bit hash of each binary value, eight bytes of every value at a time."""
    ends = np.frombuffer(keys.buffers()[1], np.int32)[keys.offset : keys.offset + len(keys) + 1].astype(np.int64)
    size = np.diff(ends)
    data = np.frombuffer(keys.buffers()[2] or b"", np.uint8)
    data = np.concatenate((data, np.zeros(8, np.uint8)))
    out = size.astype(np.uint64) * _MIX[0]
    left = np.arange(len(keys))
    done = 0
    while len(left):
        at = ends[left] + done
        live = size[left] > done
        left, at = left[live], at[live]
        if not len(left):
            break
        word = np.zeros(len(left), np.uint64)
        for j in range(8):
            inside = size[left] > done + j
            word |= np.where(inside, data[np.minimum(at + j, len(data) - 1)], 0).astype(np.uint64) << np.uint64(8 * j)
        x = (out[left] ^ word) * _MIX[1]
        out[left] = (x ^ (x >> np.uint64(29))) * _MIX[2]
        done += 8
    return out ^ (out >> np.uint64(32))


def _slot(hashed: np.ndarray, level: int, size: int) -> np.ndarray:
    x = (hashed + np.full(1, level + 1, np.uint64) * _MIX[0]) * _MIX[1]
    x = (x ^ (x >> np.uint64(31))) * _MIX[2]
    return ((x >> np.uint64(16)) % np.uint64(size)).astype(np.int64)


class Vocabulary:
    """Ranks of byte strings; a rank is the id."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        tokens = list(ranks)
        self.index = PerfectHash(pa.array(tokens, pa.binary()))
        self.ids = np.array([ranks[x] for x in tokens], np.int64)
        self.seen: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token by merges: a heap of adjacent pairs over linked bytes."""
        ranks, size = self.ranks, len(piece)
        if size < 2:
            return [ranks[piece]] if size else []
        find, stop = ranks.get, list(range(1, size + 1))  # stop[i]: where the part that starts at i ends
        back = list(range(-1, size - 1))  # back[i]: where the part before i starts
        bits = size.bit_length()
        low, wide = (1 << bits) - 1, 2 * bits
        # A heap entry is one integer: rank, start, end.
        heap = [r << wide | i << bits | i + 2 for i in range(size - 1) if (r := find(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            entry = pop(heap)
            i, end = entry >> bits & low, entry & low
            mid = stop[i]
            if not mid or mid >= size or stop[mid] != end:  # one of the two parts has changed since
                continue
            stop[i], stop[mid] = end, 0
            if end < size:
                back[end] = i
                after = stop[end]
                if (r := find(piece[i:after])) is not None:
                    push(heap, r << wide | i << bits | after)
            left = back[i]
            if left >= 0 and (r := find(piece[left:end])) is not None:
                push(heap, r << wide | left << bits | end)
        out, i = [], 0
        while i < size:
            out.append(ranks[piece[i : stop[i]]])
            i = stop[i]
        return out

    def resolve(self, pieces: list[str]) -> list[tuple[int, ...]]:
        """Ids of distinct pre-tokens: the perfect hash for all at once, merges for what it does not hold."""
        raw = [x.encode() for x in pieces]
        place = self.index.find(pa.array(raw, pa.binary()))
        whole = np.where(place >= 0, self.ids[place], -1).tolist()
        return [(own,) if own >= 0 else tuple(self.merge(x)) for own, x in zip(whole, raw, strict=True)]

    def encode(self, docs: Iterable[str]) -> list[list[tuple[int, ...]]]:
        """Per text the ids of its pre-tokens, in order."""
        split = [self.pattern.findall(x) for x in docs]
        distinct = set().union(*split)
        fresh = list(distinct.difference(self.seen))
        known = dict(zip(fresh, self.resolve(fresh), strict=True))
        if len(self.seen) + len(known) <= REMEMBERED:
            self.seen.update(known)
            known = self.seen
        else:
            known.update((x, self.seen[x]) for x in distinct.intersection(self.seen))
        return [[known[x] for x in pieces] for pieces in split]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def load(name: str) -> Vocabulary:
    """A rank file by its public name or path, loaded once per worker."""
    import public_tokenizers

    path = name if "/" in name else tokenizer_file(name)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return Vocabulary(ranks, public_tokenizers.PATTERN)


def _portions(column: pa.Array, most: int = 1 << 22):
    """Texts of a batch in portions of some megabytes, so that the pieces held at once stay few."""
    held, size = [], 0
    for text in texts(column):
        held.append(text)
        size += len(text)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: the ids of every whole text, without special tokens."""

    def run(batches):
        own = load(vocabulary)
        for batch in batches:
            ids = [[i for piece in doc for i in piece] for part in _portions(batch.column(1)) for doc in own.encode(part)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return _rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(coded: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, bytes`` from ``doc_id, ids``; null ids decode to nothing."""

    def run(batches):
        own = load(vocabulary)
        for batch in batches:
            out = [own.decode(x or ()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "bytes"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encoded and decoded again in one pass, digests only."""

    def run(batches):
        own = load(vocabulary)
        for batch in batches:
            n, first, second = [], [], []
            for part in _portions(batch.column(1)):
                spelled: dict[int, str] = {}  # by identity: equal pre-tokens of a portion share one list
                for doc in own.encode(part):
                    words = []
                    for piece in doc:
                        word = spelled.get(id(piece))
                        if word is None:
                            word = spelled[id(piece)] = ",".join(map(str, piece))
                        words.append(word)
                    ids = [i for piece in doc for i in piece]
                    n.append(len(ids))
                    first.append(hashlib.sha256(",".join(words).encode()).hexdigest())
                    second.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
