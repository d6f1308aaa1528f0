"""Repeated word windows across documents, found in super-k-mers.

A window is ``width`` consecutive words. Its minimiser is the lowest hash among its runs of ``m`` words, so equal
windows have equal minimisers. Consecutive windows of a text that share one travel as one packed string (about three
words a window instead of thirteen) to the bucket of that minimiser. There the windows are sorted by hash, compared
word for word, and every window whose words also start in a document of smaller id gives a range of words to remove.

Before anything travels, equal packed strings of a portion of text meet: the one of smallest id stands for them and
the others are settled on the spot, so a passage that fills a third of all documents travels once a portion. A bucket
that is still too large is cut again by longer minimisers, at last by the whole window.

Null and empty texts have no words. Documents without an id keep all their words and remove none elsewhere. Rows of
one id are copies of one document and never remove each other's words. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopulse.llm.common import binaries, word_blocks
from geopulse.workspace import materialise

WIDTH = 13
#: Words of a minimiser: first for all text, then for buckets over ``BUCKET_BYTES``, then the window itself.
MINIMISERS = (3, 8)
BUCKET_BYTES = 256 << 20
PORTION_BYTES = 8 << 20
#: Buckets for each partition of the input.
SPREAD = 8
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_PACKED = "bucket int, kind int, rows binary, words binary"


def _portions(rows: Iterable[tuple[int | None, int, bytes]], width: int) -> Iterator[list[tuple[int, int, list[bytes]]]]:
    """``(doc_id, position of the first word, words)`` in portions; long texts come in overlapping blocks."""
    held, size = [], 0
    for doc, base, text in rows:
        if doc is None:
            continue
        tail: list[bytes] = []
        for words in word_blocks(text):
            words = tail + words
            if len(words) >= width:
                held.append((doc, base, words))
            tail = words[max(0, len(words) - width + 1) :]
            base += len(words) - len(tail)
            size += len(text) if len(text) < 1 << 20 else 1 << 20
            if size >= PORTION_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


def _low(x: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every ``span`` neighbours, by doubling."""
    done = 1
    while done < span:
        step = min(done, span - done)
        x = np.minimum(x[:-step], x[step:])
        done += step
    return x


def _roll(h: np.ndarray, m: int) -> np.ndarray:
    """A hash of every run of ``m`` words from the hashes of words."""
    n = len(h) - m + 1
    out = np.zeros(max(n, 0), np.uint64)
    for j in range(m):
        out = (out ^ h[j : j + n]) * _A
        out ^= out >> np.uint64(32)
    return out * _B


def super_kmers(part: list[tuple[int, int, list[bytes]]], width: int, m: int):
    """``(minimiser, doc_id, start, words, packed)`` of each run of windows that share a minimiser."""
    words = [w for _, _, ws in part for w in ws]
    sizes = np.array([len(ws) for _, _, ws in part])
    if len(words) < width:
        return [], [], [], [], []
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    spans = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(spans + 1) - 1
    text = b" ".join(words)
    low = _low(_roll(h, m), width - m + 1)  # one for each window
    owner = np.repeat(np.arange(len(part)), sizes)
    first = np.cumsum(sizes) - sizes
    inside = np.flatnonzero(owner[: len(low)] == owner[width - 1 :])
    mins, own = low[inside], owner[inside]
    cut = np.flatnonzero(np.concatenate(([True], (mins[1:] != mins[:-1]) | (own[1:] != own[:-1]))))
    last = np.append(cut[1:], len(inside)) - 1
    i, j = inside[cut], inside[last] + width  # words from i to j, j exclusive
    docs = np.array([d for d, _, _ in part])[own[cut]]
    starts = np.array([b for _, b, _ in part])[own[cut]] + i - first[own[cut]]
    begin, end = (stops[i] - spans[i]).tolist(), stops[j - 1].tolist()
    return mins[cut], docs, starts, j - i, [text[a:b] for a, b in zip(begin, end, strict=True)]


def _settle(docs, starts, counts, packed):
    """Equal packed strings: which go on (those of the smallest id), and ranges removed for the others."""
    least: dict[bytes, int] = {}
    ids = docs.tolist()
    for doc, words in zip(ids, packed, strict=True):
        seen = least.get(words)
        if seen is None or doc < seen:
            least[words] = doc
    on = np.fromiter((doc == least[words] for doc, words in zip(ids, packed, strict=True)), bool, len(ids))
    off = ~on
    return on, (docs[off], starts[off], starts[off] + counts[off])


def _cut(m: int, width: int, buckets: int):
    """Map side: packed strings by bucket (kind 0), and the ranges settled at once (kind 1)."""

    def run(batches):
        pressed = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), binaries(batch.column(2)), strict=True)
            for part in _portions(rows, width):
                mins, docs, starts, counts, packed = super_kmers(part, width, m)
                if not len(docs):
                    continue
                on, gone = _settle(docs, starts, counts, packed)
                place = ((mins >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
                order = np.flatnonzero(on)
                order = order[np.argsort(place[order], kind="stable")]
                edges = np.flatnonzero(np.diff(place[order], prepend=-1))
                bucket, rows_, words_ = [], [], []
                for group in np.split(order, edges[1:]):
                    bucket.append(int(place[group[0]]))
                    table = np.stack((docs[group], starts[group], counts[group])).astype("<i8")
                    rows_.append(pressed.compress(table.T.copy().tobytes()))
                    words_.append(pressed.compress(b" ".join([packed[k] for k in group.tolist()])))
                kinds = [0] * len(bucket)
                if len(gone[0]):
                    bucket.append(int(gone[0][0] % buckets))
                    kinds.append(1)
                    rows_.append(pressed.compress(np.stack(gone).astype("<i8").T.copy().tobytes()))
                    words_.append(b"")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket, pa.int32()), pa.array(kinds, pa.int32()), pa.array(rows_, pa.binary()), pa.array(words_, pa.binary())],
                    ["bucket", "kind", "rows", "words"],
                )

    return run


def repeated(table: np.ndarray, words: list[bytes], width: int):
    """Ranges ``(doc, start, stop)`` of windows that also start in a smaller document.

    ``table`` has ``doc, start, words`` of each packed string and ``words`` is all their words in that order.
    """
    docs, starts, counts = table.T
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    owner = np.repeat(np.arange(len(docs)), counts)
    first = np.cumsum(counts) - counts
    inside = np.flatnonzero(owner[: len(owner) - width + 1] == owner[width - 1 :])
    key = _roll(h, width)[inside]
    order = np.argsort(key, kind="stable")
    key = key[order]
    same = key[1:] == key[:-1]
    many = np.concatenate(([False], same)) | np.concatenate((same, [False]))
    order, key = order[many], key[many]
    if not len(order):
        return (np.zeros(0, np.int64),) * 3
    at = inside[order]
    doc = docs[owner[at]]
    run = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    which = np.cumsum(np.concatenate(([False], key[1:] != key[:-1])))
    # The first window of least id in each run stands for it.
    lead = np.lexsort((np.arange(len(at)), doc, which))[run]
    head = at[lead][which]
    spans = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(spans + 1) - 1
    text = b" ".join(words)
    begin = stops - spans
    later = np.flatnonzero(doc > doc[lead][which])
    a, b = begin[at[later]].tolist(), stops[at[later] + width - 1].tolist()
    c, d = begin[head[later]].tolist(), stops[head[later] + width - 1].tolist()
    equal = np.fromiter((text[i:j] == text[k:l] for i, j, k, l in zip(a, b, c, d, strict=True)), bool, len(later))
    if equal.all():
        flagged = at[later]
    else:  # different words of one hash: sort those windows by their words
        least: dict[bytes, int] = {}
        spelled = [text[begin[i] : stops[i + width - 1]] for i in at.tolist()]
        for x, y in zip(spelled, doc.tolist(), strict=True):
            least[x] = min(y, least.get(x, y))
        flagged = at[np.fromiter((y > least[x] for x, y in zip(spelled, doc.tolist(), strict=True)), bool, len(at))]
    if not len(flagged):
        return (np.zeros(0, np.int64),) * 3
    flagged = np.sort(flagged)
    fresh = np.concatenate(([True], (np.diff(flagged) != 1) | (owner[flagged[1:]] != owner[flagged[:-1]])))
    i = flagged[fresh]
    j = flagged[np.append(np.flatnonzero(fresh)[1:], len(flagged)) - 1] + width
    own = owner[i]
    return docs[own], starts[own] + i - first[own], starts[own] + j - first[own]


def _ranges(width: int, limit: int):
    """Reduce side: a bucket at a time, in order of bucket. Ranges to remove, and strings of buckets over ``limit``."""

    def give(doc, start, stop, words=None):
        blank = pa.nulls(len(doc), pa.binary()) if words is None else pa.array(words, pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(stop, pa.int64()), blank], ["doc_id", "start", "stop", "words"]
        )

    def overfull(tables, texts):
        for table, text in zip(tables, texts, strict=True):
            words, cut, at = text.split(), [], 0
            for n in table[:, 2].tolist():
                cut.append(b" ".join(words[at : at + n]))
                at += n
            yield give(table[:, 0], table[:, 1], table[:, 1] + table[:, 2], cut)

    def run(batches):
        plain = zstandard.ZstdDecompressor()
        now, size, tables, texts = None, 0, [], []

        def finish():
            if tables:
                words = [w for text in texts for w in text.split()]
                found = repeated(np.concatenate(tables), words, width)
                if len(found[0]):
                    yield give(*found)

        for batch in batches:
            for bucket, kind, rows, words in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                table = np.frombuffer(plain.decompress(rows), "<i8").reshape(-1, 3)
                if kind:
                    yield give(*table.T)
                    continue
                if bucket != now:
                    if size <= limit:
                        yield from finish()
                    now, size, tables, texts = bucket, 0, [], []
                text = plain.decompress(words)
                size += len(text)
                tables.append(table)
                texts.append(text)
                if size > limit:
                    yield from overfull(tables, texts)
                    tables, texts = [], []
        if size <= limit:
            yield from finish()

    return run


def ranges(docs: DataFrame, *, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc_id, start, stop``: words to remove; ranges may overlap and repeat."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("start"), F.col(text_col).cast("string").alias("words"))
    out = None
    for m in (*(x for x in MINIMISERS if x < width), width):
        limit = bucket_bytes if m < width else 1 << 62
        buckets = SPREAD * max(8, rows.rdd.getNumPartitions())
        packed = rows.mapInArrow(_cut(m, width, buckets), _PACKED)
        found = packed.repartition(F.col("bucket")).sortWithinPartitions("bucket").mapInArrow(
            _ranges(width, limit), "doc_id long, start long, stop long, words binary"
        )
        found = materialise(found, "ranges")
        own = found.where("words is null").select("doc_id", "start", "stop")
        out = own if out is None else out.unionByName(own)
        rows = found.where("words is not null").select("doc_id", "start", "words")
        if m == width or rows.isEmpty():
            return out


def deduplicate(docs: DataFrame, *, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: the words that stay, joined by one space, as bytes of UTF-8."""
    gone = ranges(docs, width=width, id_col=id_col, text_col=text_col).groupBy("doc_id").agg(F.collect_set(F.struct("start", "stop")).alias("gone"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            total, removed, kept = [], [], []
            for text, cuts in zip(binaries(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                words = text.split()
                edge = np.zeros(len(words) + 1, np.int64)
                for cut in cuts or ():
                    edge[cut["start"]] += 1
                    edge[cut["stop"]] -= 1
                stay = (np.cumsum(edge)[:-1] == 0).tolist() if cuts else None
                left = words if stay is None else [w for w, s in zip(words, stay, strict=True) if s]
                total.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return rows.join(gone, "doc_id", "left").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept binary")
