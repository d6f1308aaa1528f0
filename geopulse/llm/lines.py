"""Near-equal lines across documents: a segment-partition edit join (PassJoin, Li et al. 2011).

Two lines within ``edits`` of each other share one of the ``edits + 1`` segments of the shorter one, at a place that
the lengths and the segment's number confine. So every distinct line indexes its segments under its length and probes
with the few substrings that can match a segment of a line at most ``edits`` shorter (multi-match-aware selection).
Keys travel in compressed blocks by bucket. Within a key, pairs whose bigram-parity signatures differ in more than
four bits an edit are out; the rest are verified over the texts by banded bit-parallel edit distance (Hyyrö 2003).

Equal lines are one line from the start, so copies never form pairs. Edits go by length: of lines shorter than ``least``
characters fewer are near (of 20 and two: one edit from 10 characters on, below that only equal lines). A class is what links connect; it is named by its first line in order of document and
place. Null texts have no lines, empty texts one empty line; documents without an id take no part and keep all lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopulse.llm.common import components, grouped, texts
from geopulse.workspace import materialise

EDITS = 2
LEAST = 20
PORTION_CHARS = 4 << 20
#: Buckets for each partition of the input, and the rows of a bucket compared within one task.
SPREAD, BUCKET_ROWS = 8, 4_000_000
#: Rows of one key compared as one block where a bucket is over that.
BLOCK_ROWS = 16_384
_ROW = np.dtype([("key", "<u4"), ("id", "<i8"), ("sign", "<u8"), ("probe", "u1")])
_MIX = np.uint64(0x9E3779B97F4A7C15)


def allowed(length: int, edits: int = EDITS, least: int = LEAST) -> int:
    """Edits between a line of so many characters and one no shorter: in proportion to the length, up to ``edits`` from ``least`` on."""
    return min(edits, length * edits // least) if least else edits


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """Start and size of the ``edits + 1`` even segments of a line."""
    parts = edits + 1
    size, longer = divmod(length, parts)
    out, at = [], 0
    for i in range(parts):
        n = size + (i >= parts - longer)
        out.append((at, n))
        at += n
    return out


def probes(length: int, edits: int, least: int = 0) -> list[tuple[int, int, int, int]]:
    """``(indexed length, segment, start, size)`` of the substrings that may match a segment of a line no longer."""
    out = []
    for other in range(max(edits + 1 if not least else 1, length - edits), length + 1):
        shift, most = length - other, allowed(other, edits, least)
        if not most or shift > most:
            continue
        for i, (at, n) in enumerate(segments(other, most)):
            low = max(0, at - i, at + shift - (most - i))
            high = min(length - n, at + i, at + shift + most - i)
            out += [(other, i, start, n) for start in range(low, high + 1)]
    return out


def signatures(lines: list[str]) -> np.ndarray:
    """Parities of hashed bigrams in 64 bits; one edit flips at most four."""
    sizes = np.fromiter(map(len, lines), np.int64, len(lines)) + 1
    points = np.frombuffer("\n".join(["", *lines, ""]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    pair = (points[:-1] * np.uint64(0x1F123BB5) + points[1:]) * _MIX
    bits = np.uint64(1) << (pair >> np.uint64(58))
    # The bigrams of a line run from the break before it to the break after it.
    return np.bitwise_xor.reduceat(bits, np.cumsum(sizes) - sizes) if len(lines) else np.zeros(0, np.uint64)


def _identity(line: str) -> tuple[int, int]:
    value = xxhash.xxh3_128_intdigest(line.encode("utf-8", "surrogatepass"))
    return (value >> 64) - (1 << 63), (value & (1 << 64) - 1) - (1 << 63)


def split_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, line_no, id, rest, chars``: every line with its 128-bit identity."""

    def run(batches):
        for batch in batches:
            for part in _portions(batch):
                owner, place, one, two, size = [], [], [], [], []
                for doc, text in part:
                    for i, line in enumerate(text.split("\n")):
                        a, b = _identity(line)
                        owner.append(doc)
                        place.append(i)
                        one.append(a)
                        two.append(b)
                        size.append(len(line))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owner, pa.int64()), pa.array(place, pa.int32()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(size, pa.int32())],
                    ["doc_id", "line_no", "id", "rest", "chars"],
                )

    return _rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, line_no int, id long, rest long, chars int")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.where("doc_id is not null and text is not null")


def _portions(batch: pa.RecordBatch) -> Iterator[list[tuple[int, str]]]:
    held, size = [], 0
    for doc, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
        held.append((doc, text))
        size += len(text)
        if size >= PORTION_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _keys(edits: int, least: int, buckets: int):
    """Map side: index and probe rows of the distinct lines of a portion, in blocks by bucket."""
    digest = xxhash.xxh3_64_intdigest

    def run(batches):
        pressed, plans = zstandard.ZstdCompressor(level=1), {}
        for batch in batches:
            for part in _portions(batch):
                lines = list({line for _, text in part for line in text.split("\n") if allowed(len(line), edits, least)})
                if not lines:
                    continue
                hashes, owners, parts = [], [], []
                for line in lines:
                    n = len(line)
                    plan = plans.get(n)
                    if plan is None:
                        own = [(n, i, at, size) for i, (at, size) in enumerate(segments(n, allowed(n, edits, least)))]
                        plan = plans[n] = [(at, at + size, other << 3 | i) for other, i, at, size in own + probes(n, edits, least)]
                    hashes += [digest(line[a:b].encode("utf-8", "surrogatepass"), seed) for a, b, seed in plan]
                    owners.append(len(plan))
                    parts.append(allowed(n, edits, least))
                h = np.array(hashes, np.uint64)
                counts = np.array(owners)
                rows = np.zeros(len(h), _ROW)
                rows["key"] = h >> np.uint64(32)
                rows["id"] = np.repeat(np.array([_identity(x)[0] for x in lines], np.int64), counts)
                rows["sign"] = np.repeat(signatures(lines), counts)
                first = np.cumsum(counts) - counts
                rows["probe"] = np.arange(len(h)) - np.repeat(first, counts) > np.repeat(np.array(parts), counts)
                place = ((h & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(place, kind="stable")
                edges = np.flatnonzero(np.diff(place[order], prepend=-1))
                groups = np.split(order, edges[1:])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place[order[edges]], pa.int32()), pa.array([pressed.compress(rows[g].tobytes()) for g in groups], pa.binary())],
                    ["bucket", "rows"],
                )

    return run


def near_pairs(key: np.ndarray, ids: np.ndarray, sign: np.ndarray, probe: np.ndarray, bits: int):
    """Pairs of ids (lower first) that share a key, one indexed and one probing, with near signatures. Sorted by key."""
    out = []
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(key)))
    at = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= 32), sizes))
    for d in range(1, 32):
        at = at[at + d < len(key)]
        at = at[key[at] == key[at + d]]
        if not len(at):
            break
        a, b = at, at + d
        good = (probe[a] != probe[b]) & (ids[a] != ids[b]) & (np.bitwise_count(sign[a] ^ sign[b]) <= bits)
        if good.any():
            out.append((ids[a[good]], ids[b[good]]))
    for s in np.flatnonzero(sizes > 32):
        own = np.arange(starts[s], starts[s] + sizes[s])
        # The index holds a line once; a portion may have brought it again.
        index = own[probe[own] == 0]
        index = index[np.unique(ids[index], return_index=True)[1]]
        asks = own[probe[own] == 1]
        asks = asks[np.unique(ids[asks], return_index=True)[1]]
        width = max(1, (1 << 20) // max(1, len(asks)))
        for i in range(0, len(index), width):
            block = index[i : i + width]
            near = np.bitwise_count(sign[block][:, None] ^ sign[asks][None, :]) <= bits
            a, b = np.nonzero(near)
            a, b = ids[block[a]], ids[asks[b]]
            if (a != b).any():
                out.append((a[a != b], b[a != b]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = (np.concatenate(side) for side in zip(*out, strict=True))
    pairs = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b))), axis=1)
    return pairs[0], pairs[1]


def _meet(edits: int, limit: int):
    """Reduce side: a bucket at a time. Candidate pairs, or the rows of a bucket over ``limit``."""
    names = ["a", "b", "key", "sign", "probe"]

    def pairs(a, b):
        none = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), none, none, pa.nulls(len(a), pa.bool_())], names)

    def overfull(bucket, rows):
        key = rows["key"].astype(np.int64) | np.int64(bucket) << np.int64(32)
        return pa.RecordBatch.from_arrays(
            [pa.array(rows["id"]), pa.nulls(len(rows), pa.int64()), pa.array(key), pa.array(rows["sign"].view(np.int64)), pa.array(rows["probe"] == 1)], names
        )

    def run(batches):
        plain = zstandard.ZstdDecompressor()
        now, size, held = None, 0, []

        def finish():
            if held:
                rows = np.concatenate(held)
                rows = rows[np.argsort(rows["key"], kind="stable")]
                a, b = near_pairs(*(np.ascontiguousarray(rows[x]) for x in ("key", "id", "sign", "probe")), 4 * edits)
                if len(a):
                    yield pairs(a, b)

        for batch in batches:
            for bucket, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if bucket != now:
                    yield from finish()
                    now, size, held = bucket, 0, []
                held.append(np.frombuffer(plain.decompress(raw), _ROW))
                size += len(held[-1])
                if size > limit:
                    for rows in held:
                        yield overfull(bucket, rows)
                    held = []
        yield from finish()

    return run


def _compare(edits: int):
    def task(rows: pa.Table, over: bool):
        a, b = near_pairs(
            *(rows[x].to_numpy() for x in ("key", "a")), rows["sign"].to_numpy().view(np.uint64), rows["probe"].to_numpy().astype(np.uint8), 4 * edits
        )
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return task


def candidates(docs: DataFrame, *, edits: int, least: int, id_col: str, text_col: str, limit: int = BUCKET_ROWS, block: int = BLOCK_ROWS) -> DataFrame:
    """``a, b``: distinct pairs of line ids that share a segment and have near signatures."""
    rows = _rows(docs, id_col, text_col)
    buckets = SPREAD * max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keys = rows.mapInArrow(_keys(edits, least, buckets), "bucket int, rows binary")
    found = keys.repartition(F.col("bucket")).sortWithinPartitions("bucket").mapInArrow(
        _meet(edits, limit), "a long, b long, key long, sign long, probe boolean"
    )
    found = materialise(found, "candidates")
    full, pairs = found.where("key is not null"), found.where("key is null").select("a", "b")
    if not full.isEmpty():
        # Every pair of blocks of a full key meets in one task, so none grows with the key.
        full = full.drop("b").distinct()
        n = full.groupBy("key").agg(F.ceil(F.count("*") * 2 / F.lit(block)).alias("n"))
        mine = F.pmod(F.xxhash64("a"), F.col("n"))
        dealt = full.join(n, "key").withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
        dealt = dealt.select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("key"), "a", "sign", "probe")
        pairs = pairs.unionByName(grouped(dealt, "key", _compare(edits), "a long, b long", limit=1 << 62))
    return pairs.distinct()


def edit_distances(pairs: list[tuple[str, str]], most: int) -> np.ndarray:
    """Edit distance of each pair where it is at most ``most``, else ``most + 1``: bit-parallel on a band, all pairs at once."""
    out = np.full(len(pairs), most + 1, np.int64)
    left, shift, cut = [], [], []
    for k, (a, b) in enumerate(pairs):
        if len(a) < len(b):
            a, b = b, a
        if len(a) - len(b) > most:
            continue
        if a == b:
            out[k] = 0
            continue
        i = _common(a, b)
        j = _common(a[i:][::-1], b[i:][::-1])
        a, b = a[i : len(a) - j], b[i : len(b) - j]
        if not b:
            out[k] = len(a)
            continue
        left.append(k)
        shift.append(len(a) - len(b))
        cut.append((a, b))
    order = sorted(range(len(left)), key=lambda i: len(cut[i][1]))
    for at in range(0, len(order), 4096):
        chosen = order[at : at + 4096]
        got = _banded([cut[i] for i in chosen], np.array([shift[i] for i in chosen]), most)
        out[[left[i] for i in chosen]] = np.minimum(got, most + 1)
    return out


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _banded(cut: list[tuple[str, str]], shift: np.ndarray, most: int) -> np.ndarray:
    """Bit ``b`` of a word stands for row ``column - most + b``; the answer runs along diagonal ``shift``."""
    rows, width = len(cut), 2 * most + 1
    longest = len(cut[-1][1])
    # The longer line with ``most`` blanks before it, so that the band never leaves the array.
    a = np.zeros((rows, longest + 3 * most + 2), np.uint32)
    b = np.zeros((rows, longest), np.uint32)
    size = np.zeros(rows, np.int64)
    for k, (x, y) in enumerate(cut):
        u = np.frombuffer(x.encode("utf-32-le", "surrogatepass"), "<u4")
        v = np.frombuffer(y.encode("utf-32-le", "surrogatepass"), "<u4")
        a[k, most : most + len(u)] = u + 1  # 0 is no character
        b[k, : len(v)] = v + 1
        size[k] = len(v)
    a, b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    one = np.uint64(1)
    mask = np.uint64((1 << width) - 1)
    up = np.full(rows, ((1 << width) - 1) & ~((1 << most) - 1), np.uint64)  # rows from 1 grow by one in column 0
    down = np.zeros(rows, np.uint64)
    distance, diagonal = shift.astype(np.int64), (shift + most).astype(np.uint64)
    for j in range(longest):
        live = j < size
        equal = np.zeros(rows, np.uint64)
        for k in range(width):
            equal |= (a[j + k] == b[j]).astype(np.uint64) << np.uint64(k)
        flat = ((((equal & up) + up) ^ up) | equal | down) & mask
        right = (down | ~(flat | up)) & mask
        fall = flat & up
        distance += live & ((flat >> diagonal) & one == 0)
        low = flat >> one
        up = (fall | ~(low | right)) & mask
        down = low & right
    return distance


def links(docs: DataFrame, *, edits: int = EDITS, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``a, b``: ids of distinct lines within the edits that their length allows, each pair once."""
    pairs = materialise(candidates(docs, edits=edits, least=least, id_col=id_col, text_col=text_col), "pairs")
    wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()

    def spelled(batches):
        for batch in batches:
            for part in _portions(batch):
                lines = list({line for _, text in part for line in text.split("\n") if allowed(len(line), edits, least)})
                yield pa.RecordBatch.from_arrays([pa.array([_identity(x)[0] for x in lines], pa.int64()), pa.array(lines, pa.string())], ["id", "line"])

    text = _rows(docs, id_col, text_col).mapInArrow(spelled, "id long, line string").join(wanted.hint("merge"), "id", "left_semi")
    text = materialise(text.groupBy("id").agg(F.min("line").alias("line")), "lines")

    def verify(batches):
        for batch in batches:
            both = list(zip(texts(batch.column("x")), texts(batch.column("y")), strict=True))
            near = edit_distances(both, edits) <= np.array([allowed(min(len(x), len(y)), edits, least) for x, y in both], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(near))

    full = pairs.join(text.select(F.col("id").alias("a"), F.col("line").alias("x")), "a")
    full = full.join(text.select(F.col("id").alias("b"), F.col("line").alias("y")), "b")
    return full.select("a", "b", "x", "y").mapInArrow(verify, "a long, b long")


def classes(docs: DataFrame, *, edits: int = EDITS, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, line_no, chars, links, class_doc_id, class_line_no`` of every line; ``links`` counts other texts near it."""
    lines = materialise(split_lines(docs, id_col=id_col, text_col=text_col), "lines")
    near = materialise(links(docs, edits=edits, least=least, id_col=id_col, text_col=text_col), "links")
    roots = components(near)
    ends = near.select(F.col("a").alias("id")).unionByName(near.select(F.col("b").alias("id"))).groupBy("id").agg(F.count("*").alias("links"))
    linked = ends.join(roots, F.col("id") == F.col("node")).select("id", "links", "root")
    first = lines.groupBy("id", "rest").agg(F.min(F.struct("doc_id", "line_no")).alias("first"))
    named = first.join(linked, "id", "left")
    named = materialise(named.select("id", "rest", "first", F.coalesce("links", F.lit(0)).cast("long").alias("links"), "root"), "classes")
    # Most lines have no link: they name their own class and stay out of the join by root.
    apart = named.where("root is null").select("id", "rest", "links", F.col("first").alias("class"))
    joined = named.where("root is not null")
    lowest = joined.groupBy("root").agg(F.min("first").alias("class"))
    named = joined.join(lowest, "root").select("id", "rest", "links", "class").unionByName(apart)
    return lines.join(named, ["id", "rest"]).select(
        "doc_id", "line_no", "chars", "links", F.col("class.doc_id").alias("class_doc_id"), F.col("class.line_no").alias("class_line_no")
    )


def deduplicate(docs: DataFrame, *, edits: int = EDITS, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with only the first line of each class left in the text; blank lines always stay."""
    found = classes(docs, edits=edits, least=least, id_col=id_col, text_col=text_col)
    late = found.where("chars > 0").where("doc_id <> class_doc_id or line_no <> class_line_no")
    gone = late.groupBy("doc_id").agg(F.collect_set("line_no").alias("__gone"))
    named = gone.withColumnRenamed("doc_id", "__id").hint("merge")
    joined = docs.join(named, docs[id_col].cast("long") == F.col("__id"), "left").drop("__id")
    place, names, schema = docs.columns.index(text_col), docs.columns, docs.schema

    def run(batches):
        for batch in batches:
            cuts, column = batch.column(len(names)).to_pylist(), batch.column(place)
            out = []
            for text, null, cut in zip(texts(column), column.is_null().to_pylist(), cuts, strict=True):
                if cut and not null:
                    drop = set(cut)
                    text = "\n".join([x for i, x in enumerate(text.split("\n")) if i not in drop or not x.strip()])
                out.append(None if null else text)
            columns = list(batch.columns[: len(names)])
            columns[place] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(run, schema)
