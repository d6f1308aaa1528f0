"""Near-duplicate documents by SimHash: a popcount embedding joined on a Manhattan grid, then verified.

A 64-bit fingerprint maps to 32 segment popcounts (two bits each). The Manhattan distance of two such vectors
never exceeds the Hamming distance of the fingerprints, so fingerprints that differ in at most three bits have
one half (16 segments) of Manhattan distance at most one. Each half lies on an integer grid; vectors of odd sum
also visit their neighbouring cells, which brings together every pair at distance one (such pairs have one odd
sum). Rows that meet in a cell are compared exactly. A cell yields a spanning forest of its links, not all pairs.

Null and empty texts have no words: fingerprint zero, linked like any other. Equal fingerprints are one node, so
copies never meet in pairs. Other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopulse.llm.common import binaries, components, grouped, word_blocks
from geopulse.workspace import materialise

SEED = 42
#: Rows of one cell compared within one task; a fuller cell is cut into blocks and all pairs of blocks are compared.
CELL_LIMIT = 16_384
_ODD = np.uint64(0x5555555555555555)


def fingerprint(text: bytes, width: int = 3) -> int:
    """SimHash of a UTF-8 text over ``width``-word shingles, repeats included."""
    digest = xxhash.xxh64_intdigest
    counts, total, carry = np.zeros(64, np.int64), 0, []
    for words in word_blocks(text.lower()):
        words = carry + words
        if len(words) < width:
            carry = words
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
        counts, total = _add(counts, total, [digest(joined[i:j], SEED) for i, j in spans])
        carry = words[len(words) - width + 1 :] if width > 1 else []
    if not total:
        if not carry:
            return 0
        counts, total = _add(counts, total, [digest(b" ".join(carry), SEED)])
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def counted(values: np.ndarray) -> tuple[np.ndarray, int]:
    """How many of the 64-bit hashes have each bit set, and how many they are."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(values), 4096):
        part = np.ascontiguousarray(values[i : i + 4096]).view(np.uint8).reshape(-1, 8)
        counts = counts + np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return counts, len(values)


def _add(counts: np.ndarray, total: int, hashes: list[int]) -> tuple[np.ndarray, int]:
    more, n = counted(np.array(hashes, "<u8"))
    return counts + more, total + n


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``doc_id, bits``: the fingerprint of every whole text as a signed long."""

    def run(batches):
        for batch in batches:
            bits = np.array([fingerprint(x, width) for x in binaries(batch.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits)], ["doc_id", "bits"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, bits long")


def _cells(batches):
    """Each fingerprint with the grid cells of its two halves and, from vectors of odd sum, the cells next to them."""
    for batch in batches:
        x = batch.column("bits").to_numpy().view(np.uint64)
        vector = (x & _ODD) + ((x >> np.uint64(1)) & _ODD)  # 32 popcounts of two bits each
        cells, owners = [], []
        for half in (0, 1):
            part = ((vector >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            base = np.int64(half) << np.int64(32)
            cells.append(part | base)
            owners.append(x)
            odd = np.bitwise_count(((x >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF))) % 2 == 1
            part, own = part[odd], x[odd]
            for j in range(0, 32, 2):
                field = (part >> j) & 3
                for step, may in ((1, field < 2), (-1, field > 0)):
                    cells.append((part[may] + np.int64(step << j)) | base)
                    owners.append(own[may])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(cells)), pa.array(np.concatenate(owners).view(np.int64))], ["cell", "bits"]
        )


def _links(distance: int):
    """Spanning links of each cell's rows; the rows of an overfull cell go on as they are."""

    def task(rows: pa.Table, over: bool):
        cell, bits = rows["cell"].to_numpy(), rows["bits"].to_numpy()
        if over:
            yield _batch(bits, None, cell)
            return
        if not len(cell):
            return
        starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        sizes = np.diff(np.append(starts, len(cell)))
        x, out = bits.view(np.uint64), []
        few = np.repeat((sizes > 1) & (sizes <= 16), sizes)
        at = np.flatnonzero(few)
        for d in range(1, 16):
            at = at[at + d < len(cell)]
            at = at[cell[at] == cell[at + d]]
            if not len(at):
                break
            near = at[np.bitwise_count(x[at] ^ x[at + d]) <= distance]
            if len(near):
                out.append((bits[near], bits[near + d]))
        for i in np.flatnonzero(sizes > 16):
            out += forest(x[starts[i] : starts[i] + sizes[i]], distance)
        if out:
            yield _batch(*(np.concatenate(side) for side in zip(*out, strict=True)), None)

    return task


def _batch(a: np.ndarray, b: np.ndarray | None, cell: np.ndarray | None) -> pa.RecordBatch:
    blank = pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(a), blank if b is None else pa.array(b), blank if cell is None else pa.array(cell)], ["a", "b", "cell"]
    )


def forest(x: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest of the links among ``x``, found breadth-first a block at a time."""
    rest, out = np.unique(x), []
    while len(rest):
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            width = max(1, (1 << 20) // len(rest))
            block, front = front[:width], front[width:]
            near = np.bitwise_count(block[:, None] ^ rest[None, :]) <= distance
            hit = near.any(axis=0)
            if hit.any():
                found = rest[hit]
                out.append((block[near[:, hit].argmax(axis=0)].view(np.int64), found.view(np.int64)))
                front, rest = np.concatenate((front, found)), rest[~hit]
    return out


def links(marks: DataFrame, distance: int = 3, *, limit: int = CELL_LIMIT) -> DataFrame:
    """``a, b``: links between distinct fingerprints (``bits``), enough to connect all that are near."""
    if distance > 3:
        raise ValueError("two halves of the embedding prove links of at most three bits")
    schema = "a long, b long, cell long"
    cells = marks.select("bits").distinct().mapInArrow(_cells, "cell long, bits long")
    found = materialise(grouped(cells, "cell", _links(distance), schema, limit=limit), "near")
    full = found.where("cell is not null")
    pieces = full.groupBy("cell").agg(F.ceil(F.count("*") * 2 / F.lit(limit)).alias("n"))
    if pieces.isEmpty():
        return found.select("a", "b")
    # Every row of an overfull cell goes once to each pair that its block forms.
    mine = F.pmod(F.xxhash64("a"), F.col("n"))
    dealt = (
        full.join(pieces, "cell")
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
        .select(F.xxhash64("cell", F.least("mine", "other"), F.greatest("mine", "other")).alias("cell"), F.col("a").alias("bits"))
    )
    rest = grouped(dealt, "cell", _links(distance), schema, limit=1 << 62)
    return found.where("cell is null").select("a", "b").unionByName(materialise(rest, "near").select("a", "b"))


def near_duplicates(docs: DataFrame, *, distance: int = 3, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, bits, component_id``: the smallest id reachable over links of at most ``distance`` bits.

    A null id stays a row of its own and never names a component.
    """
    marks = materialise(fingerprints(docs, id_col=id_col, text_col=text_col, width=width), "fingerprints")
    roots = components(links(marks, distance))
    first = marks.groupBy("bits").agg(F.min("doc_id").alias("first"))
    named = first.join(roots, F.col("bits") == F.col("node"), "left").select("bits", "first", F.coalesce("root", "bits").alias("root"))
    named = materialise(named, "roots")
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return marks.join(named.join(lowest, "root").select("bits", "component_id"), "bits").select("doc_id", "bits", "component_id")
