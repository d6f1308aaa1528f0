"""Near-duplicate documents by the Jaccard index of their word shingles: SimHash and MinHash bands propose, exact sets decide.

A document is the set of its hashed ``WIDTH``-word shingles, in lower case; of fewer words, all of them are one shingle.
Equal sets are one node. Two ways propose pairs. SimHash: the majority bits of a set's hashes go through the popcount grid of
``simhash``, which proves all pairs of at most three bits; sets of one fingerprint are held against the least of them. Sets at
Jaccard 0.8 lie about ten bits apart, beyond what two halves of the grid prove, so ``BANDS`` bands of ``ROWS`` least hashes find the rest: a
pair at 0.8 is missed by all bands with probability 3e-6, a nearer one with less. Whatever is proposed is compared as whole sets.

A band cell need not list its pairs. Each of its sets is compared with the least of them; where what is linked by then
does not hold the whole cell together, the sets travel to the cell. Of a component that fills it each set goes to one block, the others go to every
block, and only sets of different components are compared. Rows without an id take no part; null and empty texts are
one set, the empty one, like other equal texts; repeated rows are copies; ties cannot matter, as links are not chosen. Very long texts are their distinct shingles in memory. An
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopulse.llm import simhash
from geopulse.llm.common import binaries, components, grouped, word_blocks
from geopulse.workspace import materialise

WIDTH, LEAST = 5, 0.8
BANDS, ROWS = 24, 4
#: Sets of one cell compared within one task.
BLOCK = 512
SEED = 42
_draw = np.random.default_rng(SEED)
_XOR = _draw.integers(0, 1 << 64, BANDS * ROWS, np.uint64)
_TIMES = _draw.integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(1)


def shingles(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a UTF-8 text."""
    digest = xxhash.xxh64_intdigest
    parts, carry = [], []
    for words in word_blocks(text.lower()):
        words = carry + words
        if len(words) >= width:
            found = [digest(b" ".join(words[i : i + width]), SEED) for i in range(len(words) - width + 1)]
            parts.append(np.unique(np.array(found, np.uint64)))
        carry = words[-(width - 1) :] if width > 1 else []
    if not parts:
        parts = [np.array([digest(b" ".join(carry), SEED)] if carry else [], np.uint64)]
    return np.unique(np.concatenate(parts))


def identity(own: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63)


def cells(own: np.ndarray) -> list[int]:
    """The cell of a set in every band; the empty set has the cells of no other."""
    least = np.full(len(_XOR), (1 << 64) - 1, np.uint64)
    for at in range(0, len(own), 4096):
        part = own[at : at + 4096]
        least = np.minimum(least, ((part[None, :] ^ _XOR[:, None]) * _TIMES[:, None]).min(axis=1))
    return [xxhash.xxh3_64_intdigest(least[i * ROWS : (i + 1) * ROWS].tobytes(), i) - (1 << 63) for i in range(BANDS)]


def near(one: np.ndarray, two: np.ndarray, least: float = LEAST) -> bool:
    """Whether the Jaccard index of two sorted sets is ``least`` or more."""
    if min(len(one), len(two)) < least * max(len(one), len(two)):
        return False
    both = len(np.intersect1d(one, two, assume_unique=True))
    union = len(one) + len(two) - both
    return not union or both >= least * union


def simhash_bits(own: np.ndarray) -> int:
    """SimHash of a set of hashes as a signed long."""
    counts, total = simhash.counted(own)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])


def forest(names: list[int], roots: list[int], sets: list[np.ndarray], least: float = LEAST) -> list[tuple[int, int]]:
    """Links that hold together what is near among sets of different components; those of one are never compared."""
    up = {r: r for r in roots}

    def find(r: int) -> int:
        while up[r] != r:
            up[r] = up[up[r]]
            r = up[r]
        return r

    by_root: dict[int, list[int]] = {}
    for i, r in enumerate(roots):
        by_root.setdefault(r, []).append(i)
    order, out = sorted(by_root, key=lambda r: (len(by_root[r]), r)), []
    for k, r in enumerate(order[:-1]):
        others = [i for other in order[k + 1 :] for i in by_root[other]]
        for i in by_root[r]:
            for j in others:
                a, b = find(r), find(roots[j])
                if a != b and near(sets[i], sets[j], least):
                    out.append((names[i], names[j]))
                    up[a] = b
    return out


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, set, shingles``: the identity and the hashes of every document."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                own = [shingles(x, width) for x in binaries(part.column(1))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(map(identity, own), pa.int64()), pa.array([x.tobytes() for x in own], pa.binary())],
                    ["doc_id", "set", "shingles"],
                )

    return docs.mapInArrow(run, "doc_id long, set long, shingles binary")


def proposed(marks: DataFrame) -> DataFrame:
    """``a, b``: distinct sets whose SimHash is the same, through the least of them, or at most three bits away, through the grid."""
    kinds = marks.groupBy("set").agg(F.first("bits").alias("bits"))
    least = kinds.groupBy("bits").agg(F.min("set").alias("a"))
    same = kinds.join(least, "bits").where("set <> a").select("a", F.col("set").alias("b"))
    near_bits = simhash.links(kinds).withColumnsRenamed({"a": "x", "b": "y"})
    one, two = least.select(F.col("bits").alias("x"), "a"), least.select(F.col("bits").alias("y"), F.col("a").alias("b"))
    return same.unionByName(near_bits.join(one, "x").join(two, "y").select("a", "b"))


def links(docs: DataFrame, marks: DataFrame, *, width: int = WIDTH, least: float = LEAST, block: int = BLOCK) -> DataFrame:
    """``a, b``: links between distinct sets of ``doc_id, text``, enough to connect all that are near and meet in a band."""
    met = marks.groupBy("set").agg(F.min("doc_id").alias("first"), F.first("cells").alias("cells"))
    met = met.select("set", "first", F.explode("cells").alias("cell"))

    def together(rows: pa.Table, over: bool):
        """Rows of cells with company; pieces of a full cell have it."""
        cell = rows["cell"].to_numpy()
        more = np.ones(len(cell), bool)
        if not over:
            _, place, count = np.unique(cell, return_inverse=True, return_counts=True)
            more = count[place] > 1
        yield from rows.filter(pa.array(more)).to_batches()

    met = materialise(grouped(met, "cell", together, "set long, first long, cell long", limit=1 << 16), "cells")
    # Cells of the same sets are one cell.
    kinds = met.groupBy("cell").agg(F.count("*").alias("n"), F.min("set").alias("hub"), F.bit_xor(F.xxhash64("set")).alias("x"), F.sum(F.hash("set").cast("long")).alias("y"))
    kinds = kinds.groupBy("n", "hub", "x", "y").agg(F.min("cell").alias("cell")).where("n > 1").select("cell", "n", "hub")
    met = materialise(met.join(kinds, "cell"), "met")
    ahead = materialise(proposed(marks), "proposed")
    if met.isEmpty() and ahead.isEmpty():
        return ahead
    firsts = marks.groupBy("set").agg(F.min("doc_id").alias("first"))
    asked = ahead.select(F.col("a").alias("set")).unionByName(ahead.select(F.col("b").alias("set"))).unionByName(met.select("set")).distinct()
    wanted = firsts.join(asked, "set", "left_semi").select("first").distinct()
    whole = docs.join(wanted, docs["doc_id"] == wanted["first"], "left_semi")
    whole = _sets(whole, width).join(asked, "set", "left_semi")
    whole = materialise(whole.groupBy("set").agg(F.first("shingles").alias("shingles")), "sets")

    def verify(batches):
        for batch in batches:
            a, b, x, y = (batch.column(c).to_pylist() for c in ("a", "b", "x", "y"))
            yield _pairs([(i, j) for i, j, p, q in zip(a, b, x, y, strict=True) if near(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), least)])

    pairs = met.where("set <> hub").select(F.col("hub").alias("a"), F.col("set").alias("b")).unionByName(ahead).distinct()
    pairs = pairs.join(whole.select(F.col("set").alias("a"), F.col("shingles").alias("x")), "a")
    pairs = pairs.join(whole.select(F.col("set").alias("b"), F.col("shingles").alias("y")), "b")
    found = materialise(pairs.select("a", "b", "x", "y").mapInArrow(verify, "a long, b long"), "near")

    roots = components(found)
    named = met.where("n > 2").join(roots, F.col("set") == F.col("node"), "left").select("cell", "set", "n", F.coalesce("root", "set").alias("root"))
    apart = named.groupBy("cell").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("cell")
    left = materialise(named.join(apart, "cell").select("cell", "set", "root"), "apart")
    if left.isEmpty():
        return found
    # The largest component of a cell is dealt out by block; the others meet each block of it and one another.
    sizes = left.groupBy("cell", "root").agg(F.count("*").alias("n"))
    heads = sizes.groupBy("cell").agg(F.max(F.struct("n", "root")).alias("big"), F.sum("n").alias("n"))
    heads = heads.select("cell", F.col("big.root").alias("big"), F.ceil(F.col("big.n") / block).alias("blocks"), (F.col("n") - F.col("big.n")).alias("rest"))
    parts = left.join(heads, "cell").withColumn("small", F.ceil(F.col("rest") / F.lit(block)))
    mine = parts.withColumn("mine", F.pmod(F.xxhash64("set"), F.greatest(F.when(F.col("root") == F.col("big"), F.col("blocks")).otherwise(F.col("small")), F.lit(1))))
    none = F.lit(0).cast("long")
    large = mine.where("root = big").select("cell", "set", "root", F.col("mine").alias("one"), F.explode(F.sequence(none, F.col("small") - 1)).alias("two"), F.lit("big").alias("kind"))
    small = mine.where("root <> big")
    facing = small.select("cell", "set", "root", F.explode(F.sequence(none, F.col("blocks") - 1)).alias("one"), F.col("mine").alias("two"), F.lit("big").alias("kind"))
    among = small.withColumn("other", F.explode(F.sequence(none, F.col("small") - 1))).select(
        "cell", "set", "root", F.least("mine", "other").alias("one"), F.greatest("mine", "other").alias("two"), F.lit("small").alias("kind")
    )
    dealt = large.unionByName(facing).unionByName(among).select(F.xxhash64("cell", "one", "two", "kind").alias("cell"), "set", "root")

    def compare(rows: pa.Table, over: bool):
        cell = rows["cell"].to_numpy()
        edges = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1], [True])))
        for i, j in zip(edges, edges[1:]):
            own = rows.slice(i, j - i)
            out = forest(own["set"].to_pylist(), own["root"].to_pylist(), [np.frombuffer(x, np.uint64) for x in own["shingles"].to_pylist()], least)
            if out:
                yield _pairs(out)

    rest = grouped(dealt.join(whole, "set").select("cell", "set", "root", "shingles"), "cell", compare, "a long, b long", limit=1 << 62)
    return found.unionByName(materialise(rest, "near"))


def near_duplicates(docs: DataFrame, *, width: int = WIDTH, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, component_id``: the smallest id reachable over links of Jaccard index ``least`` or more."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")

    def run(batches):
        for batch in batches:
            own = [shingles(x, width) for x in binaries(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(map(f, own), pa.int64()) for f in (identity, simhash_bits)), pa.array(map(cells, own), pa.list_(pa.int64()))],
                ["doc_id", "set", "bits", "cells"],
            )

    marks = materialise(rows.mapInArrow(run, "doc_id long, set long, bits long, cells array<long>"), "marks")
    roots = components(links(rows, marks, width=width, least=least))
    first = marks.groupBy("set").agg(F.min("doc_id").alias("first"))
    named = first.join(roots, F.col("set") == F.col("node"), "left").select("set", "first", F.coalesce("root", "set").alias("root"))
    named = materialise(named, "roots")
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return marks.join(named.join(lowest, "root").select("set", "component_id"), "set").select("doc_id", "component_id")
