"""Approximate nearest neighbours by cosine over several shifted Hilbert orderings.

Each ordering projects the unit vectors on a few random orthogonal axes, cuts every axis at shifted quantiles of a
bounded sample and takes the cell's place on the Hilbert curve as key. Keys are range-partitioned and sorted in Spark;
counts per partition turn places into global positions, and positions into blocks of equal size, so no key, however
common, makes a block larger. A query meets the rows of its own block and of the two beside it, which covers a window
of at least one block on either side; the best of every window merge, in double precision on the original vectors.

Equal vectors share a place: of each, only the smallest ids that can appear in an answer are candidates. Rows whose
vector is null, zero, of another length than the first, or has a null or non-finite component take no part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geopulse.llm.common import grouped
from geopulse.workspace import materialise

AXES, BITS = 8, 6
#: Vectors read by the driver to place the cuts of the axes; every row is indexed whatever their number.
SAMPLE = 5000
#: Rows of a block: a 32nd of all, within these bounds.
BLOCK = (256, 8192)
SEED = 7


def block_rows(rows: int) -> int:
    return min(max(rows // 32, BLOCK[0]), BLOCK[1])


def orderings(rows: int) -> int:
    """How many curves: fitted on vectors without any structure, the hardest case; the smaller a window's share, the more."""
    share = min(1.0, 3 * block_rows(rows) / max(rows, 1))
    return math.ceil(10 * (0.1 / share) ** 0.7) + 3


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each cell (rows of integers below ``2**bits``) on the Hilbert curve, by Gray-code rotations of the axes."""
    x = cells.T.astype(np.uint64)
    axes = len(x)
    for b in range(bits - 1, 0, -1):
        bit, low = np.uint64(1 << b), np.uint64((1 << b) - 1)
        for i in range(axes):
            flip = (x[i] & bit) != 0
            swap = np.where(flip, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & np.uint64(1 << b), np.uint64((1 << b) - 1), np.uint64(0))
    x ^= turn
    place = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(axes):
            place = place << np.uint64(1) | (x[i] >> np.uint64(b) & np.uint64(1))
    return place.astype(np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as double rows."""
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1) if raw else np.zeros((0, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector`` (doubles as bytes) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and size(v) > 0")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.coalesce(fine, F.lit(False)) & F.exists("v", lambda x: x != 0))
    size = rows.agg(F.min_by(F.size("v"), "vec_id")).first()[0]
    rows = rows.where(F.size("v") == F.lit(size or 0))

    def run(batches):
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False) + 0.0  # no negative zeros
            x = flat.reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary())], ["vec_id", "vector"])

    return rows.mapInArrow(run, "vec_id long, vector binary")


def nearest(
    vectors: DataFrame, *, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding",
    curves: int | None = None, block: int | None = None,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest found for every row whose id is divisible by ``every``."""
    rows = materialise(usable(vectors, id_col, vector_col), "vectors")
    turn = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    rows = materialise(
        rows.select("vec_id", "vector", (turn <= k + 1).alias("candidate"), (F.col("vec_id") % every == 0).alias("query"))
        .where("candidate or query"), "vectors",
    )
    total = rows.count()
    curves, block = curves or orderings(total), block or block_rows(total)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").collect()
    axes, cuts = _fit([r[0] for r in sample], curves)

    def keys(batches):
        for batch in batches:
            x = _unit(_matrix(batch.column(1)))
            for o in range(curves):
                y = x @ axes[o]
                cells = np.stack([np.searchsorted(cuts[o][i], y[:, i]) for i in range(y.shape[1])], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), o, np.int32)), pa.array(hilbert(cells, BITS)), batch.column(0)], ["curve", "key", "vec_id"]
                )

    def places(batches):
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            curve = batch.column(0).to_numpy()
            place = np.empty(len(curve), np.int64)
            for o in np.unique(curve).tolist():
                own = curve == o
                at = seen.get(o, 0)
                place[own] = at + np.arange(own.sum())
                seen[o] = at + int(own.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(np.full(len(curve), part, np.int32)), pa.array(place)], ["curve", "vec_id", "part", "place"]
            )

    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.select("vec_id", "vector").mapInArrow(keys, "curve int, key long, vec_id long")
    ordered = ordered.repartitionByRange(width, "curve", "key", "vec_id").sortWithinPartitions("curve", "key", "vec_id")
    ordered = materialise(ordered.mapInArrow(places, "curve int, vec_id long, part int, place long"), "places")
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ordered.groupBy("curve", "part").agg(F.count("*").alias("n"))
    counts = counts.select("curve", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    last = max(0, total - 1) // block
    spots = ordered.join(counts, ["curve", "part"]).select("vec_id", "curve", F.floor((F.col("place") + F.col("skip")) / block).alias("block"))
    spots = spots.groupBy("vec_id").agg(F.collect_list(F.struct("curve", "block")).alias("spots"))  # one for each curve
    # A candidate goes to its own block, a query also to the blocks beside it.
    spread = rows.join(spots, "vec_id").withColumn("spot", F.explode("spots")).select(
        "vec_id", "vector", "candidate", "query", "spot.curve", F.col("spot.block").alias("home"),
        F.explode(F.when(F.col("query"), F.array(*(F.col("spot.block") + d for d in (-1, 0, 1)))).otherwise(F.array("spot.block"))).alias("block"),
    ).where(F.col("block").between(0, last))
    spread = spread.select(
        (F.col("curve") * F.lit(last + 1) + F.col("block")).cast("long").alias("cell"), "vec_id", "vector",
        (F.col("candidate") & (F.col("block") == F.col("home"))).alias("candidate"), "query",
    )
    found = grouped(spread, "cell", _best(k), "query_id long, vec_id long, score double", limit=1 << 62)
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _fit(sample: list[bytes], curves: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Random orthogonal axes of each curve, and shifted quantiles of the sample along them."""
    x = _unit(np.frombuffer(b"".join(sample), "<f8").reshape(len(sample), -1)) if sample else np.zeros((0, 1))
    draw, axes, cuts = np.random.default_rng(SEED), [], []
    for _ in range(curves):
        own = np.linalg.qr(draw.standard_normal((x.shape[1], min(AXES, x.shape[1]))))[0]
        axes.append(own)
        shift = draw.random(own.shape[1])
        parts = 1 << BITS
        if len(x):
            y = x @ own
            cuts.append(np.stack([np.quantile(y[:, i], (np.arange(parts - 1) + 0.5 + shift[i] / 2) / parts) for i in range(y.shape[1])]))
        else:
            cuts.append(np.zeros((own.shape[1], parts - 1)))
    return axes, cuts


def _best(k: int):
    def task(rows: pa.Table, over: bool):
        rows = rows.combine_chunks()
        cell = rows["cell"].to_numpy()
        edges = np.append(np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))), len(cell))
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            part = rows.slice(a, b - a)
            ids, asks = part["vec_id"].to_numpy(), np.flatnonzero(part["query"].to_numpy(zero_copy_only=False))
            offers = np.flatnonzero(part["candidate"].to_numpy(zero_copy_only=False))
            if not len(asks) or not len(offers):
                continue
            order = offers[np.argsort(ids[offers], kind="stable")]
            x = _unit(_matrix(part["vector"].combine_chunks()))
            for i in range(0, len(asks), 512):
                own = asks[i : i + 512]
                score = x[own] @ x[order].T
                score[ids[own][:, None] == ids[order][None, :]] = -np.inf
                top = np.argsort(-score, axis=1, kind="stable")[:, :k]  # ties to the smaller id
                kept = np.take_along_axis(score, top, axis=1)
                real = np.isfinite(kept)
                out.append((np.repeat(ids[own], real.sum(axis=1)), ids[order][top[real]], kept[real]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(s)) for s in zip(*out, strict=True)], ["query_id", "vec_id", "score"])

    return task
