"""Shared pieces: row identity, streams of sorted groups, components of a link graph."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geopulse.workspace import materialise

_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_blocks(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, a megabyte at a time and never cut inside a word."""
    at, end = 0, len(text)
    while at < end:
        stop = min(end, at + size)
        if stop < end:
            found = _SPACE.search(text, stop)
            stop = found.start() if found else end
        yield text[at:stop].split()
        at = stop


def binaries(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str, limit: int) -> Iterator[tuple[pa.Table, bool]]:
    """Whole groups of a stream sorted by ``key``, many at a time; the flag marks pieces of a group over ``limit`` rows.

    Memory stays near one batch plus ``limit`` rows: a longer group is handed on in pieces as it streams by.
    """
    kept: list[pa.RecordBatch] = []
    held, over = 0, None

    def drain() -> pa.Table:
        nonlocal kept, held
        out = pa.Table.from_batches(kept)
        kept, held = [], 0
        return out

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        first = int(np.searchsorted(keys, keys[0], side="right"))
        if over is not None and keys[0] == over:
            yield pa.Table.from_batches([batch.slice(0, first)]), True
            batch, keys = batch.slice(first), keys[first:]
            if not len(keys):
                continue
        over = None
        last = int(np.searchsorted(keys, keys[-1], side="left"))
        if held:
            tail = kept[-1].column(key)[-1].as_py()
            if keys[0] != tail:
                yield drain(), False
            elif last:
                head = int(np.searchsorted(keys, keys[0], side="right"))
                kept.append(batch.slice(0, head))
                yield drain(), False
                batch, keys, last = batch.slice(head), keys[head:], last - head
        if last:
            yield pa.Table.from_batches([batch.slice(0, last)]), False
        kept.append(batch.slice(last))
        held += batch.num_rows - last
        if held > limit:
            over = keys[-1]
            yield drain(), True
    if held:
        yield drain(), False


def grouped(df: DataFrame, key: str, task: Callable, schema: str, *, limit: int, order: tuple[str, ...] = ()) -> DataFrame:
    """Co-locate rows by ``key`` and run ``task(table, over_limit) -> Iterator[RecordBatch]`` over whole groups."""

    def run(batches):
        for rows, over in sorted_groups(batches, key, limit):
            yield from task(rows, over)

    return df.repartition(F.col(key)).sortWithinPartitions(key, *order).mapInArrow(run, schema)


def components(links: DataFrame) -> DataFrame:
    """``a, b`` (long) to ``node, root``: the smallest node reachable, for every node on a link.

    Large-star and small-star rounds (Kiveris et al. 2014); the links never leave the executors and each
    round is a written table.
    """
    edges = materialise(
        links.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct(), "links"
    )
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("m").alias("v"), F.col("v").alias("m")))
        low = both.groupBy("v").agg(F.min("m").alias("low")).select("v", F.least("low", "v").alias("low"))
        large = both.where("m > v").join(low, "v").select(F.col("m").alias("v"), F.col("low").alias("m")).distinct()
        low = large.groupBy("v").agg(F.min("m").alias("low"))
        small = large.join(low, "v").select(F.col("m").alias("v"), F.col("low").alias("m")).where("v <> m")
        edges = materialise(small.unionByName(low.select("v", F.col("low").alias("m"))).distinct(), "links")
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    return edges.select(F.col("v").alias("node"), F.col("m").alias("root")).unionByName(
        edges.select(F.col("m").alias("node"), F.col("m").alias("root")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "m")), F.sum(F.hash("v", "m").cast("long"))).first())


def joined_digest(rows: DataFrame, key: str, value: str, glue: str) -> DataFrame:
    """``key, digest``: SHA-256 of the values of a key, glued, for rows that stand together by key and in order within it.

    Values stream by: none but the running hash is held.
    """

    def run(batches):
        now, running = None, None
        for batch in batches:
            keys, out = batch.column(0), []
            for own, part in zip(keys.to_pylist(), binaries(batch.column(1)), strict=True):
                if running is None or own != now:
                    if running is not None:
                        out.append((now, running.hexdigest()))
                    now, running = own, hashlib.sha256(part)
                else:
                    running.update(glue.encode())
                    running.update(part)
            yield _digests(out, keys.type)
        if running is not None:
            yield _digests([(now, running.hexdigest())], keys.type)

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, F.col(value).cast("string").alias(value)).mapInArrow(run, f"{key} {kind}, digest string")


def _digests(found: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], kind), pa.array([f[1] for f in found], pa.string())], ["key", "digest"])


def texts(column: pa.Array) -> list[str]:
    """A string column as Python strings; null is empty, bytes that are not UTF-8 become U+FFFD."""
    return [x.decode("utf-8", "replace") for x in binaries(column)]


def tokenizer_file(name: str) -> str:
    """Where a public vocabulary lies on the machine that asks; resolved inside the task."""
    import public_tokenizers

    return public_tokenizers.path(name)
