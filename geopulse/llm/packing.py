"""Packing token sequences by shortest-pack-first over the histogram of lengths.

Every text is tokenised whole and ends with one closing id. What exceeds a sequence is cut into full sequences and a
rest. Only the histogram of piece lengths (at most ``size`` rows) reaches the driver: lengths go longest first, and
all pieces of one length are placed at once into the emptiest packs that take them, by changing counts of packing
patterns. Patterns come back to the pieces by rank: the r-th piece of a length takes the r-th slot of that length.

Null and empty texts are the closing id alone. Repeated rows are packed like any other. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geopulse.llm import bpe
from geopulse.llm.common import texts, tokenizer_file
from geopulse.workspace import materialise

SIZE = 2048
CLOSING = 1
#: Ranks of ``byte_bpe_50k.json`` and the special token that its library finds inside texts.
RANKS, SPECIAL = "byte_bpe_50k.tiktoken", {"<|endoftext|>": 50256}
#: Characters of a run from which a text is split and merged by ``bpe`` instead of the library.
LONG = 4096
_BLANKS = re.compile(rf"\s{{{LONG}}}")
_SPECIAL = re.compile("(" + "|".join(map(re.escape, SPECIAL)) + ")")
#: Pieces of one length that are numbered within one task.
RANK_ROWS = 100_000
_SLOTS = "length int, first long, last long, base long, offset long"


@functools.lru_cache(maxsize=1)
def tokenizer(ranks: str = RANKS) -> tiktoken.Encoding:
    import public_tokenizers

    with open(tokenizer_file(ranks), "rb") as lines:
        merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(ranks, pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens=SPECIAL)


def _runs_long(text: str) -> bool:
    """Whether a run with or without white space has ``LONG`` characters: the library's splitter fails on very long ones."""
    return len(text) >= LONG and (max(map(len, text.split()), default=0) >= LONG or _BLANKS.search(text) is not None)


def _merged_ids(text: str, ranks: str) -> np.ndarray:
    """Ids by the splitting and the heap of :mod:`bpe`, whatever the length of a run; special tokens cut the text."""
    own, out = bpe.load(ranks), []
    for i, part in enumerate(_SPECIAL.split(text)):
        out += [SPECIAL[part]] if i % 2 else [x for piece in own.encode([part])[0] for x in piece]
    return np.array(out, "<u4")


def token_ids(text: str, ranks: str = RANKS) -> np.ndarray:
    if _runs_long(text):
        return _merged_ids(text, ranks)
    own = tokenizer(ranks)
    if any(special in text for special in SPECIAL):
        return np.array(own.encode(text, allowed_special="all"), "<u4")
    return np.array(own.encode_ordinary(text), "<u4")


def pieces(docs: DataFrame, *, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens``: every text cut into runs of at most ``size`` ids."""

    def run(batches):
        for batch in batches:
            owner, start, length, crc, total = [], [], [], [], []
            for i, text in enumerate(texts(batch.column(1))):
                ids = np.append(token_ids(text), np.uint32(CLOSING)).astype("<u4")
                for at in range(0, len(ids), size):
                    part = ids[at : at + size]
                    owner.append(i)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    total.append(len(ids))
            numbers = [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner, pa.int64())), *numbers],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def patterns(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, tuple[int, ...]]]:
    """``(count, lengths)`` of the packs: shortest-pack-first over the histogram, longest lengths first."""
    packs: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)  # by free space
    spaces: list[int] = []  # negated, a heap: the most space first

    def put(free: int, count: int, lengths: tuple[int, ...]) -> None:
        if not packs[free]:
            heapq.heappush(spaces, -free)
        packs[free].append((count, lengths))

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= size:
            raise ValueError(f"a piece of {length} ids does not fit a sequence of {size}")
        left = histogram[length]
        while left:
            while spaces and not packs[-spaces[0]]:
                heapq.heappop(spaces)
            free = -spaces[0] if spaces else 0
            if free < length:
                put(size - length, left, (length,))
                break
            count, lengths = packs[free].pop()
            taken = min(count, left)
            if count > taken:
                put(free, count - taken, lengths)
            put(free - length, taken, (*lengths, length))
            left -= taken
    return [pack for free in sorted(packs) for pack in packs[free]]


def slots(found: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int]]:
    """``(length, first, last, base, offset)``: which ranks of a length sit where in which sequences."""
    used: dict[int, int] = defaultdict(int)
    out, base = [], 0
    for count, lengths in found:
        offset = 0
        for length in lengths:
            out.append((length, used[length], used[length] + count - 1, base, offset))
            used[length] += count
            offset += length
        base += count
    return out


def place(cut: DataFrame, *, size: int = SIZE) -> DataFrame:
    """``sequence_id, offset`` for pieces with ``doc_id, start, length``; other columns stay."""
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    spark = cut.sparkSession
    table = spark.createDataFrame(slots(patterns(counts, size)), _SLOTS)
    parts = max(counts.values(), default=0) // RANK_ROWS + 1
    salted = cut.withColumn("part", F.pmod(F.xxhash64("doc_id", "start"), F.lit(parts)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    skip = salted.groupBy("length", "part").agg(F.count("*").alias("n"))
    skip = skip.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    within = Window.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32")
    ranked = salted.withColumn("rank", F.row_number().over(within) - 1).join(skip, ["length", "part"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("skip")).drop("part", "skip")
    # The slots are as many as the patterns' entries, which the distinct lengths bound, not the rows.
    joined = ranked.alias("r").join(
        F.broadcast(table).alias("s"), F.expr("r.length = s.length and r.rank between s.first and s.last")
    )
    return joined.select("r.*", F.expr("s.base + r.rank - s.first").alias("sequence_id"), F.col("s.offset").alias("offset")).drop("rank")


def pack(docs: DataFrame, *, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    cut = materialise(pieces(docs, size=size, id_col=id_col, text_col=text_col), "pieces")
    return place(cut, size=size).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
