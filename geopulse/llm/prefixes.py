"""Conversation prefix trie: every shared beginning of conversations as a node, with what its subtree holds.

A turn's id is the digest of its role and text; a conversation is the sequence of its ids, the words of each text beside them. Sequences
are range-partitioned by themselves and their id, so a shard holds neighbours and a beginning that very many share, or a
conversation copied very often, spreads over shards. In a shard the ids stand in padded matrices, ``WIDTH`` depths at a
time: ``numpy.lexsort`` orders the rows, the masks of changed columns are OR-accumulated along the depths, and where the
mask is set a node starts. ``reduceat`` over the starts aggregates every depth, the deepest first.

Only nodes on the path of a shard's first or last row can go on in another shard. They leave the shard as partial rows of
those two paths; totals, leaves and children are settled by node, subtree sums run up each path from the nodes it owns, and come together by node again.
The conversations that end in such a node leave as chunks of their ids in order, which stream through the digest.

Null roles and texts are empty, null turns come first, equal turns in order of role, text and digest; rows without a
conversation id take no part; repeated rows are turns like any other. No text is held, but the ids of one conversation
(16 bytes a turn) are one value. An empty table has no nodes, not even a root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geopulse.llm.common import joined_digest
from geopulse.workspace import materialise

#: Depths that stand in one padded matrix.
WIDTH = 16
#: Turns of a shard, and the least that are worth a shard of their own.
SHARD_TURNS, LEAST_TURNS = 2_000_000, 20_000
#: Conversation ids in one chunk.
CHUNK = 4096
WORD = r"[^\x20\x09-\x0D]+"
HEX = 32
EMPTY = hashlib.sha256(b"").hexdigest()
_INNER, _PATH, _ENDS = 0, 1, 2
_FIELDS = [
    ("kind", pa.int32()), ("node", pa.string()), ("parent", pa.string()), ("path", pa.int64()), ("depth", pa.int64()), ("conv_id", pa.int64()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()),
    ("words", pa.int64()), ("ends", pa.string()),
]
_SCHEMA = ", ".join(f"{name} {'int' if t == pa.int32() else 'string' if t == pa.string() else 'long'}" for name, t in _FIELDS)


# -- sequences -----------------------------------------------------------------


def turns(rows: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, pos, id, words``: the turns of every conversation, numbered from 1."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    out = rows.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    out = out.where("conv_id is not null").select(
        "conv_id", "turn", F.md5(F.concat_ws(":", F.char_length("role"), "role", "text")).alias("id"), "role", F.left("text", F.lit(64)).alias("head"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "head", "id")
    return out.withColumn("pos", F.row_number().over(order)).select("conv_id", "pos", "id", "words")


def shared_starts(spoken: DataFrame, *, group: int = 20, most: int = 4) -> DataFrame:
    """Conversations whose first turns are those of the first of their group, up to a hashed number below ``most``.

    Rows of a turn that gives way have a null ``id``, so that their conversation is known.
    """
    taken = lambda c: F.crc32(c.cast("string")) % most
    own = spoken.select("conv_id", "pos", F.when(F.col("pos") > taken(F.col("conv_id")), F.col("id")).alias("id"), "words", F.lit(True).alias("own"))
    lent = spoken.where((F.pmod("conv_id", F.lit(group)) == 0) & (F.col("pos") < most))
    lent = lent.withColumn("conv_id", F.explode(F.sequence(F.col("conv_id"), F.col("conv_id") + (group - 1))))
    lent = lent.where(F.col("pos") <= taken(F.col("conv_id"))).select("conv_id", "pos", "id", "words", F.lit(False).alias("own"))
    return own.unionByName(lent)


def sequences(spoken: DataFrame) -> DataFrame:
    """``conv_id, ids, words``: the turn ids of each conversation in order as one string, and the words of each turn.

    A row of no id counts only as a sign of its conversation; where there is a column ``own``, a conversation needs a row with it set.
    """
    if "own" not in spoken.columns:
        spoken = spoken.withColumn("own", F.lit(True))
    turn = F.when(F.col("id").isNotNull(), F.struct("pos", "id", "words"))
    found = spoken.groupBy("conv_id").agg(F.max("own").alias("own"), F.sort_array(F.collect_list(turn)).alias("turns")).where("own")
    return found.select("conv_id", F.array_join("turns.id", "").alias("ids"), F.col("turns.words").alias("words"))


# -- a shard -------------------------------------------------------------------


class _Shard:
    """Sequences of a range of the order: ids in two halves, flat; ``first`` and ``size`` say where each row's are."""

    def __init__(self, conv: np.ndarray, size: np.ndarray, ids: np.ndarray, words: np.ndarray):
        self.conv, self.size, self.ids, self.words = conv, size, ids, words
        self.first = np.cumsum(size) - size
        self._order()

    def _matrix(self, rows: np.ndarray, depth: int) -> np.ndarray:
        """``(rows, WIDTH, 2)`` ids from ``depth`` on; zero is no turn."""
        at = depth + np.arange(WIDTH)
        there = at[None, :] < self.size[rows][:, None]
        out = np.zeros((len(rows), WIDTH, 2), np.uint64)
        out[there] = self.ids[(self.first[rows][:, None] + at[None, :])[there]]
        return out

    def _order(self) -> None:
        """Order rows by ids, then conversation: only rows that are still level look at the next columns."""
        rank = np.zeros(len(self.conv), np.int64)
        level, depth = np.arange(len(rank)), 0
        while len(level):
            m = self._matrix(level, depth).reshape(len(level), 2 * WIDTH)
            order = np.lexsort((*(m[:, k] for k in range(2 * WIDTH - 1, -1, -1)), rank[level]))
            level, m = level[order], m[order]
            old = rank[level]
            head = np.concatenate(([True], old[1:] != old[:-1]))
            new = head | np.concatenate(([True], (m[1:] != m[:-1]).any(axis=1)))
            place = np.arange(len(level))
            start = place[head][np.cumsum(head) - 1]
            at = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            rank[level] = old + at[group] - start
            sizes, longest = np.diff(np.append(at, len(level))), np.maximum.reduceat(self.size[level], at)
            depth += WIDTH
            level = level[((sizes > 1) & (longest > depth))[group]]
        order = np.lexsort((self.conv, rank))
        self.conv, self.size, self.first = self.conv[order], self.size[order], self.first[order]

    def starts(self) -> tuple[np.ndarray, np.ndarray]:
        """Whether a node starts at each row and depth, flat in order of rows, and where a row's flags begin."""
        offset = np.cumsum(self.size) - self.size
        flags = np.zeros(int(self.size.sum()), bool)
        changed = np.zeros(len(self.size), bool)
        changed[0] = True
        before = np.concatenate(([0], self.size[:-1]))
        depth, rows = 0, np.flatnonzero(self.size > 0)
        while len(rows):
            m = self._matrix(rows, depth)
            differs = np.concatenate((np.ones((1, WIDTH), bool), (m[1:] != m[:-1]).any(axis=2)))
            # A row after a shorter one is not compared with it here, and starts all deeper nodes.
            carried = changed[rows] | (before[rows] <= depth)
            mask = np.logical_or.accumulate(np.concatenate((carried[:, None], differs), axis=1), axis=1)[:, 1:]
            at = depth + np.arange(WIDTH)
            there = at[None, :] < self.size[rows][:, None]
            flags[(offset[rows][:, None] + at[None, :])[there]] = mask[there]
            changed[rows] = mask[:, -1]
            depth += WIDTH
            rows = rows[self.size[rows] > depth]
        return flags, offset

    def paths(self) -> tuple[list[str], list[str]]:
        """Digests of every beginning of the first and of the last row, the empty one included."""
        out = []
        for row in (0, len(self.size) - 1):
            running, names = hashlib.md5(), []
            names.append(running.hexdigest())
            for part in self.ids[self.first[row] : self.first[row] + self.size[row]]:
                running.update(part.tobytes())
                names.append(running.hexdigest())
            out.append(names)
        return out[0], out[1]

    def nodes(self, shard: int) -> Iterator[pa.RecordBatch]:
        """The rows of every depth from the deepest up: whole nodes, partial ones of both paths, ends of the latter."""
        n = len(self.size)
        flags, offset = self.starts()
        names = self.paths()
        by_size = np.argsort(-self.size, kind="stable")
        lengths = self.size[by_size]
        leaves, saved = np.zeros(n, np.int64), np.zeros(n, np.int64)
        child, children = np.zeros(n, np.int64), np.zeros(0, np.int64)
        pending: dict | None = None
        for depth in range(int(self.size.max()), -1, -1):
            rows = np.sort(by_size[: np.searchsorted(-lengths, -depth, side="right")])
            starts = np.flatnonzero(flags[offset[rows] + depth - 1]) if depth else np.zeros(1, np.int64)
            top = rows[starts]
            counts = np.diff(np.append(starts, len(rows)))
            least = np.minimum.reduceat(self.conv[rows], starts)
            said = self.words[self.first[top] + depth - 1] if depth else np.zeros(1, np.int64)
            kids, below, kept = (np.add.reduceat(x[rows], starts) for x in (child, leaves, saved))
            open_ = np.zeros(len(top), bool)
            sides = [rows[0] == 0, rows[-1] == n - 1]
            open_[0] |= sides[0]
            open_[-1] |= sides[1]
            if pending is not None:
                yield self._whole(pending, depth, top, least, open_, names)
            own, leaf = (counts - 1) * said, (kids == 0).astype(np.int64)
            ends = self._ends(rows, starts, depth)
            shut = ~open_
            for at in sorted(set(([0] if sides[0] else []) + ([len(top) - 1] if sides[1] else []))):
                yield from self._partial(at, sides, len(top), depth, shard, names, least, counts, kids, below, kept, said, ends)
            pending = {
                "depth": depth, "top": top[shut], "conv_id": least[shut], "n_convs": counts[shut], "n_children": kids[shut],
                "n_leaves": (below + leaf)[shut], "saved": (kept + own)[shut], "words": said[shut],
                "ends": [_spelled(ends[i]) if i in ends else EMPTY for i in np.flatnonzero(shut).tolist()],
            }
            child[children] = 0
            children = top[shut]
            child[children] = 1
            leaves[children] += leaf[shut]
            saved[children] += own[shut]

    def _ends(self, rows: np.ndarray, starts: np.ndarray, depth: int) -> dict[int, np.ndarray]:
        """By node the conversations of just that depth; they come first in it."""
        at = np.flatnonzero(self.size[rows] == depth)
        if not len(at):
            return {}
        node = np.searchsorted(starts, at, side="right") - 1
        cuts = np.flatnonzero(np.diff(node)) + 1
        return {int(k[0]): self.conv[rows[i]] for k, i in zip(np.split(node, cuts), np.split(at, cuts), strict=True)}

    def _whole(self, own: dict, depth: int, top: np.ndarray, least: np.ndarray, open_: np.ndarray, names) -> pa.RecordBatch:
        """Nodes that no other shard has, with their parent of ``depth``: its conversation, or its name where that is open."""
        above = np.searchsorted(top, own["top"], side="right") - 1
        parent = [None] * len(above)
        for i in np.flatnonzero(open_[above]).tolist():
            parent[i] = names[0][depth] if above[i] == 0 and top[0] == 0 else names[1][depth]
        known = pa.array(least[above], pa.int64(), mask=open_[above])
        many = len(above)
        return _rows(many, kind=[_INNER] * many, parent=parent, depth=[own["depth"]] * many, parent_conv_id=known, **{
            x: own[x] for x in ("conv_id", "n_convs", "n_children", "n_leaves", "saved", "words", "ends")
        })

    def _partial(self, at, sides, many, depth, shard, names, least, counts, kids, below, kept, said, ends) -> Iterator[pa.RecordBatch]:
        """An open node on the path of the first row, of the last, or of both; then the last one's row holds no figures."""
        on = [side for side in (0, 1) if sides[side] and at == (0 if side == 0 else many - 1)]
        name, parent = names[on[0]][depth], names[on[0]][depth - 1] if depth else None
        for k, side in enumerate(on):
            figures = (least[at], counts[at], kids[at], below[at], kept[at]) if not k else (least[at], 0, 0, 0, 0)
            yield _rows(1, kind=[_PATH], node=[name], parent=[parent], path=[2 * shard + side], depth=[depth], words=[int(said[at])], **{
                c: [int(v)] for c, v in zip(("conv_id", "n_convs", "n_children", "n_leaves", "saved"), figures, strict=True)
            })
        ids = ends.get(at)
        for i in range(0, 0 if ids is None else len(ids), CHUNK):
            part = ids[i : i + CHUNK]
            yield _rows(1, kind=[_ENDS], node=[name], conv_id=[int(part[0])], ends=[",".join(map(str, part.tolist()))])


def _spelled(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


def _rows(many: int, **columns) -> pa.RecordBatch:
    given = [columns[name] if name in columns else pa.nulls(many, t) for name, t in _FIELDS]
    arrays = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, (_, t) in zip(given, _FIELDS, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in _FIELDS])


def _gathered(small: Iterator[pa.RecordBatch], rows: int = 8192) -> Iterator[pa.RecordBatch]:
    """Batches of some size out of many small ones."""
    held, size = [], 0
    for batch in small:
        held.append(batch)
        size += len(batch)
        if size >= rows or len(held) >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=rows)
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=rows)


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, size, ids, words = [], [], [], []
    for batch in batches:
        spelled = batch.column("ids").to_pylist()
        conv.append(batch.column("conv_id").to_numpy())
        size.append(np.fromiter((len(x) // HEX for x in spelled), np.int64, len(spelled)))
        ids.append(np.frombuffer(bytes.fromhex("".join(spelled)), ">u8").astype(np.uint64).reshape(-1, 2))
        words.append(batch.column("words").flatten().to_numpy(zero_copy_only=False))
    if sum(map(len, conv)):
        own = _Shard(*(np.concatenate(x) for x in (conv, size, ids, words)))
        yield from _gathered(own.nodes(TaskContext.get().partitionId()))


# -- the trie ------------------------------------------------------------------


def trie(found: DataFrame, *, shard_turns: int = SHARD_TURNS, least_turns: int = LEAST_TURNS) -> DataFrame:
    """Nodes of the sequences ``conv_id, ids, words``: every distinct beginning, from the empty one.

    ``conv_id`` (the smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.
    """
    spark = found.sparkSession
    found = materialise(found, "sequences")
    total = found.agg(F.sum(F.length("ids") / HEX + 1)).first()[0] or 0
    width = min(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / least_turns))
    shards = max(1, width, math.ceil(total / shard_turns))
    parts = materialise(found.repartitionByRange(shards, "ids", "conv_id").mapInArrow(_shard, _SCHEMA), "nodes")
    paths, inner = parts.where(F.col("kind") == _PATH), parts.where(F.col("kind") == _INNER)

    totals = paths.groupBy("node").agg(
        F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("inner"), F.max("words").alias("words"), F.min("path").alias("owner"),
    )
    shared = totals.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("shared")).where("node is not null")
    totals = totals.join(shared, "node", "left").withColumn("n_children", F.col("inner") + F.coalesce("shared", F.lit(0)))
    totals = materialise(totals, "totals")
    # A node's own figures go up the path that owns it; what else its subtree holds was added in its shards.
    owner = F.col("path") == F.col("owner")
    mine = totals.select("node", "owner", ((F.col("n_convs") - 1) * F.col("words")).alias("own"), (F.col("n_children") == 0).cast("long").alias("leaf"))
    along = paths.select("node", "path", "depth", "n_leaves", "saved").join(mine, "node")
    up = Window.partitionBy("path").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    along = along.select(
        "node", (F.col("n_leaves") + F.sum(F.when(owner, F.col("leaf")).otherwise(0)).over(up)).alias("n_leaves"),
        (F.col("saved") + F.sum(F.when(owner, F.col("own")).otherwise(0)).over(up)).alias("saved"),
    )
    sums = along.groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    chunks = parts.where(F.col("kind") == _ENDS).select("node", "conv_id", "ends").repartition("node").sortWithinPartitions("node", "conv_id")
    ended = joined_digest(chunks, "node", "ends", ",")
    above = totals.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    open_ = totals.join(sums, "node").join(ended, "node", "left").join(above, "parent", "left")
    open_ = open_.withColumn("ends", F.coalesce("digest", F.lit(EMPTY)))
    below = inner.where("parent is not null").drop("parent_conv_id").join(above, "parent")
    columns: list[Column] = [
        F.col("conv_id"), F.col("depth"), F.col("parent_conv_id"), F.col("n_convs"), F.col("n_children"), F.col("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"),
    ]
    return inner.where("parent is null").select(*columns).unionByName(below.select(*columns)).unionByName(open_.select(*columns))
