"""Conversation structure repair: cheapest edits to legal turns, by an auction over an integer-cost lattice.

A conversation's rows, in order of turn (nulls first; ties by role, text and its digest), are to read ``(s?(ua)+)?`` in
initials of role. A row is kept (0), given the role user or assistant (1) or deleted (2, the only choice for blank and
repeated rows); an empty row of either role may be inserted anywhere (5); a truncated row that stays costs 5 more.

The lattice has four nodes before each row: nothing said, system, user, assistant. Bertsekas' auction finds the shortest
path: the path grows along the arc that is cheapest by cost and price while that is tight, else the price of its last
node rises and the path shrinks. Once it meets the end, the prices are a dual solution: every cheapest edit script
consists of tight arcs only. They are traced in order of letter, through nodes from which tight arcs lead to the end,
so of equally cheap scripts the ASCII-least is taken. Long conversations are solved in segments from the last to the
first; a segment ends in the exact prices of the next one's four entry nodes, so work grows with the number of rows.

Nulls in role and text count as one space: such a row is blank or has no legal role. A null id names one conversation.
Texts are never gathered: scripts come from one number a row, and a second pass streams the sorted rows through their
script. A script is one value of its conversation and grows with it, a letter a row. Rows repeated in full are
duplicates of the first. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Rows of one auction.
SEGMENT = 64
SPACE = " \t\n\x0b\x0c\r"
_FAR = 1 << 40
# Nodes of a layer and where an emitted initial leads.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_OTHER, _S, _U, _A = range(4)
_TURN = {_START: (_U, _USER), _SYSTEM: (_U, _USER), _USER: (_A, _ASSISTANT), _ASSISTANT: (_U, _USER)}
_NONE, _BLANK, _DUPLICATE, _TRUNCATED = range(4)
_LEGAL = {(_S, _U), (_U, _A), (_A, _U)}
COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


# -- the lattice of a segment --------------------------------------------------


def _arcs(facts: bytes, last: bool, ahead: tuple[int, ...]) -> list[list[tuple[str, int, int]]]:
    """Per node its ``(letter, node, cost)`` in order of letter; the end is the node after all."""
    end, out = 4 * (len(facts) + 1), []
    for i, fact in enumerate(facts):
        initial, fault = divmod(fact, 4)
        stay = TRUNCATED if fault == _TRUNCATED else 0
        for state in range(4):
            emitted, then = _TURN[state]
            arcs = [("D", 4 * (i + 1) + state, DELETE), ("I", 4 * i + then, INSERT)]
            if fault not in (_BLANK, _DUPLICATE):
                if initial == emitted:
                    arcs.append(("K", 4 * (i + 1) + then, KEEP + stay))
                elif initial == _S and state == _START:
                    arcs.append(("K", 4 * (i + 1) + _SYSTEM, KEEP + stay))
                arcs.append(("R", 4 * (i + 1) + then, REROLE + stay))
            out.append(arcs)
    at = 4 * len(facts)
    for state in range(4):
        # What is inserted at the border belongs to the next segment.
        arcs = [("", end, ahead[state])] if ahead[state] < _FAR else []
        out.append(arcs + ([("I", at + _TURN[state][1], INSERT)] if last else []))
    return out


def _floor(facts: bytes) -> list[int]:
    """Prices to start with: what the rows from here on cost at least."""
    prices, rest = [0], 0
    prices += [0] * 4
    for fact in reversed(facts):
        rest += DELETE if fact % 4 else KEEP
        prices += [rest] * 4
    return prices[::-1]


def auction(arcs: list[list[tuple[str, int, int]]], price: list[int], origin: int, end: int) -> None:
    """Raise ``price``, which no arc may violate, until tight arcs join ``origin`` to ``end``."""
    path = [origin]
    while path[-1] != end:
        node = path[-1]
        best, to = _FAR, -1
        for _, other, cost in arcs[node]:
            if cost + price[other] < best:
                best, to = cost + price[other], other
        if price[node] < best:
            price[node] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(to)


@functools.lru_cache(maxsize=1 << 15)
def _segment(facts: bytes, last: bool, ahead: tuple[int, ...], entries: tuple[int, ...]) -> dict[int, tuple[int, str, int]]:
    """For each entry node the cost to the end, the letters of the least cheapest script and the node it leaves by."""
    end = 4 * (len(facts) + 1)
    arcs, price = _arcs(facts, last, ahead), _floor(facts)
    for origin in entries:
        auction(arcs, price, origin, end)
    tight = [[a for a in own if price[i] == a[2] + price[a[1]]] for i, own in enumerate(arcs)]
    alive = [False] * end + [True]
    for layer in range(len(facts), -1, -1):
        # Insertions stay in the layer: two more rounds carry what they reach.
        for node in 3 * [*range(4 * layer, 4 * layer + 4)]:
            alive[node] = alive[node] or any(alive[other] for _, other, _ in tight[node])
    out = {}
    for origin in entries:
        node, letters, leave = origin, [], origin
        while node != end:
            letter, other, _ = next(a for a in tight[node] if alive[a[1]])
            letters.append(letter)
            node, leave = other, node
        out[origin] = price[origin], "".join(letters), leave % 4
    return out


def script(facts: bytes) -> tuple[int, str]:
    """Cost and letters of the ASCII-least cheapest script for rows given as ``4 * initial + fault``."""
    found, ahead, base = [], (0, _FAR, _FAR, 0), 0
    for at in range((max(len(facts), 1) - 1) // SEGMENT * SEGMENT, -1, -SEGMENT):
        own = _segment(facts[at : at + SEGMENT], not found, ahead, (_START, _SYSTEM, _USER, _ASSISTANT) if at else (_START,))
        found.append(own)
        if at:
            low = min(cost for cost, _, _ in own.values())
            ahead, base = tuple(own[s][0] - low for s in range(4)), base + low
    cost, parts, state = found[-1][_START][0] + base, [], _START
    for own in reversed(found):
        _, letters, state = own[state]
        parts.append(letters)
    return cost, "".join(parts)


# -- rows ----------------------------------------------------------------------


def ordered(rows: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text`` with nulls as one space, and the columns that settle equal turns."""
    said = F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(" "))
    out = rows.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), said.alias("text"))
    return _settle(out).withColumn("copy", F.lit(0))


def _settle(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"head": F.left("text", F.lit(64)), "digest": F.md5("text")})


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("head"), F.col("digest"), F.col("copy")]


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of :func:`ordered`, some of them spoilt by a hash of id and turn; what is dropped stays as ``dropped`` for its id's sake."""
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    out = rows.withColumn("code", F.crc32(name) % 20)
    out = out.withColumns({
        "text": F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
        "role": F.when(F.col("code") == 4, "user").otherwise(F.col("role")),
        "dropped": F.col("code") == 0,
        "copy": F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
    })
    return _settle(out.drop("code"))


def _facts(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, fact`` in order of each conversation; a dropped row has fact -1."""
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    initial = F.when(F.startswith("role", F.lit("s")), _S).when(F.startswith("role", F.lit("u")), _U).when(F.startswith("role", F.lit("a")), _A).otherwise(_OTHER)
    cut = ~F.right(bare, F.lit(1)).isin(".", "!", "?")
    dropped = F.col("dropped") if "dropped" in rows.columns else F.lit(False)
    lean = rows.select("conv_id", "turn", "role", "head", "digest", "copy", dropped.alias("dropped"), (bare == "").alias("blank"), cut.alias("cut"), initial.alias("initial"))
    seen = Window.partitionBy("conv_id", "dropped", "role", "digest").orderBy(*_order())
    lean = lean.repartition("conv_id").withColumn("again", F.row_number().over(seen) > 1)
    fault = F.when(F.col("blank"), _BLANK).when(F.col("again"), _DUPLICATE).when(F.col("cut"), _TRUNCATED).otherwise(_NONE)
    fact = F.when(F.col("dropped"), -1).otherwise(4 * F.col("initial") + fault).cast("int")
    return lean.sortWithinPartitions("conv_id", *_order()).select("conv_id", "turn", fact.alias("fact"))


class _Tally:
    """What is known of a conversation while its rows stream by."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.facts = conv_id, bytearray()
        self.low: int | None = None
        self.high, self.turns, self.illegal = 0, 0, 0
        self.faults = [0, 0, 0, 0]

    def add(self, turn: int | None, fact: int) -> None:
        if fact < 0:
            return
        if turn is not None:
            if self.low is None:
                self.low, self.turns = turn, 1
            elif turn != self.high:
                self.turns += 1
            self.high = turn
        if self.facts and (self.facts[-1] // 4, fact // 4) not in _LEGAL:
            self.illegal += 1
        self.faults[fact % 4] += 1
        self.facts.append(fact)

    def row(self) -> tuple:
        cost, audit = script(bytes(self.facts))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, *self.faults[1:], self.illegal, cost, audit)


def scripts(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` of every conversation in rows of :func:`ordered` or :func:`damaged`.

    ``audit`` has a letter for every kept, reroled, deleted and inserted row, in order.
    """
    schema = pa.schema([("conv_id", pa.int64()), *((x, pa.int64()) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string())])

    def run(batches):
        now: _Tally | None = None
        for batch in batches:
            done = []
            for conv, turn, fact in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now.conv_id != conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Tally(conv)
                now.add(turn, fact)
            yield _batch(done, schema)
        if now is not None:
            yield _batch([now.row()], schema)

    return _facts(rows).mapInArrow(run, f"conv_id long, {COUNTS}")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def repaired(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """``conv_id, place, edit, role, text``: the rows that :func:`scripts` leaves or inserts, streamed in order of conversation and place."""
    if "dropped" in rows.columns:
        rows = rows.where("not dropped")
    nothing = {c: F.lit(None).cast(t) for c, t in (("turn", "long"), ("role", "string"), ("text", "string"), ("head", "string"), ("digest", "string"), ("copy", "int"))}
    heads = plans.select("conv_id", F.lit(0).alias("kind"), "audit", *(v.alias(c) for c, v in nothing.items()))
    said = rows.select("conv_id", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("audit"), *nothing)
    both = heads.unionByName(said).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *_order())
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def run(batches):
        conv, audit, at, place, last = None, "", 0, 0, ""

        def inserted() -> Iterator[tuple]:
            nonlocal at, place, last
            while at < len(audit) and audit[at] == "I":
                last = "a" if last == "u" else "u"
                yield conv, place, "I", "assistant" if last == "a" else "user", ""
                at, place = at + 1, place + 1

        for batch in batches:
            out: list[tuple] = []
            for own, kind, plan, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "kind", "audit", "role", "text")), strict=True):
                out += inserted()
                if kind == 0:
                    conv, audit, at, place, last = own, plan, 0, 0, ""
                    continue
                letter = audit[at]
                at += 1
                if letter == "D":
                    continue
                if letter == "R":
                    role = "assistant" if last == "u" else "user"
                last = role[:1]
                out.append((conv, place, letter, role, text))
                place += 1
            yield _batch(out, schema)
        yield _batch(list(inserted()), schema)

    return both.select("conv_id", "kind", "audit", "role", "text").mapInArrow(run, "conv_id long, place long, edit string, role string, text string")
