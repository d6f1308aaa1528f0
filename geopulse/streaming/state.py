"""Streams with keyed state of their own: trailing statistics from a ring of days, run health with timers.

State lives in RocksDB and stays small: a ring holds as many days as the longest window and the permitted delay, a workflow holds
its totals, and the copies of its runs for as long as a newer copy may come.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from geopulse.functions.timefns import hours_behind

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EPOCH = date(1970, 1, 1)
HOUR_MS = 3_600_000


def use_rocksdb(spark: SparkSession) -> None:
    """State of this kind needs the RocksDB store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


# -- trailing windows ----------------------------------------------------------


def window_figures(values: np.ndarray, lengths: Sequence[int]) -> dict[str, np.ndarray]:
    """Figures of the trailing windows that end at each place from ``max(lengths) - 1`` on; NaN is a day without a row."""
    longest = max(lengths)
    out: dict[str, np.ndarray] = {}
    for n in lengths:
        seen = np.lib.stride_tricks.sliding_window_view(values[longest - n :], n)
        there = ~np.isnan(seen)
        held, filled = there.any(axis=1), np.where(there, seen, 0.0)
        total = filled.sum(axis=1)
        most = np.where(there, seen, -np.inf).max(axis=1)
        out[f"mean_{n}"] = np.where(held, total / n, np.nan)
        out[f"max_{n}"] = np.where(held, most, np.nan)
        spread = np.sqrt(np.maximum((filled * filled).sum(axis=1) - total * total / n, 0.0) / (n - 1)) if n > 1 else np.nan
        out[f"stddev_{n}"] = np.where(held, spread, np.nan)
        out[f"zero_days_{n}"] = np.where(held, n - (filled != 0).sum(axis=1), -1)
    return out


class TrailingRing(StatefulProcessor):
    """Daily values of a key in a ring; an arriving day re-states every window that holds it.

    A row more than ``delay`` days behind the newest day of the batches before is late and left out, as behind a watermark.
    """

    def __init__(self, keys: Sequence[str], lengths: Sequence[int], delay: int):
        self.keys, self.lengths, self.delay = list(keys), list(lengths), delay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getValueState("ring", "first int, counts array<double>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        longest, known, newest = max(self.lengths), {}, None
        if self.ring.exists():
            first, counts = self.ring.get()
            known = {first + i: v for i, v in enumerate(counts) if not np.isnan(v)}
            newest = first + len(counts) - 1
        touched: set[int] = set()
        for pdf in rows:
            for day, n in zip(pdf["ring_day"].tolist(), pdf["ring_value"].tolist()):
                if newest is None or day >= newest - self.delay:
                    known[day] = known.get(day, 0.0) + n
                    touched.add(day)
        if not touched:
            return
        newest = max(known) if newest is None else max(newest, max(touched))
        low, high = min(touched), max(touched) + longest - 1
        values = np.full(high - low + longest, np.nan)
        for day, n in known.items():
            if low - longest < day <= high:
                values[day - low + longest - 1] = n
        ends = np.arange(low, high + 1)
        stated = np.zeros(len(ends), bool)
        for day in touched:
            stated[day - low : day - low + longest] = True
        figures = window_figures(values, self.lengths)
        out = pd.DataFrame({"window_end": [_EPOCH + timedelta(days=int(d)) for d in ends[stated]], **{k: v[stated] for k, v in figures.items()}})
        for n in self.lengths:
            gone = out[f"zero_days_{n}"] < 0
            out[f"zero_days_{n}"] = out[f"zero_days_{n}"].astype("Int64").mask(gone)
        for name, value in reversed(list(zip(self.keys, key))):
            out.insert(0, name, value)
        first = newest - self.delay - longest + 1
        self.ring.update((first, [known.get(day, float("nan")) for day in range(first, newest + 1)]))
        yield out

    def close(self) -> None:
        pass


def _combined(keys: Sequence[str]):
    """Adds up the rows of a key and day within a batch before they are shuffled."""

    def run(batches):
        for batch in batches:
            found = pa.Table.from_batches([batch]).group_by([*keys, "ring_day"]).aggregate([("ring_value", "sum")])
            yield from found.select([*keys, "ring_day", "ring_value_sum"]).rename_columns([*keys, "ring_day", "ring_value"]).combine_chunks().to_batches()

    return run


def trailing_stream(
    stream: DataFrame, time_col: str, keys: Sequence[str], lengths: Sequence[int] = (7, 14, 30), *, value: Column | None = None, delay_days: int = 3
) -> DataFrame:
    """Trailing figures of daily sums (row counts without ``value``), kept by the stream alone.

    For every window that an arriving row falls into: ``window_end`` and mean, maximum, deviation and zero days of each length;
    days without rows count as zero. Update mode: the newest row of a key and window holds.
    """
    use_rocksdb(stream.sparkSession)
    amount = F.lit(1.0) if value is None else value.cast("double")
    rows = stream.where(F.col(time_col).isNotNull()).select(
        *keys, F.unix_date(F.col(time_col).cast("date")).alias("ring_day"), F.coalesce(amount, F.lit(0.0)).alias("ring_value")
    )
    own = StructType([f for f in rows.schema if f.name in keys])
    schema = StructType([own[k] for k in keys]).add("window_end", "date")
    for n in lengths:
        schema = schema.add(f"mean_{n}", "double").add(f"max_{n}", "double").add(f"stddev_{n}", "double").add(f"zero_days_{n}", "long")
    combined = rows.mapInArrow(_combined(keys), rows.schema)
    return combined.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=TrailingRing(keys, lengths, delay_days), outputStructType=schema, outputMode="Update", timeMode="None"
    )


# -- run health ----------------------------------------------------------------

_RUN = pa.schema(
    [("run_id", pa.string()), ("started", pa.float64()), ("finished", pa.float64()), ("status", pa.string()), ("duration_s", pa.float64()),
     ("rows_written", pa.float64()), ("failed_units", pa.float64()), ("came", pa.float64())]
)
_TOTALS = "runs long, ok long, failed_units long, started long, run_id string, status string, duration_s double, rows_written long"
HEALTH = (
    "stage string, workflow string, part int, state string, runs long, ok long, failed_units long, last_run_us long, run_id string, duration_s double, "
    "rows long, stated_ms long"
)
PARTS = 128


def _pack(copies: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _RUN, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
        writer.write_table(pa.Table.from_pandas(copies[_RUN.names], _RUN, preserve_index=False))
    return sink.getvalue().to_pybytes()


def _unpack(packed: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(packed).read_all().to_pandas()


class RunHealth(StatefulProcessor):
    """Totals and the newest run of one part of a workflow's runs; each of its stages is stated when runs arrive and when its time budget runs out.

    Runs are dealt to parts by their id, so that a workflow of many runs is no single task; :func:`whole_stages` puts the parts together.
    A later copy of a run replaces the former as long as that is held, ``retention_ms`` after it came; the copies of a part are one packed
    value, read and written once a batch. ``shift_ms`` is how far the clock of the runs is behind that of the cluster: 0 live, more in a replay.
    """

    def __init__(self, stages: Sequence[tuple[str, str, int | None]], retention_ms: int, shift_ms: int = 0):
        self.stages, self.retention, self.shift = list(stages), retention_ms, shift_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", _TOTALS)
        self.copies = handle.getValueState("copies", "packed binary", self.retention)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        runs, ok, failed, newest = 0, 0, None, None
        if self.totals.exists():
            runs, ok, failed, *newest = self.totals.get()
        now = timerValues.getCurrentProcessingTimeInMs()
        arrived = pd.concat(list(rows), ignore_index=True).assign(came=float(now), fresh=True)[[*_RUN.names, "fresh"]]
        if arrived.empty:
            return
        held = _unpack(self.copies.get()[0]) if self.copies.exists() else None
        if held is not None:
            held = held[held["came"] > now - self.retention].assign(fresh=False)
        both = arrived if held is None or held.empty else pd.concat([held, arrived], ignore_index=True)
        # finished later, else started later; among equal copies the one that came last
        both = both.sort_values(["finished", "started"], na_position="first", kind="stable").drop_duplicates("run_id", keep="last")
        own = both[both["fresh"]]
        former = own[:0] if held is None else held[held["run_id"].isin(own["run_id"])]
        runs += len(own) - len(former)
        ok += int((own["status"] == "success").sum()) - int((former["status"] == "success").sum())
        if own["failed_units"].notna().any() or former["failed_units"].notna().any():
            failed = (failed or 0) + int(own["failed_units"].sum()) - int(former["failed_units"].sum())
        if len(own):
            renewed = newest is not None and newest[1] in set(former["run_id"])
            last = (both if renewed else own).sort_values(["started", "run_id"], na_position="first").iloc[-1]
            last = [_whole(last.started), last.run_id, last.status, _real(last.duration_s), _whole(last.rows_written)]
            if renewed or newest is None or _age(last) > _age(newest):
                newest = last
            self.copies.update((_pack(both),))
        self.totals.update((runs, ok, failed, *newest))
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        yield self._stated(key, now)
        due = [self._due(newest, budget) for _, workflow, budget in self.stages if workflow == key[0]]
        for at in {d for d in due if d is not None and d >= now}:
            self.handle.registerTimer(at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.totals.exists():
            yield self._stated(key, max(timerValues.getCurrentProcessingTimeInMs(), expiredTimerInfo.getExpiryTimeInMs()))

    def _due(self, newest: Sequence, budget: int | None) -> int | None:
        """The first millisecond past the budget, in the cluster's time."""
        return None if budget is None or newest[0] is None else newest[0] // 1000 + budget * HOUR_MS + 1 + self.shift

    def _stated(self, key: tuple, now: int) -> pd.DataFrame:
        workflow, part = key
        runs, ok, failed, *newest = self.totals.get()
        out = []
        for stage, own, budget in self.stages:
            if own == workflow:
                due = self._due(newest, budget)
                state = "failed" if newest[2] != "success" else "overdue" if due is not None and now >= due else "live"
                out.append((stage, workflow, part, state, runs, ok, failed, newest[0], newest[1], newest[3], newest[4], now))
        frame = pd.DataFrame(out, columns=[part.split()[0] for part in HEALTH.split(", ")])
        return frame.astype({c: "Int64" for c in ("failed_units", "last_run_us", "rows")})

    def close(self) -> None:
        pass


def _whole(value) -> int | None:
    return None if pd.isna(value) else int(value)


def _real(value) -> float | None:
    return None if pd.isna(value) else float(value)


def _age(run: Sequence) -> tuple:
    return (run[0] is not None, run[0] or 0, run[1])


def run_health(stream: DataFrame, stages: Sequence[tuple[str, str | None, int | None]], *, retention_hours: float = 24.0 * 30, shift_ms: int = 0, parts: int = PARTS) -> DataFrame:
    """Stage states from arriving runs and passing time: a row for each stage and part whenever it is stated anew, the last one holds.

    Runs of workflows that no stage names state nothing and are left out.
    """
    use_rocksdb(stream.sparkSession)
    known = [s for s in stages if s[1] is not None]
    run_id = F.col("run_id").cast("string")
    rows = stream.where(F.col("workflow").isin(sorted({s[1] for s in known}))).select(
        "workflow", F.pmod(F.xxhash64(run_id), F.lit(parts)).cast("int").alias("part"), run_id.alias("run_id"), F.unix_micros(F.col("started_at").cast("timestamp")).alias("started"),
        F.unix_micros(F.col("finished_at").cast("timestamp")).alias("finished"), "status", F.col("duration_s").cast("double").alias("duration_s"),
        F.col("rows_written").cast("long").alias("rows_written"), F.col("failed_units").cast("long").alias("failed_units"),
    )
    return rows.groupBy("workflow", "part").transformWithStateInPandas(
        statefulProcessor=RunHealth(known, int(retention_hours * HOUR_MS), shift_ms), outputStructType=HEALTH, outputMode="Update", timeMode="ProcessingTime"
    )


def whole_stages(stated: DataFrame) -> DataFrame:
    """One row per stage from the last statements of its parts: counts add up, the part with the newest run tells the state."""
    newest = F.struct(F.col("last_run_us").isNotNull(), "last_run_us", "run_id")
    figures = F.max_by(F.struct("state", "last_run_us", "duration_s", "rows"), newest).alias("n")
    return stated.groupBy("stage", "workflow").agg(
        *[F.sum(name).alias(name) for name in ("runs", "ok", "failed_units")], figures, F.max("stated_ms").alias("stated_ms")
    ).select("stage", "workflow", "n.state", "runs", "ok", "failed_units", "n.last_run_us", "n.duration_s", "n.rows", "stated_ms")


def stage_board(stated: DataFrame, stages: DataFrame, asof: Column) -> DataFrame:
    """The columns of a flow report from the last statement of each stage; stages never stated are unrecorded or external."""
    own = stated.select("stage", "state", "runs", "ok", "failed_units", "duration_s", "rows", F.timestamp_micros("last_run_us").alias("last_run"))
    joined = stages.join(own, "stage", "left")
    age = F.when(F.col("last_run").isNotNull(), hours_behind(F.col("last_run"), asof))
    unseen = F.when(F.col("workflow").isNull(), "external").otherwise("unrecorded")
    return joined.select(
        "stage", "workflow", F.coalesce("state", unseen).alias("state"), "last_run", age.alias("age_hours"), "duration_s", "rows", "failed_units",
        F.coalesce("runs", F.lit(0)).alias("runs"), (F.col("ok") / F.col("runs")).alias("success_rate"),
    )
