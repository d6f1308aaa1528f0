"""Incremental landing, latest-wins, windowed counts, online flags and run monitoring.

Every query runs from a file source with an explicit schema and a checkpoint in the shared folder;
``available_now=True`` processes what is there and stops.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from geopulse.config import DEFAULTS, FIRE_LADDER, Thresholds
from geopulse.functions import scoring
from geopulse.operators.dedup import latest_wins
from geopulse.operators.upsert import upsert
from geopulse.sources.versions import PeriodSink, VersionedSink
from geopulse.streaming.state import run_health, whole_stages


def read_files(
    spark: SparkSession, path: str, schema: StructType, *, pattern: str | None = None, max_files: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def _start(writer, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def land_stream(
    stream: DataFrame, path: str, checkpoint: str, time_col: str, *, available_now: bool = True
) -> StreamingQuery:
    """Append arriving rows under their observation day."""
    stamp = F.col(time_col)
    keyed = stream.withColumns(
        {"year": F.date_format(stamp, "yyyy"), "month": F.date_format(stamp, "MM"), "day": F.date_format(stamp, "dd")}
    )
    writer = keyed.writeStream.format("parquet").partitionBy("year", "month", "day").option("path", path)
    return _start(writer, checkpoint, available_now)


def first_wins(stream: DataFrame, keys: Sequence[str], time_col: str, delay: str) -> DataFrame:
    """Keep the first copy of each key seen within the watermark. For the newest copy use an upsert."""
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(list(keys))


Sink = VersionedSink | PeriodSink


def upsert_stream(
    stream: DataFrame, sink: Sink, checkpoint: str, keys: Sequence[str], newest_first: Sequence[Column] = (),
    *, output_mode: str = "append", available_now: bool = True,
) -> StreamingQuery:
    """Fold each micro-batch into a keyed table; with ``newest_first`` the newest copy of a key wins."""

    def merge(current: DataFrame | None, batch: DataFrame) -> DataFrame:
        if not newest_first:
            return batch if current is None else upsert(current, batch, keys, repeats=True)
        rows = batch if current is None else current.unionByName(batch, allowMissingColumns=True)
        return latest_wins(rows, keys, newest_first)

    def fold(batch: DataFrame, batch_id: int) -> None:
        sink.fold(batch, batch_id, merge)

    writer = stream.writeStream.outputMode(output_mode).foreachBatch(fold)
    return _start(writer, checkpoint, available_now)


def daily_counts(stream: DataFrame, time_col: str, keys: Sequence[str], value: str, delay: str = "2 days") -> DataFrame:
    """Tumbling day counts per key; late rows inside the watermark still land in their own day."""
    windowed = stream.withWatermark(time_col, delay).groupBy(F.window(time_col, "1 day"), *keys)
    return windowed.agg(F.count(F.lit(1)).alias("detection_count"), F.sum(value).alias("value_sum")).select(
        F.col("window.start").cast("date").alias("observation_date"), *keys, "detection_count", "value_sum"
    )


def sliding_stats(
    stream: DataFrame, time_col: str, keys: Sequence[str], value: str, days: int, delay: str = "2 days"
) -> DataFrame:
    """Statistics over windows of ``days``, one ending every day."""
    windowed = stream.withWatermark(time_col, delay).groupBy(F.window(time_col, f"{days} days", "1 day"), *keys)
    return windowed.agg(
        F.count(F.lit(1)).alias("events"), F.avg(value).alias("value_mean"), F.max(value).alias("value_max")
    ).select(F.col("window.end").cast("date").alias("window_end"), *keys, "events", "value_mean", "value_max")


def flag_online(counts: DataFrame, baseline: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Score arriving daily counts against a static seasonal baseline (regions x 366 rows)."""
    keyed = counts.withColumn("day_of_year", F.dayofyear("observation_date"))
    joined = keyed.join(baseline, ["region_id", "day_of_year"], "left")
    z = scoring.zscore(
        F.col("detection_count"), F.col("baseline_median"), F.col("baseline_scale"), limits.fire_floor,
        F.col("baseline_samples") >= limits.min_samples,
    )
    return joined.withColumn("zscore", z).select(
        "region_id", "observation_date", "detection_count", "zscore",
        scoring.is_anomaly(F.col("zscore"), limits.fire_z).alias("is_anomaly"),
        scoring.severity(F.col("zscore"), FIRE_LADDER, limits.fire_z).alias("severity"),
    )


def monitor_runs(
    stream: DataFrame, out: VersionedSink, checkpoint: str, stages: Sequence[tuple[str, str | None, int | None]],
    *, retention_hours: float = 24.0 * 30, shift_ms: int = 0, every: str = "10 seconds",
) -> StreamingQuery:
    """Keep the last statement of every stage in a table of as many rows as stages; :func:`state.stage_board` reads it.

    No history is read again: totals are keyed state, and a stage that gets no runs turns overdue by its timer. The last statements of the
    parts of the runs are a small table beside ``out``. The query goes on while time passes; :func:`until_idle` ends one over files that no longer grow.
    """
    parts = VersionedSink(out.spark, f"{out.root}-parts")

    def merge(current: DataFrame | None, batch: DataFrame) -> DataFrame:
        rows = batch if current is None else current.unionByName(batch)
        return latest_wins(rows, ["stage", "part"], [F.desc("stated_ms"), F.desc("runs")])

    def fold(batch: DataFrame, batch_id: int) -> None:
        # Passing time makes batches without rows; state is worked on once for both.
        batch.persist()
        if not batch.isEmpty():
            parts.fold(batch, batch_id, merge)
            out.fold(whole_stages(parts.latest(before=batch_id + 1)), batch_id, lambda _, stages: stages)
        batch.unpersist()

    stated = run_health(stream, stages, retention_hours=retention_hours, shift_ms=shift_ms)
    writer = stated.writeStream.outputMode("update").foreachBatch(fold).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every).start()


def until_idle(query: StreamingQuery, seconds: float = 120.0) -> list[dict]:
    """Stop a query once a batch found no new rows after some that did; the progress of the batches with rows.

    ``seconds`` bounds the wait for rows, not the work on them: a batch may take as long as its rows need.
    """
    waiting, fed = time.monotonic(), {}
    while query.isActive and time.monotonic() - waiting < seconds:
        status = query.status
        if status["isTriggerActive"] and status["isDataAvailable"]:
            waiting = time.monotonic()
        for p in query.recentProgress:
            if p["numInputRows"]:
                fed[p["batchId"]] = p
        last = query.lastProgress
        if fed and last is not None and not last["numInputRows"] and last["batchId"] > max(fed):
            query.stop()
            return list(fed.values())
        time.sleep(0.2)
    if query.exception() is not None:
        raise query.exception()
    query.stop()
    raise TimeoutError("the stream had no batch without rows in time")
