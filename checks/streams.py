"""Streaming forms, run to completion over the given tables and compared with the batch result."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import functions as F

from checks.base import check
from geopulse.config import STAGES
from geopulse.plans import ops
from geopulse.streaming import pipelines, state
from geopulse.workspace import scratch


FILE_ROWS = 500_000


def files(t, df, name: str, parts: int = 4):
    """A folder of files for a file source to replay, its schema and half the number of files, for two micro-batches.

    At least ``parts`` files, and more as the rows grow: a task writes one of them, or a few, whatever the size of the table.
    """
    path = scratch(t.spark, name)
    parts = max(parts, -(-df.count() // FILE_ROWS))
    df.repartition(parts).write.parquet(path)
    return path, df.schema, -(-parts // 2)


def events(t):
    """The events in four micro-batches by time of arrival; every ninth event arrives two days late."""
    rows = t.read("events").withColumn("ts", F.col("ts").cast("timestamp"))
    late = F.when(F.col("event_id") % 9 == 0, 2).otherwise(0)
    rows = rows.withColumn("_at", F.unix_seconds("ts") + late * F.lit(86_400))
    low, high = rows.agg(F.min("_at"), F.max("_at")).first()
    path = scratch(t.spark, "arrivals")
    for part in range(4):  # a file source replays files in the order they were written
        batch = rows.where(F.least(F.floor((F.col("_at") - low) * 4 / max(high - low, 1)), F.lit(3)) == part)
        batch.drop("_at").coalesce(1).write.mode("append").parquet(path)
    return pipelines.read_files(t.spark, path, rows.drop("_at").schema, max_files=1)


def drain(query) -> None:
    query.awaitTermination()
    batches = [p for p in query.recentProgress if p["numInputRows"]]
    if len(batches) < 2:
        raise AssertionError("the stream ran in one micro-batch")


@check("land_stream", "event_type day:d rows:i total:f",
       "select event_type, cast(ts as date) as day, count(*) as rows, sum(value) as total from events group by 1, 2")
def _(t):
    out = scratch(t.spark, "landed")
    drain(pipelines.land_stream(events(t), out, scratch(t.spark, "cp"), "ts"))
    day = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))
    return t.spark.read.parquet(out).groupBy("event_type", day.alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("value").alias("total")
    )


@check("stream_latest_wins", "product region_id observation_date:d rows:i frp:f",
       "select product, region_id, observation_date, count(*) as rows, sum(frp) as frp from detections group by 1, 2, 3")
def _(t):
    path, schema, half = files(t, t.det_raw, "refetched")
    sink = pipelines.PeriodSink(t.spark, scratch(t.spark, "latest"), F.date_format("acq_datetime", "yyyyMM"))
    newest = [F.desc_nulls_last("ingested_at"), F.desc_nulls_last("run_id")]
    stream = pipelines.read_files(t.spark, path, schema, max_files=half)
    keys = ["product", "acq_datetime", "latitude", "longitude"]
    drain(pipelines.upsert_stream(stream, sink, scratch(t.spark, "cp"), keys, newest))
    return sink.latest().groupBy("product", "region_id", F.to_date("acq_datetime").alias("observation_date")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("frp").alias("frp")
    )


@check("stream_first_wins", "event_type users:i", "select event_type, count(distinct user_id) as users from events group by 1")
def _(t):
    sink = pipelines.PeriodSink(t.spark, scratch(t.spark, "first"), F.pmod("user_id", F.lit(16)))
    firsts = pipelines.first_wins(events(t), ["event_type", "user_id"], "ts", "60 days")
    drain(pipelines.upsert_stream(firsts, sink, scratch(t.spark, "cp"), ["event_type", "user_id"]))
    return sink.latest().groupBy("event_type").agg(F.count(F.lit(1)).alias("users"))


@check("stream_daily_counts", "observation_date:d event_type detection_count:i value_sum:f",
       "select cast(ts as date) as observation_date, event_type, count(*) as detection_count, sum(value) as value_sum from events group by 1, 2")
def _(t):
    sink = pipelines.PeriodSink(t.spark, scratch(t.spark, "counts"), F.date_format("observation_date", "yyyyMM"))
    counts = pipelines.daily_counts(events(t), "ts", ["event_type"], "value", delay="3 days")
    keys = ["observation_date", "event_type"]
    drain(pipelines.upsert_stream(counts, sink, scratch(t.spark, "cp"), keys, output_mode="update"))
    return sink.latest()


@check("stream_sliding_stats", "window_end:d event_type events:i value_mean:f value_max:f",
       """select cast(d as date) + cast(o as int) as window_end, event_type, count(*) as events, avg(value) as value_mean, max(value) as value_max
          from (select cast(ts as date) as d, event_type, value, unnest(range(1, 8)) as o from events) group by 1, 2""")
def _(t):
    sink = pipelines.PeriodSink(t.spark, scratch(t.spark, "sliding"), F.date_format("window_end", "yyyyMM"))
    stats = pipelines.sliding_stats(events(t), "ts", ["event_type"], "value", 7, delay="3 days")
    keys = ["window_end", "event_type"]
    drain(pipelines.upsert_stream(stats, sink, scratch(t.spark, "cp"), keys, output_mode="update"))
    return sink.latest()


LENGTHS = (7, 14, 30)
TRAILING = ", ".join(
    f"""case when count(*) filter (o < {n}) > 0 then sum(c) filter (o < {n}) / {n}e0 end as mean_{n}, max(c) filter (o < {n}) as max_{n},
        case when count(*) filter (o < {n}) > 0 then sqrt(greatest(sum(c * c) filter (o < {n}) - (sum(c) filter (o < {n})) * (sum(c) filter (o < {n})) / {n}e0, 0) / ({n} - 1)) end as stddev_{n},
        case when count(*) filter (o < {n}) > 0 then {n} - count(*) filter (o < {n} and c <> 0) end as zero_days_{n}"""
    for n in LENGTHS
)


@check("stream_trailing_stats", "event_type window_end:d " + " ".join(f"mean_{n}:f max_{n}:f stddev_{n}:f4 zero_days_{n}:i" for n in LENGTHS),
       f"""select event_type, d + cast(o as int) as window_end, {TRAILING} from (
          select event_type, cast(ts as date) as d, cast(count(*) as double) as c, unnest(range(0, 30)) as o from events group by 1, 2) group by 1, 2""")
def _(t):
    # fed by the events alone, late ones included; the newest statement of a window wins
    sink = pipelines.PeriodSink(t.spark, scratch(t.spark, "trailing"), F.date_format("window_end", "yyyyMM"))
    stats = state.trailing_stream(events(t), "ts", ["event_type"], LENGTHS, delay_days=3)
    keys = ["event_type", "window_end"]
    drain(pipelines.upsert_stream(stats, sink, scratch(t.spark, "cp"), keys, output_mode="update"))
    return sink.latest()


@check("stream_flag_online", "region_id observation_date:d detection_count:i zscore:f is_anomaly severity",
       "select * from fire where detection_count > 0")
def _(t):
    path, schema, half = files(t, t.detections, "staged")
    stream = pipelines.read_files(t.spark, path, schema, max_files=half)
    counts = pipelines.daily_counts(stream, "observed_at", ["region_id"], "frp", delay="20000 days")
    # the file order is not the order of time here, so nothing may be called late
    flagged = pipelines.flag_online(counts, t.baseline)
    sink = pipelines.PeriodSink(t.spark, scratch(t.spark, "online"), F.date_format("observation_date", "yyyyMM"))
    keys = ["region_id", "observation_date"]
    drain(pipelines.upsert_stream(flagged, sink, scratch(t.spark, "cp"), keys, output_mode="update"))
    return sink.latest()


@check("stream_monitor_runs", "stage workflow state last_run:t age_hours:f rows runs:i success_rate:f",
       """select stage, s.workflow, last_run, age_hours, last_rows as rows, coalesce(runs, 0) as runs, ok / runs as success_rate,
          case when s.workflow is null then 'external' when runs is null then 'unrecorded' when last_status <> 'success' then 'failed'
               when age_hours > budget then 'overdue' else 'live' end as state
          from (values ('collect', 'collect_data', 8), ('store', 'collect_data', null), ('transform', 'transform', 30),
                ('train', 'train_model', 216), ('score', 'train_model', 216), ('serve', null, null)) as s(stage, workflow, budget)
          left join (select workflow, count(*) as runs, count(*) filter (status = 'success') as ok, max(started_at) as last_run,
                     arg_max(status, (started_at, run_id)) as last_status, arg_max(rows_written, (started_at, run_id)) as last_rows,
                     greatest(epoch(timestamp '2024-01-31 12:00:00' - max(started_at)) / 3600e0, 0) as age_hours
                     from runs group by 1) t on t.workflow = s.workflow""")
def _(t):
    path, schema, half = files(t, t.runs, "runs")
    out = pipelines.VersionedSink(t.spark, scratch(t.spark, "stages"))
    stream = pipelines.read_files(t.spark, path, schema, max_files=half)
    asof = datetime(2024, 1, 31, 12, tzinfo=UTC)
    # a replay: the clock of the runs stands at the time asked for
    shift = int((datetime.now(UTC) - asof).total_seconds() * 1000)
    query = pipelines.monitor_runs(stream, out, scratch(t.spark, "cp"), STAGES, shift_ms=shift, retention_hours=1.0, every="1 second")
    if len(pipelines.until_idle(query)) < 2:
        raise AssertionError("the stream ran in one micro-batch")
    return state.stage_board(out.latest(), ops.stage_table(t.spark), F.lit("2024-01-31 12:00:00").cast("timestamp"))
