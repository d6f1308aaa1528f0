"""Steps whose cost must not grow faster than their input."""

import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Row

import __spark_entry__ as entry
from checks import streams
from checks.base import Tables
from geopulse.operators import series
from geopulse.plans import marts, serving, staging
from geopulse.session import SPLIT_BYTES
from geopulse.sources import markets
from geopulse.sources.versions import VersionedSink
from geopulse.streaming import pipelines


@pytest.mark.parametrize("ascending", [True, False])
def test_key_at_finds_the_row_of_every_place(spark, ascending):
    """The key of a place comes from ranges of keys: no ordered limit brings the rows before it to the driver."""
    draw = random.Random(7)
    rows = [(draw.choice([None, 1.5, 2.5, 4.0]), i) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b int").repartition(5)
    sign = 1 if ascending else -1
    want = sorted(rows, key=lambda r: (r[0] is None, sign * (r[0] or 0.0), r[1]))
    keys = [("a", ascending), ("b", True)]
    for place in (1, 17, 41, 60):
        assert serving.key_at(df, keys, place) == dict(zip(("a", "b"), want[place - 1], strict=True))
    assert serving.key_at(df, keys, 0) is None and serving.key_at(df, keys, 61) is None
    behind = serving.page_after(df, keys, serving.key_at(df, keys, 40), limit=5).collect()
    assert [(r["a"], r["b"]) for r in behind] == want[40:45] and behind[0]["left"] == 20


class _Status:
    """A query whose only batch works longer than the wait for rows."""

    isActive = True

    def __init__(self, busy: float):
        self.done = time.monotonic() + busy
        self.stopped = False

    @property
    def status(self):
        busy = time.monotonic() < self.done
        return {"isTriggerActive": busy, "isDataAvailable": busy, "message": ""}

    @property
    def recentProgress(self):
        return [] if time.monotonic() < self.done else [{"batchId": 0, "numInputRows": 3}, {"batchId": 1, "numInputRows": 0}]

    @property
    def lastProgress(self):
        return self.recentProgress[-1] if self.recentProgress else None

    def exception(self):
        return None

    def stop(self):
        self.stopped = True


def test_a_long_batch_is_not_taken_for_an_idle_stream():
    query = _Status(2.5)
    assert [p["batchId"] for p in pipelines.until_idle(query, seconds=1.0)] == [0] and query.stopped


def test_runs_of_one_workflow_are_many_groups_and_add_up(spark, tmp_path):
    """Copies in the same and in later batches replace the former ones, whatever part they are in."""
    start = datetime(2024, 1, 1)
    run = lambda i, status, rows, minutes=1: Row(
        "w", f"r{i}", start + timedelta(hours=i), start + timedelta(hours=i, minutes=minutes), status, 60.0, rows, i % 3
    )
    first = [run(i, "failed" if i % 4 == 0 else "success", i) for i in range(60)] + [run(59, "failed", 5, 0)]
    second = [run(i, "success", i, 9) for i in range(0, 20)] + [run(30, "failed", 0, 0), run(70, "success", 70)]
    source, schema = tmp_path / "in", "workflow string, run_id string, started_at timestamp, finished_at timestamp, status string, duration_s double, rows_written long, failed_units long"
    for rows in (first, second):
        frame = spark.createDataFrame(rows, schema).coalesce(1)
        frame.write.mode("append").parquet(str(source))
        time.sleep(1.1)
    stages = [("a", "w", None), ("b", None, None)]
    out = VersionedSink(spark, str(tmp_path / "out"))
    stream = pipelines.read_files(spark, str(source), frame.schema, max_files=1)
    query = pipelines.monitor_runs(stream, out, str(tmp_path / "cp"), stages, every="1 second")
    assert len(pipelines.until_idle(query)) == 2
    row = out.latest().collect()
    assert len(row) == 1 and (row[0]["runs"], row[0]["rows"], row[0]["state"]) == (61, 70, "live")
    kept = {r[1]: r for r in first[:60]} | {r[1]: r for r in second if r[1] != "r30"}
    assert row[0]["ok"] == sum(r[4] == "success" for r in kept.values()) and row[0]["failed_units"] == sum(r[7] for r in kept.values())
    parts = VersionedSink(spark, f"{out.root}-parts").latest()
    assert parts.select("part").distinct().count() > 20


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_readers_of_composites_shuffle_only_what_they_read(spark):
    """A metric, a scope and the columns read reach below the exchange of latest-wins."""
    t = Tables.of(spark, "/root/testdata/sf0.001")
    text = _plan(marts.cell_change(t.composites))
    below = text[text.index("Exchange hashpartitioning"):]
    assert "= grid)" in below and "recent_mean" not in below and "product" not in below
    monthly = _plan(t.composites.where("metric_type = 'ndvi' and spatial_scope = 'region'").select("month_start", "value_mean"))
    below = monthly[monthly.index("Exchange hashpartitioning"):]
    assert "= ndvi)" in below and "= region)" in below and "observation_count" not in below


def test_latest_wins_shuffles_rows_in_the_order_of_their_keys(spark):
    """No hash travels with the rows, and neighbours share a time, which the shuffle's compression finds."""
    t = Tables.of(spark, "/root/testdata/sf0.001")
    for staged, stamp in ((staging.stg_composites(t.comp_raw), "window_end"), (staging.stg_detections(t.det_raw), "observed_at")):
        text = _plan(staged)
        below = text[text.index("Exchange hashpartitioning"):]
        assert below.startswith(f"Exchange hashpartitioning({stamp}#") and f"Sort [{stamp}#" in below and "xxhash64" not in text


def test_facts_and_daily_anomaly_shuffle_only_what_they_read(spark):
    """Neither writes a whole staged table first: unread columns and other metrics stay out of the exchange."""
    t = Tables(spark, "/root/testdata/sf0.001")
    assert t.facts.count() and t.sst_daily.count()
    assert "detections" not in vars(t) and "gridded" not in vars(t)
    text = _plan(series.detection_facts(staging.stg_detections(t.det_raw)))
    below = text[text.rindex("Exchange hashpartitioning"):]
    assert "frp" in below and "bright" not in below and "instrument" not in below
    assert "sea_ice_extent" not in _plan(series.daily_metric(staging.stg_gridded(t.grid_raw)))


def test_replayed_files_grow_with_their_rows(spark, monkeypatch):
    """A larger table is dealt to more files, still in two micro-batches, so that no task writes a fixed share of it."""
    t = Tables.of(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(streams, "FILE_ROWS", 50)
    df = spark.range(1000).repartition(3)
    path, schema, half = streams.files(t, df, "replay")
    written = spark.read.schema(schema).parquet(path)
    assert len(written.inputFiles()) == 20 and half == 10 and written.count() == 1000


def test_queries_read_in_splits_that_a_task_can_sort(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    entry.queries()["severity"](spark, "/root/testdata/sf0.001")
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == SPLIT_BYTES
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_period_is_read_once_and_not_once_a_point(spark):
    """Start and resolution are read below the unfolding of a period's points; a period without values still complains of nothing."""
    t = Tables.of(spark, "/root/testdata/sf0.001")
    text = _plan(entry.queries()["parse_market_documents"](spark, t.sf_dir))
    points = text.split("Generate explode(")[0]
    assert "gettimestamp" in text and "gettimestamp" not in points and "RLIKE" not in points

    def parse(start, resolution, value):
        period = f"<Period><timeInterval><start>{start}</start></timeInterval><resolution>{resolution}</resolution><Point><position>1</position>{value}</Point></Period>"
        whole = "<Period><timeInterval><start>2024-01-01T00:00Z</start></timeInterval><resolution>P1DT15M</resolution><Point><position>2</position><price.amount>3</price.amount></Point></Period>"
        xml = f"<Publication_MarketDocument><TimeSeries>{whole}{period}</TimeSeries></Publication_MarketDocument>"
        return markets.parse_market_documents(spark.createDataFrame([(xml,)], "xml string"), "day_ahead_price")

    price = "<price.amount>5</price.amount>"
    assert {(r.timestamp, r.value) for r in parse("noon", "P1Y", "").collect()} == {(datetime(2024, 1, 2, 0, 15), 3.0)}
    for start, resolution, complaint in (("noon", "PT60M", "period without a usable start: noon"), ("2024-01-01T00:00Z", "P1Y", "unsupported resolution: P1Y")):
        with pytest.raises(Exception, match=complaint):
            parse(start, resolution, price).collect()
