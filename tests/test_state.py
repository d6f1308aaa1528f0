"""Streams with state of their own: windows from a ring, run health with timers."""

import time
from datetime import UTC, date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from geopulse.sources.versions import VersionedSink
from geopulse.streaming import pipelines, state

RUNS = "workflow string, run_id string, started_at timestamp, finished_at timestamp, status string, duration_s double, rows_written long, failed_units long"


@pytest.fixture
def narrow(spark):
    """Few state partitions."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_window_figures_beside_plain():
    draw = np.random.default_rng(4)
    values = np.where(draw.random(80) < 0.4, np.nan, draw.integers(0, 4, 80).astype(float))
    got = state.window_figures(values, (1, 7, 30))
    for end in range(29, 80):
        for n in (1, 7, 30):
            own = values[end + 1 - n : end + 1]
            there = own[~np.isnan(own)]
            zeros = np.append(there, np.zeros(n - len(there)))
            row = {k: got[f"{k}_{n}"][end - 29] for k in ("mean", "max", "stddev", "zero_days")}
            if not len(there):
                assert np.isnan(row["mean"]) and np.isnan(row["max"]) and row["zero_days"] == -1
                continue
            assert row["mean"] == pytest.approx(zeros.mean()) and row["max"] == there.max() and row["zero_days"] == n - np.count_nonzero(there)
            if n > 1:
                assert row["stddev"] == pytest.approx(zeros.std(ddof=1), abs=1e-9)


def _stream(spark, folder, schema):
    return pipelines.read_files(spark, str(folder), schema, max_files=1)


def test_trailing_stream_takes_late_rows_and_leaves_out_older_ones(narrow, tmp_path):
    """Two days late counts, five days late with a delay of three does not; the newest statement of a window holds."""
    first = date(2024, 1, 1)
    batches = [[0, 0, 1, 4], [2, 9, 9], [7, 4, 3], [12]]
    source = tmp_path / "in"
    for batch in batches:
        rows = [Row(k="a", d=first + timedelta(days=n)) for n in batch]
        narrow.createDataFrame(rows, "k string, d date").coalesce(1).write.mode("append").parquet(str(source))
        time.sleep(1.1)  # files are read in the order of their times
    out = VersionedSink(narrow, str(tmp_path / "out"))
    figures = state.trailing_stream(_stream(narrow, source, narrow.read.parquet(str(source)).schema), "d", ["k"], (3,), delay_days=3)
    query = pipelines.upsert_stream(figures, out, str(tmp_path / "cp"), ["k", "window_end"], output_mode="update")
    query.awaitTermination()
    kept = [0, 0, 1, 4, 2, 9, 9, 7, 12]  # 4 and 3 come when day 9 is known
    want = {}
    for end in range(15):
        own = [kept.count(d) for d in range(end - 2, end + 1)]
        if any(own):
            want[first + timedelta(days=end)] = (pytest.approx(sum(own) / 3), max(own), own.count(0))
    got = {r["window_end"]: (r["mean_3"], r["max_3"], r["zero_days_3"]) for r in out.latest().collect()}
    assert got == want


def _run(workflow, run_id, started, status="success", finished=None, rows=1):
    return Row(workflow, run_id, started, finished or started + timedelta(minutes=1), status, 60.0, rows, 0)


def test_a_stage_turns_overdue_by_time_alone(narrow, tmp_path):
    """No run arrives after the first files, a copy of a run replaces the former, and a timer states the stage anew."""
    now = datetime.now(UTC).replace(tzinfo=None)
    stages = [("fast", "w", 1), ("slow", "w", 50), ("other", "v", None), ("never", "x", 3), ("outside", None, None)]
    source, schema = tmp_path / "in", None
    spent = timedelta(hours=1) - timedelta(seconds=45)
    files = [
        [_run("w", "r1", now - timedelta(hours=9)), _run("v", "q1", now - timedelta(hours=1), status="failure")],
        [_run("w", "r2", now - spent, status="failure", rows=5), _run("w", "r2", now - spent, finished=now - spent + timedelta(minutes=5), rows=7)],
    ]
    for rows in files:
        frame = narrow.createDataFrame(rows, RUNS).coalesce(1)
        frame.write.mode("append").parquet(str(source))
        schema = frame.schema
        time.sleep(1.1)
    out = VersionedSink(narrow, str(tmp_path / "out"))
    query = pipelines.monitor_runs(_stream(narrow, source, schema), out, str(tmp_path / "cp"), stages, every="1 second")
    seen, deadline = set(), time.monotonic() + 120
    try:
        while time.monotonic() < deadline and ("fast", "overdue", 2) not in seen:
            table = out.latest()
            if table is not None:
                seen |= {(r["stage"], r["state"], r["runs"]) for r in table.collect()}
            time.sleep(0.5)
    finally:
        query.stop()
    assert {("fast", "live", 2), ("fast", "overdue", 2), ("slow", "live", 2), ("other", "failed", 1)} <= seen
    board = state.stage_board(out.latest(), narrow.createDataFrame(stages, "stage string, workflow string, budget_hours int"), F.current_timestamp())
    rows = {r["stage"]: r for r in board.collect()}
    assert (rows["fast"]["runs"], rows["fast"]["rows"], rows["fast"]["success_rate"]) == (2, 7, 1.0)
    assert rows["slow"]["state"] == "live" and rows["never"]["state"] == "unrecorded" and rows["outside"]["state"] == "external"
