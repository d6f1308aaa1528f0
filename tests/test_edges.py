"""Edge cases on small literal frames, and brute-force comparisons."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from geopulse import contracts
from geopulse.config import KNOWN_EVENTS, REGION_COLUMNS, REGIONS
from geopulse.functions import detections as dx
from geopulse.functions import hexgrid, scoring, text, timefns
from geopulse.operators import dedup, evaluate, expect, features, forest, ranking, regions, series, upsert
from geopulse.plans import acceptance, marts, serving, training
from geopulse.sources import detections as source
from geopulse.sources import grids, lake, markets
from geopulse.sources import series as index_series
from geopulse.workspace import scratch


def fails(df, message):
    with pytest.raises(Exception, match=message):
        df.collect()


def one(df):
    return df.collect()[0]


# -- functions ------------------------------------------------------------------


def test_confidence_words_numbers_and_errors(spark):
    df = spark.createDataFrame([("l",), (" High ",), ("29.9",), ("80",), ("250",), ("-3",), ("nan",), (None,)], "c string")
    rows = df.select(dx.confidence_level(F.col("c")).alias("l"), dx.confidence_pct(F.col("c")).alias("p")).collect()
    assert [(r.l, r.p) for r in rows] == [
        ("low", 30.0), ("high", 90.0), ("low", 29.9), ("high", 80.0), ("high", 100.0), ("low", 0.0), (None, None), (None, None)
    ]
    fails(df.where("c = 'nan'").select(dx.strict_confidence_level(F.col("c"))), "unrecognised confidence")


def test_acquisition_time_pads_and_rejects(spark):
    df = spark.createDataFrame([("2024-05-01", "930"), ("2024-05-01", "5.0"), ("2024-05-01", "2460"), ("x", "0930")], "d string, c string")
    got = [r[0] for r in df.select(dx.acquisition_time(F.col("d"), F.col("c"))).collect()]
    assert got == [dt.datetime(2024, 5, 1, 9, 30), dt.datetime(2024, 5, 1, 0, 5), None, None]


def test_null_score_is_neither_anomaly_nor_normal(spark):
    df = spark.createDataFrame([(None,), (5.0,), (4.9,)], "z double")
    rows = df.select(scoring.is_anomaly(F.col("z"), 5.0).alias("a"), scoring.severity(F.col("z"), (("extreme", 12.0),), 5.0).alias("s")).collect()
    assert [(r.a, r.s) for r in rows] == [(None, "unknown"), (True, "moderate"), (False, "normal")]


def test_cf_axis_rejects_other_units(spark):
    df = spark.createDataFrame([(1.5, "days since 1800-01-01 00:00:00")], "v double, u string")
    assert one(df.select(timefns.decode_cf_time(F.col("v"), F.col("u"))))[0] == dt.datetime(1800, 1, 2, 12)
    fails(df.select(timefns.decode_cf_time(F.col("v"), F.lit("months since 1800-01-01"))), "unsupported time axis")


def test_longitude_window_wraps(spark):
    df = spark.createDataFrame([(-10.0, 3.5), (-180.0, 180.0), (10.0, 20.0)], "w double, e double")
    got = [[(p.lo, p.hi) for p in r[0]] for r in df.select(timefns.split_lon_window(F.col("w"), F.col("e"))).collect()]
    assert got == [[(350.0, 360.0), (0.0, 3.5)], [(0.0, 360.0)], [(10.0, 20.0)]]


def test_hexagons(spark):
    rng = random.Random(7)
    pts = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(2000)]
    df = spark.createDataFrame(pts, "lat double, lon double").withColumn("id", hexgrid.cell(F.col("lat"), F.col("lon"), 3))
    for r in df.withColumn("c", hexgrid.cell_center(F.col("id"))).collect():
        assert math.hypot(r.lat - r.c.lat, r.lon - r.c.lon) <= hexgrid.EDGE_DEGREES[3] + 1e-9
    back = df.withColumn("c", hexgrid.cell_center(F.col("id"))).withColumn("again", hexgrid.cell(F.col("c.lat"), F.col("c.lon"), 3))
    inside = back.where("c.lat between -90 and 90 and c.lon between -180 and 180")
    assert inside.where("id <> again").count() == 0
    ring = one(df.limit(1).select(hexgrid.k_ring(F.col("id"), 3).alias("k"), hexgrid.cell_boundary(F.col("id")).alias("b")))
    assert len(set(ring.k)) == 1 + 3 * 3 * 4 and ring.b[0] == ring.b[-1] and len(ring.b) == 7
    with pytest.raises(ValueError):
        hexgrid.k_ring(F.col("id"), -1)
    with pytest.raises(ValueError):
        hexgrid.cell(F.col("lat"), F.col("lon"), 16)


def test_oversized_bbox_is_refused(spark):
    box = spark.createDataFrame([("b", -10.0, 35.0, 3.0, 44.0)], "region_id string, west double, south double, east double, north double")
    assert regions.cells_for_bbox(box, 3).count() > 10
    fails(regions.cells_for_bbox(box, 7, max_cells=100), "too many cells")


def test_regions_smallest_wins(spark):
    dim = spark.createDataFrame(list(REGIONS), ", ".join(f"{c} {'string' if i < 3 else 'int' if i == 7 else 'double'}" for i, c in enumerate(REGION_COLUMNS)))
    rng = random.Random(3)
    pts = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(500)] + [(45.0, 10.0), (46.0, 22.0), (70.0, 20.0), (43.9, -10.0)]
    got = regions.assign_region(spark.createDataFrame(pts, "latitude double, longitude double"), dim).collect()

    def area(r):
        return abs((r[6] - r[4]) * 110.574 * (r[5] - r[3]) * 111.320 * math.cos(math.radians((r[4] + r[6]) / 2)))

    ordered = sorted(REGIONS, key=area)
    for r in got:
        expected = next((x[0] for x in ordered if x[3] <= r.longitude <= x[5] and x[4] <= r.latitude <= x[6]), None)
        assert r.region_id == expected
    assert len(got) == len(pts)


def test_redaction_shapes(spark):
    secret = "s3cr3t-value-1"
    df = spark.createDataFrame([(f"auth=abcd1234 {secret} bearer abcdefghijklmnop https://hooks.slack.com/services/T/B/x ok",)], "t string")
    got = one(df.select(text.redact(F.col("t"), [secret])))[0]
    assert secret not in got and "abcd1234" not in got and "abcdefghijklmnop" not in got and got.endswith(" ok")


# -- operators --------------------------------------------------------------------


def test_latest_wins_with_a_hot_key_and_null_keys(spark):
    hot = spark.range(20000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    rest = spark.createDataFrame([(None, 1), (None, 5), ("a", 2)], "k string, v bigint")
    got = dedup.latest_wins(hot.unionByName(rest), ["k"], [F.desc("v")])
    assert {(r.k, r.v) for r in got.collect()} == {("hot", 19999), (None, 5), ("a", 2)}


def test_ranks_against_numpy_with_a_hot_value(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(size=3000), np.full(1500, 0.25), -np.arange(10.0)])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
    got = one(ranking.linear_quantiles(df, "v", {"a": 0.0, "b": 0.333, "c": 0.975, "d": 1.0}))
    assert np.allclose([got.a, got.b, got.c, got.d], np.quantile(values, [0.0, 0.333, 0.975, 1.0]))
    near = one(ranking.nearest_rank_quantiles(df, "v", {"p": 0.75}))
    assert near.p == np.sort(values)[int(len(values) * 0.75)] and near.n == len(values)
    ranked = ranking.percentile_rank(df.where("v is not null and not isnan(v)"), "v").collect()
    ordered = np.sort(values)
    assert all(np.isclose(r.percentile, np.searchsorted(ordered, r.v, side="right") / len(values)) for r in ranked)
    new = spark.createDataFrame([(-100.0,), (0.25,), (100.0,)], "x double")
    foreign = {r.x: r.p for r in ranking.foreign_percentile_rank(df, "v", new, "x", "p").collect()}
    assert foreign[-100.0] == 1 / len(values) and foreign[100.0] == 1.0
    assert np.isclose(foreign[0.25], np.searchsorted(ordered, 0.25, side="right") / len(values))


def test_ring_crosses_new_year_and_leap_day(spark):
    days = [(dt.date(2023, 12, 31), 9), (dt.date(2024, 12, 31), 5), (dt.date(2024, 1, 1), 1)]
    df = spark.createDataFrame([("r", d, n) for d, n in days], "region_id string, observation_date date, detection_count bigint")
    base = {r.day_of_year: r for r in series.seasonal_baseline(df, halfwidth=1).collect()}
    assert base[366].baseline_samples == 3 and base[366].baseline_median == 5 and base[366].baseline_years == 2
    assert base[1].baseline_samples == 2 and base[2].baseline_samples == 1


def test_year_over_year_row_and_calendar(spark):
    months = [dt.date(2020 + i // 12, i % 12 + 1, 1) for i in range(26) if i != 3]
    df = spark.createDataFrame([("r", "ndvi", m, float(i)) for i, m in enumerate(months)], "region_id string, metric_type string, month_start date, value_mean double")
    by_row = {r.month_start: r.value_prior_year for r in series.year_over_year(df).collect()}
    exact = {r.month_start: r.value_prior_year for r in series.year_over_year(df, calendar=True).collect()}
    assert by_row[months[12]] == 0.0 and months[12] == dt.date(2021, 2, 1)
    assert exact[dt.date(2021, 1, 1)] == 0.0 and exact[dt.date(2021, 4, 1)] is None


def test_zero_days_exist_and_absent_source_drops_only_its_marts(spark):
    raw = spark.createDataFrame(
        [("a", dt.date(2024, 1, 1), "c", "S", 1.0, "high", 90.0, "N", 1.0, 2.0), ("a", dt.date(2024, 1, 4), "c", "S", None, "low", 10.0, "D", 1.0, 2.0)],
        "region_id string, observation_date date, h3_index string, satellite string, frp double, confidence string, confidence_pct double, daynight string, latitude double, longitude double",
    )
    dim = spark.createDataFrame([("a", "fire"), ("b", "fire"), ("c", "ice")], "region_id string, anomaly_type string")
    built = marts.build_marts(raw, None, None, dim)
    assert set(built) == {"fire_anomalies", "cell_fire"}
    rows = built["fire_anomalies"].collect()
    assert len(rows) == 8 and {r.region_id for r in rows} == {"a", "b"}
    quiet = [r for r in rows if r.region_id == "a" and r.observation_date == dt.date(2024, 1, 2)][0]
    assert quiet.detection_count == 0 and quiet.frp_sum is None and quiet.night_detection_share is None
    assert quiet.zscore is None and quiet.is_anomaly is None and quiet.severity == "unknown"


def test_upsert_is_idempotent_and_checks_keys(spark):
    target = spark.createDataFrame([("a", 1, 0.5)], "k string, v bigint, anomaly_score double")
    new = spark.createDataFrame([("a", 2, "x"), ("b", 3, "y")], "k string, v bigint, extra string")
    once = upsert.upsert(target, new, ["k"], ["anomaly_score"])
    twice = upsert.upsert(once, new, ["k"], ["anomaly_score"])
    want = {("a", 2, 0.5, "x"), ("b", 3, None, "y")}
    for df in (once, twice):
        assert {(r.k, r.v, r.anomaly_score, r.extra) for r in df.collect()} == want
    with pytest.raises(KeyError):
        upsert.upsert(target, new, ["nope"])
    assert upsert.key_covers(["a", "b"], ["a"]) and not upsert.key_covers(["a"], ["a", "b"])


def test_contract_lists_every_failure(spark):
    df = spark.createDataFrame([(95.0, 10.0, "x")], "latitude double, longitude double, product string")
    found = {(r["column"], r["check"]) for r in contracts.validate(df, contracts.DETECTIONS).collect()}
    assert ("latitude", "le(90)") in found and ("product", "min_length(3)") in found and ("acq_datetime", "required") in found
    with pytest.raises(ValueError, match="latitude"):
        contracts.require_valid(df, contracts.DETECTIONS)
    assert [f.name for f in contracts.DETECTIONS.fields] == contracts.conform(df, contracts.DETECTIONS).columns


def test_expectations_pass_on_clean_tables(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, s string")
    assert expect.unique(df, "s").count() == 0 and expect.accepted_values(df, "s", ["a"]).count() == 0
    assert expect.not_empty(df.where("false")).count() == 1
    assert expect.drift(df, df).count() == 0


def test_documented_events(spark):
    days = [("r", dt.date(2024, 1, d), n, p, f) for d, n, p, f in [(1, 100, 0.99, True), (2, 10, 0.95, False), (3, 1, 0.1, False)]]
    scored = spark.createDataFrame(days, "region_id string, observation_date date, detection_count bigint, anomaly_percentile double, is_anomaly boolean")
    d = lambda n: dt.date(2024, 1, n)
    events = spark.createDataFrame(
        [(1, "r", d(1), d(1), 100, True), (2, "r", d(2), d(2), 10, True), (3, "r", d(3), d(3), 1, True), (4, "r", d(3), d(3), 100, True),
         (5, "r", d(3), d(3), 1, False), (6, "r", d(1), d(3), 100, False), (7, "q", d(1), d(1), 1, True)],
        "event_id int, region_id string, start date, end date, recorded_peak int, expected boolean",
    )
    out = evaluate.check_events(scored, events)
    got = {r.event_id: (r.criterion, r.passed) for r in out.collect()}
    assert got == {1: ("flag", True), 2: ("rank", True), 3: ("missed", False), 4: ("data-changed", False), 5: ("clean", True), 6: ("flag", False), 7: ("no-data", False)}
    rate = one(evaluate.event_pass_rate(out))
    assert (rate.events, rate.evaluated, rate.passed_events) == (7, 6, 3)
    assert len(KNOWN_EVENTS) == 6 and sum(not e[4] for e in KNOWN_EVENTS) == 1


def test_look_back_is_all_or_a_number_of_days():
    assert serving.look_back(None) is None and serving.look_back(-30.9) == 30
    for bad in ({"days": 3}, float("nan"), "400", True):
        with pytest.raises(ValueError):
            serving.look_back(bad)


def test_registries_agree(spark):
    from geopulse.config import MART_BUDGET_DAYS, PUBLISH_KEYS
    from geopulse.plans import registry

    tables = {r["table"]: r for r in registry.table_registry(spark).collect()}
    assert set(PUBLISH_KEYS) <= set(tables) and set(MART_BUDGET_DAYS) <= set(tables)
    known = {r.source_id: set(r.metric_types) for r in registry.source_table(spark).collect()}
    assert {s for r in tables.values() for s in r.source_ids} <= set(known)
    assert all(metrics <= set(contracts.METRIC_UNITS) for metrics in known.values())
    ids = {r.region_id for r in registry.region_table(spark).collect()}
    assert len(ids) == 7
    assert {r.region_id for r in registry.known_events(spark).collect()} <= ids
    assert {r.region_id for r in registry.investigations(spark).collect()} <= ids


# -- model ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 3))
    x[:15] += 9.0
    return spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(x)], "k bigint, a double, b double, c double")


def test_planted_outliers_rank_on_top(spark, planted):
    fitted = forest.fit_isolation_forest(planted, ["a", "b", "c"], ["k"], trees=100)
    rows = forest.score(planted, fitted).collect()
    assert all(0.0 < r.anomaly_score < 1.0 for r in rows)
    top = sorted(rows, key=lambda r: -r.anomaly_score)[:15]
    assert {r.k for r in top} == set(range(15))


def test_forest_does_not_depend_on_layout(spark, planted):
    fit = lambda df: forest.fit_isolation_forest(df, ["a", "b", "c"], ["k"], trees=20)
    one_way = {tuple(r) for r in fit(planted.coalesce(1)).nodes.collect()}
    other = {tuple(r) for r in fit(planted.repartition(7, "a")).nodes.collect()}
    assert one_way == other
    sizes = fit(planted).nodes.where("node = 0").select("size").distinct().collect()
    assert [r["size"] for r in sizes] == [256]


def test_training_refuses_to_judge_itself(spark, planted):
    with pytest.raises(KeyError):
        training.train(planted, columns=("a", "b"))
    with pytest.raises(KeyError):
        features.feature_matrix(planted)


# -- sources -----------------------------------------------------------------------------


def test_csv_without_data_is_refused(spark):
    path = scratch(spark, "bad")
    spark.createDataFrame([("Invalid key.",)], "v string").write.text(path)
    with pytest.raises(ValueError, match="not a detections CSV"):
        source.read_detections_csv(spark, path, "P")


def test_header_must_exist(spark):
    df = spark.createDataFrame([("no header here\n1,2",)], "t string")
    fails(index_series.csv_rows(df, "t", "Year", ["year"]), "no header line")


def test_block_count_must_match_axes(spark):
    row = Row(values=[[[1.0, 2.0], [3.0, float("nan")]]], times=[0], lats=[1.0, 2.0], lons=[359.0, 1.0])
    df = spark.createDataFrame([row])
    got = {(r.latitude, r.longitude): r.value for r in grids.flatten_grid(df, 0.25).collect()}
    assert got == {(1.0, -1.0): 1.0, (1.0, 1.0): 2.0, (2.0, -1.0): 3.0}
    fails(grids.flatten_grid(df.withColumn("lats", F.array(F.lit(1.0))), 0.25), "axes say")


def document(points, resolution="PT60M"):
    body = "".join(f"<Point><position>{p}</position>{v}</Point>" for p, v in points)
    return (
        '<?xml version="1.0"?><ns:Publication_MarketDocument xmlns:ns="urn:a"><TimeSeries><currency_Unit.name>EUR</currency_Unit.name>'
        f"<Period><timeInterval><start>2024-01-01T23:00Z</start></timeInterval><resolution>{resolution}</resolution>{body}</Period>"
        "</TimeSeries></ns:Publication_MarketDocument>"
    )


def test_market_documents(spark):
    def parse(xml):
        return markets.parse_market_documents(spark.createDataFrame([(xml,)], "xml string"), "day_ahead_price")

    good = parse(document([(1, "<price.amount>5</price.amount>"), (3, "<price.amount>7</price.amount>"), (2, "")])).collect()
    assert {(r.timestamp, r.value, r.unit) for r in good} == {(dt.datetime(2024, 1, 1, 23), 5.0, "EUR"), (dt.datetime(2024, 1, 2, 1), 7.0, "EUR")}
    assert parse("<Acknowledgement_MarketDocument><text>No matching data found</text></Acknowledgement_MarketDocument>").count() == 0
    fails(parse("<Other><text>broken</text></Other>"), "unexpected document")
    fails(parse(document([(1, "<amount>5</amount>")])), "points without any")
    fails(parse(document([(0, "<price.amount>5</price.amount>")])), "unusable position")
    fails(parse(document([(1, "<price.amount>5</price.amount>")], "P1Y")), "unsupported resolution")


def test_landing_refuses_nothing_and_repeats(spark):
    root = scratch(spark, "lake")
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 5)), (None, dt.datetime(2024, 2, 1))], "region_id string, at timestamp")
    with pytest.raises(ValueError):
        lake.land(df.where("false"), root, "s", "at")
    for _ in range(2):
        lake.land(df, root, "s", "at")
        lake.land(df, root, "s", "at", backfill=True)
    assert lake.read_lake(spark, root, "s").count() == 4
    assert lake.read_lake(spark, root, "t") is None


def test_acceptance_catches_a_detector_that_flags_everything(spark):
    rows = [("r", dt.date(2024, 1, 1), 50, 9.0, flag) for flag in (True, True)]
    fire = spark.createDataFrame(rows, "region_id string, observation_date date, detection_count bigint, zscore double, is_anomaly boolean")
    got = {r["check"]: r.passed for r in acceptance.acceptance({"fire_anomalies": fire}).collect()}
    assert got["fire_spike_detected"] and not got["fire_flag_rate_is_selective"] and not got["marts_are_populated"]


# -- nothing is dropped ------------------------------------------------------------------


@pytest.mark.parametrize("rows", [1, 2, 100, 256, 300])
def test_every_tree_samples_what_it_should(spark, planted, rows):
    small = planted.where(F.col("k") < rows)
    fitted = forest.fit_isolation_forest(small, ["a", "b", "c"], ["k"], trees=60)
    nodes = fitted.nodes.collect()
    roots = [n["size"] for n in nodes if n["node"] == 0]
    assert roots == [min(256, rows)] * 60
    leaves = {}
    for n in nodes:
        if n["feature"] < 0:
            leaves[n["tree"]] = leaves.get(n["tree"], 0) + n["size"]
    assert set(leaves.values()) == {min(256, rows)} and max(n["depth"] for n in nodes) <= 8
    assert forest.score(small, fitted).count() == rows


def test_rows_without_a_time_are_kept_aside(spark):
    root = scratch(spark, "undated")
    df = spark.createDataFrame([("2020-01-01", "a", 1.0), (None, "a", 2.0), (None, None, 3.0)], "at string, region_id string, v double")
    df = df.withColumn("at", F.col("at").cast("timestamp"))
    for _ in range(2):
        lake.land(df, root, "s", "at")
    assert spark.read.parquet(lake.reject_path(root, "s")).count() == 2 and lake.read_lake(spark, root, "s").count() == 1


def test_upsert_refuses_repeats_and_takes_null_keys_as_equal(spark):
    from geopulse.operators.upsert import upsert

    old = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    new = spark.createDataFrame([(None, "c"), (2, "d")], "k int, v string")
    once = upsert(old, new, ["k"])
    assert sorted(map(str, once.collect())) == sorted(map(str, upsert(once, new, ["k"]).collect()))
    assert once.count() == 3 and once.where("v = 'b'").isEmpty()
    fails(upsert(old, new.union(new), ["k"]), "repeats a key")
    assert upsert(old, new.union(new), ["k"], repeats=True).count() == 5


def test_upsert_needs_no_join(spark):
    from geopulse.operators.upsert import upsert

    old = spark.createDataFrame([(1, "a", 0.5)], "k int, v string, score double")
    new = spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string")
    out = upsert(old, new, ["k"], ["score"])
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and text.count("Exchange hashpartitioning") == 1
    assert {tuple(r) for r in out.select("k", "v", "score").collect()} == {(1, "b", 0.5), (2, "c", None)}


def test_redaction_reaches_short_secrets_and_inner_json(spark):
    row = {"note": "pin 4711.", "inner": '{"a": {"my_token": "abc", "n": 1}, "password": "", "list": [{"secret": 5}]}', "map_key": ""}
    df = spark.createDataFrame([(row,)], "m map<string,string>")
    got = one(df.select(text.redact_map(F.col("m"), secrets=["4711."]).alias("m"))).m
    assert got["note"] == f"pin {text.REDACTED}" and got["map_key"] == "missing"
    assert got["inner"] == '{"a": {"my_token": "set", "n": 1}, "password": "missing", "list": [{"secret": "set"}]}'
    with pytest.raises(ValueError):
        text.redact(F.col("m"), [""])


def test_metrics_do_not_mix_in_change_statistics(spark):
    rows = [("r", m, float(v)) for m, v in (("ndvi", 1), ("ndvi", 3), ("sar", 10), ("sar", 30))]
    df = spark.createDataFrame(rows, "region_id string, metric_type string, value_change double")
    assert {(r.metric_type, r.change_mean) for r in series.change_stats(df).collect()} == {("ndvi", 2.0), ("sar", 20.0)}


def test_lake_reads_only_the_folders_asked_for(spark):
    root = scratch(spark, "pruned")
    rows = [(f"2020-0{m}-1{d} 05:00:00", r, float(m)) for m in (1, 2, 3) for d in (0, 1) for r in ("a", "b")]
    df = spark.createDataFrame(rows, "at string, region_id string, v double").withColumn("at", F.col("at").cast("timestamp"))
    lake.land(df.where("at >= '2020-02-01'"), root, "s", "at")
    lake.land(df.where("at < '2020-02-01'"), root, "s", "at", backfill=True)
    some = lake.read_lake(spark, root, "s", since="2020-02-11", until="2020-03-10", regions=["a"])
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and plan.count("PartitionFilters") == 2
    assert sorted(str(r["at"])[:10] for r in some.collect()) == ["2020-02-11", "2020-03-10"]
    assert lake.read_lake(spark, root, "s").count() == 12 and lake.read_lake(spark, root, "s", months=["2020-01"]).count() == 4
    assert set(some.columns) == {"at", "region_id", "v"}


def test_a_broken_write_leaves_the_table_and_can_be_replayed(spark):
    from geopulse.sources.versions import PeriodSink, VersionedSink

    merge = lambda old, new: new if old is None else upsert.upsert(old, new, ["k"])
    batch = lambda rows: spark.createDataFrame(rows, "k int, v string")
    broken = lambda old, new: merge(old, new).where(F.raise_error(F.lit("lost")).cast("boolean"))
    for sink in (PeriodSink(spark, scratch(spark, "p"), F.col("k") % 2), VersionedSink(spark, scratch(spark, "v"))):
        sink.fold(batch([(1, "a"), (2, "a"), (3, "a")]), 0, merge)
        with pytest.raises(Exception, match="lost"):
            sink.fold(batch([(1, "b"), (4, "b")]), 1, broken)
        assert {tuple(r) for r in sink.latest().select("k", "v").collect()} == {(1, "a"), (2, "a"), (3, "a")}
        for _ in range(2):
            sink.fold(batch([(1, "b"), (4, "b")]), 1, merge)
        sink.fold(batch([(3, "c")]), 2, merge)
        sink.fold(batch([(3, "c")]), 2, merge)
        assert {tuple(r) for r in sink.latest().select("k", "v").collect()} == {(1, "b"), (2, "a"), (3, "c"), (4, "b")}


def test_the_grid_goes_on_past_the_date_line_and_the_poles(spark):
    df = spark.createDataFrame([(10.0, 180.0), (10.0, -180.0), (89.9, 50.0), (-89.9, 179.9)], "lat double, lon double")
    df = df.withColumn("id", hexgrid.cell(F.col("lat"), F.col("lon"), 3))
    ids = [r["id"] for r in df.collect()]
    assert ids[0] == ids[1]
    near = df.select("lat", F.explode(hexgrid.k_ring(F.col("id"), 2)).alias("n")).distinct()
    centres = near.select("lat", hexgrid.cell_center(F.col("n")).alias("c")).collect()
    edge = hexgrid.EDGE_DEGREES[3]
    assert all(abs(r.c.lon) <= 180 + edge and abs(r.c.lat) <= 90 + edge for r in centres)
    assert min(r.c.lon for r in centres if r.lat == 10) < -178 and max(r.c.lon for r in centres if r.lat == 10) > 178


def test_scratch_has_an_owner_that_can_let_go(spark):
    import os

    from geopulse.workspace import materialise, run_root

    df = materialise(spark.range(3).toDF("k"), "mine")
    assert df.count() == 3 and run_root(spark).removeprefix("file:") in df.inputFiles()[0]
    assert os.path.isdir(run_root(spark).removeprefix("file:"))


def test_pages_by_key_cover_a_table_once(spark):
    """Whatever the page size, directions and nulls: pages behind one another are the table in order, and ``left`` counts down."""
    rows = [(a, b) for a in (None, 1, 2, 3) for b in (None, "x", "y", "z")]
    df = spark.createDataFrame(rows, "a int, b string").repartition(3)
    last = lambda v: (v is None, v)
    for up_a, up_b in [(True, True), (True, False), (False, True), (False, False)]:
        def place(r):
            a, b = r
            return (a is None, (a or 0) * (1 if up_a else -1), b is None, (ord(b) if b else 0) * (1 if up_b else -1))

        want, got, after = sorted(rows, key=place), [], None
        while True:
            page = serving.page_after(df, [("a", up_a), ("b", up_b)], after, limit=5).collect()
            if not page:
                break
            assert {r["left"] for r in page} == {len(rows) - len(got)}
            got += [(r["a"], r["b"]) for r in page]
            after = {"a": got[-1][0], "b": got[-1][1]}
        assert got == want


def test_redaction_of_json_by_tokens(spark):
    """Whatever stands under a sensitive key goes, at any depth; broken JSON hides the rest; other text is untouched."""
    deep = '{"a":' * 300 + '{"my_token": {"x": [1, {"y": "s3cret"}]}, "z": [1, 2]}' + "}" * 300
    cases = {
        '{"password":{"a":{"b":"topsecretvalue"}}}': '{"password":"set"}',
        '{"token":["a",["deepsecret1"]]}': '{"token":"set"}',
        '{"token" : "a", "b": {"Secret_X":\n null}}': '{"token" : "set", "b": {"Secret_X":\n "missing"}}',
        '[{"map_key": -0.0}, {"map_key": 0.5}, {"webhook": true}]': '[{"map_key": "missing"}, {"map_key": "set"}, {"webhook": "set"}]',
        '{"token": {"a": "cut off': '{"token": "set"',
        '{"a": "the \\"token\\": is no key", "b": 1}': '{"a": "the \\"token\\": is no key", "b": 1}',
        deep: deep.replace('{"x": [1, {"y": "s3cret"}]}', '"set"'),
        "no json { at all": "no json { at all",
        "": "",
    }
    df = spark.createDataFrame(list(cases.items()), "raw string, want string")
    for r in df.select("want", text.redact_json(F.col("raw")).alias("got")).collect():
        assert r["got"] == r["want"]
