"""Physical plans: pruned scans, map-side limits, no cross joins."""

import pytest

from checks import CHECKS
from checks.base import Tables

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["fire_anomalies", "deforestation_index", "ice_extent_trends", "assign_region", "check_events", "map_window",
     "window_facts", "composite_mean", "percentile_rank", "upsert_protected", "dense_spine", "flow_report"],
)
def test_no_cross_or_nested_loop_joins(spark, name):
    text = plan(CHECKS[name].run(Tables.of(spark, SF_DIR)))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_dedup_limits_groups_before_the_shuffle(spark):
    text = plan(CHECKS["stg_detections"].run(Tables.of(spark, SF_DIR)))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1


def test_scan_reads_only_what_is_used(spark):
    text = plan(CHECKS["severity"].run(Tables.of(spark, SF_DIR)))
    assert "ReadSchema: struct<l_linenumber:int,l_quantity:double,l_tax:double>" in text


def test_window_filter_reaches_the_scan(spark):
    from geopulse.plans import serving

    cells = serving.window_filter(Tables.of(spark, SF_DIR).cells, "1996-01-01", "1996-02-01", region="2-HIGH")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = plan(cells)
    assert "PushedFilters" in text and "GreaterThanOrEqual(period_start" in text and "EqualTo(region_id,2-HIGH)" in text
