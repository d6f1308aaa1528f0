"""Expectations over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import check, num
from geopulse import config
from geopulse.operators import expect
from geopulse.plans import acceptance, marts


@check("not_null", "region_id observation_date:d", "select * from daily where frp_sum is null or confidence_pct_mean is null")
def _(t):
    return expect.not_null(t.daily, ["frp_sum", "confidence_pct_mean"])


@check("unique", "o_custkey:i row_count:i", "select o_custkey, count(*) as row_count from orders group by 1 having count(*) > 1")
def _(t):
    return expect.unique(t.read("orders"), "o_custkey")


@check("unique_combination", "l_orderkey:i l_linenumber:i row_count:i",
       "select l_orderkey, l_linenumber, count(*) as row_count from lineitem group by 1, 2 having count(*) > 1")
def _(t):
    return expect.unique_combination(t.read("lineitem"), ["l_orderkey", "l_linenumber"])


@check("accepted_values", "value row_count:i",
       "select severity as value, count(*) as row_count from fire where severity not in ('normal', 'unknown') group by 1")
def _(t):
    return expect.accepted_values(t.fire, "severity", ["normal", "unknown"])


@check("relationships", "value:i row_count:i",
       """select l_suppkey as value, count(*) as row_count from lineitem
          where l_suppkey not in (select s_suppkey * 2 from supplier) group by 1""")
def _(t):
    parent = t.read("supplier").select((F.col("s_suppkey") * 2).alias("k"))
    return expect.relationships(t.read("lineitem"), "l_suppkey", parent, "k")


@check("column_between", "region_id observation_date:d zscore:f", "select * from fire where zscore < -0.5 or zscore > 4")
def _(t):
    return expect.column_between(t.fire, "zscore", -0.5, 4.0)


@check("not_older_than", "latest_observation:d",
       "select max(observation_date) as latest_observation from detections having max(observation_date) < date '2001-12-01' - 45")
def _(t):
    return expect.not_older_than(t.detections, "observation_date", 45, F.lit("2001-12-01").cast("date"))


@check("not_empty", "row_count:i",
       """select count(*) as row_count from fire having count(*) = 0
          union all select count(*) from fire where detection_count < 0 having count(*) = 0""")
def _(t):
    return expect.not_empty(t.fire).unionByName(expect.not_empty(t.fire.where("detection_count < 0")))


@check("no_future", "model_name latest:d",
       """select 'detections' as model_name, max(observation_date) as latest from detections having max(observation_date) > date '1999-01-01' + 1
          union all select 'gridded', max(observation_date) from gridded having max(observation_date) > date '1999-01-01' + 1""")
def _(t):
    tables = {"detections": (t.detections, "observation_date"), "gridded": (t.gridded, "observation_date")}
    return expect.no_future(tables, F.lit("1999-01-01").cast("date"))


@check("regions_without_data", "region_id",
       "select region_id from region_dim where region_id not in (select region_id from detections)")
def _(t):
    return expect.regions_without_data(t.region_dim, t.detections, "fire")


@check("drift", "side c_custkey:i c_nationkey:i",
       """select 'missing' as side, c_custkey, c_nationkey from customer where c_acctbal < 0
          union all select 'unexpected', c_custkey, c_nationkey + 1 from customer where c_acctbal < 0""")
def _(t):
    # the copy moved every customer in debt to the next nation
    expected = t.read("customer").select("c_custkey", "c_nationkey")
    moved = F.col("c_nationkey") + F.when(F.col("c_acctbal") < 0, 1).otherwise(0)
    return expect.drift(expected, t.read("customer").select("c_custkey", moved.alias("c_nationkey")))


# physical bounds: column, low, high, required
FIRE_BOUNDS = (
    ("detection_count", 0, 100000, True),
    ("night_detection_share", 0, 1, False),
    ("cell_concentration", 0, 1, False),
    ("frp_per_detection", 0, 300, False),
    ("baseline_median", 0, 100000, True),
    ("baseline_samples", 1, 1000000, True),
    ("zscore", -1, 100000, False),
)


@check("expectation_report", "column violations:i",
       " union all ".join(
           f"select '{c}' as \"column\", count(*) filter ({c} < {lo} or {c} > {hi}{f' or {c} is null' if req else ''}) as violations from fire"
           for c, lo, hi, req in FIRE_BOUNDS))
def _(t):
    return expect.report(t.fire, FIRE_BOUNDS)


@check("sensitivity", "check hits:i passed",
       """select 'fire_spike' as "check", count(*) as hits, count(*) > 0 as passed from fire where is_anomaly and detection_count >= 5
          union all select 'ice_excursion', count(*), count(*) > 0 from ice where is_anomaly and zscore <= -1
          union all select 'marine_heat', count(*), count(*) > 0 from cell_sst where value >= 1.5
          union all select 'ndvi_crash', count(*), count(*) > 0 from yoy y join yoy_stats s on s.region_id = y.region_id
          and s.metric_type = y.metric_type where y.metric_type = 'ndvi' and y.value_change < s.change_mean""")
def _(t):
    from geopulse.operators.dedup import union_by_name
    from geopulse.plans import marts
    from geopulse.plans.acceptance import planted_hits

    return union_by_name(
        [
            planted_hits("fire_spike", t.fire, F.col("is_anomaly") & (F.col("detection_count") >= 5)),
            planted_hits("ice_excursion", t.ice, F.col("is_anomaly") & (F.col("zscore") <= -1)),
            planted_hits("marine_heat", marts.cell_sst(t.gridded), F.col("value") >= 1.5),
            planted_hits("ndvi_crash", marts.deforestation_index(t.composites), F.col("ndvi_change") < F.col("change_mean")),
        ]
    )


@check("flag_rate_ceiling", "scored:i flagged:i rate:f passed",
       """select count(zscore) as scored, count(*) filter (is_anomaly) as flagged, count(*) filter (is_anomaly) / count(zscore) as rate,
          count(zscore) > 0 and count(*) filter (is_anomaly) / count(zscore) <= 0.02 as passed from fire""")
def _(t):
    from geopulse.plans.acceptance import flag_rate_ceiling

    return flag_rate_ceiling(t.fire)


SPIKE, CRASH, EXCURSION, HEAT, CEILING = (num(x) for x in (
    acceptance.FIRE_SPIKE, acceptance.NDVI_CRASH, acceptance.ICE_EXCURSION_Z, acceptance.MARINE_HEAT, acceptance.MAX_FLAG_RATE
))


@check("acceptance", 'check hits:i passed',
       f"""select 'fire_spike_detected' as "check", count(*) as hits, count(*) > 0 as passed from fire where is_anomaly and detection_count >= {SPIKE}
          union all select 'fire_flag_rate_is_selective', count(*) filter (is_anomaly), count(zscore) > 0 and count(*) filter (is_anomaly) / count(zscore) <= {CEILING} from fire
          union all select 'ice_excursion_detected', count(*), count(*) > 0 from ice where is_anomaly and zscore <= {EXCURSION}
          union all select 'marine_heatwave_present', count(*), count(*) > 0 from cell_sst where metric_type = 'sst_anomaly' and value >= {HEAT}
          union all select 'marts_are_populated', 4, (select count(*) from fire) > 0 and (select count(*) from ice) > 0 and (select count(*) from cells) > 0 and (select count(*) from cell_sst) > 0""")
def _(t):
    # the whole acceptance run of a build; the index of vegetation is absent, as where its source was not collected
    built = {"fire_anomalies": t.fire, "ice_extent_trends": t.ice, "cell_fire": t.cells, "cell_sst": marts.cell_sst(t.gridded)}
    return acceptance.acceptance(built)


@check("marts_populated", "mart rows:i populated",
       """select 'fire_anomalies' as mart, count(*) as rows, count(*) > 0 as populated from fire
          union all select 'ice_extent_trends', count(*), count(*) > 0 from ice
          union all select 'cell_fire', count(*), count(*) > 0 from cells
          union all select 'cell_sst', count(*), count(*) > 0 from cell_sst""")
def _(t):
    from geopulse.plans import marts
    from geopulse.plans.acceptance import populated

    return populated(
        {"fire_anomalies": t.fire, "ice_extent_trends": t.ice, "cell_fire": t.cells, "cell_sst": marts.cell_sst(t.gridded)}
    )


@check("registry_in_step", "problem value row_count:i",
       f"""select 'region not registered' as problem, region_id as value, count(*) as row_count from detections
          where region_id not in ({", ".join(f"'{r[0]}'" for r in config.REGIONS)}) group by 2
          union all select 'metric not registered', metric_type, count(*) from (select metric_type from gridded
            union all select metric_type from composites union all select event_type from events) as seen
          where metric_type not in ({", ".join(f"'{m}'" for s in config.SOURCES for m in s[2])}) group by 2
          union all select 'source of a table not registered', s, count(*) from (select unnest([{", ".join(f"'{x}'" for r in config.TABLES for x in r[2])}]) as s)
          where s not in ({", ".join(f"'{s[0]}'" for s in config.SOURCES)}) group by 2""")
def _(t):
    from geopulse.operators.dedup import union_by_name
    from geopulse.plans import registry

    sources, regions = registry.source_table(t.spark), registry.region_table(t.spark)
    metrics = sources.select(F.explode("metric_types").alias("metric"))
    # event types are no metrics, so they must be reported
    seen = union_by_name([df.select("metric_type") for df in (t.gridded, t.composites)] + [t.read("events").select(F.col("event_type").alias("metric_type"))])
    used = registry.table_registry(t.spark).select(F.explode("source_ids").alias("source_id"))
    found = {
        "region not registered": expect.relationships(t.detections, "region_id", regions, "region_id"),
        "metric not registered": expect.relationships(seen, "metric_type", metrics, "metric"),
        "source of a table not registered": expect.relationships(used, "source_id", sources, "source_id"),
    }
    return union_by_name([df.select(F.lit(name).alias("problem"), F.col("value").cast("string").alias("value"), "row_count") for name, df in found.items()])
