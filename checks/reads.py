"""Serving reads and operations reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import ASOF, check
from geopulse.operators.dedup import union_by_name
from geopulse.plans import ops, serving
from geopulse.workspace import materialise

CURRENT = "(select model_version from predictions group by 1 order by max(scored_at) desc limit 1)"


@check("anomalies", "region_id observation_date:d detection_count:i zscore:f severity is_anomaly anomaly_percentile:f",
       f"""select f.*, p.anomaly_percentile from fire f left join predictions p on p.region_id = f.region_id
          and p.observation_date = f.observation_date and p.model_version = {CURRENT}""")
def _(t):
    return serving.anomalies(t.fire, t.predictions, ASOF)


@check("anomalies_flagged", "region_id observation_date:d zscore:f anomaly_percentile:f",
       f"""select f.*, p.anomaly_percentile from fire f left join predictions p on p.region_id = f.region_id
          and p.observation_date = f.observation_date and p.model_version = {CURRENT}
          where f.observation_date >= date '{ASOF}' - 2000 and f.is_anomaly and f.region_id = '2-HIGH'""")
def _(t):
    return serving.anomalies(t.fire, t.predictions, ASOF, days=2000, region="2-HIGH", only_anomalies=True)


@check("ice_trends", "region_id period_start:d value:f baseline_mean:f baseline_source zscore:f severity is_anomaly",
       "select * from ice")
def _(t):
    return serving.ice_trends(t.ice, ASOF)


@check("ice_trends_recent", "region_id period_start:d value:f baseline_mean:f baseline_source zscore:f severity is_anomaly",
       f"select * from ice where period_start >= date '{ASOF}' - 400")
def _(t):
    return serving.ice_trends(t.ice, ASOF, days=400)


@check("seasonal_profile", "region_id month:i mean_detections:f flagged_days:i",
       """select region_id, month(observation_date) as month, avg(detection_count) as mean_detections,
          count(*) filter (is_anomaly) as flagged_days from fire group by 1, 2""")
def _(t):
    return serving.seasonal_profile(t.fire)


REGIME = """select case when is_anomaly then 'flagged' else 'unflagged' end as regime, count(*) as days, avg(detection_count) as mean_detections,
  avg(night_detection_share) as night_share, avg(cell_concentration) as cell_concentration,
  avg(frp_per_detection) as frp_per_detection, avg(satellite_count) as satellites from fire where detection_count > 0 group by 1"""


@check("regime_comparison", "regime days:i mean_detections:f night_share:f cell_concentration:f frp_per_detection:f satellites:f", REGIME)
def _(t):
    return serving.regime_comparison(t.fire)


@check("regime_ratio", "feature flagged:f unflagged:f ratio:f",
       f"""with r as ({REGIME}), u as (unpivot (select * exclude (days) from r)
            on mean_detections, night_share, cell_concentration, frp_per_detection, satellites into name feature value v)
          select feature, max(v) filter (regime = 'flagged') as flagged, max(v) filter (regime = 'unflagged') as unflagged,
          max(v) filter (regime = 'flagged') / max(v) filter (regime = 'unflagged') as ratio from u group by 1""")
def _(t):
    return serving.regime_ratio(serving.regime_comparison(t.fire))


@check("region_summaries", "region_id first_day:d last_day:d total_detections:i peak:i flagged_days:i days:i median:f",
       """select region_id, min(observation_date) as first_day, max(observation_date) as last_day, sum(detection_count) as total_detections,
          max(detection_count) as peak, count(*) filter (is_anomaly) as flagged_days, count(*) as days,
          median(detection_count) as median from fire group by 1""")
def _(t):
    return serving.region_summaries(t.fire)


@check("overview_kpis", "total_detections:i days_scored:i days_flagged:i flagged_pct:f",
       """select sum(detection_count) as total_detections, count(zscore) as days_scored, count(*) filter (is_anomaly) as days_flagged,
          count(*) filter (is_anomaly) / count(zscore) * 100 as flagged_pct from fire""")
def _(t):
    return serving.overview_kpis(t.fire)


@check("cell_activity", "period_start:d cells:i peak:f",
       "select period_start, count(*) as cells, max(value) as peak from cells group by 1")
def _(t):
    return serving.cell_activity(t.cells)


@check("busiest_period", "period_start:d cells:i peak:f",
       "select period_start, count(*) as cells, max(value) as peak from cells group by 1 order by 2 desc, 1 limit 1")
def _(t):
    return serving.busiest_period(serving.cell_activity(t.cells))


FLAGGED_WINDOW = """(select * from cells c where period_start between date '1996-02-10' and date '2000-11-20'
  and exists (select 1 from fire f where f.region_id = c.region_id and f.is_anomaly and f.observation_date = c.period_start))"""


def flagged_window(t, part):
    return serving.map_window(t.cells, "1996-02-10", "2000-11-20", region="all", fire=t.fire, limit=40)[part]


@check("map_window", "h3_index region_id period_start:d value:f",
       f"select * from {FLAGGED_WINDOW} order by value desc, h3_index, period_start, region_id limit 40")
def _(t):
    return flagged_window(t, "cells")


@check("map_summary", "p50:f p75:f p90:f p98:f domain_min:f domain_max:f total_cells:i truncated",
       f"""select coalesce(max(case when rn = cast(floor(n * 0.50e0) as bigint) + 1 then value end), 1) as p50,
          coalesce(max(case when rn = cast(floor(n * 0.75e0) as bigint) + 1 then value end), 2) as p75,
          coalesce(max(case when rn = cast(floor(n * 0.90e0) as bigint) + 1 then value end), 3) as p90,
          coalesce(max(case when rn = cast(floor(n * 0.98e0) as bigint) + 1 then value end), 4) as p98,
          coalesce(min(value), 0) as domain_min, coalesce(max(value), 0) as domain_max, count(*) as total_cells, count(*) > 40 as truncated
          from (select value, row_number() over (order by value) as rn, count(*) over () as n from {FLAGGED_WINDOW})""")
def _(t):
    return flagged_window(t, "summary")


@check("map_activity", "period_start:d cells:i peak:f",
       f"select period_start, count(*) as cells, max(value) as peak from {FLAGGED_WINDOW} group by 1")
def _(t):
    return flagged_window(t, "activity")


@check("map_coverage", "first_period:d last_period:d",
       "select min(period_start) as first_period, max(period_start) as last_period from cells")
def _(t):
    return flagged_window(t, "coverage")


@check("cells_by_region", "region_id cells:i peak_cells:f mean_cells:f",
       "select region_id, count(*) as cells, max(value) as peak_cells, round(avg(value), 2) as mean_cells from cells group by 1")
def _(t):
    return serving.cells_by_region(t.cells)


def status(t):
    return serving.table_status(
        t.spark,
        {
            "fire_anomalies": (t.fire, "observation_date"), "cell_fire": (t.cells, "period_start"),
            "ice_extent_trends": (t.ice, "period_start"), "predictions": (t.predictions, "observation_date"),
            "pipeline_runs": (t.runs, "started_at"), "cell_change": (None, "period_start"),
        },
    )


STATUS = """(select 'fire_anomalies' as "table", true as present, count(*) as rows, min(observation_date) as first_value, max(observation_date) as last_value from fire
  union all select 'cell_fire', true, count(*), min(period_start), max(period_start) from cells
  union all select 'ice_extent_trends', true, count(*), min(period_start), max(period_start) from ice
  union all select 'predictions', true, count(*), min(observation_date), max(observation_date) from predictions
  union all select 'pipeline_runs', true, count(*), cast(min(started_at) as date), cast(max(started_at) as date) from runs
  union all select 'cell_change', false, null, null, null)"""


@check("table_status", "table present rows first_value:d last_value:d", f"select * from {STATUS}")
def _(t):
    return status(t)


@check("mart_freshness", "table present last_value:d days_behind budget_days:i late",
       f"""select "table", present, last_value, case when last_value is not null then greatest(date_diff('day', last_value, date '2001-09-01'), 0) end as days_behind, b as budget_days,
          case when last_value is not null then greatest(date_diff('day', last_value, date '2001-09-01'), 0) > b end as late
          from (select *, case "table" when 'fire_anomalies' then 3 when 'cell_fire' then 3 when 'ice_extent_trends' then 10
                when 'predictions' then 10 when 'pipeline_runs' then 30 else 45 end as b from {STATUS})""")
def _(t):
    return ops.mart_freshness(status(t), F.lit("2001-09-01").cast("date"))


@check("mart_rollup", "late:i absent:i",
       f"""select count(*) filter (greatest(date_diff('day', last_value, date '2001-09-01'), 0) > b) as late, count(*) filter (not present) as absent
          from (select *, case "table" when 'fire_anomalies' then 3 when 'cell_fire' then 3 when 'ice_extent_trends' then 10
                when 'predictions' then 10 when 'pipeline_runs' then 30 else 45 end as b from {STATUS})""")
def _(t):
    return ops.mart_rollup(ops.mart_freshness(status(t), F.lit("2001-09-01").cast("date")))


@check("health", "table present rows healthy", f"select *, true as healthy from {STATUS}")
def _(t):
    return ops.health(status(t), "fire_anomalies")


@check("ops_report", "runs:i success_rate:f last_run:t tables:i table_rows:i model_version",
       f"""select count(*) as runs, count(*) filter (status = 'success') / count(*) as success_rate, max(started_at) as last_run,
          (select count(*) filter (present) from {STATUS}) as tables, (select sum(rows) from {STATUS}) as table_rows,
          {CURRENT} as model_version from runs""")
def _(t):
    return ops.ops_report(t.runs, status(t), t.predictions)


TOTALS = """(select workflow, count(*) as runs, count(*) filter (status = 'success') as ok, max(started_at) as last_run,
  max(started_at) filter (status = 'success') as last_ok, sum(rows_written) as rows_total, sum(failed_units) as failed_units,
  arg_max(status, (started_at, run_id)) as last_status, arg_max(duration_s, (started_at, run_id)) as duration_s,
  arg_max(rows_written, (started_at, run_id)) as last_rows from runs group by 1)"""


@check("run_totals", "workflow runs:i ok:i last_run:t last_ok:t rows_total:i failed_units:i last_status duration_s:f last_rows:i",
       f"select * from {TOTALS}")
def _(t):
    return ops.run_totals(t.runs)


@check("runs_by_status", "status n:i", "select status, count(*) as n from runs group by 1")
def _(t):
    return ops.runs_by_status(t.runs)


STAGES = "(values ('collect', 'collect_data', 8), ('store', 'collect_data', null), ('transform', 'transform', 30), ('train', 'train_model', 216), ('score', 'train_model', 216), ('serve', null, null)) as s(stage, workflow, budget)"
FLOW = f"""(select stage, s.workflow, last_run, age_hours, duration_s, last_rows as rows, failed_units, coalesce(runs, 0) as runs, ok / runs as success_rate,
  case when s.workflow is null then 'external' when runs is null then 'unrecorded' when last_status <> 'success' then 'failed'
       when age_hours > budget then 'overdue' else 'live' end as state
  from {STAGES} left join (select *, greatest(epoch(timestamp '2024-01-31 12:00:00' - last_run) / 3600e0, 0) as age_hours from {TOTALS}) t
  on t.workflow = s.workflow)"""


def stages(t):
    return ops.stage_states(t.runs, ops.stage_table(t.spark), F.lit("2024-01-31 12:00:00").cast("timestamp"))


@check("flow_report", "stage workflow state last_run:t age_hours:f duration_s:f rows failed_units runs:i success_rate:f",
       f"select * replace (cast(failed_units as bigint) as failed_units) from {FLOW}")
def _(t):
    return stages(t)


@check("stage_rollup", "need_attention:i unrecorded:i freshest_hours:f",
       f"""select count(*) filter (state in ('failed', 'overdue', 'unrecorded')) as need_attention,
          count(*) filter (state = 'unrecorded') as unrecorded, min(age_hours) as freshest_hours from {FLOW}""")
def _(t):
    return ops.stage_rollup(stages(t))


# suppliers as sources: credentials and metric lists as JSON text, some of it broken
SOURCES = """(select 'src' || s_suppkey as source_id, s_name as label,
  case s_suppkey % 4 when 0 then '{"KEY":"missing","TOKEN":"missing"}' when 1 then '{"KEY":"set","TOKEN":"missing"}' when 2 then '{}' else 'oops' end as credentials,
  case s_suppkey % 3 when 0 then '["a","b"]' when 1 then '["a"]' else 'oops' end as metric_types, s_suppkey from supplier)"""
REGISTRY = """(select p_brand as "table", 'src' || (p_partkey % (select count(*) + 5 from supplier)) as source_id, p_type as domain from part)"""


def sources(t):
    k = F.col("s_suppkey")
    return t.read("supplier").select(
        F.concat(F.lit("src"), k).alias("source_id"), F.col("s_name").alias("label"),
        F.when(k % 4 == 0, '{"KEY":"missing","TOKEN":"missing"}').when(k % 4 == 1, '{"KEY":"set","TOKEN":"missing"}')
        .when(k % 4 == 2, "{}").otherwise("oops").alias("credentials"),
        F.when(k % 3 == 0, '["a","b"]').when(k % 3 == 1, '["a"]').otherwise("oops").alias("metric_types"),
    )


def registry(t):
    n = t.read("supplier").agg((F.count(F.lit(1)) + 5).alias("n")).scalar()
    return t.read("part").select(
        F.col("p_brand").alias("table"), F.array(F.concat(F.lit("src"), F.col("p_partkey") % n)).alias("source_ids")
    )


@check("marts_by_source", "source_id served_by",
       f"""select source_id, array_to_string(list_sort(list(distinct "table")), ',') as served_by from {REGISTRY} group by 1""")
def _(t):
    return ops.marts_by_source(registry(t)).withColumn("served_by", F.array_join("served_by", ","))


@check("source_flow", "source_id label metrics:i credentials:i credentials_present:i blocked served_by",
       f"""select s.source_id, s.label, case s_suppkey % 3 when 0 then 2 when 1 then 1 else 0 end as metrics,
          case when s_suppkey % 4 < 2 then 2 else 0 end as credentials, (s_suppkey % 4 = 1)::int as credentials_present,
          s_suppkey % 4 = 0 as blocked, coalesce(r.served_by, '') as served_by
          from {SOURCES} s left join (select source_id, array_to_string(list_sort(list(distinct "table")), ',') as served_by
          from {REGISTRY} group by 1) r on r.source_id = s.source_id""")
def _(t):
    return ops.source_flow(sources(t), registry(t)).withColumn("served_by", F.array_join("served_by", ","))


@check("coverage_by_domain", "domain present:i total:i live",
       """select p_type as domain, count(*) filter (p_size % 3 = 0) as present, count(*) as total, bool_or(p_size % 3 = 0) as live
          from part where p_size > 5 group by 1""")
def _(t):
    parts = t.read("part").withColumn("table", F.col("p_partkey"))
    here = parts.where("p_size % 3 = 0").select("table", F.lit(True).alias("present"))
    reg = parts.select("table", F.col("p_type").alias("domain"), (F.col("p_size") <= 5).alias("internal"))
    return ops.coverage_by_domain(here, reg)


@check("collection_summary", "run_id:i units:i ok_units:i failed_units:i rows_written:i status",
       """select l_orderkey as run_id, count(*) as units, count(*) filter (l_quantity > 10) as ok_units, count(*) filter (l_quantity <= 10) as failed_units,
          cast(sum(case when l_quantity > 10 then l_quantity end) as bigint) as rows_written,
          case when count(*) filter (l_quantity <= 10) = 0 then 'success' when count(*) filter (l_quantity > 10) > 0 then 'partial' else 'failed' end as status
          from (select l_orderkey, l_quantity from lineitem) group by 1""".replace(
           "cast(sum(case when l_quantity > 10 then l_quantity end) as bigint)", "coalesce(cast(sum(case when l_quantity > 10 then l_quantity end) as bigint), 0)"))
def _(t):
    ok = F.col("l_quantity") > 10
    outcomes = t.read("lineitem").select(
        F.col("l_orderkey").alias("run_id"), ok.alias("ok"), F.when(ok, F.col("l_quantity").cast("bigint")).alias("rows")
    )
    return ops.collection_summary(outcomes)


# one investigation per customer around its first order, alternating tails
WINDOWS = """(select o_custkey as slug, min_by(o_orderpriority, (o_orderdate, o_orderkey)) as region_id, cast(min(o_orderdate) as date) as a,
  cast(min(o_orderdate) as date) + 6 as b, case when o_custkey % 2 = 0 then 'upper' else 'lower' end as tail from orders group by 1, 5)"""


def windows(t):
    day = F.to_date("o_orderdate")
    return t.read("orders").groupBy(F.col("o_custkey").alias("slug")).agg(
        F.min_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("region_id"), F.min(day).alias("start")
    ).select(
        "slug", "region_id", "start", F.date_add("start", 6).alias("end"),
        F.when(F.col("slug") % 2 == 0, "upper").otherwise("lower").alias("tail"),
    )


@check("window_facts", "slug region_id span_days:i flagged_days:i total:f peak_date:d peak zscore:f baseline_median:f",
       f"""select w.slug, w.region_id, count(f.region_id) as span_days, count(*) filter (f.is_anomaly) as flagged_days, sum(f.detection_count) as total,
          arg_max(f.observation_date, (coalesce(case when tail = 'lower' then -zscore else zscore end, -1e300), -epoch(f.observation_date))) as peak_date,
          arg_max(f.detection_count, (coalesce(case when tail = 'lower' then -zscore else zscore end, -1e300), -epoch(f.observation_date))) as peak,
          arg_max(f.zscore, (coalesce(case when tail = 'lower' then -zscore else zscore end, -1e300), -epoch(f.observation_date))) as zscore,
          arg_max(f.baseline_median, (coalesce(case when tail = 'lower' then -zscore else zscore end, -1e300), -epoch(f.observation_date))) as baseline_median
          from {WINDOWS} w left join fire f on f.region_id = w.region_id and f.observation_date between w.a and w.b group by 1, 2""")
def _(t):
    return serving.window_facts(t.fire, windows(t), "observation_date", "detection_count", ["baseline_median"])


@check("paired_series", "region_id first_period:d last_period:d points:i low:f high:f",
       """select region_id, min(period_start) as first_period, max(period_start) as last_period, count(*) as points,
          min(least(value, baseline_mean)) as low, max(greatest(value, baseline_mean)) as high
          from (select *, pos - row_number() over (partition by region_id order by period_start) as island
                from (select *, row_number() over (partition by region_id order by period_start) as pos from ice)
                where baseline_mean is not null and value is not null) group by region_id, island""")
def _(t):
    return serving.paired_series(t.ice)


@check("worst_days", "region_id observation_date:d detection_count:i z:f severity",
       """select *, round(zscore, 1) as z from fire order by zscore desc nulls last, region_id, observation_date limit 15""")
def _(t):
    return serving.worst_days(t.fire)


@check("month_anomalies", "region_id observation_date:d detection_count:i z:f",
       "select *, round(zscore, 1) as z from fire where month(observation_date) = 2 and is_anomaly")
def _(t):
    return serving.month_anomalies(t.fire)


@check("rule_vs_model", "region_id observation_date:d detection_count:i rule_z:f model_pct:f severity",
       f"""select f.region_id, f.observation_date, detection_count, round(zscore, 1) as rule_z, round(anomaly_percentile, 3) as model_pct, severity
          from fire f join predictions p on p.region_id = f.region_id and p.observation_date = f.observation_date
          and p.model_version = {CURRENT} where f.is_anomaly order by model_pct, 1, 2 limit 15""")
def _(t):
    return serving.rule_vs_model(t.fire, t.predictions)


@check("below_normal", "region_id period_start:d extent:f normal:f z:f",
       """select region_id, period_start, round(value, 2) as extent, round(baseline_mean, 2) as normal, round(zscore, 2) as z from ice
          where baseline_mean is not null and value is not null order by zscore nulls last, region_id, period_start limit 12""")
def _(t):
    return serving.below_normal(t.ice)


@check("page_after", "l_orderkey:i l_linenumber:i l_partkey:i l_suppkey:i l_extendedprice:f left:i turn:i",
       """select *, (place - 1) // 40 + 1 as turn, total - ((place - 1) // 40) * 40 as left
          from (select l_orderkey, l_linenumber, l_partkey, l_suppkey, case when l_linenumber % 5 <> 0 then l_extendedprice end as l_extendedprice, count(*) over () as total,
                row_number() over (order by case when l_linenumber % 5 <> 0 then l_extendedprice end desc nulls last, l_orderkey, l_linenumber, l_partkey, l_suppkey) as place from lineitem)
          where place <= 120 or place > (total - 120) // 40 * 40""")
def _(t):
    # the first three pages and then the last ones, each found by the key of the row before it
    rows = t.read("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(F.col("l_linenumber") % 5 != 0, F.col("l_extendedprice")).alias("l_extendedprice")
    )
    keys = [("l_extendedprice", False), ("l_orderkey", True), ("l_linenumber", True), ("l_partkey", True), ("l_suppkey", True)]
    total, names = rows.count(), [name for name, _ in keys]
    start = (total - 120) // 40 * 40
    jump = serving.key_at(rows, keys, start)
    out, turn, after = [], 1, None
    while turn * 40 - 40 < total:
        page = materialise(serving.page_after(rows, keys, after, limit=40).withColumn("turn", F.lit(turn)), "page")
        out.append(page)
        after = page.orderBy(F.desc_nulls_last(names[0]), *names[1:]).tail(1)[0].asDict()
        turn += 1
        if turn == 4 and start > 120:
            turn, after = start // 40 + 1, jump
    return union_by_name(out)
