"""Window functions, ranks, quantiles and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import check
from geopulse.operators import dedup, features, ranking
from geopulse.plans import ops, serving


@check("latest_wins", "product attempts:i corrected:i rows:i",
       """select product, count(distinct ingested_at) as attempts, count(*) filter (run_id like '%-1') as corrected, count(*) as rows
          from detections group by 1""")
def _(t):
    newest = dedup.latest_wins(
        t.det_raw, ["product", "acq_datetime", "latitude", "longitude"],
        [F.desc_nulls_last("ingested_at"), F.desc_nulls_last("run_id")],
    )
    per = newest.groupBy("product", "ingested_at").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.endswith("run_id", F.lit("-1"))).alias("c")
    )
    return per.groupBy("product").agg(
        F.count(F.lit(1)).alias("attempts"), F.sum("c").alias("corrected"), F.sum("n").alias("rows")
    )


@check("lags", "region_id observation_date:d count_lag1 count_lag2 count_lag3 count_lag7", "select * from trailing_figures")
def _(t):
    return features.lags(features.scoreable_days(t.fire))


@check("trailing_windows",
       "region_id observation_date:d count_mean_7:f count_std_7:f count_max_7 count_mean_14:f count_max_14 count_mean_30:f count_std_30:f zero_days_30",
       "select * from trailing_figures")
def _(t):
    return features.trailing_windows(features.scoreable_days(t.fire))


@check("lead_in", "region_id observation_date:d sst_anomaly_mean_7:f sst_anomaly_change_7:f",
       "select region_id, observation_date, last_week as sst_anomaly_mean_7, last_week - week_before as sst_anomaly_change_7 from sst_before")
def _(t):
    return features.lead_in(t.sst_daily)


@check("latest_run", "workflow started_at:t run_id status rows_written:i",
       """select * from runs qualify row_number() over (partition by workflow order by started_at desc, run_id desc) = 1""")
def _(t):
    return ops.latest_run(t.runs)


@check("newest_reading", "region_id period_start:d value:f zscore:f",
       """select region_id, period_start, value, zscore from ice
          qualify row_number() over (partition by region_id order by period_start desc) = 1""")
def _(t):
    return serving.newest_reading(t.ice, "period_start", ["value", "zscore"])


LINE = "l_orderkey l_linenumber l_partkey l_suppkey"


@check("cumulative_counts", "value:f n_equal:i n_upto:i n_total:i",
       """select l_extendedprice as value, count(*) as n_equal, cast(sum(count(*)) over (order by l_extendedprice) as bigint) as n_upto,
          cast(sum(count(*)) over () as bigint) as n_total from lineitem group by 1""")
def _(t):
    return ranking.cumulative_counts(t.read("lineitem"), "l_extendedprice")


@check("nearest_rank_quantiles", "min_value:f max_value:f n:i p50:f p75:f p90:f p98:f",
       """select min(v) as min_value, max(v) as max_value, count(*) as n,
          max(case when rn = cast(floor(n * 0.50e0) as bigint) + 1 then v end) as p50, max(case when rn = cast(floor(n * 0.75e0) as bigint) + 1 then v end) as p75,
          max(case when rn = cast(floor(n * 0.90e0) as bigint) + 1 then v end) as p90, max(case when rn = cast(floor(n * 0.98e0) as bigint) + 1 then v end) as p98
          from (select l_extendedprice as v, row_number() over (order by l_extendedprice) as rn, count(*) over () as n from lineitem)""")
def _(t):
    return ranking.nearest_rank_quantiles(t.read("lineitem"), "l_extendedprice", serving.LEGEND)


@check("linear_quantiles", "n:i p1:f p50:f p99:f",
       """select count(*) as n, quantile_cont(l_extendedprice, 0.01) as p1, quantile_cont(l_extendedprice, 0.5) as p50,
          quantile_cont(l_extendedprice, 0.99) as p99 from lineitem""")
def _(t):
    return ranking.linear_quantiles(t.read("lineitem"), "l_extendedprice", {"p1": 0.01, "p50": 0.5, "p99": 0.99})


@check("percentile_rank", LINE + " percentile:f",
       "select l_orderkey, l_linenumber, l_partkey, l_suppkey, cume_dist() over (order by l_quantity) as percentile from lineitem")
def _(t):
    return ranking.percentile_rank(t.read("lineitem"), "l_quantity")


@check("foreign_percentile_rank", "o_orderkey percentile:f",
       """with r as (select l_extendedprice as v, count(*) as c from lineitem group by 1),
          cum as (select v, cast(sum(c) over (order by v) as bigint) as upto, cast(sum(c) over () as bigint) as n from r)
          select o_orderkey, greatest(coalesce(upto, 0), 1) / cast((select max(n) from cum) as double) as percentile
          from orders asof left join cum on orders.o_totalprice >= cum.v""")
def _(t):
    return ranking.foreign_percentile_rank(t.read("lineitem"), "l_extendedprice", t.read("orders"), "o_totalprice")


EVENT = "region_id observation_date:d detection_count:i zscore:f severity"


@check("top_events", EVENT,
       """select * from fire where zscore is not null order by zscore desc, region_id, observation_date limit 15""")
def _(t):
    return serving.top_events(t.fire)


@check("exceptions", EVENT,
       """select * from fire where is_anomaly order by coalesce(zscore, 0) desc, region_id, observation_date limit 10""")
def _(t):
    return serving.exceptions(t.fire)


@check("densest_cells", "h3_index region_id period_start:d value:f",
       "select * from cells order by value desc, h3_index, period_start, region_id")
def _(t):
    return serving.densest_cells(t.cells)


@check("page", "region_id observation_date:d detection_count:i total:i",
       """select *, (select count(*) from fire) as total from fire
          order by observation_date desc, region_id limit 50 offset 100""")
def _(t):
    return serving.page(t.fire, [F.desc("observation_date"), F.col("region_id")], limit=50, offset=100)


@check("run_log", "workflow status started_at:t duration_s:f rows_written:i failed_units:i",
       """select * from (select *, case when status = 'failed' then null else started_at end as s from runs)
          order by s desc nulls last, run_id limit 25""")
def _(t):
    late = t.runs.withColumn("_s", F.when(F.col("status") != "failed", F.col("started_at")))
    ranked = late.withColumn("real", F.col("started_at")).withColumn("started_at", F.col("_s"))
    return ops.run_log(ranked)
