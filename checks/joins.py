"""Joins, set operations and keyed upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import check
from geopulse.config import MODEL_OWNED
from geopulse.operators import dedup, features, upsert
from geopulse.plans import serving

# -- joins ----------------------------------------------------------------------


@check("join_precursor", "region_id observation_date:d sst_anomaly_mean_7:f sst_anomaly_change_7:f",
       "select region_id, observation_date, sst_anomaly_mean_7, sst_anomaly_change_7 from feature_table")
def _(t):
    return features.join_precursor(features.scoreable_days(t.fire), t.sst_daily)


@check("flagged_semi_join", "h3_index region_id period_start:d value:f",
       """select c.h3_index, c.region_id, c.period_start, c.value from cells c
          where exists (select 1 from fire f where f.region_id = c.region_id and f.is_anomaly and f.observation_date = c.period_start)""")
def _(t):
    return serving.window_filter(t.cells, "1990-01-01", "2010-01-01", fire=t.fire)


@check("flagged_semi_join_monthly", "h3_index region_id period_start:d value:f",
       """select c.h3_index, c.region_id, c.period_start, c.value from cell_sst c
          where exists (select 1 from fire f where f.region_id = c.region_id and f.is_anomaly
                        and cast(date_trunc('month', f.observation_date) as date) = c.period_start)""")
def _(t):
    from geopulse.plans import marts

    return serving.window_filter(marts.cell_sst(t.gridded), "1990-01-05", "2010-01-05", grain="month", fire=t.fire)


@check("pinned_predictions", "region_id observation_date:d zscore:f anomaly_percentile:f",
       """select f.region_id, f.observation_date, f.zscore, p.anomaly_percentile from fire f
          left join predictions p on p.region_id = f.region_id and p.observation_date = f.observation_date
          and p.model_version = (select model_version from predictions group by 1 order by max(scored_at) desc limit 1)""")
def _(t):
    return serving.with_percentile(t.fire, t.predictions)


@check("current_model", "model_version scored_at:t predictions:i",
       """select model_version, max(scored_at) as scored_at, count(*) as predictions from predictions
          group by 1 order by 2 desc limit 1""")
def _(t):
    return serving.current_model(t.predictions)


# -- set operations ----------------------------------------------------------------


@check("union_by_name", "k:i kind price:f balance:f",
       """select o_orderkey as k, 'order' as kind, o_totalprice as price, null as balance from orders
          union all select c_custkey, 'customer', null, c_acctbal from customer
          union all select s_suppkey, 'supplier', null, s_acctbal from supplier""")
def _(t):
    return dedup.union_by_name(
        [
            t.read("orders").select(F.col("o_orderkey").alias("k"), F.lit("order").alias("kind"), F.col("o_totalprice").alias("price")),
            t.read("customer").select(F.col("c_custkey").alias("k"), F.lit("customer").alias("kind"), F.col("c_acctbal").alias("balance")),
            t.read("supplier").select(F.col("s_suppkey").alias("k"), F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("balance")),
        ]
    )


@check("concat_fetches", "region_id metric_type rows:i with_normal:i",
       """select region_id, metric_type, count(*) as rows, count(baseline_stddev) as with_normal from grid_raw group by 1, 2""")
def _(t):
    metric = F.col("metric_type")
    series = t.grid_raw.where(metric != "sea_ice_extent_climatology").drop("baseline_stddev", "day_of_year")
    normals = t.grid_raw.where(metric == "sea_ice_extent_climatology")
    both = dedup.union_by_name([series, normals])
    return both.groupBy("region_id", "metric_type").agg(
        F.count(F.lit(1)).alias("rows"), F.count("baseline_stddev").alias("with_normal")
    )


@check("distinct_regions", "region_id", "select distinct region_id from fire")
def _(t):
    return serving.regions(t.fire)


@check("drop_duplicates", "region_id acq_datetime:t latitude:f longitude:f product confidence frp:f bright_ti4:f brightness:f daynight satellite instrument ingested_at:t run_id h3_index",
       """select distinct region_id, acq_datetime, latitude, longitude, product, confidence, frp, bright_ti4, brightness, daynight,
          satellite, instrument, ingested_at, run_id, h3_index from det_raw""")
def _(t):
    # a fetch that delivered the second attempt again
    rows = t.det_raw.select(
        "region_id", "acq_datetime", "latitude", "longitude", "product", "confidence", "frp", "bright_ti4", "brightness",
        "daynight", "satellite", "instrument", "ingested_at", "run_id", "h3_index", "attempt",
    )
    return dedup.union_by_name([rows, rows.where("attempt = 1")]).drop("attempt").dropDuplicates()


ARCHIVES = """(select o_orderkey as k, o_custkey % 97 as w, o_totalprice as v, case when o_orderstatus = 'F' then 'sp' else 'nrt' end as product from orders)"""


def archives(t):
    rows = t.read("orders").select(
        F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 97).alias("w"), F.col("o_totalprice").alias("v"),
        F.when(F.col("o_orderstatus") == "F", "sp").otherwise("nrt").alias("product"),
    )
    return rows.where("product = 'sp'"), rows.where("product = 'nrt'")


@check("prefer_archive", "k:i w:i v:f product",
       f"""with a as {ARCHIVES} select * from a where product = 'sp'
          union all select * from a where product = 'nrt' and w not in (select w from a where product = 'sp')""")
def _(t):
    return dedup.prefer_archive(*archives(t), ["w"])


@check("uncovered_windows", "w:i",
       f"""with a as {ARCHIVES} select w from (select distinct c_custkey % 151 as w from customer) where w not in (select w from a)""")
def _(t):
    windows = t.read("customer").select((F.col("c_custkey") % 151).alias("w")).distinct()
    return dedup.uncovered_windows(windows, *archives(t), ["w"])


# -- upsert ---------------------------------------------------------------------------

# published: days before 2000 already carry model columns; incoming: days from 1999 on, with one new column
PUBLISHED = """(select region_id, observation_date, detection_count, cast(detection_count as double) / 7 as anomaly_score,
  'forest:old' as model_version, timestamp '2000-01-01' as scored_at from daily where observation_date < date '2000-01-01')"""
INCOMING = """(select region_id, observation_date, detection_count + 1 as detection_count, frp_max
  from daily where observation_date >= date '1999-01-01')"""


def published(t):
    return t.daily.where("observation_date < date '2000-01-01'").select(
        "region_id", "observation_date", "detection_count", (F.col("detection_count") / 7).alias("anomaly_score"),
        F.lit("forest:old").alias("model_version"), F.lit("2000-01-01").cast("timestamp").alias("scored_at"),
    )


def incoming(t):
    null = lambda kind: F.lit(None).cast(kind)
    return t.daily.where("observation_date >= date '1999-01-01'").select(
        "region_id", "observation_date", (F.col("detection_count") + 1).alias("detection_count"), "frp_max",
        null("double").alias("anomaly_score"), null("string").alias("model_version"), null("timestamp").alias("scored_at"),
    )


KEY = ["region_id", "observation_date"]


@check("upsert", "region_id observation_date:d detection_count:i frp_max:f model_version",
       f"""with p as {PUBLISHED}, i as {INCOMING}
          select region_id, observation_date, detection_count, null as frp_max, model_version from p
          where (region_id, observation_date) not in (select (region_id, observation_date) from i)
          union all select region_id, observation_date, detection_count, frp_max, null from i""")
def _(t):
    return upsert.upsert(published(t), incoming(t), KEY)


@check("upsert_protected", "region_id observation_date:d detection_count:i anomaly_score:f model_version scored_at:t",
       f"""with p as {PUBLISHED}, i as {INCOMING}
          select coalesce(i.region_id, p.region_id) as region_id, coalesce(i.observation_date, p.observation_date) as observation_date,
                 coalesce(i.detection_count, p.detection_count) as detection_count, p.anomaly_score, p.model_version, p.scored_at
          from p full join i on i.region_id = p.region_id and i.observation_date = p.observation_date""")
def _(t):
    return upsert.upsert(published(t), incoming(t), KEY, MODEL_OWNED)


@check("upsert_twice", "region_id rows:i total:i newer:i",
       f"""with p as {PUBLISHED}, i as {INCOMING}
          select coalesce(i.region_id, p.region_id) as region_id, count(*) as rows,
                 sum(coalesce(i.detection_count, p.detection_count)) as total, count(i.frp_max) as newer
          from p full join i on i.region_id = p.region_id and i.observation_date = p.observation_date group by 1""")
def _(t):
    once = upsert.upsert(published(t), incoming(t), KEY, MODEL_OWNED)
    twice = upsert.upsert(once, incoming(t), KEY, MODEL_OWNED)
    return twice.groupBy("region_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("detection_count").alias("total"), F.count("frp_max").alias("newer")
    )


# orders by customer, null for every third: the source repeats keys, and the latest order of each wins
REPEATED = """(select case when o_custkey % 3 = 0 then null else o_custkey % 97 end as k, o_orderkey as n, o_totalprice as v from orders)"""


def repeated(t, keep):
    k = F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey") % 97)
    return t.read("orders").where(keep).select(k.alias("k"), F.col("o_orderkey").alias("n"), F.col("o_totalprice").alias("v"))


@check("upsert_repeated_and_null_keys", "k n v:f2",
       f"""select distinct k, max(n) over (partition by k) as n, arg_max(v, n) over (partition by k) as v from {REPEATED}""")
def _(t):
    first = upsert.upsert(repeated(t, "false"), repeated(t, "o_orderkey % 2 = 0"), ["k"], order=["n"])
    late = dedup.union_by_name([first, repeated(t, "o_orderkey % 2 = 1")])
    once = upsert.upsert(first, late, ["k"], order=["n"])
    return upsert.upsert(once, late, ["k"], order=["n"])  # again, which must change nothing


@check("upsert_evolved", "region_id observation_date:d detection_count:i frp_max:f",
       f"""with p as {PUBLISHED}, i as {INCOMING}
          select coalesce(i.region_id, p.region_id) as region_id, coalesce(i.observation_date, p.observation_date) as observation_date,
                 coalesce(i.detection_count, p.detection_count) as detection_count, i.frp_max
          from p full join i on i.region_id = p.region_id and i.observation_date = p.observation_date""")
def _(t):
    return upsert.upsert(published(t).drop(*MODEL_OWNED), incoming(t).drop(*MODEL_OWNED), KEY)


@check("merge_period", "run_id region_id frp:f",
       """select i.run_id, i.region_id, i.frp from det_raw i where attempt = 1
          union all select d.run_id, d.region_id, d.frp from det_raw d where attempt = 0
          and (d.product, d.acq_datetime, d.latitude, d.longitude) not in
              (select (product, acq_datetime, latitude, longitude) from det_raw where attempt = 1)""")
def _(t):
    from geopulse.sources.lake import merge_period

    first, second = t.det_raw.where("attempt = 0"), t.det_raw.where("attempt = 1")
    return merge_period(first, second, ["product", "acq_datetime", "latitude", "longitude"])


@check("payload_profile", "column rows:i present:i all_null",
       f"""with i as {INCOMING}
          select 'region_id' as "column", count(*) as rows, count(region_id) as present, count(*) > 0 and count(region_id) = 0 as all_null from i
          union all select 'observation_date', count(*), count(observation_date), count(observation_date) = 0 from i
          union all select 'detection_count', count(*), count(detection_count), count(detection_count) = 0 from i
          union all select 'frp_max', count(*), count(frp_max), count(frp_max) = 0 from i
          union all select 'anomaly_score', count(*), 0, count(*) > 0 from i
          union all select 'model_version', count(*), 0, count(*) > 0 from i
          union all select 'scored_at', count(*), 0, count(*) > 0 from i""")
def _(t):
    return upsert.payload_profile(incoming(t))


@check("key_sanity", "table covers violations:i",
       " union all ".join(
           f"""select '{name}' as "table", true as covers, count(*) as violations from (select {key} from {source} group by {key} having count(*) > 1)"""
           for name, key, source in (
               ("fire_anomalies", "region_id, observation_date", "fire"), ("ice_extent_trends", "region_id, period_start", "ice"),
               ("cell_fire", "h3_index, period_start, metric_type, region_id", "cells"),
               ("cell_sst", "h3_index, period_start, metric_type, region_id", "cell_sst"),
               ("deforestation_index", "region_id, month_start", "(select * from yoy where metric_type = 'ndvi')"),
               ("glacier_backscatter", "region_id, month_start", "(select * from yoy where metric_type = 'sar_backscatter')"),
               ("cell_change", "h3_index, period_end, metric_type, region_id", "(select * from composites where spatial_scope = 'grid')"),
           )))
def _(t):
    from geopulse.config import PUBLISH_KEYS
    from geopulse.operators.expect import unique_combination
    from geopulse.plans import marts

    tables = {"fire_anomalies": t.fire, "cell_fire": t.cells} | {
        name: df for name, df in marts.build_marts(None, t.gridded, t.composites, t.region_dim).items()
    }
    grain = {"fire_anomalies": KEY, "ice_extent_trends": ["region_id", "period_start"], "deforestation_index": ["region_id", "month_start"],
             "glacier_backscatter": ["region_id", "period_start"]}
    parts = []
    for name, key in PUBLISH_KEYS.items():
        df, unique = tables[name], grain.get(name, ["h3_index", "period_start", "region_id"])
        upsert.check_key(df, key, name)
        bad = unique_combination(df, list(key)).agg(F.count(F.lit(1)).alias("violations"))
        parts.append(bad.select(F.lit(name).alias("table"), F.lit(upsert.key_covers(key, unique)).alias("covers"), "violations"))
    return dedup.union_by_name(parts)


@check("upsert_predictions", "region_id model_version rows:i flagged:i",
       """select region_id, model_version, count(*) as rows, cast(sum(case when is_anomaly then 1 else 0 end) as bigint) as flagged
          from predictions group by 1, 2""")
def _(t):
    from geopulse.config import PREDICTION_KEY

    old = t.predictions.where("model_version = 'forest:aaa'")
    table = upsert.upsert(upsert.upsert(old, t.predictions, PREDICTION_KEY), t.predictions, PREDICTION_KEY)
    return table.groupBy("region_id", "model_version").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("is_anomaly").cast("int")).alias("flagged")
    )


@check("run_records", "run_id status duration_s:f details",
       """select run_id, status, date_diff('second', started_at, finished_at) as duration_s,
          '{"workflow":"' || workflow || '","rows":' || rows_written || '}' as details from runs""")
def _(t):
    from geopulse.plans.ops import run_records

    details = F.struct("workflow", F.col("rows_written").alias("rows"))
    return run_records(t.runs.withColumn("details", details))
