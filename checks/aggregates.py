"""Aggregations, dense series, baselines and the marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import check
from geopulse.operators import series
from geopulse.plans import marts, staging

DAILY = "region_id observation_date:d detection_count:i h3_cell_count:i frp_sum:f frp_max:f frp_mean:f high_confidence_count:i confidence_pct_mean:f night_detection_count:i satellite_count:i"
DENSE = "region_id observation_date:d detection_count:i h3_cell_count:i high_confidence_count:i night_detection_count:i satellite_count:i max_cell_detections:i frp_sum:f frp_max:f frp_mean:f confidence_pct_mean:f"


@check("daily_region", DAILY + " max_cell_detections:i",
       "select * from daily_region join densest_cell using (region_id, observation_date)")
def _(t):
    return series.daily_region(t.facts)


@check("distinct_counts", "region_id observation_date:d h3_cell_count:i satellite_count:i", "select * from daily_region")
def _(t):
    return series.distinct_counts(t.facts)


@check("densest_cell", "region_id observation_date:d max_cell_detections:i", "select * from densest_cell")
def _(t):
    return series.densest_cell(t.facts)


@check("daily_cell", "h3_index region_id observation_date:d latitude:f longitude:f detection_count:i frp_sum:f frp_max:f high_confidence_count:i confidence_pct_mean:f",
       "select * from daily_cell")
def _(t):
    return series.daily_cell(t.facts)


@check("dense_spine", "region_id observation_date:d", "select * from spine")
def _(t):
    return series.dense_spine(t.region_dim, series.date_bounds(t.detections))


@check("spine_join", DENSE, "select * from daily")
def _(t):
    return series.dense_daily(series.daily_region(t.facts), t.region_dim)


@check("ring_contributions", "region_id day_of_year:i value:i freq:i",
       "select region_id, day_of_year, value, count(*) as freq from (select region_id, day_of_year, unnest(counts) as value from near_days) group by 1, 2, 3")
def _(t):
    return series.ring_contributions(t.daily)


@check("ring_slots", "region_id observation_date:d before:i after:i",
       """select region_id, observation_date, ((dayofyear(observation_date) - 1 - 15 + 366) % 366) + 1 as before,
          ((dayofyear(observation_date) - 1 + 15 + 366) % 366) + 1 as after from daily""")
def _(t):
    day = F.col("observation_date")
    return t.daily.select(
        "region_id", day, series.ring_slot(day, F.lit(-15)).alias("before"), series.ring_slot(day, F.lit(15)).alias("after")
    )


@check("baseline_years", "region_id day_of_year:i baseline_years:i", "select * from neighbourhood")
def _(t):
    return series.baseline_years(t.daily)


BASELINE = "region_id day_of_year:i baseline_median:f baseline_mad:f baseline_scale:f baseline_samples:i baseline_years:i"


@check("seasonal_baseline", BASELINE, "select * from baseline")
def _(t):
    return series.seasonal_baseline(t.daily)


@check("join_baseline", "region_id observation_date:d detection_count:i baseline_median:f baseline_scale:f baseline_samples:i",
       "select * from fire_scored")
def _(t):
    return series.join_baseline(t.daily, t.baseline)


MONTHLY = "region_id metric_type month_start:d value_mean:f value_stddev:f value_min:f value_max:f observation_count:i cloud_pct_mean:f row_count:i latitude:f longitude:f"


@check("monthly_region", MONTHLY, "select * from monthly")
def _(t):
    return series.monthly_region(t.composites)


@check("year_over_year", "region_id metric_type month_start:d value_prior_year:f value_change:f", "select * from yoy")
def _(t):
    return series.year_over_year(t.monthly)


@check("year_over_year_calendar", "region_id metric_type month_start:d value_prior_year:f value_change:f",
       """select m.region_id, m.metric_type, m.month_start, p.value_mean as value_prior_year,
          m.value_mean - p.value_mean as value_change
          from monthly m left join monthly p on p.region_id = m.region_id and p.metric_type = m.metric_type
          and p.month_start = m.month_start - interval 12 month""")
def _(t):
    return series.year_over_year(t.monthly, calendar=True)


@check("change_stats", "region_id metric_type change_mean:f change_stddev:f change_samples:i", "select * from yoy_stats")
def _(t):
    return series.change_stats(series.year_over_year(t.monthly))


@check("join_change_stats", "region_id metric_type month_start:d value_change:f change_mean:f change_stddev:f change_samples:i",
       """select y.region_id, y.metric_type, y.month_start, y.value_change, s.change_mean, s.change_stddev, s.change_samples
          from yoy y left join yoy_stats s on s.region_id = y.region_id and s.metric_type = y.metric_type""")
def _(t):
    changes = series.year_over_year(t.monthly)
    return changes.join(series.change_stats(changes), ["region_id", "metric_type"], "left")


@check("climatology_normals", "region_id day_of_year:i clim_mean:f clim_stddev:f", "select * from normals")
def _(t):
    return series.climatology_normals(t.gridded)


@check("monthly_cell", "region_id h3_index month_start:d latitude:f longitude:f value:f",
       "select *, period_start as month_start from cell_sst")
def _(t):
    return series.monthly_cell(t.gridded)


@check("daily_metric", "region_id observation_date:d value:f", "select * from sst_daily")
def _(t):
    return series.daily_metric(t.gridded)


FIRE = (
    "region_id observation_date:d detection_count:i h3_cell_count:i high_confidence_count:i frp_sum:f frp_max:f frp_mean:f "
    "confidence_pct_mean:f night_detection_share:f cell_concentration:f frp_per_detection:f night_detection_count:i "
    "satellite_count:i max_cell_detections:i baseline_median:f baseline_mad:f baseline_scale:f baseline_samples:i "
    "baseline_years:i baseline_method zscore:f is_anomaly severity"
)


@check("fire_anomalies", FIRE, "select * from fire")
def _(t):
    return marts.fire_anomalies(staging.stg_detections(t.det_raw), t.region_dim)


@check("deforestation_index",
       "region_id month_start:d ndvi_mean:f ndvi_stddev:f ndvi_min:f ndvi_max:f ndvi_prior_year:f ndvi_change:f change_mean:f "
       "change_stddev:f change_samples:i change_zscore:f is_anomaly severity observation_count:i cloud_pct_mean:f",
       """select *, change_zscore <= -2 as is_anomaly,
          case when change_zscore is null then 'unknown' when change_zscore <= -4 then 'extreme'
               when change_zscore <= -3 then 'high' when change_zscore <= -2 then 'moderate' else 'normal' end as severity
          from (select y.region_id, y.month_start, y.value_mean as ndvi_mean, y.value_stddev as ndvi_stddev,
                       y.value_min as ndvi_min, y.value_max as ndvi_max, y.value_prior_year as ndvi_prior_year,
                       y.value_change as ndvi_change, s.change_mean, s.change_stddev, s.change_samples,
                       y.observation_count, y.cloud_pct_mean,
                       case when y.value_change is not null then (y.value_change - s.change_mean)
                            / greatest(coalesce(s.change_stddev, 0e0), 0.01e0) end as change_zscore
                from yoy y left join yoy_stats s on s.region_id = y.region_id and s.metric_type = y.metric_type
                where y.metric_type = 'ndvi')""")
def _(t):
    return marts.deforestation_index(t.composites)


@check("ice_extent_trends",
       "region_id period_start:d metric_type baseline_source value:f baseline_mean:f baseline_stddev:f baseline_samples:i "
       "latitude:f longitude:f zscore:f is_anomaly severity", "select * from ice")
def _(t):
    return marts.ice_extent_trends(t.gridded)


@check("glacier_backscatter",
       "region_id period_start:d metric_type baseline_source value:f baseline_mean:f baseline_stddev:f baseline_samples:i "
       "latitude:f longitude:f zscore:f is_anomaly severity",
       """select *, abs(zscore) >= 2.5 as is_anomaly,
          case when zscore is null then 'unknown' when abs(zscore) >= 4 then 'extreme' when abs(zscore) >= 3 then 'high'
               when abs(zscore) >= 2.5 then 'moderate' else 'normal' end as severity
          from (select y.region_id, y.month_start as period_start, y.metric_type, 'series_yoy' as baseline_source,
                       y.value_mean as value, s.change_mean as baseline_mean, s.change_stddev as baseline_stddev,
                       s.change_samples as baseline_samples, y.latitude, y.longitude,
                       case when y.value_change is not null and s.change_samples >= 10 then (y.value_change - s.change_mean)
                            / greatest(coalesce(s.change_stddev, 0e0), 0.05e0) end as zscore
                from yoy y left join yoy_stats s on s.region_id = y.region_id and s.metric_type = y.metric_type
                where y.metric_type = 'sar_backscatter')""")
def _(t):
    return marts.glacier_backscatter(t.composites)


LAYER = "source_id region_id h3_index latitude:f longitude:f period_start:d period_grain metric_type spatial_scope value:f"


@check("cell_fire", LAYER + " high_confidence_count:f", "select * from cells")
def _(t):
    return marts.cell_fire(t.facts)


@check("cell_sst", LAYER, "select * from cell_sst")
def _(t):
    return marts.cell_sst(t.gridded)


@check("cell_change", LAYER + " baseline_mean:f",
       """select 'sentinel' as source_id, region_id, h3_index, latitude, longitude, period_end as period_start,
          'week' as period_grain, metric_type, 'h3_res_' || split_part(h3_index, ':', 1) as spatial_scope, value_mean as value, baseline_mean
          from composites where spatial_scope = 'grid'""")
def _(t):
    return marts.cell_change(t.composites)
