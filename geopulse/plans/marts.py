"""The seven published marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geopulse.config import DEFAULTS, FIRE_LADDER, ICE_LADDER, NDVI_LADDER, Thresholds
from geopulse.functions import hexgrid, scoring
from geopulse.operators import series
from geopulse.workspace import materialise


def _model_columns() -> list[Column]:
    """Columns a scoring job fills later; a transform only reserves them."""
    return [
        F.lit(None).cast("double").alias("anomaly_score"),
        F.lit(None).cast("string").alias("model_version"),
        F.lit(None).cast("timestamp").alias("scored_at"),
    ]


def score_daily(daily: DataFrame, baseline: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Daily figures against their seasonal baseline."""
    joined = series.join_baseline(daily, baseline)
    z = scoring.zscore(
        F.col("detection_count"), F.col("baseline_median"), F.col("baseline_scale"), limits.fire_floor,
        F.col("baseline_samples") >= limits.min_samples,
    )
    count = F.col("detection_count")
    return joined.withColumn("zscore", z).select(
        "region_id", "observation_date", "detection_count", "h3_cell_count", "high_confidence_count",
        "frp_sum", "frp_max", "frp_mean", "confidence_pct_mean",
        scoring.safe_ratio(F.col("night_detection_count"), count).alias("night_detection_share"),
        scoring.safe_ratio(F.col("max_cell_detections"), count).alias("cell_concentration"),
        scoring.safe_ratio(F.col("frp_sum"), count).alias("frp_per_detection"),
        "night_detection_count", "satellite_count", "max_cell_detections",
        "baseline_median", "baseline_mad", "baseline_scale", "baseline_samples", "baseline_years",
        F.lit("median_mad").alias("baseline_method"), "zscore",
        scoring.is_anomaly(F.col("zscore"), limits.fire_z).alias("is_anomaly"),
        scoring.severity(F.col("zscore"), FIRE_LADDER, limits.fire_z).alias("severity"),
        *_model_columns(),
    )


def daily_table(facts: DataFrame, regions: DataFrame) -> DataFrame:
    """The dense region-by-day table, written out because the baseline reads it several times."""
    daily = materialise(series.daily_region(facts), "daily-region")
    return materialise(series.dense_daily(daily, regions), "daily")


def fire_anomalies(
    detections: DataFrame, regions: DataFrame, limits: Thresholds = DEFAULTS, facts: DataFrame | None = None
) -> DataFrame:
    """Daily detection anomalies per region, from staged detections (or their facts, if already written)."""
    if facts is None:
        facts = materialise(series.detection_facts(detections), "facts")
    daily = daily_table(facts, regions)
    return score_daily(daily, series.seasonal_baseline(daily), limits)


def _changes(composites: DataFrame, metric: str) -> DataFrame:
    """Monthly figures of one metric and their changes; a row a month, written, as the statistics of the changes read them too."""
    monthly = series.monthly_region(composites.where(F.col("metric_type") == metric))
    return series.year_over_year(materialise(monthly, "monthly"))


def deforestation_index(composites: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Monthly vegetation index with its year-over-year change scored on the lower tail."""
    monthly = _changes(composites, "ndvi")
    z = scoring.zscore(F.col("value_change"), F.col("change_mean"), F.col("change_stddev"), limits.ndvi_floor)
    scored = monthly.join(series.change_stats(monthly), ["region_id", "metric_type"], "left").withColumn("change_zscore", z)
    return scored.select(
        "region_id", "month_start", F.col("value_mean").alias("ndvi_mean"), F.col("value_stddev").alias("ndvi_stddev"),
        F.col("value_min").alias("ndvi_min"), F.col("value_max").alias("ndvi_max"),
        F.col("value_prior_year").alias("ndvi_prior_year"), F.col("value_change").alias("ndvi_change"),
        "change_mean", "change_stddev", "change_samples", "change_zscore",
        scoring.is_anomaly(F.col("change_zscore"), limits.ndvi_drop_z, "lower").alias("is_anomaly"),
        scoring.severity(F.col("change_zscore"), NDVI_LADDER, limits.ndvi_drop_z, "lower").alias("severity"),
        "observation_count", "cloud_pct_mean", *_model_columns(),
    )


def ice_extent_trends(gridded: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Daily extent against the published per-day normal, scored on both tails."""
    extent = gridded.where("metric_type = 'sea_ice_extent'").select(
        "region_id", "observation_date", "value", "latitude", "longitude"
    )
    joined = series.join_baseline(extent, series.climatology_normals(gridded))
    z = scoring.zscore(F.col("value"), F.col("clim_mean"), F.col("clim_stddev"), limits.ice_floor)
    return joined.withColumn("zscore", z).select(
        "region_id", F.col("observation_date").alias("period_start"), F.lit("sea_ice_extent").alias("metric_type"),
        F.lit("nsidc_climatology").alias("baseline_source"), "value",
        F.col("clim_mean").alias("baseline_mean"), F.col("clim_stddev").alias("baseline_stddev"),
        F.lit(limits.climatology_years).alias("baseline_samples"), "latitude", "longitude", "zscore",
        scoring.is_anomaly(F.col("zscore"), limits.ice_z, "both").alias("is_anomaly"),
        scoring.severity(F.col("zscore"), ICE_LADDER, limits.ice_z, "both").alias("severity"),
        *_model_columns(),
    )


def glacier_backscatter(composites: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Monthly backscatter scored against its own year-over-year changes on both tails."""
    monthly = _changes(composites, "sar_backscatter")
    z = scoring.zscore(
        F.col("value_change"), F.col("change_mean"), F.col("change_stddev"), limits.ice_floor,
        F.col("change_samples") >= limits.min_samples,
    )
    scored = monthly.join(series.change_stats(monthly), ["region_id", "metric_type"], "left").withColumn("zscore", z)
    return scored.select(
        "region_id", F.col("month_start").alias("period_start"), "metric_type",
        F.lit("series_yoy").alias("baseline_source"), F.col("value_mean").alias("value"),
        F.col("change_mean").alias("baseline_mean"), F.col("change_stddev").alias("baseline_stddev"),
        F.col("change_samples").alias("baseline_samples"), "latitude", "longitude", "zscore",
        scoring.is_anomaly(F.col("zscore"), limits.ice_z, "both").alias("is_anomaly"),
        scoring.severity(F.col("zscore"), ICE_LADDER, limits.ice_z, "both").alias("severity"),
        *_model_columns(),
    )


def _cell_layer(
    df: DataFrame, source: str, period: str, grain: str, metric: Column, scope: str,
    value: Column, high: Column, baseline: Column,
) -> DataFrame:
    return df.select(
        F.lit(source).alias("source_id"), "region_id", "h3_index", "latitude", "longitude",
        F.col(period).alias("period_start"), F.lit(grain).alias("period_grain"), metric.alias("metric_type"),
        # a cell of our own grid names its resolution; other ids keep what the source stands for
        F.when(hexgrid.is_valid_cell(F.col("h3_index")), F.concat(F.lit("h3_res_"), hexgrid.parts(F.col("h3_index"))[0].cast("string")))
        .otherwise(scope).alias("spatial_scope"), value.cast("double").alias("value"),
        high.cast("double").alias("high_confidence_count"), baseline.cast("double").alias("baseline_mean"),
    )


def cell_fire(facts: DataFrame) -> DataFrame:
    """Detections per cell and day, from detection facts."""
    return _cell_layer(
        series.daily_cell(facts), "firms", "observation_date", "day", F.lit("fire_detection_count"), "h3_res_7",
        F.col("detection_count"), F.col("high_confidence_count"), F.lit(None),
    )


def cell_sst(gridded: DataFrame) -> DataFrame:
    """Monthly surface temperature anomaly per cell."""
    return _cell_layer(
        series.monthly_cell(gridded), "noaa_nsidc", "month_start", "month", F.col("metric_type"), "h3_res_5",
        F.col("value"), F.lit(None), F.lit(None),
    )


def cell_change(composites: DataFrame) -> DataFrame:
    """Year-over-year change per cell, for composites computed at grid grain."""
    grid = composites.where("spatial_scope = 'grid'")
    return _cell_layer(
        grid, "sentinel", "period_end", "week", F.col("metric_type"), "h3_res_5",
        F.col("value_mean"), F.lit(None), F.col("baseline_mean"),
    )


def build_marts(
    detections: DataFrame | None, gridded: DataFrame | None, composites: DataFrame | None, regions: DataFrame
) -> dict[str, DataFrame]:
    """Marts of the staged sources that exist; an absent source removes only its own marts."""
    marts: dict[str, DataFrame] = {}
    if detections is not None:
        fire = regions.where("anomaly_type = 'fire'") if "anomaly_type" in regions.columns else regions
        facts = materialise(series.detection_facts(detections), "facts")
        marts["fire_anomalies"] = fire_anomalies(detections, fire, facts=facts)
        marts["cell_fire"] = cell_fire(facts)
    if gridded is not None:
        marts["ice_extent_trends"] = ice_extent_trends(gridded)
        marts["cell_sst"] = cell_sst(gridded)
    if composites is not None:
        marts["deforestation_index"] = deforestation_index(composites)
        marts["glacier_backscatter"] = glacier_backscatter(composites)
        marts["cell_change"] = cell_change(composites)
    return marts
