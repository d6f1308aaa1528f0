"""Thresholds and registries."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Thresholds:
    """Cut-offs of the scoring marts. Fixed values."""

    fire_z: float = 5.0
    ndvi_drop_z: float = -2.0
    ice_z: float = 2.5
    min_samples: int = 10
    fire_floor: float = 0.5
    ndvi_floor: float = 0.01
    ice_floor: float = 0.05
    climatology_years: int = 30
    mad_to_sigma: float = 1.4826
    ring_days: int = 366
    ring_halfwidth: int = 15


DEFAULTS = Thresholds()

# Severity ladders, strongest first.
FIRE_LADDER = (("extreme", 12.0), ("high", 8.0))
NDVI_LADDER = (("extreme", -4.0), ("high", -3.0))
ICE_LADDER = (("extreme", 4.0), ("high", 3.0))

# Freshness budgets in days per source and per mart.
SOURCE_BUDGET_DAYS = {"fire": 3, "composites": 45, "gridded": 10}
MART_BUDGET_DAYS = {
    "fire_anomalies": 3,
    "cell_fire": 3,
    "ice_extent_trends": 10,
    "cell_sst": 45,
    "deforestation_index": 45,
    "glacier_backscatter": 45,
    "cell_change": 45,
    "predictions": 10,
    "pipeline_runs": 30,
}
DEFAULT_BUDGET_DAYS = 30

# Study regions (id, name, anomaly type, west, south, east, north, resolution).
REGION_COLUMNS = ("region_id", "name", "anomaly_type", "west", "south", "east", "north", "h3_resolution")
REGIONS = (
    ("iberia_fire", "Iberian Peninsula", "fire", -10.0, 35.5, 3.5, 43.9, 7),
    ("greece_fire", "Greece & Aegean", "fire", 19.0, 34.4, 28.5, 41.8, 7),
    ("carpathian_deforest", "Romanian Carpathians", "deforestation", 21.0, 43.9, 27.6, 48.3, 7),
    ("alps_ice", "European Alps", "ice", 5.4, 43.7, 16.6, 48.3, 7),
    ("norway_ice", "Norway & Svalbard glaciers", "ice", 4.0, 58.0, 31.0, 80.5, 7),
    ("arctic", "Arctic sea ice", "ice", -180.0, 60.0, 180.0, 90.0, 5),
    ("antarctic", "Antarctic sea ice", "ice", -180.0, -90.0, 180.0, -55.0, 5),
)

# Bidding zones attributed to each study region.
ZONES = (
    ("greece_fire", "10YGR-HTSO-----Y"),
    ("iberia_fire", "10YES-REE------0"),
    ("iberia_fire", "10YPT-REN------W"),
    ("carpathian_deforest", "10YRO-TEL------P"),
    ("alps_ice", "10YAT-APG------L"),
    ("norway_ice", "10YNO-0--------C"),
)

# Upsert key of each published table, and the columns a republish must not blank. Cell layers hold a row for
# each region that a cell belongs to, so the region is part of their keys.
PUBLISH_KEYS = {
    "fire_anomalies": ("region_id", "observation_date"),
    "ice_extent_trends": ("region_id", "period_start"),
    "cell_fire": ("h3_index", "period_start", "metric_type", "region_id"),
    "cell_sst": ("h3_index", "period_start", "metric_type", "region_id"),
    "deforestation_index": ("region_id", "month_start"),
    "glacier_backscatter": ("region_id", "period_start"),
    "cell_change": ("h3_index", "period_start", "metric_type", "region_id"),
}
PREDICTION_KEY = ("region_id", "observation_date", "model_version")
MODEL_OWNED = ("anomaly_score", "model_version", "scored_at")

# Pipeline stages (id, run-history workflow, allowed age in hours).
STAGES = (
    ("collect", "collect_data", 8),
    ("store", "collect_data", None),
    ("transform", "transform", 30),
    ("train", "train_model", 216),
    ("score", "train_model", 216),
    ("serve", None, None),
)

# Documented events (region, first day, last day, recorded peak, expected).
KNOWN_EVENTS = (
    ("iberia_fire", "2025-08-15", "2025-08-17", 13329, True),
    ("greece_fire", "2025-08-12", "2025-08-13", 2005, True),
    ("iberia_fire", "2026-02-24", "2026-02-27", 1184, True),
    ("iberia_fire", "2026-07-03", "2026-07-03", 2238, True),
    ("greece_fire", "2024-09-30", "2024-09-30", 808, True),
    ("iberia_fire", "2025-07-26", "2025-07-26", 172, False),
)
RANK_THRESHOLD = 0.90
DATA_CHANGE_TOLERANCE = 0.6

# Named investigation windows (slug, region, first day, last day, tail).
INVESTIGATIONS = (
    ("august-2025-iberia", "iberia_fire", "2025-08-15", "2025-08-17", "upper"),
    ("february-2026-iberia", "iberia_fire", "2026-02-24", "2026-02-27", "upper"),
    ("antarctic-sea-ice-deficit", "antarctic", "2026-08-20", "2026-09-19", "lower"),
    ("greece-2024-autumn", "greece_fire", "2024-09-29", "2024-10-01", "upper"),
)

# Observation sources (id, label, metrics, anomaly types, cell resolution, cron).
SOURCES = (
    ("firms", "Active fire detections", ("fire_radiative_power", "brightness"), ("fire",), 7, "15 */6 * * *"),
    ("sentinel", "Vegetation index and radar backscatter composites", ("ndvi", "sar_backscatter"), ("deforestation", "ice"), 7, "30 3 * * *"),
    ("noaa_nsidc", "Sea-surface temperature anomaly and sea-ice index", ("sst_anomaly", "sea_ice_extent", "sea_ice_extent_climatology"), ("fire", "ice"), 5, "45 4 * * 1"),
    ("entsoe", "Day-ahead electricity price and actual load", ("day_ahead_price", "actual_load"), ("fire", "deforestation", "ice"), 7, "35 7 * * *"),
)

# Published tables (name, domain, sources, date column, internal).
TABLES = (
    ("fire_anomalies", "fire", ("firms",), "observation_date", False),
    ("cell_fire", "fire", ("firms",), "period_start", False),
    ("ice_extent_trends", "cryosphere", ("noaa_nsidc",), "period_start", False),
    ("cell_sst", "marine", ("noaa_nsidc",), "period_start", False),
    ("deforestation_index", "vegetation", ("sentinel",), "month_start", False),
    ("glacier_backscatter", "cryosphere", ("sentinel",), "period_start", False),
    ("cell_change", "vegetation", ("sentinel",), "period_start", False),
    ("predictions", "operations", ("firms", "sentinel", "noaa_nsidc"), "observation_date", True),
    ("pipeline_runs", "operations", (), "started_at", True),
    ("sources", "operations", (), None, True),
)
