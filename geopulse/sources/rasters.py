"""Reductions of pixel tables: masking, indices, zonal statistics, composites, change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Scene cloud ceiling, and the quality bits of opaque cloud and cirrus.
MAX_CLOUD_PCT = 60
CLOUD_BIT = 10
CIRRUS_BIT = 11


def clear_sky(qa: Column) -> Column:
    return (F.getbit(qa, F.lit(CLOUD_BIT)) == 0) & (F.getbit(qa, F.lit(CIRRUS_BIT)) == 0)


def mask_clouds(pixels: DataFrame, qa: str = "qa", cloud_pct: str = "cloud_pct") -> DataFrame:
    """Pixels of scenes under the cloud ceiling whose own quality bits are clear."""
    return pixels.where((F.col(cloud_pct) < MAX_CLOUD_PCT) & clear_sky(F.col(qa)))


def radar_scenes(pixels: DataFrame, mode: str = "mode", polarisations: str = "polarisations") -> DataFrame:
    """Wide-swath scenes whose polarisation list contains VV."""
    return pixels.where((F.col(mode) == "IW") & F.array_contains(polarisations, "VV"))


def ndvi(nir: Column, red: Column) -> Column:
    """Normalised difference, null where both bands are zero."""
    return F.when(nir + red != 0, (nir - red) / (nir + red))


def day_windows(windows: DataFrame) -> DataFrame:
    """Inclusive ``(window_start, window_end)`` windows spread over their days, for equi-joins."""
    days = F.sequence("window_start", "window_end", F.expr("interval 1 day"))
    return windows.select("window_start", "window_end", F.explode(days).alias("day"))


def zonal_stats(
    pixels: DataFrame, keys: Sequence[str], value: str = "value", population: bool = True
) -> DataFrame:
    """Mean, spread, count, min and max per zone and window."""
    spread = F.stddev_pop if population else F.stddev_samp
    return pixels.groupBy(*keys).agg(
        F.avg(value).alias("mean"),
        spread(value).alias("stddev"),
        F.count(value).alias("observation_count"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )


def composite_mean(pixels: DataFrame, windows: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Mean per key and window. Pixels are averaged per day first, so windows join small rows."""
    daily = pixels.groupBy(*keys, "day").agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    joined = daily.join(day_windows(windows), "day")
    return joined.groupBy(*keys, "window_start", "window_end").agg(
        (F.sum("_sum") / F.sum("_n")).alias("mean"), F.sum("_n").alias("observation_count")
    )


def composite_wide(composites: DataFrame, keys: Sequence[str], metric: str, window_ends: Sequence[str]) -> DataFrame:
    """One column per window end (``<metric>_<yyyymmdd>``)."""
    labelled = composites.withColumn("_band", F.concat(F.lit(f"{metric}_"), F.date_format("window_end", "yyyyMMdd")))
    bands = [f"{metric}_{end.replace('-', '')}" for end in window_ends]
    return labelled.groupBy(*keys).pivot("_band", bands).agg(F.first("mean"))


def grid_change(
    pixels: DataFrame, recent_start: Column, recent_end: Column, keys: Sequence[str] = ("region_id", "h3_index"),
    value: str = "value", day: str = "day",
) -> DataFrame:
    """Recent mean minus the mean 365 days earlier per cell, in one aggregate; cells lacking either drop out."""
    d = F.col(day)
    recent = d.between(recent_start, recent_end)
    baseline = d.between(F.date_sub(recent_start, 365), F.date_sub(recent_end, 365))
    means = pixels.where(recent | baseline).groupBy(*keys).agg(
        F.avg(F.when(recent, F.col(value))).alias("recent_mean"),
        F.avg(F.when(baseline, F.col(value))).alias("baseline_mean"),
    )
    return means.withColumn("mean", F.col("recent_mean") - F.col("baseline_mean")).where("mean is not null")
