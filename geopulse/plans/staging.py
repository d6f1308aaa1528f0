"""Typed, deduplicated staging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from geopulse.contracts import COMPOSITES, DETECTIONS, GRIDDED, conform
from geopulse.functions.detections import first_number
from geopulse.functions.timefns import month_start, utc_date
from geopulse.operators.dedup import latest_wins


def _number(name: str) -> Column:
    return F.col(name).cast("double").alias(name)


def _stamp(df: DataFrame, name: str, out: str | None = None) -> Column:
    """A timestamp column; text that does not read as one becomes null."""
    column = F.col(name)
    if not isinstance(df.schema[name].dataType, (TimestampType, TimestampNTZType)):
        column = column.cast("string").try_cast("timestamp")
    return column.cast("timestamp").alias(out or name)


def _newest_first() -> list[Column]:
    return [F.desc_nulls_last("ingested_at"), F.desc_nulls_last("run_id")]


def type_detections(raw: DataFrame) -> DataFrame:
    """Typed projection; rows without a region or a readable time are dropped."""
    raw = conform(raw, DETECTIONS)
    brightness = first_number(F.col("bright_ti4"), F.col("brightness"))
    typed = raw.where(F.col("region_id").isNotNull()).select(
        _stamp(raw, "acq_datetime", "observed_at"), _number("latitude"), _number("longitude"),
        "h3_index", "region_id", "product", "confidence", _number("confidence_pct"), _number("frp"),
        brightness.alias("brightness_k"), "daynight", "satellite", "instrument",
        _stamp(raw, "ingested_at"), "run_id",
    )
    return typed.where(F.col("observed_at").isNotNull())


def stg_detections(raw: DataFrame) -> DataFrame:
    """Detections, newest copy of each (product, time, position)."""
    newest = latest_wins(type_detections(raw), ["observed_at", "latitude", "longitude", "product"], _newest_first())
    return newest.withColumn("observation_date", utc_date(F.col("observed_at")))


def type_gridded(raw: DataFrame) -> DataFrame:
    raw = conform(raw, GRIDDED)
    typed = raw.where(F.col("region_id").isNotNull()).select(
        _stamp(raw, "timestamp", "observed_at"), _number("latitude"), _number("longitude"),
        "h3_index", "region_id", "metric_type", "product",
        F.coalesce("spatial_scope", F.lit("gridded")).alias("spatial_scope"),
        _number("value"), "unit", _number("baseline_stddev"),
        F.col("day_of_year").cast("string").try_cast("double").cast("int").alias("day_of_year"),
        _stamp(raw, "ingested_at"), "run_id",
    )
    return typed.where(F.col("observed_at").isNotNull())


def stg_gridded(raw: DataFrame) -> DataFrame:
    """Gridded and index rows, newest copy of each (metric, region, time, position, day of year)."""
    keys = ["observed_at", "latitude", "longitude", "metric_type", "region_id", "day_of_year"]
    newest = latest_wins(type_gridded(raw), keys, _newest_first())
    stamp = F.col("observed_at")
    return newest.withColumns({"observation_date": utc_date(stamp), "month_start": month_start(stamp)})


def type_composites(raw: DataFrame) -> DataFrame:
    raw = conform(raw, COMPOSITES)
    # columns that change together stand together, and those that differ in every row stand last: rows next to each other compress better
    typed = raw.where(F.col("region_id").isNotNull()).select(
        _stamp(raw, "window_start"), _stamp(raw, "window_end"), "product", "metric_type",
        F.coalesce("spatial_scope", F.lit("region")).alias("spatial_scope"), "region_id",
        F.col("mean").cast("double").alias("value_mean"),
        F.col("min").cast("double").alias("value_min"),
        F.col("max").cast("double").alias("value_max"),
        _number("recent_mean"), _number("baseline_mean"),
        F.col("stddev").cast("double").alias("value_stddev"),
        F.col("observation_count").cast("string").try_cast("bigint").alias("observation_count"),
        _number("cloud_pct"), _stamp(raw, "ingested_at"), _number("latitude"), _number("longitude"), "h3_index", "run_id",
    )
    return typed.where(F.col("window_end").isNotNull())


def stg_composites(raw: DataFrame) -> DataFrame:
    """Composites, newest copy of each (metric, scope, window end, cell)."""
    newest = latest_wins(
        type_composites(raw), ["window_end", "h3_index", "metric_type", "spatial_scope"], _newest_first()
    )
    stamp = F.col("window_end")
    return newest.withColumns({"period_end": utc_date(stamp), "month_start": month_start(stamp)})
