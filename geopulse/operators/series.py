"""Dense series, daily and monthly aggregates, seasonal and year-over-year baselines."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geopulse.config import DEFAULTS


def date_bounds(df: DataFrame, day: str = "observation_date") -> DataFrame:
    return df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def dense_spine(regions: DataFrame, bounds: DataFrame, out: str = "observation_date") -> DataFrame:
    """Every region on every day between the one-row bounds ``(first_day, last_day)``."""
    span = bounds.select(F.struct("first_day", "last_day")).scalar()
    days = F.sequence(span["first_day"], span["last_day"], F.expr("interval 1 day"))
    return regions.select("region_id", F.explode(days).alias(out))


def _count_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("long")


def detection_facts(detections: DataFrame) -> DataFrame:
    """Detections pre-aggregated by (region, day, cell, satellite).

    Daily figures, cell counts and distinct counts are all built from this table, so the raw rows
    are shuffled once, already combined on the map side. Write it out before using it twice.
    """
    return detections.groupBy("region_id", "observation_date", "h3_index", "satellite").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("frp").alias("frp_sum"),
        F.max("frp").alias("frp_max"),
        F.count("frp").alias("frp_n"),
        _count_where(F.col("confidence") == "high").alias("high_n"),
        F.sum("confidence_pct").alias("pct_sum"),
        F.count("confidence_pct").alias("pct_n"),
        _count_where(F.col("daynight") == "N").alias("night_n"),
        F.min(F.struct("latitude", "longitude")).alias("point"),
    )


def _cells(facts: DataFrame) -> DataFrame:
    return facts.groupBy("region_id", "observation_date", "h3_index").agg(
        F.sum("n").alias("n"),
        F.sum("frp_sum").alias("frp_sum"),
        F.max("frp_max").alias("frp_max"),
        F.sum("frp_n").alias("frp_n"),
        F.sum("high_n").alias("high_n"),
        F.sum("pct_sum").alias("pct_sum"),
        F.sum("pct_n").alias("pct_n"),
        F.sum("night_n").alias("night_n"),
        F.min("point").alias("point"),
    )


def daily_cell(facts: DataFrame) -> DataFrame:
    """Sparse counts per cell and day; the lowest coordinate stands for the cell."""
    return _cells(facts).select(
        "h3_index", "region_id", "observation_date",
        F.col("point.latitude").alias("latitude"), F.col("point.longitude").alias("longitude"),
        F.col("n").alias("detection_count"), "frp_sum", "frp_max",
        F.col("high_n").alias("high_confidence_count"),
        (F.col("pct_sum") / F.col("pct_n")).alias("confidence_pct_mean"),
    )


def densest_cell(facts: DataFrame) -> DataFrame:
    """Largest per-cell count of each region and day."""
    cells = facts.groupBy("region_id", "observation_date", "h3_index").agg(F.sum("n").alias("n"))
    return cells.groupBy("region_id", "observation_date").agg(F.max("n").alias("max_cell_detections"))


def _distinct(facts: DataFrame, column: str, out: str) -> DataFrame:
    keys = ["region_id", "observation_date"]
    return facts.select(*keys, column).distinct().groupBy(*keys).agg(F.count(column).alias(out))


def distinct_counts(facts: DataFrame) -> DataFrame:
    """Distinct cells and satellites per region and day, each through its own small distinct set."""
    cells = _distinct(facts, "h3_index", "h3_cell_count")
    return cells.join(_distinct(facts, "satellite", "satellite_count"), ["region_id", "observation_date"])


def daily_region(facts: DataFrame) -> DataFrame:
    """All figures of a region's day."""
    keys = ["region_id", "observation_date"]
    days = _cells(facts).groupBy(*keys).agg(
        F.sum("n").alias("detection_count"),
        F.count("h3_index").alias("h3_cell_count"),
        F.sum("high_n").alias("high_confidence_count"),
        F.sum("night_n").alias("night_detection_count"),
        F.max("n").alias("max_cell_detections"),
        F.sum("frp_sum").alias("frp_sum"),
        F.max("frp_max").alias("frp_max"),
        (F.sum("frp_sum") / F.sum("frp_n")).alias("frp_mean"),
        (F.sum("pct_sum") / F.sum("pct_n")).alias("confidence_pct_mean"),
    )
    return days.join(_distinct(facts, "satellite", "satellite_count"), keys)


ZERO_FILLED = (
    "detection_count", "h3_cell_count", "high_confidence_count", "night_detection_count",
    "satellite_count", "max_cell_detections",
)


def spine_join(spine: DataFrame, daily: DataFrame) -> DataFrame:
    """Left join of daily figures onto the spine: counts become 0, measured values stay null."""
    joined = spine.join(daily, ["region_id", "observation_date"], "left")
    return joined.select(
        "region_id", "observation_date",
        *[F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name) for name in ZERO_FILLED],
        "frp_sum", "frp_max", "frp_mean", "confidence_pct_mean",
    )


def dense_daily(daily: DataFrame, regions: DataFrame) -> DataFrame:
    """Daily figures with a row for every region and day of the span they cover."""
    return spine_join(dense_spine(regions, date_bounds(daily)), daily)


# -- seasonal ring ---------------------------------------------------------


def ring_slot(day: Column, offset: Column, ring: int = DEFAULTS.ring_days) -> Column:
    """Day-of-year slot an observation contributes to, on a ring that always has 366 slots."""
    return F.pmod(F.dayofyear(day) - 1 + offset + ring, F.lit(ring)) + 1


def ring_contributions(
    daily: DataFrame, value: str = "detection_count", halfwidth: int = DEFAULTS.ring_halfwidth
) -> DataFrame:
    """Frequency of every value in every ±halfwidth neighbourhood.

    The history is folded to (region, day slot, value) frequencies *before* the fan-out, so its
    size does not grow with the number of years.
    """
    slots = daily.groupBy("region_id", F.dayofyear("observation_date").alias("slot"), F.col(value).alias("value")).agg(
        F.count(F.lit(1)).alias("freq")
    )
    offsets = F.explode(F.sequence(F.lit(-halfwidth), F.lit(halfwidth)))
    return (
        slots.select("region_id", "slot", "value", "freq", offsets.alias("day_offset"))
        .select(
            "region_id",
            (F.pmod(F.col("slot") - 1 + F.col("day_offset") + DEFAULTS.ring_days, F.lit(DEFAULTS.ring_days)) + 1)
            .alias("day_of_year"),
            "value", "freq",
        )
        .groupBy("region_id", "day_of_year", "value")
        .agg(F.sum("freq").alias("freq"))
    )


def baseline_years(daily: DataFrame, halfwidth: int = DEFAULTS.ring_halfwidth) -> DataFrame:
    """Distinct calendar years behind each day-of-year neighbourhood."""
    days = daily.select(
        "region_id", F.dayofyear("observation_date").alias("slot"), F.year("observation_date").alias("year")
    ).distinct()
    offsets = F.explode(F.sequence(F.lit(-halfwidth), F.lit(halfwidth)))
    return (
        days.select("region_id", "slot", "year", offsets.alias("day_offset"))
        .select(
            "region_id", "year",
            (F.pmod(F.col("slot") - 1 + F.col("day_offset") + DEFAULTS.ring_days, F.lit(DEFAULTS.ring_days)) + 1)
            .alias("day_of_year"),
        )
        .distinct()
        .groupBy("region_id", "day_of_year")
        .agg(F.count("year").alias("baseline_years"))
    )


_BASELINE = "day_of_year int, baseline_median double, baseline_mad double, baseline_scale double, baseline_samples long, baseline_years long"


def _middle(values: np.ndarray, counts: np.ndarray) -> float:
    """Median of sorted values that stand ``counts`` times each."""
    ends = np.cumsum(counts)
    if not len(ends) or not ends[-1]:
        return float("nan")
    low, high = np.searchsorted(ends, [(ends[-1] - 1) // 2, ends[-1] // 2], side="right")
    return 0.5 * values[low] + 0.5 * values[high]


def ring_statistics(
    slot: np.ndarray, value: np.ndarray, freq: np.ndarray, years: list[list[int]], halfwidth: int, ring: int = DEFAULTS.ring_days
) -> dict[str, list]:
    """Figures of every neighbourhood of a ring of day slots from one histogram that slides once around it.

    Each step adds the slot that comes into reach and takes away the one that leaves. Values may be NaN: they are samples without a value.
    """
    distinct, place = np.unique(value[~np.isnan(value)], return_inverse=True)
    at = np.full(len(value), len(distinct))
    at[~np.isnan(value)] = place
    labels = sorted({y for own in years for y in own})
    number = {y: i for i, y in enumerate(labels)}
    by_slot: list[list[int]] = [[] for _ in range(ring)]
    for i, s in enumerate((slot - 1).tolist()):
        by_slot[s].append(i)
    seen = np.zeros((ring, len(labels)), np.int64)
    for i, s in enumerate((slot - 1).tolist()):
        seen[s, [number[y] for y in years[i]]] = 1
    counts, held = np.zeros(len(distinct) + 1, np.int64), np.zeros(len(labels), np.int64)

    def move(s: int, sign: int) -> None:
        np.add.at(counts, at[by_slot[s]], sign * freq[by_slot[s]])
        held[:] += sign * seen[s]

    reach = range(-halfwidth, halfwidth + 1)
    for offset in reach:
        move(offset % ring, 1)
    out: dict[str, list] = {c.split()[0]: [] for c in _BASELINE.split(", ")}
    for centre in range(ring):
        if centre:
            move((centre - halfwidth - 1) % ring, -1)
            move((centre + halfwidth) % ring, 1)
        samples = int(counts.sum())
        if samples:
            own = np.flatnonzero(counts[:-1])
            median = _middle(distinct[own], counts[own])
            gaps = np.abs(distinct[own] - median)
            order = np.argsort(gaps, kind="stable")
            mad = _middle(gaps[order], counts[own][order])
            row = (centre + 1, median, mad, DEFAULTS.mad_to_sigma * mad, samples, int((held > 0).sum()))
            for name, x in zip(out, row, strict=True):
                out[name].append(x)
    return out


def seasonal_baseline(
    daily: DataFrame, value: str = "detection_count", halfwidth: int = DEFAULTS.ring_halfwidth
) -> DataFrame:
    """Median, MAD, scaled MAD, samples and years per region and day of year.

    History is folded to (region, day slot, value) first; a region's folded rows, no more than its days, meet once, and a histogram slides around
    the ring there. What is shuffled does not depend on the half-width.
    """
    folded = daily.groupBy("region_id", F.dayofyear("observation_date").alias("slot"), F.col(value).cast("double").alias("value")).agg(
        F.count(F.lit(1)).alias("freq"), F.collect_set(F.year("observation_date")).alias("years")
    )

    def slide(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = ring_statistics(
            rows["slot"].to_numpy(), rows["value"].to_numpy(float), rows["freq"].to_numpy(np.int64), rows["years"].tolist(), halfwidth
        )
        out = pd.DataFrame(found)
        out.insert(0, "region_id", key[0])
        return out

    kind = daily.schema["region_id"].dataType.simpleString()
    return folded.groupBy("region_id").applyInPandas(slide, f"region_id {kind}, {_BASELINE}")


def join_baseline(daily: DataFrame, baseline: DataFrame, day: str = "observation_date") -> DataFrame:
    """Left join on region and the day-of-year of each observation."""
    keyed = daily.withColumn("day_of_year", F.dayofyear(day))
    return keyed.join(baseline, ["region_id", "day_of_year"], "left").drop("day_of_year")


# -- monthly, year over year, climatology -----------------------------------


def monthly_region(composites: DataFrame) -> DataFrame:
    """Monthly figures of region-grain composites."""
    return (
        composites.where(F.col("spatial_scope") == "region")
        .groupBy("region_id", "metric_type", "month_start")
        .agg(
            F.avg("value_mean").alias("value_mean"),
            F.stddev_samp("value_mean").alias("value_stddev"),
            F.min("value_min").alias("value_min"),
            F.max("value_max").alias("value_max"),
            F.sum("observation_count").alias("observation_count"),
            F.avg("cloud_pct").alias("cloud_pct_mean"),
            F.count(F.lit(1)).alias("row_count"),
            F.min("latitude").alias("latitude"),
            F.min("longitude").alias("longitude"),
        )
    )


def year_over_year(monthly: DataFrame, calendar: bool = False) -> DataFrame:
    """Value twelve rows earlier and the change since.

    The default counts rows, so a missing month shifts the comparison; ``calendar=True`` joins on
    the exact month a year earlier instead.
    """
    keys = ["region_id", "metric_type"]
    if calendar:
        prior = monthly.select(
            *keys, F.add_months("month_start", 12).alias("month_start"), F.col("value_mean").alias("value_prior_year")
        )
        lagged = monthly.join(prior, [*keys, "month_start"], "left")
    else:
        # one row per month, so a series is as long as its calendar
        order = Window.partitionBy(*keys).orderBy("month_start")
        lagged = monthly.withColumn("value_prior_year", F.lag("value_mean", 12).over(order))
    return lagged.withColumn("value_change", F.col("value_mean") - F.col("value_prior_year"))


def change_stats(series: DataFrame, change: str = "value_change") -> DataFrame:
    """Mean, spread and number of the known changes of each region and metric."""
    return (
        series.where(F.col(change).isNotNull())
        .groupBy("region_id", "metric_type")
        .agg(
            F.avg(change).alias("change_mean"),
            F.stddev_samp(change).alias("change_stddev"),
            F.count(F.lit(1)).alias("change_samples"),
        )
    )


def climatology_normals(gridded: DataFrame) -> DataFrame:
    """Published normals: mean value and mean spread per region and day of year."""
    return (
        gridded.where(F.col("metric_type") == "sea_ice_extent_climatology")
        .groupBy("region_id", "day_of_year")
        .agg(
            F.avg("value").alias("clim_mean"),
            F.avg(F.coalesce(F.col("baseline_stddev"), F.lit(0.0))).alias("clim_stddev"),
        )
    )


def monthly_cell(gridded: DataFrame, metric: str = "sst_anomaly") -> DataFrame:
    return (
        gridded.where(F.col("metric_type") == metric)
        .groupBy("region_id", "h3_index", "month_start", "metric_type")
        .agg(
            F.min("latitude").alias("latitude"),
            F.min("longitude").alias("longitude"),
            F.avg("value").alias("value"),
        )
    )


def daily_metric(gridded: DataFrame, metric: str = "sst_anomaly") -> DataFrame:
    """Daily region mean of one metric."""
    return (
        gridded.where(F.col("metric_type") == metric)
        .groupBy("region_id", "observation_date")
        .agg(F.avg("value").alias("value"))
    )
