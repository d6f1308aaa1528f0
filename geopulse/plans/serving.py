"""Reads a dashboard or analyst makes against the published tables."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geopulse.functions import hexgrid, scoring, timefns
from geopulse.operators import ranking
from geopulse.workspace import materialise

# Legend quantiles.
LEGEND = {"p50": 0.50, "p75": 0.75, "p90": 0.90, "p98": 0.98}
LEGEND_FALLBACK = {"p50": 1.0, "p75": 2.0, "p90": 3.0, "p98": 4.0}


def _lit(value: Column | date | str) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def _count(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("long")


def look_back(days: float | None) -> int | None:
    """Whole days to look back; ``None`` means all, anything that is not a finite number is an error."""
    if days is None:
        return None
    if isinstance(days, bool) or not isinstance(days, (int, float)) or not math.isfinite(days):
        raise ValueError(f"a look-back is a number of days, got {days!r}")
    return abs(int(days))


def since(df: DataFrame, day: str, days: float | None, asof: Column | date | str) -> DataFrame:
    back = look_back(days)
    return df if back is None else df.where(F.col(day) >= F.date_sub(_lit(asof), back))


# -- model pinning ----------------------------------------------------------


def current_model(predictions: DataFrame) -> DataFrame:
    """The version with the latest scoring time, as at most one row."""
    versions = predictions.groupBy("model_version").agg(
        F.max("scored_at").alias("scored_at"), F.count(F.lit(1)).alias("predictions")
    )
    return versions.orderBy(F.desc_nulls_last("scored_at"), "model_version").limit(1)


def pinned(predictions: DataFrame) -> DataFrame:
    """Predictions of the current version only, so joins do not multiply rows by version."""
    version = current_model(predictions).select("model_version").scalar()
    return predictions.where(F.col("model_version") == version)


def with_percentile(fire: DataFrame, predictions: DataFrame, how: str = "left") -> DataFrame:
    keys = ["region_id", "observation_date"]
    return fire.join(pinned(predictions).select(*keys, "anomaly_percentile"), keys, how)


# -- series -----------------------------------------------------------------


def anomalies(
    fire: DataFrame, predictions: DataFrame, asof: Column | date | str, *, days: float | None = None,
    region: str | None = None, only_anomalies: bool = False,
) -> DataFrame:
    rows = since(fire, "observation_date", days, asof)
    if region:
        rows = rows.where(F.col("region_id") == region)
    if only_anomalies:
        rows = rows.where("is_anomaly")
    return with_percentile(rows, predictions).select(
        "region_id", "observation_date", "detection_count", "zscore", "severity", "is_anomaly", "anomaly_percentile"
    )


def ice_trends(ice: DataFrame, asof: Column | date | str, days: float | None = None) -> DataFrame:
    return since(ice, "period_start", days, asof).select(
        "region_id", "period_start", "value", "baseline_mean", "baseline_source", "zscore", "severity", "is_anomaly"
    )


def regions(fire: DataFrame) -> DataFrame:
    return fire.select("region_id").distinct()


def seasonal_profile(fire: DataFrame) -> DataFrame:
    """Mean detections and flagged days per region and calendar month."""
    return fire.groupBy("region_id", F.month("observation_date").alias("month")).agg(
        F.avg("detection_count").alias("mean_detections"), _count(F.col("is_anomaly")).alias("flagged_days")
    )


REGIME_FEATURES = {
    "mean_detections": "detection_count",
    "night_share": "night_detection_share",
    "cell_concentration": "cell_concentration",
    "frp_per_detection": "frp_per_detection",
    "satellites": "satellite_count",
}


def regime_comparison(fire: DataFrame) -> DataFrame:
    """Flagged against unflagged active days, across the context features."""
    regime = F.when(F.col("is_anomaly"), "flagged").otherwise("unflagged")
    return (
        fire.where("detection_count > 0")
        .groupBy(regime.alias("regime"))
        .agg(F.count(F.lit(1)).alias("days"), *[F.avg(c).alias(name) for name, c in REGIME_FEATURES.items()])
    )


def regime_ratio(comparison: DataFrame) -> DataFrame:
    """One row per feature: its flagged and unflagged means and their ratio."""
    entries = F.array(
        *[F.struct(F.lit(name).alias("feature"), F.col(name).cast("double").alias("value")) for name in REGIME_FEATURES]
    )
    long = comparison.select("regime", F.explode(entries).alias("e"))
    sides = long.groupBy("e.feature").agg(
        F.max(F.when(F.col("regime") == "flagged", F.col("e.value"))).alias("flagged"),
        F.max(F.when(F.col("regime") == "unflagged", F.col("e.value"))).alias("unflagged"),
    )
    return sides.withColumn("ratio", F.when(F.col("unflagged") != 0, F.col("flagged") / F.col("unflagged")))


def region_summaries(fire: DataFrame) -> DataFrame:
    return fire.groupBy("region_id").agg(
        F.min("observation_date").alias("first_day"),
        F.max("observation_date").alias("last_day"),
        F.sum("detection_count").alias("total_detections"),
        F.max("detection_count").alias("peak"),
        _count(F.col("is_anomaly")).alias("flagged_days"),
        F.count(F.lit(1)).alias("days"),
        F.median("detection_count").alias("median"),
    )


def top_events(fire: DataFrame, k: int = 15) -> DataFrame:
    return (
        fire.where(F.col("zscore").isNotNull())
        .orderBy(F.desc("zscore"), "region_id", "observation_date")
        .limit(k)
        .select(
            "region_id", "observation_date", "detection_count", "zscore", "severity",
            "night_detection_share", "cell_concentration", "frp_per_detection",
        )
    )


def exceptions(rows: DataFrame, k: int = 10) -> DataFrame:
    """Strongest flagged days; a flag without a score counts as zero."""
    return (
        rows.where("is_anomaly")
        .orderBy(F.desc(F.coalesce("zscore", F.lit(0.0))), "region_id", "observation_date")
        .limit(k)
    )


def overview_kpis(rows: DataFrame) -> DataFrame:
    facts = rows.agg(
        F.coalesce(F.sum("detection_count"), F.lit(0)).cast("long").alias("total_detections"),
        F.count("zscore").alias("days_scored"),
        _count(F.col("is_anomaly")).alias("days_flagged"),
    )
    pct = F.when(F.col("days_scored") > 0, F.col("days_flagged") / F.col("days_scored") * 100.0).otherwise(0.0)
    return facts.withColumn("flagged_pct", pct)


def newest_reading(df: DataFrame, day: str, columns: Sequence[str]) -> DataFrame:
    return df.groupBy("region_id").agg(F.max(F.struct(day, *columns)).alias("n")).select("region_id", "n.*")


# -- map layer --------------------------------------------------------------


def window_filter(
    layer: DataFrame, start: Column | date | str, end: Column | date | str, *, grain: str = "day",
    region: str | None = None, fire: DataFrame | None = None,
) -> DataFrame:
    """Cells of a window; with ``fire``, only cells of regions and periods that were flagged.

    Flagged days are reduced to distinct (region, period) at the layer's own grain and applied as a
    semi join, so a cell is never repeated. Region ``all`` means every region.
    """
    low, high = _lit(start), _lit(end)
    if grain == "month":
        low, high = timefns.snap_to_months(low, high)
    rows = layer.where(F.col("period_start").between(low, high))
    if region and region != "all":
        rows = rows.where(F.col("region_id") == region)
    if fire is not None:
        period = F.trunc("observation_date", "month") if grain == "month" else F.col("observation_date")
        flagged = fire.where("is_anomaly").select("region_id", period.alias("period_start")).distinct()
        rows = rows.join(flagged, ["region_id", "period_start"], "left_semi")
    return rows


def densest_cells(cells: DataFrame, limit: int | None = None) -> DataFrame:
    """Cells to draw, densest first, all of them unless the caller names a limit.

    Totals and legend come from the whole window, not from this page.
    """
    ordered = cells.select(
        "h3_index", "region_id", "latitude", "longitude", "period_start", "metric_type", "spatial_scope", "value"
    ).orderBy(F.desc("value"), "h3_index", "period_start", "region_id")
    return ordered if limit is None else ordered.limit(limit)


def cell_activity(cells: DataFrame) -> DataFrame:
    return cells.groupBy("period_start").agg(F.count(F.lit(1)).alias("cells"), F.max("value").alias("peak"))


def busiest_period(activity: DataFrame) -> DataFrame:
    return activity.orderBy(F.desc("cells"), "period_start").limit(1)


def map_summary(cells: DataFrame, limit: int | None = None) -> DataFrame:
    """Legend breaks, domain, totals and whether the page is cut, as one row."""
    stats = ranking.nearest_rank_quantiles(cells, "value", LEGEND)
    return stats.select(
        *[F.coalesce(F.col(name), F.lit(LEGEND_FALLBACK[name])).alias(name) for name in LEGEND],
        F.coalesce("min_value", F.lit(0.0)).alias("domain_min"),
        F.coalesce("max_value", F.lit(0.0)).alias("domain_max"),
        F.col("n").alias("total_cells"),
        (F.lit(False) if limit is None else F.col("n") > limit).alias("truncated"),
    )


def coverage(layer: DataFrame) -> DataFrame:
    return layer.agg(F.min("period_start").alias("first_period"), F.max("period_start").alias("last_period"))


def map_window(
    layer: DataFrame, start: Column | date | str, end: Column | date | str, *, grain: str = "day",
    region: str | None = None, fire: DataFrame | None = None, limit: int | None = None,
) -> dict[str, DataFrame]:
    """The four answers of one map request; the filtered window is computed and written once for all."""
    cells = materialise(window_filter(layer, start, end, grain=grain, region=region, fire=fire), "window")
    return {
        "cells": densest_cells(cells, limit),
        "summary": map_summary(cells, limit),
        "activity": cell_activity(cells),
        "coverage": coverage(layer),
    }


def feature_rows(cells: DataFrame, summary: DataFrame) -> DataFrame:
    """Each cell as a GeoJSON feature with its legend step."""
    legend = summary.select(F.struct(*LEGEND)).scalar()
    breaks = [legend[name] for name in LEGEND]
    ring = F.transform(hexgrid.cell_boundary(F.col("h3_index")), lambda p: F.array(p["lon"], p["lat"]))
    properties = F.struct(
        "value", scoring.ramp_step(F.col("value"), breaks).alias("step"), F.col("region_id").alias("region"),
        F.col("metric_type").alias("metric"), F.col("period_start").cast("string").alias("period"),
        F.col("spatial_scope").alias("scope"),
    )
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), geometry.alias("geometry"))
    return cells.select("h3_index", "period_start", F.to_json(feature).alias("feature"))


def cells_by_region(layer: DataFrame) -> DataFrame:
    return layer.groupBy("region_id").agg(
        F.count(F.lit(1)).alias("cells"), F.max("value").alias("peak_cells"),
        F.round(F.avg("value"), 2).alias("mean_cells"),
    )


# -- catalogue, paging, stories ----------------------------------------------


def table_status(spark, tables: Mapping[str, tuple[DataFrame | None, str | None]]) -> DataFrame:
    """Presence, rows and date span of registered tables; an absent one is a row, not an error."""
    parts = []
    for name, (df, day) in tables.items():
        if df is None:
            empty = "table string, present boolean, rows bigint, first_value date, last_value date, columns int"
            parts.append(spark.createDataFrame([(name, False, None, None, None, 0)], empty))
            continue
        low = F.min(day).cast("date") if day else F.lit(None).cast("date")
        high = F.max(day).cast("date") if day else F.lit(None).cast("date")
        parts.append(
            df.agg(F.count(F.lit(1)).alias("rows"), low.alias("first_value"), high.alias("last_value")).select(
                F.lit(name).alias("table"), F.lit(True).alias("present"), "rows", "first_value", "last_value",
                F.lit(len(df.columns)).alias("columns"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def page(
    df: DataFrame, order: Sequence[Column], *, limit: int | None = None, offset: int = 0, region: str | None = None,
    day: str | None = None, days: float | None = None, asof: Column | date | str | None = None,
) -> DataFrame:
    """One page of a table in the given order, with the filtered total on every row; no limit means all rows."""
    rows = df
    if region:
        rows = rows.where(F.col("region_id") == region)
    if day and days is not None and asof is not None:
        rows = since(rows, day, days, asof)
    total = rows.agg(F.count(F.lit(1)).alias("n"))
    cut = rows.orderBy(*order)
    cut = cut.offset(offset) if offset > 0 else cut
    cut = cut if limit is None else cut.limit(limit)
    return cut.withColumn("total", total.scalar())


def page_after(
    df: DataFrame, keys: Sequence[tuple[str, bool]], after: Mapping[str, object] | None = None, *, limit: int = 50,
    region: str | None = None,
) -> DataFrame:
    """The next page behind a row, by its key: ``keys`` are ``(column, ascending)``, together unique, nulls last.

    ``after`` holds the key of the last row seen, none for the first page. A condition on the key replaces the rows before it, which
    reaches the scan, and no more than ``limit`` rows of a task travel: a page costs the same wherever it lies. ``left`` counts the rows behind the
    page's start, so a reader knows where it stands.
    """
    rows = df if region is None else df.where(F.col("region_id") == region)
    if after is not None:
        absent = [name for name, _ in keys if name not in after]
        if absent:
            raise KeyError(f"the key of a row needs {absent}")
        behind = F.lit(False)
        for name, ascending in reversed(list(keys)):
            value, column = after[name], F.col(name)
            same = column.isNull() if value is None else column == F.lit(value)
            # Nulls are the last of a column, so nothing follows one.
            later = F.lit(False) if value is None else F.coalesce(column > F.lit(value) if ascending else column < F.lit(value), F.lit(True))
            behind = later | (same & behind)
        rows = rows.where(behind)
    order = [F.asc_nulls_last(name) if ascending else F.desc_nulls_last(name) for name, ascending in keys]
    left = rows.agg(F.count(F.lit(1)).alias("n"))
    return rows.orderBy(*order).limit(limit).withColumn("left", left.scalar())


def key_at(df: DataFrame, keys: Sequence[tuple[str, bool]], place: int) -> dict[str, object] | None:
    """The key of the row at a 1-based place of the order of :func:`page_after`, to start behind it; none beyond the last row.

    An ordered limit with an offset would bring all rows before the place to the driver. Here the keys are range-partitioned and written with
    the number of their range; the driver sees one count a range, and only the range that holds the place is sorted.
    """
    if place < 1:
        return None
    names = [name for name, _ in keys]
    order = [F.asc_nulls_last(name) if ascending else F.desc_nulls_last(name) for name, ascending in keys]
    # written out, because range bounds come from sampling and the count and the sort must see the same ones
    ranged = materialise(df.select(*names).repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "places")
    left = place
    for part, n in sorted(tuple(r) for r in ranged.groupBy("_part").count().collect()):  # no more rows than shuffle partitions
        if left <= n:
            inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
            found = ranged.where(F.col("_part") == part).withColumn("_place", inside).where(F.col("_place") == left)
            return found.select(*names).first().asDict()
        left -= n
    return None


def window_facts(rows: DataFrame, windows: DataFrame, day: str, value: str, extras: Sequence[str] = ()) -> DataFrame:
    """Facts of named windows ``(slug, region_id, start, end, tail)``: the extreme day, span, flags, total.

    Windows are spread over their days and met by an equi-join on (region, day).
    """
    days = windows.select(
        "slug", "region_id", "tail", F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias(day)
    )
    joined = days.join(rows, ["region_id", day])
    signed = F.when(F.col("tail") == "lower", -F.col("zscore")).otherwise(F.col("zscore"))
    # among equal scores the earliest day stands for the window
    order = F.struct(F.coalesce(signed, F.lit(float("-inf"))).alias("z"), (-F.datediff(F.col(day), F.lit("1970-01-01"))).alias("d"))
    facts = joined.groupBy("slug").agg(
        F.count(F.lit(1)).alias("span_days"),
        _count(F.col("is_anomaly")).alias("flagged_days"),
        F.sum(value).cast("double").alias("total"),
        F.max_by(F.struct(F.col(day).alias("peak_date"), F.col(value).alias("peak"), "zscore", *extras), order).alias("t"),
    )
    return windows.select("slug", "region_id").join(facts, "slug", "left").select(
        "slug", "region_id", F.coalesce("span_days", F.lit(0)).alias("span_days"),
        F.coalesce("flagged_days", F.lit(0)).alias("flagged_days"), "total", "t.*",
    )


def paired_series(rows: DataFrame, day: str = "period_start", left: str = "value", right: str = "baseline_mean") -> DataFrame:
    """Contiguous stretches of rows where both series are present, numbered within each region."""
    order = Window.partitionBy("region_id").orderBy(day)
    complete = F.col(left).isNotNull() & F.col(right).isNotNull() & ~F.isnan(left) & ~F.isnan(right)
    numbered = rows.withColumn("_pos", F.row_number().over(order)).where(complete)
    island = F.col("_pos") - F.row_number().over(order)
    runs = numbered.withColumn("_island", island).groupBy("region_id", "_island").agg(
        F.min(day).alias("first_period"), F.max(day).alias("last_period"), F.count(F.lit(1)).alias("points"),
        F.min(F.least(left, right)).alias("low"), F.max(F.greatest(left, right)).alias("high"),
    )
    return runs.drop("_island")


# -- stock analyst queries ----------------------------------------------------


def worst_days(fire: DataFrame, k: int = 15) -> DataFrame:
    ordered = fire.orderBy(F.desc_nulls_last("zscore"), "region_id", "observation_date").limit(k)
    return ordered.select("region_id", "observation_date", "detection_count", F.round("zscore", 1).alias("z"), "severity")


def month_anomalies(fire: DataFrame, month: int = 2) -> DataFrame:
    rows = fire.where((F.month("observation_date") == month) & F.col("is_anomaly"))
    return rows.select("region_id", "observation_date", "detection_count", F.round("zscore", 1).alias("z"))


def rule_vs_model(fire: DataFrame, predictions: DataFrame, k: int = 15) -> DataFrame:
    joined = with_percentile(fire.where("is_anomaly"), predictions, "inner").select(
        "region_id", "observation_date", "detection_count", F.round("zscore", 1).alias("rule_z"),
        F.round("anomaly_percentile", 3).alias("model_pct"), "severity",
    )
    return joined.orderBy(F.asc_nulls_last("model_pct"), "region_id", "observation_date").limit(k)


def below_normal(ice: DataFrame, k: int = 12) -> DataFrame:
    rows = ice.where("baseline_mean is not null and value is not null")
    ordered = rows.orderBy(F.asc_nulls_last("zscore"), "region_id", "period_start").limit(k)
    return ordered.select(
        "region_id", "period_start", F.round("value", 2).alias("extent"),
        F.round("baseline_mean", 2).alias("normal"), F.round("zscore", 2).alias("z"),
    )
