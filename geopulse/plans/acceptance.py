"""Acceptance of a finished build: planted events are caught, and little else is flagged."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geopulse.operators.dedup import union_by_name

# What a planted event must exceed, and the ceiling on flagged days.
FIRE_SPIKE = 40
NDVI_CRASH = -0.3
ICE_EXCURSION_Z = -3.0
MARINE_HEAT = 2.5
MAX_FLAG_RATE = 0.02
REQUIRED_MARTS = ("fire_anomalies", "ice_extent_trends", "cell_fire", "cell_sst")


def planted_hits(name: str, df: DataFrame, condition: Column) -> DataFrame:
    hits = F.count_if(F.coalesce(condition, F.lit(False)))
    return df.agg(hits.alias("hits")).select(F.lit(name).alias("check"), "hits", (F.col("hits") > 0).alias("passed"))


def flag_rate_ceiling(fire: DataFrame, ceiling: float = MAX_FLAG_RATE) -> DataFrame:
    facts = fire.agg(
        F.count("zscore").alias("scored"), F.count_if(F.coalesce("is_anomaly", F.lit(False))).alias("flagged")
    )
    rate = F.when(F.col("scored") > 0, F.col("flagged") / F.col("scored")).otherwise(0.0)
    return facts.withColumn("rate", rate).withColumn("passed", (F.col("scored") > 0) & (F.col("rate") <= ceiling))


def populated(marts: Mapping[str, DataFrame]) -> DataFrame:
    return union_by_name(
        [
            df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("mart"), "rows", (F.col("rows") > 0).alias("populated")
            )
            for name, df in marts.items()
        ]
    )


def acceptance(marts: Mapping[str, DataFrame]) -> DataFrame:
    """Every check of a build as ``check, hits, passed``; marts absent by design are skipped."""
    parts = []
    if "fire_anomalies" in marts:
        fire = marts["fire_anomalies"]
        parts.append(planted_hits("fire_spike_detected", fire, F.col("is_anomaly") & (F.col("detection_count") >= FIRE_SPIKE)))
        parts.append(
            flag_rate_ceiling(fire).select(F.lit("fire_flag_rate_is_selective").alias("check"), F.col("flagged").alias("hits"), "passed")
        )
    if "deforestation_index" in marts:
        drop = F.col("is_anomaly") & (F.col("ndvi_change") <= NDVI_CRASH)
        parts.append(planted_hits("ndvi_crash_detected", marts["deforestation_index"], drop))
    if "ice_extent_trends" in marts:
        excursion = F.col("is_anomaly") & (F.col("zscore") <= ICE_EXCURSION_Z)
        parts.append(planted_hits("ice_excursion_detected", marts["ice_extent_trends"], excursion))
    if "cell_sst" in marts:
        heat = (F.col("metric_type") == "sst_anomaly") & (F.col("value") >= MARINE_HEAT)
        parts.append(planted_hits("marine_heatwave_present", marts["cell_sst"], heat))
    required = {name: marts[name] for name in REQUIRED_MARTS if name in marts}
    counts = populated(required).agg(F.count_if(F.col("populated")).alias("hits"))
    full = (F.col("hits") == len(REQUIRED_MARTS)).alias("passed")
    parts.append(counts.select(F.lit("marts_are_populated").alias("check"), "hits", full))
    return union_by_name(parts)
