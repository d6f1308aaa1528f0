"""A source as its parts: a reader, a normaliser and a contract. A new source is a new value, not new code paths."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from geopulse.contracts import DETECTIONS, Contract, conform, enrich, require_valid
from geopulse.operators.regions import add_cell_index
from geopulse.sources import detections, lake


@dataclass(frozen=True)
class Source:
    name: str
    read: Callable[[SparkSession, str], DataFrame]
    normalise: Callable[[DataFrame], DataFrame]
    contract: Contract
    time_col: str
    metric_type: str
    resolution: int

    def prepare(
        self, raw: DataFrame, run_id: str | Column, ingested_at: Column, regions: DataFrame | None = None
    ) -> DataFrame:
        """Raw rows to landing rows: normalised, conformed, validated as a whole, placed in cells and regions, stamped."""
        rows = require_valid(conform(self.normalise(raw), self.contract), self.contract)
        return enrich(add_cell_index(rows, self.resolution, regions), self.name, self.metric_type, run_id, ingested_at)

    def ingest(
        self, spark: SparkSession, location: str, root: str, run_id: str | Column, ingested_at: Column, *,
        regions: DataFrame | None = None, backfill: bool = False,
    ) -> str:
        """Read a location, prepare it and land it; nothing lands when a row breaks the contract."""
        rows = self.prepare(self.read(spark, location), run_id, ingested_at, regions)
        return lake.land(rows, root, self.name, self.time_col, backfill=backfill)


def detections_source(name: str, product: str, resolution: int) -> Source:
    """Point detections delivered as headered CSV."""
    return Source(
        name, lambda spark, path: detections.read_detections_csv(spark, path, product), detections.normalise, DETECTIONS,
        "acq_datetime", "fire_radiative_power", resolution,
    )
