"""Landing contracts: declared columns, provenance, conforming and validation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geopulse.functions import hexgrid

# Canonical unit per metric, and verbatim labels that differ from it.
METRIC_UNITS = {
    "fire_radiative_power": "MW",
    "brightness": "K",
    "ndvi": "index",
    "sar_backscatter": "dB",
    "sst": "degC",
    "sst_anomaly": "degC",
    "sea_ice_extent": "10^6 km^2",
    "sea_ice_extent_climatology": "10^6 km^2",
    "sea_ice_area": "10^6 km^2",
    "day_ahead_price": "EUR/MWh",
    "actual_load": "MW",
}
VERBATIM_UNITS = {"MAW": "MW", "EUR/MWH": "EUR/MWh"}


@dataclass(frozen=True)
class Field:
    """One declared column and its checks."""

    name: str
    type: str = "string"
    nullable: bool = False
    required: bool = True
    low: float | None = None
    high: float | None = None
    above: float | None = None
    isin: tuple[str, ...] = ()
    pattern: str | None = None
    min_length: int | None = None
    cell: bool = False


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]


def _position() -> tuple[Field, Field]:
    return (
        Field("latitude", "double", low=-90.0, high=90.0),
        Field("longitude", "double", low=-180.0, high=180.0),
    )


def _optional(name: str, kind: str = "double", **checks) -> Field:
    return Field(name, kind, nullable=True, required=False, **checks)


ENVELOPE = Contract(
    "envelope",
    (
        Field("source_id", min_length=1),
        Field("metric_type", min_length=1),
        Field("region_id", nullable=True),
        Field("h3_index", cell=True),
        Field("ingested_at", "timestamp"),
        Field("run_id", min_length=6),
    ),
)
DETECTIONS = Contract(
    "detections",
    (
        *_position(),
        Field("acq_datetime", "timestamp"),
        Field("acq_date", pattern=r"^\d{4}-\d{2}-\d{2}$"),
        Field("acq_time", pattern=r"^\d{4}$"),
        Field("product", min_length=3),
        Field("confidence", isin=("low", "nominal", "high")),
        Field("confidence_pct", "double", low=0.0, high=100.0),
        _optional("satellite", "string"),
        _optional("instrument", "string"),
        _optional("daynight", "string", isin=("D", "N")),
        _optional("frp", low=0.0),
        _optional("brightness", above=0.0),
        _optional("bright_ti4", above=0.0),
        _optional("bright_ti5", above=0.0),
        _optional("scan"),
        _optional("track"),
        _optional("version", "string"),
        _optional("type"),
    ),
)
COMPOSITES = Contract(
    "composites",
    (
        Field("window_start", "timestamp"),
        Field("window_end", "timestamp"),
        *_position(),
        Field("product", isin=("S2_SR_HARMONIZED", "S1_GRD")),
        Field("metric_type", isin=("ndvi", "sar_backscatter")),
        Field("mean", "double", nullable=True),
        _optional("stddev", low=0.0),
        _optional("min"),
        _optional("max"),
        _optional("observation_count", "bigint", low=0.0),
        _optional("cloud_pct", low=0.0, high=100.0),
        _optional("spatial_scope", "string", isin=("region", "grid")),
        _optional("baseline_mean"),
        _optional("recent_mean"),
    ),
)
GRIDDED = Contract(
    "gridded",
    (
        Field("timestamp", "timestamp"),
        *_position(),
        Field("metric_type", isin=("sst_anomaly", "sea_ice_extent", "sea_ice_extent_climatology")),
        Field("product", min_length=3),
        Field("value", "double"),
        _optional("anomaly"),
        Field("unit", nullable=True),
        _optional("spatial_scope", "string", isin=("point", "gridded", "hemispheric")),
        _optional("baseline_stddev", low=0.0),
        _optional("day_of_year", low=1.0, high=366.0),
    ),
)
MARKET = Contract(
    "market",
    (
        Field("timestamp", "timestamp"),
        *_position(),
        Field("metric_type", isin=("day_ahead_price", "actual_load")),
        Field("product", min_length=3),
        Field("value", "double"),
        Field("unit", nullable=True),
        Field("zone_code", min_length=4),
        Field("spatial_scope", isin=("bidding_zone",)),
    ),
)
SILVER = Contract(
    "silver",
    (
        Field("observed_at", "timestamp"),
        Field("metric_type", isin=tuple(sorted(METRIC_UNITS))),
        Field("value", "double"),
        Field("unit", isin=tuple(sorted(set(METRIC_UNITS.values())))),
        Field("source_id", isin=("entsoe", "firms", "sentinel", "noaa_nsidc")),
        Field("region_id"),
        Field("h3_index", cell=True),
        *_position(),
        Field("product"),
        Field("ingested_at", "timestamp"),
    ),
)


def metric_unit(metric: Column) -> Column:
    pairs = [F.lit(item) for pair in METRIC_UNITS.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), metric)


def canonical_unit(unit: Column, metric: Column) -> Column:
    """A verbatim label mapped to its canonical unit; a missing one filled from the metric."""
    pairs = [F.lit(item) for pair in VERBATIM_UNITS.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), unit), unit, metric_unit(metric))


def enrich(
    df: DataFrame, source_id: str, metric_type: str, run_id: str | Column, ingested_at: Column,
    region_id: str | None = None,
) -> DataFrame:
    """Provenance envelope. Values a row already carries are kept."""
    run = run_id if isinstance(run_id, Column) else F.lit(run_id)
    metric = F.coalesce(F.col("metric_type"), F.lit(metric_type)) if "metric_type" in df.columns else F.lit(metric_type)
    region = F.lit(region_id).cast("string")
    if "region_id" in df.columns:
        region = F.coalesce(F.col("region_id"), region)
    unit = F.col("unit") if "unit" in df.columns else F.lit(None).cast("string")
    staged = df.withColumn("metric_type", metric)
    return staged.withColumns(
        {
            "source_id": F.lit(source_id),
            "region_id": region,
            "unit": canonical_unit(unit, F.col("metric_type")),
            "ingested_at": ingested_at,
            "run_id": run,
        }
    )


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Declared columns first, absent ones as typed nulls, undeclared ones kept."""
    declared = [field.name for field in contract.fields]
    present = [
        F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.type).alias(f.name)
        for f in contract.fields
    ]
    extras = [F.col(f"`{name}`") for name in df.columns if name not in declared]
    return df.select(*present, *extras)


def _checks(field: Field) -> list[tuple[str, Column]]:
    raw = F.col(f"`{field.name}`")
    value = raw.cast("string").try_cast(field.type)
    checks = [("coerce", raw.isNotNull() & value.isNull())]
    if not field.nullable:
        checks.append(("not_null", raw.isNull()))
    if field.low is not None:
        checks.append((f"ge({field.low:g})", value < field.low))
    if field.high is not None:
        checks.append((f"le({field.high:g})", value > field.high))
    if field.above is not None:
        checks.append((f"gt({field.above:g})", value <= field.above))
    if field.isin:
        checks.append(("isin", ~value.isin(*field.isin)))
    if field.pattern:
        checks.append(("matches", ~value.rlike(field.pattern)))
    if field.min_length is not None:
        checks.append((f"min_length({field.min_length})", F.length(value) < field.min_length))
    if field.cell:
        checks.append(("valid_cell", ~hexgrid.is_valid_cell(value)))
    return checks


def validate(df: DataFrame, contract: Contract) -> DataFrame:
    """Every failed check at once: column, check, failures, and the smallest and largest bad value.

    One aggregate over the table however many checks there are. A declared column that is absent is
    one failure when it is required.
    """
    aggregates, entries = [], []
    for field in contract.fields:
        if field.name not in df.columns:
            if field.required:
                entries.append((field.name, "required", F.lit(1).cast("long"), F.lit(None), F.lit(None)))
            continue
        for check, failing in _checks(field):
            key = f"c{len(aggregates)}"
            failing = F.coalesce(failing, F.lit(False))
            shown = F.when(failing, F.col(f"`{field.name}`").cast("string"))
            aggregates.append(
                F.struct(
                    F.coalesce(F.sum(F.when(failing, 1).otherwise(0)), F.lit(0)).cast("long").alias("n"),
                    F.min(shown).alias("lo"),
                    F.max(shown).alias("hi"),
                ).alias(key)
            )
            entries.append((field.name, check, F.col(f"{key}.n"), F.col(f"{key}.lo"), F.col(f"{key}.hi")))
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"), F.lit(check).alias("check"), n.alias("failures"),
                lo.cast("string").alias("example_low"), hi.cast("string").alias("example_high"),
            )
            for name, check, n, lo, hi in entries
        ]
    )
    wide = df.agg(*(aggregates or [F.count(F.lit(1)).alias("n")]))
    return wide.select(F.explode(rows).alias("r")).select("r.*").where("failures > 0")


def require_valid(df: DataFrame, contract: Contract) -> DataFrame:
    """Raise with every failure listed, or return the frame."""
    failures = validate(df, contract).collect()  # at most one row per declared check
    if failures:
        lines = [f"  - {r['column']} failed {r['check']} on {r['failures']} row(s), e.g. {r['example_low']}" for r in failures]
        raise ValueError("\n".join([f"{contract.name}: validation failed", *lines]))
    return df


def to_silver(df: DataFrame, observed_at: str, value: str) -> DataFrame:
    """The unified one-row-per-reading shape."""
    return df.select(
        F.col(observed_at).alias("observed_at"), "metric_type", F.col(value).cast("double").alias("value"),
        canonical_unit(F.col("unit") if "unit" in df.columns else F.lit(None).cast("string"), F.col("metric_type")).alias("unit"),
        "source_id", "region_id", "h3_index", "latitude", "longitude", "product", "ingested_at",
    )
