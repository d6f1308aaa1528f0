"""Point detections: reading headered CSV and normalising rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geopulse.functions import detections as fx

# Numeric columns, required columns, and columns where a negative value means missing.
NUMERIC = ("latitude", "longitude", "brightness", "bright_ti4", "bright_ti5", "frp", "scan", "track", "type")
REQUIRED = ("latitude", "longitude", "acq_date", "acq_time", "confidence")
PHYSICAL = ("scan", "track", "frp", "brightness", "bright_ti4", "bright_ti5")
# Age in days from which the reprocessed archive exists, up to which the live one does.
REPROCESSED_FROM_DAYS = 100
LIVE_UNTIL_DAYS = 112


def read_detections_csv(spark: SparkSession, path: str, product: str) -> DataFrame:
    """Headered CSV as text columns with trimmed lower-case names; a payload without data is refused."""
    raw = spark.read.option("header", "true").option("ignoreLeadingWhiteSpace", "true").csv(path)
    named = raw.toDF(*[name.strip().lower() for name in raw.columns])
    if "latitude" not in named.columns:
        raise ValueError(f"{product}: payload is not a detections CSV, its header reads {named.columns}")
    return named.withColumn("product", F.lit(product))


def coerce_numbers(df: DataFrame) -> DataFrame:
    """Listed columns as numbers; rows without a coordinate are dropped."""
    present = [name for name in NUMERIC if name in df.columns]
    typed = df.withColumns({name: F.trim(F.col(name).cast("string")).try_cast("double") for name in present})
    return typed.dropna(subset=["latitude", "longitude"])


def parse_times(df: DataFrame) -> DataFrame:
    """Acquisition timestamps; a row whose date and clock do not parse keeps a null one."""
    return df.withColumns(
        {
            "acq_date": F.trim(F.col("acq_date").cast("string")),
            "acq_time": fx.clock_digits(F.col("acq_time")),
            "acq_datetime": fx.acquisition_time(F.col("acq_date"), F.col("acq_time")),
        }
    )


def time_report(parsed: DataFrame) -> DataFrame:
    """Rows read, kept and rejected for an unparsable time, as one row."""
    return parsed.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("acq_datetime").alias("kept"),
        F.count_if(F.col("acq_datetime").isNull()).alias("rejected"),
    )


def normalise(df: DataFrame, strict: bool = True) -> DataFrame:
    """Typed detections. ``strict`` fails on an unknown confidence; otherwise it stays null."""
    missing = [name for name in REQUIRED if name not in df.columns]
    if missing:
        raise ValueError(f"payload is missing required column(s) {missing}; received {sorted(df.columns)}")
    parsed = parse_times(coerce_numbers(df)).where(F.col("acq_datetime").isNotNull())
    level = fx.strict_confidence_level if strict else fx.confidence_level
    columns: dict[str, Column] = {
        "confidence_pct": fx.confidence_pct(F.col("confidence")),
        "confidence": level(F.col("confidence")),
    }
    if "daynight" in df.columns:
        columns["daynight"] = fx.day_night(F.col("daynight"))
    for name in ("satellite", "instrument", "version"):
        if name in df.columns:
            columns[name] = fx.blank_to_null(F.col(name))
    for name in PHYSICAL:
        if name in df.columns:
            columns[name] = fx.non_negative(F.col(name))
    return parsed.withColumns(columns)


def require_times(parsed: DataFrame, normalised: DataFrame) -> DataFrame:
    """Fail only when a non-empty payload has no parsable time at all."""
    if normalised.isEmpty() and not parsed.isEmpty():
        raise ValueError("acquisition timestamps are unparseable in every row")
    return normalised


def product_plan(window_end: Column, today: Column | date) -> Column:
    """``struct(preferred, alternative)`` archive for a window by its age; nulls mean uncovered."""
    today = today if isinstance(today, Column) else F.lit(today)
    age = F.datediff(today, window_end)
    reprocessed, live = age >= REPROCESSED_FROM_DAYS, age <= LIVE_UNTIL_DAYS
    return F.struct(
        F.when(reprocessed, "sp").when(live, "nrt").alias("preferred"),
        F.when(reprocessed & live, "nrt").alias("alternative"),
    )
