"""The small configured dimensions as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geopulse import config


def region_table(spark: SparkSession) -> DataFrame:
    schema = "region_id string, name string, anomaly_type string, west double, south double, east double, north double, h3_resolution int"
    return spark.createDataFrame(list(config.REGIONS), schema)


def source_table(spark: SparkSession) -> DataFrame:
    schema = (
        "source_id string, label string, metric_types array<string>, anomaly_types array<string>, "
        "h3_resolution int, cadence_cron string"
    )
    return spark.createDataFrame([tuple(map(_plain, row)) for row in config.SOURCES], schema)


def table_registry(spark: SparkSession) -> DataFrame:
    schema = "table string, domain string, source_ids array<string>, date_column string, internal boolean"
    return spark.createDataFrame([tuple(map(_plain, row)) for row in config.TABLES], schema)


def known_events(spark: SparkSession) -> DataFrame:
    """Documented events in the shape :func:`geopulse.operators.evaluate.check_events` takes."""
    rows = [(i, *event) for i, event in enumerate(config.KNOWN_EVENTS)]
    df = spark.createDataFrame(rows, "event_id int, region_id string, start string, end string, recorded_peak int, expected boolean")
    return df.withColumns({"start": F.to_date("start"), "end": F.to_date("end")})


def investigations(spark: SparkSession) -> DataFrame:
    """Named windows in the shape :func:`geopulse.plans.serving.window_facts` takes."""
    df = spark.createDataFrame(list(config.INVESTIGATIONS), "slug string, region_id string, start string, end string, tail string")
    return df.withColumns({"start": F.to_date("start"), "end": F.to_date("end")})


def _plain(value):
    return list(value) if isinstance(value, tuple) else value
