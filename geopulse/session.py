"""Session defaults. Everything assumes UTC; shuffle width is left to the cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession


# Staged rows are several times as wide as the compressed columns they come from, so small splits keep the sorts of a task in memory.
SPLIT_BYTES = "8m"


def get_spark(app: str = "geopulse", *, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.files.maxPartitionBytes": SPLIT_BYTES,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
