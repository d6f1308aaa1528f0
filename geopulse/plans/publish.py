"""Publishing marts: keyed upsert per mart with a report, or a full rebuild."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from geopulse.config import MODEL_OWNED, PUBLISH_KEYS
from geopulse.operators.upsert import check_key, upsert
from geopulse.sources.versions import VersionedSink

REPORT_SCHEMA = "table string, state string, rows bigint, added_columns array<string>"


def published(spark: SparkSession, path: str) -> DataFrame | None:
    """The current version of a published table."""
    return VersionedSink(spark, path).latest()


def publish_table(
    spark: SparkSession, df: DataFrame, path: str, keys: Sequence[str],
    protected: Sequence[str] = MODEL_OWNED, rebuild: bool = False,
) -> list[str]:
    """Upsert into the table at ``path`` as a new version; returns columns it gained.

    Readers keep the former version until the new one is whole. ``rebuild`` replaces the table, for when the key
    itself changed meaning.
    """
    check_key(df, keys, path)
    sink = VersionedSink(spark, path)
    target = sink.latest()
    added = [] if rebuild or target is None else [name for name in df.columns if name not in target.columns]

    def merge(current: DataFrame | None, batch: DataFrame) -> DataFrame:
        if rebuild or current is None:
            current = batch.limit(0)  # nothing to keep, but a repeated key is refused all the same
        return upsert(current, batch, keys, [name for name in protected if name in {*batch.columns, *current.columns}])

    sink.fold(df, max(sink.versions(), default=-1) + 1, merge)
    return added


def publish(
    spark: SparkSession, marts: Mapping[str, DataFrame | None], root: str,
    keys: Mapping[str, Sequence[str]] = PUBLISH_KEYS, rebuild: Sequence[str] = (),
) -> DataFrame:
    """Publish every mart that exists; absent and empty marts are reported, not errors."""
    report = []
    for name, key in keys.items():
        df = marts.get(name)
        if df is None:
            report.append((name, "absent", None, []))
            continue
        if df.isEmpty():
            report.append((name, "empty", 0, []))
            continue
        added = publish_table(spark, df, f"{root}/{name}", key, rebuild=name in rebuild)
        report.append((name, "published", published(spark, f"{root}/{name}").count(), added))
    return spark.createDataFrame(report, REPORT_SCHEMA)
