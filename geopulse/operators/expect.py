"""Data-quality expectations. Each returns its violations: no rows means it passed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geopulse.operators.dedup import union_by_name


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    condition = F.lit(False)
    for name in columns:
        condition = condition | F.col(name).isNull()
    return df.where(condition)


def unique(df: DataFrame, column: str) -> DataFrame:
    return unique_combination(df.where(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Distinct non-null values outside the list, with their counts."""
    return (
        df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose key has no parent. The child is reduced to distinct keys before it meets the parent."""
    orphans = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    return orphans.join(parent.select(F.col(parent_column).alias("value")), "value", "left_anti")


def column_between(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    value = F.col(column)
    return df.where(value.isNotNull() & ((value < low) | (value > high)))


def not_older_than(df: DataFrame, column: str, days: int, asof: Column) -> DataFrame:
    """The newest day, if it is staler than the budget."""
    newest = df.agg(F.max(column).alias("latest_observation"))
    return newest.where(F.col("latest_observation") < F.date_sub(asof, days))


def not_empty(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).where("row_count = 0")


def no_future(tables: dict[str, tuple[DataFrame, str]], asof: Column) -> DataFrame:
    """Tables whose newest day lies beyond tomorrow."""
    checks = [
        df.agg(F.max(column).alias("latest"))
        .where(F.col("latest") > F.date_add(asof, 1))
        .select(F.lit(name).alias("model_name"), "latest")
        for name, (df, column) in tables.items()
    ]
    return union_by_name(checks)


def regions_without_data(regions: DataFrame, df: DataFrame, anomaly_type: str | None = None) -> DataFrame:
    if anomaly_type is not None:
        regions = regions.where(F.col("anomaly_type") == anomaly_type)
    return regions.select("region_id").join(df.select("region_id").distinct(), "region_id", "left_anti")


def drift(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows on one side only, counting duplicates."""
    missing = expected.exceptAll(actual).withColumn("side", F.lit("missing"))
    extra = actual.exceptAll(expected).withColumn("side", F.lit("unexpected"))
    return missing.unionByName(extra)


def report(df: DataFrame, bounds: Sequence[tuple[str, float | None, float | None, bool]]) -> DataFrame:
    """One pass over a table for a list of ``(column, low, high, required)`` expectations."""
    flags = []
    for name, low, high, required in bounds:
        value = F.col(name)
        bad = F.lit(False)
        if required:
            bad = bad | value.isNull()
        if low is not None:
            bad = bad | (value < low)
        if high is not None:
            bad = bad | (value > high)
        count = F.sum(F.when(F.coalesce(bad, F.lit(False)), 1).otherwise(0))
        flags.append(F.coalesce(count, F.lit(0)).cast("long").alias(name))
    wide = df.agg(*flags)
    entries = F.array(
        *[F.struct(F.lit(name).alias("column"), F.col(name).alias("violations")) for name, *_ in bounds]
    )
    return wide.select(F.explode(entries).alias("e")).select("e.column", "e.violations")
