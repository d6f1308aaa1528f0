"""Exact global ranks and quantiles without sorting everything in one task.

Rows collapse to (value, count) pairs first, so a value shared by a third of the rows is one pair.
The pairs are range-partitioned and written once with the number of their range; each range is then
ranked by its own task, and only the range totals (one row per task) are summed in one place.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geopulse.workspace import materialise


def cumulative_counts(df: DataFrame, value: str, weight: Column | None = None) -> DataFrame:
    """One row per distinct non-null value: ``value``, ``n_equal``, ``n_upto``, ``n_total``.

    ``weight`` counts something other than rows (0 keeps a value in the output without counting it).
    """
    counted = F.sum(F.lit(1) if weight is None else weight).cast("long").alias("n_equal")
    pairs = (
        df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
        .groupBy(F.col(value).cast("double").alias("value"))
        .agg(counted)
    )
    # written out, because range bounds come from sampling and both uses below must see the same ones
    ranged = materialise(pairs.repartitionByRange("value").withColumn("part", F.spark_partition_id()), "ranks")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = ranged.groupBy("part").agg(F.sum("n_equal").alias("in_part")).select(
        "part",
        F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("n_before"),
        F.sum("in_part").over(everything).alias("n_total"),
    )
    inside = Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    # one row per range partition, so this side never exceeds spark.sql.shuffle.partitions rows
    return ranged.join(F.broadcast(totals), "part").select(
        "value",
        "n_equal",
        (F.col("n_before") + F.sum("n_equal").over(inside)).alias("n_upto"),
        "n_total",
    )


def value_at_rank(counts: DataFrame, ranks: Mapping[str, Column]) -> DataFrame:
    """One row with the value at each 1-based rank; ranks may use ``n_total``."""
    picks = []
    for name, rank in ranks.items():
        holds = (F.col("n_upto") >= rank) & (F.col("n_upto") - F.col("n_equal") < rank)
        picks.append(F.max(F.when(holds, F.col("value"))).alias(name))
    return counts.agg(*picks)


def nearest_rank_quantiles(df: DataFrame, value: str, quantiles: Mapping[str, float]) -> DataFrame:
    """Value at rank ``floor(n*q) + 1`` per quantile, with min, max and n, as one row."""
    counts = cumulative_counts(df, value)
    total = F.col("n_total")
    picks = []
    for name, q in quantiles.items():
        rank = F.floor(total * F.lit(float(q))) + 1
        holds = (F.col("n_upto") >= rank) & (F.col("n_upto") - F.col("n_equal") < rank)
        picks.append(F.max(F.when(holds, F.col("value"))).alias(name))
    return counts.agg(
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.coalesce(F.max("n_total"), F.lit(0).cast("long")).alias("n"),
        *picks,
    )


def linear_quantiles(df: DataFrame, value: str, quantiles: Mapping[str, float]) -> DataFrame:
    """Linearly interpolated quantiles (position ``(n-1)*q``) of a whole column, as one row."""
    counts = cumulative_counts(df, value)
    ranks: dict[str, Column] = {}
    for name, q in quantiles.items():
        position = (F.col("n_total") - 1) * F.lit(float(q))
        ranks[f"{name}_lo"] = F.floor(position) + 1
        ranks[f"{name}_hi"] = F.ceil(position) + 1
    held = []
    for name, rank in ranks.items():
        inside = (F.col("n_upto") >= rank) & (F.col("n_upto") - F.col("n_equal") < rank)
        held.append(F.max(F.when(inside, F.col("value"))).alias(name))
    picked = counts.agg(F.max("n_total").alias("n"), *held)
    columns = []
    for name, q in quantiles.items():
        position = (F.col("n") - 1) * F.lit(float(q))
        low, high = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        columns.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return picked.select("n", *columns)


def percentile_rank(df: DataFrame, value: str, out: str = "percentile") -> DataFrame:
    """Share of rows at or below each row's value; null values rank null."""
    ranks = cumulative_counts(df, value).select(
        F.col("value").alias("_value"), (F.col("n_upto") / F.col("n_total")).alias(out)
    )
    return df.join(ranks, F.col(value).cast("double") == F.col("_value"), "left").drop("_value")


def foreign_percentile_rank(
    reference: DataFrame, ref_value: str, df: DataFrame, value: str, out: str = "percentile"
) -> DataFrame:
    """Rank of each row's value within another frame's distribution, clipped to ``[1/n, 1]``."""
    both = reference.select(F.col(ref_value).cast("double").alias("v"), F.lit(1).alias("w")).unionAll(
        df.select(F.col(value).cast("double").alias("v"), F.lit(0).alias("w"))
    )
    share = F.col("n_upto") / F.col("n_total")
    ranks = cumulative_counts(both, "v", F.col("w")).select(
        F.col("value").alias("_value"),
        F.greatest(share, F.lit(1.0) / F.col("n_total")).alias(out),
    )
    return df.join(ranks, F.col(value).cast("double") == F.col("_value"), "left").drop("_value")
