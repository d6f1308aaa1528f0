"""Keyed upsert that survives re-runs and never blanks columns another job owns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def check_key(df: DataFrame, keys: Sequence[str], name: str = "table") -> None:
    missing = [key for key in keys if key not in df.columns]
    if missing:
        raise KeyError(f"{name} is missing its declared key column(s) {missing}; available: {df.columns}")


def key_covers(publish_key: Sequence[str], unique_key: Sequence[str]) -> bool:
    """A publish key may hold more columns than a unique key, never fewer."""
    return set(unique_key) <= set(publish_key)


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], protected: Sequence[str] = (),
    order: Sequence[str] = (), repeats: bool = False,
) -> DataFrame:
    """Insert-or-update by key; columns new to either side are added.

    Both sides meet in one shuffle by key, without a join. Null keys are equal to each other, so applying a source
    twice changes nothing. A key that a source holds more than once is an error, unless ``order`` says which row is
    the latest or ``repeats`` says that all of them stay. Protected columns keep the target's values, null where the row is new.
    """
    check_key(target, keys, "target")
    check_key(source, keys, "source")
    owned = [name for name in protected if name in target.columns]
    source = source.drop(*[name for name in protected if name in source.columns and name not in owned])
    both = target.withColumn("__new", F.lit(0)).unionByName(source.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    same, incoming = Window.partitionBy(*keys), F.col("__new") == 1
    both = both.withColumn("__found", F.sum("__new").over(same))
    for name in owned:
        before = F.first(F.when(~incoming, F.col(f"`{name}`")), ignorenulls=True).over(same)
        both = both.withColumn(name, F.when(incoming, before).otherwise(F.col(f"`{name}`")))
    if order:
        latest = Window.partitionBy(*keys, "__new").orderBy(*[F.desc_nulls_last(name) for name in order])
        both = both.withColumn("__turn", F.row_number().over(latest)).where((F.col("__turn") == 1) | ~incoming).drop("__turn")
    elif not repeats:
        spelled = F.concat_ws(", ", *[F.col(f"`{key}`").cast("string") for key in keys])
        repeated = F.raise_error(F.concat(F.lit("the source repeats a key: "), spelled)).cast("boolean")
        both = both.where(F.when(incoming & (F.col("__found") > 1), repeated).otherwise(F.lit(True)))
    return both.where(incoming | (F.col("__found") == 0)).drop("__new", "__found")


def payload_profile(df: DataFrame) -> DataFrame:
    """Rows and non-null values of each column; ``all_null`` marks columns with no value at all."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{name}`")).alias(name) for name in df.columns]
    )
    entries = F.array(
        *[F.struct(F.lit(name).alias("column"), F.col(f"`{name}`").alias("present")) for name in df.columns]
    )
    return counted.select("_rows", F.explode(entries).alias("e")).select(
        F.col("e.column").alias("column"),
        F.col("_rows").alias("rows"),
        F.col("e.present").alias("present"),
        ((F.col("_rows") > 0) & (F.col("e.present") == 0)).alias("all_null"),
    )
