"""Latest-wins deduplication and set helpers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_wins(df: DataFrame, keys: Sequence[str | Column], newest_first: Sequence[Column]) -> DataFrame:
    """Keep the newest row of every key.

    ``row_number() = 1`` is planned with a group limit on both sides of the shuffle, so a key with
    any number of copies sends at most one row per map task. Rows reach the shuffle in the order of
    ``keys``: led by a time or a number, two rows seldom compare past eight bytes, and neighbours
    share much of what they hold, which the shuffle's compression then finds.
    """
    order = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def latest_per_group(df: DataFrame, group: str, stamp: str, columns: Sequence[str]) -> DataFrame:
    """Columns of each group's newest row, in one aggregate."""
    newest = F.max(F.struct(stamp, *columns)).alias("newest")
    return df.groupBy(group).agg(newest).select(group, "newest.*")


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of differently shaped frames; absent columns become null."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def prefer_archive(preferred: DataFrame, alternative: DataFrame, window_key: Sequence[str]) -> DataFrame:
    """Rows of the preferred archive, and of the alternative for windows the first has none of."""
    covered = preferred.select(*window_key).distinct()
    fallback = alternative.join(covered, list(window_key), "left_anti")
    return preferred.unionByName(fallback, allowMissingColumns=True)


def uncovered_windows(
    windows: DataFrame, preferred: DataFrame, alternative: DataFrame, window_key: Sequence[str]
) -> DataFrame:
    """Windows neither archive has rows for."""
    keys = list(window_key)
    covered = preferred.select(*keys).unionByName(alternative.select(*keys)).distinct()
    return windows.join(covered, keys, "left_anti")
