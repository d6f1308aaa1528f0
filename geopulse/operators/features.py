"""Strictly causal feature table: nothing at or after the scored day enters a window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geopulse.functions.scoring import seasonal_angle

# The model's input columns, in order.
FEATURES = (
    "detection_count", "h3_cell_count", "high_confidence_count", "frp_sum", "frp_max", "frp_mean",
    "confidence_pct_mean", "count_lag1", "count_lag2", "count_lag3", "count_lag7", "count_mean_7",
    "count_std_7", "count_max_7", "count_mean_14", "count_max_14", "count_mean_30", "count_std_30",
    "zero_days_30", "count_delta_1", "count_ratio_7", "count_ratio_30", "fire_dispersion",
    "frp_per_detection", "high_confidence_share", "sst_anomaly_mean_7", "sst_anomaly_change_7",
)
KEYS = ("region_id", "observation_date")


def _ordered():
    # a series holds one row per day, so its length is bounded by the calendar
    return Window.partitionBy("region_id").orderBy("observation_date")


def lags(daily: DataFrame, value: str = "detection_count", steps: Sequence[int] = (1, 2, 3, 7)) -> DataFrame:
    return daily.withColumns({f"count_lag{n}": F.lag(value, n).over(_ordered()) for n in steps})


def trailing_windows(daily: DataFrame, value: str = "detection_count") -> DataFrame:
    """Trailing 7, 14 and 30 row statistics, all ending the row before."""
    last = {n: _ordered().rowsBetween(-n, -1) for n in (7, 14, 30)}
    return daily.withColumns(
        {
            "count_mean_7": F.avg(value).over(last[7]),
            "count_std_7": F.stddev_samp(value).over(last[7]),
            "count_max_7": F.max(value).over(last[7]),
            "count_mean_14": F.avg(value).over(last[14]),
            "count_max_14": F.max(value).over(last[14]),
            "count_mean_30": F.avg(value).over(last[30]),
            "count_std_30": F.stddev_samp(value).over(last[30]),
            "zero_days_30": F.sum(F.when(F.col(value) == 0, 1).otherwise(0)).over(last[30]),
        }
    )


def lead_in(precursor: DataFrame, value: str = "value") -> DataFrame:
    """Level of a precursor over the previous 7 rows, and its change against the 7 before those."""
    level = F.avg(value).over(_ordered().rowsBetween(-7, -1))
    before = F.avg(value).over(_ordered().rowsBetween(-14, -8))
    return precursor.select(
        *KEYS, level.alias("sst_anomaly_mean_7"), (level - before).alias("sst_anomaly_change_7")
    )


def ratios(windowed: DataFrame) -> DataFrame:
    """Deltas, ratios to recent means, and per-detection shares."""
    n = F.greatest(F.col("detection_count"), F.lit(1))
    return windowed.withColumns(
        {
            "count_delta_1": F.col("detection_count") - F.col("count_lag1"),
            "count_ratio_7": F.col("detection_count") / (F.col("count_mean_7") + 1.0),
            "count_ratio_30": F.col("detection_count") / (F.col("count_mean_30") + 1.0),
            "fire_dispersion": F.col("h3_cell_count") / n,
            "frp_per_detection": F.col("frp_sum") / n,
            "high_confidence_share": F.col("high_confidence_count") / n,
        }
    )


def seasonal_encoding(df: DataFrame, day: str = "observation_date") -> DataFrame:
    angle = seasonal_angle(F.col(day))
    return df.withColumns({"doy_sin": F.sin(angle), "doy_cos": F.cos(angle)})


def join_precursor(df: DataFrame, precursor: DataFrame) -> DataFrame:
    """Left join of the precursor's lead-in; days without one read as no departure."""
    joined = df.join(lead_in(precursor), list(KEYS), "left")
    return joined.withColumns(
        {name: F.coalesce(F.col(name), F.lit(0.0)) for name in ("sst_anomaly_mean_7", "sst_anomaly_change_7")}
    )


def scoreable_days(marts: DataFrame) -> DataFrame:
    """Days with a z-score; measured values read as zero on empty days."""
    measured = ("frp_sum", "frp_max", "frp_mean", "confidence_pct_mean")
    return marts.where(F.col("zscore").isNotNull()).select(
        *KEYS, "detection_count", "h3_cell_count", "high_confidence_count",
        *[F.coalesce(F.col(name), F.lit(0.0)).alias(name) for name in measured],
        "zscore", "is_anomaly",
    )


def causal_features(marts: DataFrame, precursor: DataFrame) -> DataFrame:
    """Full feature table; ``zscore`` and ``is_anomaly`` ride along as reference, never as input."""
    windowed = trailing_windows(lags(scoreable_days(marts)))
    return seasonal_encoding(join_precursor(ratios(windowed), precursor))


FEATURE_BUILDERS = {"fire": causal_features}


def feature_matrix(
    df: DataFrame, columns: Sequence[str] = FEATURES, missing: str = "drop", keep: Sequence[str] = KEYS
) -> DataFrame:
    """Keys and features only; incomplete rows are dropped (training) or zero-filled (scoring)."""
    absent = [name for name in columns if name not in df.columns]
    if absent:
        raise KeyError(f"feature frame is missing {absent}")
    if missing == "drop":
        df = df.dropna(subset=list(columns))
    elif missing == "zero":
        df = df.withColumns({name: F.coalesce(F.col(name), F.lit(0)) for name in columns})
    else:
        raise ValueError(f"missing must be 'drop' or 'zero', got {missing!r}")
    return df.select(*keep, *[F.col(name).cast("double").alias(name) for name in columns])


def feature_report(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Rows, usable rows, date span, regions and worst null share, as one row."""
    complete = F.lit(True)
    for name in columns:
        complete = complete & F.col(name).isNotNull()
    usable = F.coalesce(F.sum(F.when(complete, 1).otherwise(0)), F.lit(0)).cast("long")
    nulls = [F.count_if(F.col(name).isNull()) / F.count(F.lit(1)) for name in columns]
    regions = df.select("region_id").distinct().agg(F.count("region_id").alias("n"))
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        usable.alias("usable_rows"),
        (F.count(F.lit(1)) - usable).alias("dropped_rows"),
        F.min("observation_date").alias("first_day"),
        F.max("observation_date").alias("last_day"),
        F.greatest(*nulls).alias("null_fraction_max"),
    ).withColumn("regions", regions.scalar())
