"""Scores, flags and ladders as plain column arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def zscore(value: Column, centre: Column, scale: Column, floor: float, enough: Column | None = None) -> Column:
    """Distance from the centre in floored scales; null where ``enough`` does not hold."""
    z = (value - centre) / F.greatest(F.coalesce(scale, F.lit(0.0)), F.lit(float(floor)))
    return z if enough is None else F.when(enough, z)


def is_anomaly(z: Column, threshold: float, tail: str = "upper") -> Column:
    """Three-valued flag: null means the row could not be scored."""
    if tail == "upper":
        return z >= F.lit(float(threshold))
    if tail == "lower":
        return z <= F.lit(float(threshold))
    if tail == "both":
        return F.abs(z) >= F.lit(float(threshold))
    raise ValueError(f"tail must be upper, lower or both, got {tail!r}")


def severity(z: Column, ladder: Sequence[tuple[str, float]], threshold: float, tail: str = "upper") -> Column:
    """Ladder of labels, strongest step first; ``moderate`` is the flag threshold itself."""
    label = F.when(z.isNull(), "unknown")
    for name, step in (*ladder, ("moderate", threshold)):
        label = label.when(is_anomaly(z, step, tail), name)
    return label.otherwise("normal")


def safe_ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, null where there is nothing to divide by."""
    return F.when(whole > 0, part.cast("double") / whole)


def ramp_step(value: Column, breaks: Sequence[float | Column]) -> Column:
    """How many breaks the value has reached, at most 4."""
    reached = F.lit(0)
    for edge in breaks:
        edge = edge if isinstance(edge, Column) else F.lit(float(edge))
        reached = reached + F.when(value >= edge, 1).otherwise(0)
    return F.least(reached, F.lit(4))


def seasonal_angle(day: Column) -> Column:
    return F.lit(2.0) * F.pi() * F.dayofyear(day) / F.lit(365.25)


def finite(value: Column) -> Column:
    """NaN and infinities become null."""
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)
