"""Time axes, window generators and longitude windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Units of a "<unit> since <epoch>" axis, in seconds.
CF_UNIT_SECONDS = {"days": 86400, "hours": 3600, "minutes": 60, "seconds": 1}
CF_UNITS = r"(?i)^\s*(days|hours|minutes|seconds)\s+since\s+(.+?)\s*$"


def utc_date(stamp: Column) -> Column:
    return F.to_date(stamp)


def month_start(stamp: Column) -> Column:
    return F.trunc(F.to_date(stamp), "month")


def decode_cf_time(value: Column, units: Column) -> Column:
    """Offsets on a "<unit> since <epoch>" axis as timestamps; any other axis is an error."""
    unit = F.lower(F.regexp_extract(units, CF_UNITS, 1))
    epoch = F.try_to_timestamp(F.regexp_extract(units, CF_UNITS, 2))
    seconds = F.lit(None).cast("long")
    for name, length in CF_UNIT_SECONDS.items():
        seconds = F.when(unit == name, F.lit(length)).otherwise(seconds)
    micros = F.unix_micros(epoch) + F.round(value.cast("double") * seconds * 1000000).cast("long")
    bad = F.raise_error(F.concat(F.lit("unsupported time axis: "), F.coalesce(units, F.lit("null"))))
    return F.when(seconds.isNull() | epoch.isNull(), bad.cast("timestamp")).otherwise(F.timestamp_micros(micros))


def date_windows(start: Column, end: Column, size_days: int) -> Column:
    """Inclusive windows of at most ``size_days``, anchored on the start, as an array of structs."""
    if size_days < 1:
        raise ValueError("size_days must be at least 1")
    opens = F.sequence(start, end, F.expr(f"interval {int(size_days)} days"))
    return F.when(
        start <= end,
        F.transform(
            opens,
            lambda d: F.struct(
                d.alias("window_start"), F.least(F.date_add(d, size_days - 1), end).alias("window_end")
            ),
        ),
    )


def month_windows(start: Column, end: Column) -> Column:
    """Calendar months clipped to the range."""
    months = F.sequence(F.trunc(start, "month"), end, F.expr("interval 1 month"))
    return F.when(
        start <= end,
        F.transform(
            months,
            lambda m: F.struct(
                F.greatest(m, start).alias("window_start"), F.least(F.last_day(m), end).alias("window_end")
            ),
        ),
    )


def composite_windows(start: Column, end: Column, period: str) -> Column:
    """Daily, anchored weekly or calendar-month windows."""
    key = period.strip().upper()
    if key in ("D", "W"):
        return date_windows(start, end, 1 if key == "D" else 7)
    if key == "M":
        return month_windows(start, end)
    raise ValueError(f"unknown composite period {period!r}; expected D, W or M")


def month_chunks(start: Column, end: Column) -> Column:
    """Half-open ``[chunk_start, chunk_end)`` month pieces of an inclusive range."""
    return F.transform(
        month_windows(start, end),
        lambda w: F.struct(
            w["window_start"].alias("chunk_start"), F.date_add(w["window_end"], 1).alias("chunk_end")
        ),
    )


def snap_to_months(start: Column, end: Column) -> tuple[Column, Column]:
    """Widen a range outwards to whole months, for layers stamped by month."""
    return F.trunc(start, "month"), F.last_day(end)


def days_behind(last: Column, asof: Column) -> Column:
    return F.greatest(F.datediff(asof, last), F.lit(0))


def hours_behind(last: Column, asof: Column) -> Column:
    return F.greatest((F.unix_micros(asof) - F.unix_micros(last)) / F.lit(3600000000.0), F.lit(0.0))


def to_360(lon: Column) -> Column:
    return F.pmod(lon.cast("double"), F.lit(360.0))


def split_lon_window(west: Column, east: Column) -> Column:
    """One or two ``(lo, hi)`` windows of a bbox on a 0..360 grid, as an array."""
    piece = lambda a, b: F.struct(a.alias("lo"), b.alias("hi"))
    zero, full = F.lit(0.0), F.lit(360.0)
    low, high = to_360(west), to_360(east)
    high = F.when((high == 0.0) & (east > 0.0), full).otherwise(high)
    return (
        F.when(east - west >= 360.0, F.array(piece(zero, full)))
        .when(low < high, F.array(piece(low, high)))
        .when(low == high, F.array(piece(low, low)))
        .otherwise(F.array(piece(low, full), piece(zero, high)))
    )
