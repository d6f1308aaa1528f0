"""Normalising raw point detections."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Confidence words and the percentage each stands for; numeric cut-offs.
CONFIDENCE_WORDS = (("low", ("l", "low"), 30.0), ("nominal", ("n", "nominal"), 60.0), ("high", ("h", "high"), 90.0))
LOW_BELOW = 30.0
HIGH_FROM = 80.0


def confidence_pct(raw: Column) -> Column:
    """Percent behind a word or number; null if it is neither."""
    text = F.lower(F.trim(raw.cast("string")))
    number = text.try_cast("double")
    number = F.when(~F.isnan(number), number)
    pct = F.when(number.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), number)))
    for _, words, value in CONFIDENCE_WORDS:
        pct = F.when(text.isin(*words), F.lit(value)).otherwise(pct)
    return pct


def confidence_level(raw: Column) -> Column:
    """``low``/``nominal``/``high``; null if the value is not a confidence at all."""
    text = F.lower(F.trim(raw.cast("string")))
    pct = confidence_pct(raw)
    level = (
        F.when(pct.isNull(), F.lit(None).cast("string"))
        .when(pct < LOW_BELOW, "low")
        .when(pct >= HIGH_FROM, "high")
        .otherwise("nominal")
    )
    for name, words, _ in CONFIDENCE_WORDS:
        level = F.when(text.isin(*words), F.lit(name)).otherwise(level)
    return level


def strict_confidence_level(raw: Column) -> Column:
    """As :func:`confidence_level`, but an unrecognised value fails the job."""
    shown = F.coalesce(raw.cast("string"), F.lit("null"))
    bad = F.raise_error(F.concat(F.lit("unrecognised confidence value: "), shown))
    return F.coalesce(confidence_level(raw), bad.cast("string"))


def clock_digits(raw: Column) -> Column:
    """``930`` and ``930.0`` both become ``0930``."""
    text = F.regexp_replace(F.trim(raw.cast("string")), r"\.0$", "")
    return F.when(F.length(text) < 4, F.lpad(text, 4, "0")).otherwise(text)


def acquisition_time(day: Column, clock: Column) -> Column:
    """Timestamp from a date and an ``HHMM`` clock; null where they do not parse."""
    day, clock = F.trim(day.cast("string")), clock_digits(clock)
    shaped = day.rlike(r"^\d{4}-\d{2}-\d{2}$") & clock.rlike(r"^\d{4}$")
    return F.when(shaped, F.try_to_timestamp(F.concat_ws(" ", day, clock), F.lit("yyyy-MM-dd HHmm")))


def day_night(raw: Column) -> Column:
    flag = F.upper(F.substring(F.trim(raw.cast("string")), 1, 1))
    return F.when(flag.isin("D", "N"), flag)


def blank_to_null(raw: Column) -> Column:
    text = F.trim(raw.cast("string"))
    return F.when(~text.isin("", "nan"), text)


def non_negative(value: Column) -> Column:
    return F.when(value >= 0, value)


def first_number(*columns: Column) -> Column:
    """First column that reads as a number, for values each instrument names differently."""
    return F.coalesce(*[column.try_cast("double") for column in columns])
