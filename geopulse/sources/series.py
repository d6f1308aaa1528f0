"""Index series published as CSV behind citation and units lines."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Labels attached to index rows, and the year climatology days are anchored to.
INDEX_PRODUCT = "nsidc_seaice_index_v4_0"
INDEX_UNIT = "10^6 km^2"
CLIMATOLOGY_YEAR = 2001


def csv_rows(documents: DataFrame, text: str, sentinel: str, columns: list[str], units_rows: int = 0) -> DataFrame:
    """Data lines below the real header of each document, as text columns by header name.

    The header is the first line that starts with ``sentinel``; a document without one is an error.
    Each document is one publisher file, so a row of the input is one small file.
    """
    lines = F.split(F.col(text), r"\r?\n")
    is_header = lambda line: F.startswith(F.lower(F.trim(line)), F.lit(sentinel.lower()))
    at = F.array_position(F.transform(lines, is_header), True)
    missing = F.raise_error(F.concat(F.lit("no header line starting with "), F.lit(sentinel)))
    staged = documents.withColumn("_lines", lines).withColumn("_at", at)
    staged = staged.withColumn("_at", F.when(F.col("_at") > 0, F.col("_at")).otherwise(missing.cast("bigint")))
    header = F.transform(F.split(F.element_at("_lines", F.col("_at").cast("int")), ","), lambda n: F.lower(F.trim(n)))
    staged = staged.withColumn("_names", header).withColumn(
        "_data", F.slice("_lines", F.col("_at").cast("int") + 1 + units_rows, F.size("_lines"))
    )
    exploded = staged.withColumn("_line", F.explode("_data")).where(F.trim("_line") != "")
    exploded = exploded.withColumn("_cells", F.split("_line", ","))
    picked = []
    for name in columns:
        slot = F.array_position("_names", name)
        value = F.when(slot > 0, F.trim(F.get("_cells", (slot - 1).cast("int"))))
        picked.append(value.alias(name))
    keep = [name for name in documents.columns if name != text]
    return exploded.select(*keep, *picked)


def read_csv_after_header(
    spark: SparkSession, path: str, sentinel: str, columns: list[str], units_rows: int = 0
) -> DataFrame:
    """Publisher files under ``path``, read whole because the header's position differs per file."""
    files = spark.read.text(path, wholetext=True).withColumn("source_dataset", F.col("_metadata.file_name"))
    return csv_rows(files, "value", sentinel, columns, units_rows)


def _labelled(df: DataFrame, metric: str) -> DataFrame:
    return df.withColumns(
        {
            "metric_type": F.lit(metric),
            "product": F.lit(INDEX_PRODUCT),
            "unit": F.lit(INDEX_UNIT),
            "spatial_scope": F.lit("hemispheric"),
        }
    )


def sea_ice_daily(df: DataFrame, start: date | Column, end: date | Column) -> DataFrame:
    """Daily extent rows inside the window; unparsable dates or values are dropped."""
    start = start if isinstance(start, Column) else F.lit(start)
    end = end if isinstance(end, Column) else F.lit(end)
    number = lambda name: F.col(name).cast("string").try_cast("double")
    day = F.try_to_date(
        F.concat_ws(
            "-",
            F.lpad(number("year").cast("int").cast("string"), 4, "0"),
            F.lpad(number("month").cast("int").cast("string"), 2, "0"),
            F.lpad(number("day").cast("int").cast("string"), 2, "0"),
        ),
        "yyyy-MM-dd",
    )
    staged = df.withColumn("_day", day).withColumn("value", number("extent"))
    kept = staged.where(F.col("value").isNotNull() & F.col("_day").between(start, end))
    stamped = kept.withColumn("timestamp", F.col("_day").cast("timestamp"))
    return _labelled(stamped.drop("_day", "year", "month", "day", "extent"), "sea_ice_extent")


def first_present(df: DataFrame, names: list[str]) -> Column | None:
    for name in names:
        if name in df.columns:
            return F.col(f"`{name}`")
    return None


def climatology(df: DataFrame) -> DataFrame:
    """Per-day normals under either naming of the value and spread columns.

    Day 366 keeps its number and takes the timestamp of the year's last day.
    """
    value = first_present(df, ["average extent", "extent"])
    spread = first_present(df, ["std deviation", "stddev"])
    if "doy" not in df.columns or value is None:
        raise ValueError(f"climatology has unexpected columns {df.columns}")
    number = lambda column: column.cast("string").try_cast("double")
    doy = number(F.col("doy"))
    used = {"doy", "average extent", "extent", "std deviation", "stddev"}
    staged = df.select(
        *[F.col(f"`{name}`") for name in df.columns if name not in used],
        doy.alias("day_of_year"), number(value).alias("value"),
        (number(spread) if spread is not None else F.lit(None).cast("double")).alias("baseline_stddev"),
    ).dropna(subset=["day_of_year", "value"])
    offset = (F.least(F.col("day_of_year"), F.lit(365.0)) - 1).cast("int")
    first = F.make_date(F.lit(CLIMATOLOGY_YEAR), F.lit(1), F.lit(1))
    return _labelled(staged.withColumn("timestamp", F.date_add(first, offset).cast("timestamp")), "sea_ice_extent_climatology")
