"""Market documents: nested XML periods and points as timestamped rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geopulse.config import ZONES

# Document families by metric (root, value element, product) and element names.
PRICE_PRODUCT = "A44_day_ahead_price"
LOAD_PRODUCT = "A65_actual_load"
FAMILIES = {
    "day_ahead_price": ("Publication_MarketDocument", "price.amount", PRICE_PRODUCT),
    "actual_load": ("GL_MarketDocument", "quantity", LOAD_PRODUCT),
}
DOCUMENT = (
    "struct<TimeSeries: array<struct<`currency_Unit.name`: string, `price_Measure_Unit.name`: string, "
    "`quantity_Measure_Unit.name`: string, Period: array<struct<timeInterval: struct<start: string, end: string>, "
    "resolution: string, Point: array<struct<position: string, `price.amount`: string, quantity: string>>>>>>>"
)
NO_DATA = "No matching data"
RESOLUTION = r"^P(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?)?$"


def root_name(xml: Column) -> Column:
    """Local name of the document element."""
    return F.regexp_extract(xml, r"<(?:[A-Za-z_][\w.-]*:)?([A-Za-z_][\w.-]*)[\s/>]", 1)


def read_minutes(duration: Column) -> Column:
    """Minutes of a P1D / PT60M style duration; null for anything else."""
    text = F.upper(F.trim(duration))
    part = lambda group: F.coalesce(F.regexp_extract(text, RESOLUTION, group).try_cast("long"), F.lit(0))
    minutes = part(1) * 1440 + part(2) * 60 + part(3)
    return F.when(text.rlike(RESOLUTION) & (minutes > 0), minutes)


def read_start(text: Column) -> Column:
    """The time a period's start states; null if none can be read."""
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mmX")),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssX")),
        F.try_to_timestamp(text),
    )


def demand(value: Column, kind: str, complaint: str, text: Column) -> Column:
    """The value that was read from ``text``; an error where it is null."""
    bad = F.raise_error(F.concat(F.lit(complaint), F.coalesce(text, F.lit("null"))))
    return F.when(value.isNotNull(), value).otherwise(bad.cast(kind))


def _unit(series: Column, metric: str) -> Column:
    if metric == "actual_load":
        return series["quantity_Measure_Unit.name"]
    currency, measure = series["currency_Unit.name"], series["price_Measure_Unit.name"]
    return F.nullif(F.concat_ws("/", currency, measure), F.lit(""))


def parse_market_documents(documents: DataFrame, metric: str, xml: str = "xml") -> DataFrame:
    """One row per valued point of each document.

    ``timestamp = start + (position - 1) * resolution`` with positions restarting per period. A
    "no matching data" acknowledgement yields nothing; another root, an unusable position or value,
    and a document whose points carry no value at all are errors.
    """
    root, element, product = FAMILIES[metric]
    keep = [name for name in documents.columns if name != xml]
    text = F.col(xml)
    empty = F.contains(text, F.lit(NO_DATA))
    wrong_root = F.raise_error(F.concat(F.lit(f"{metric}: unexpected document "), root_name(text)))
    has_value = lambda p: F.coalesce(F.trim(p[element]), F.lit("")) != ""

    def points(doc: Column) -> Column:
        per_series = lambda s: F.transform(s["Period"], lambda p: F.coalesce(p["Point"], F.array()))
        return F.flatten(F.flatten(F.transform(doc["TimeSeries"], per_series)))

    def undrifted(doc: Column) -> Column:
        """The document, unless it has points and none of them a value: then the element was renamed."""
        drifted = (F.size(points(doc)) > 0) & ~F.exists(points(doc), has_value)
        error = F.raise_error(F.lit(f"{metric}: points without any {element}"))
        return F.when(drifted, error.cast(DOCUMENT)).otherwise(doc)

    # an acknowledgement becomes a null document, which unfolds to no rows wherever filters move
    parsed = (
        F.when(root_name(text) == root, F.from_xml(text, DOCUMENT, {"ignoreNamespace": "true", "mode": "FAILFAST"}))
        .when(empty, F.lit(None).cast(DOCUMENT))
        .otherwise(wrong_root.cast(DOCUMENT))
    )
    # bound through a one-element array so that each document is parsed once
    checked = F.element_at(F.transform(F.array(parsed), undrifted), 1)
    series = documents.select(*keep, F.explode(checked["TimeSeries"]).alias("s"))
    periods = series.select(*keep, _unit(F.col("s"), metric).alias("unit"), F.explode("s.Period").alias("p"))
    # start and resolution are read once a period, below the unfolding of its points; only a point with a value complains of them
    start, every = F.col("p.timeInterval.start"), F.col("p.resolution")
    read = periods.select(
        *keep, "unit", start.alias("_from"), every.alias("_every"),
        read_start(start).alias("_start"), read_minutes(every).alias("_minutes"), F.col("p.Point").alias("_points"),
    )
    timed = read.select(*keep, "unit", "_from", "_every", "_start", "_minutes", F.explode("_points").alias("pt")).where(has_value(F.col("pt")))
    began = demand(F.col("_start"), "timestamp", "period without a usable start: ", F.col("_from"))
    minutes = demand(F.col("_minutes"), "bigint", "unsupported resolution: ", F.col("_every"))
    position = F.trim(F.col("pt.position")).try_cast("bigint")
    value = F.trim(F.col("pt")[element]).try_cast("double")
    bad_position = F.raise_error(F.lit("point with an unusable position")).cast("bigint")
    bad_value = F.raise_error(F.lit("point with a non-numeric value")).cast("double")
    slot = F.when(position >= 1, position).otherwise(bad_position) - 1
    stamp = F.timestamp_micros(F.unix_micros(began) + slot * minutes * 60000000)
    return timed.select(
        *keep, stamp.alias("timestamp"),
        F.when(value.isNotNull(), value).otherwise(bad_value).alias("value"),
        "unit", F.lit(metric).alias("metric_type"), F.lit(product).alias("product"),
    )


def zone_regions(spark, zones=ZONES) -> DataFrame:
    return spark.createDataFrame(list(zones), "region_id string, zone_code string")


def market_rows(points: DataFrame, zones: DataFrame, regions: DataFrame) -> DataFrame:
    """Rows of all chunks without the overlaps between adjacent ones, anchored to their zone's region."""
    anchors = zones.join(regions, "region_id").select(
        "zone_code", "region_id",
        ((F.col("south") + F.col("north")) / 2).alias("latitude"),
        ((F.col("west") + F.col("east")) / 2).alias("longitude"),
    )
    unique = points.dropDuplicates()
    return unique.join(anchors, "zone_code").withColumn("spatial_scope", F.lit("bidding_zone"))
