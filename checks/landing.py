"""Sources, the lake, array blocks, market documents, rasters and publishing."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import LAT, LON, check
from geopulse.functions import timefns
from geopulse.plans import publish
from geopulse.sources import detections as source
from geopulse.sources import grids, lake, markets, rasters, series
from geopulse.sources.versions import VersionedSink, filesystem
from geopulse.workspace import scratch

# -- lake ------------------------------------------------------------------------


def event_rows(t):
    return t.read("events").select(
        "event_id", F.col("ts").cast("timestamp").alias("observed_at"), F.col("event_type").alias("region_id"), "value"
    )


@check("land", "region_id day:d rows:i total:f",
       """select event_type as region_id, cast(ts as date) as day, count(*) as rows, sum(value) as total from events group by 1, 2""")
def _(t):
    root = scratch(t.spark, "lake")
    for _ in range(2):  # the second landing must leave the same lake
        path = lake.land(event_rows(t), root, "events", "observed_at", max_records_per_file=2000)
    landed = t.spark.read.parquet(path)
    day = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))
    return landed.groupBy(F.col("region").alias("region_id"), day.alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("value").alias("total")
    )


@check("read_lake", "region_id rows:i orders:i total:f2",
       """select region_id, count(*) as rows, count(k) as orders, sum(v) as total from (
          select event_type as region_id, null as k, value as v from events
          union all select o_orderpriority, o_orderkey, o_totalprice from orders) group by 1""")
def _(t):
    root = scratch(t.spark, "lake")
    lake.land(event_rows(t), root, "mixed", "observed_at")
    archive = t.read("orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_orderdate").cast("timestamp").alias("observed_at"),
        F.col("o_orderpriority").alias("region_id"), F.col("o_totalprice").alias("value"),
    )
    lake.land(archive, root, "mixed", "observed_at", backfill=True)
    if lake.read_lake(t.spark, root, "absent") is not None:
        raise AssertionError("an absent source must read as None")
    both = lake.read_lake(t.spark, root, "mixed")
    return both.groupBy("region_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count("k").alias("orders"), F.sum("value").alias("total")
    )


@check("refresh_months", "region_id observation_date:d rows:i total:f2",
       """select o_orderpriority as region_id, o_orderdate as observation_date, count(*) as rows,
          sum(case when o_orderdate between date '1995-03-01' and date '1995-03-31' then 2 else 1 end * o_totalprice) as total
          from orders group by 1, 2""")
def _(t):
    # a staged table is built once, one month of the lake lands again with other values, and only that month is staged anew
    root, path = scratch(t.spark, "lake"), scratch(t.spark, "staged")
    rows = t.read("orders").select(
        F.col("o_orderpriority").alias("region_id"), F.col("o_orderdate").cast("timestamp").alias("observed_at"), F.col("o_totalprice").alias("value"),
    )
    stage = lambda raw: raw.withColumn("observation_date", F.to_date("observed_at"))
    lake.land(rows, root, "orders", "observed_at", backfill=True)
    lake.refresh(t.spark, root, "orders", path, stage, "observation_date")
    again = rows.where("date_format(observed_at, 'yyyy-MM') = '1995-03'").withColumn("value", F.col("value") * 2)
    lake.land(again, root, "orders", "observed_at", backfill=True)
    staged = lake.refresh(t.spark, root, "orders", path, stage, "observation_date", months=["1995-03"])
    return staged.groupBy("region_id", "observation_date").agg(F.count(F.lit(1)).alias("rows"), F.sum("value").alias("total"))


@check("refresh_changed", "region_id observation_date:d rows:i total:f2 rebuilt",
       """select o_orderpriority as region_id, o_orderdate as observation_date, count(*) as rows,
          sum(case when o_orderdate between date '1995-03-01' and date '1995-03-31' then 2 else 1 end * o_totalprice) as total, '1995-03,1996-07' as rebuilt
          from orders where o_orderdate not between date '1996-07-01' and date '1996-07-31' group by 1, 2""")
def _(t):
    # nobody says which months changed: one lands again with other values, one disappears, and only those two are staged anew
    root, path = scratch(t.spark, "lake"), scratch(t.spark, "staged")
    rows = t.read("orders").select(
        F.col("o_orderpriority").alias("region_id"), F.col("o_orderdate").cast("timestamp").alias("observed_at"), F.col("o_totalprice").alias("value"),
    )
    stage = lambda raw: raw.withColumn("observation_date", F.to_date("observed_at"))
    manifests = VersionedSink(t.spark, scratch(t.spark, "manifests"))
    turn = lambda: lake.refresh_changed(t.spark, root, "orders", path, stage, "observation_date", manifests)
    lake.land(rows, root, "orders", "observed_at", backfill=True)
    turn()
    if turn()[1]:
        raise AssertionError("an unchanged lake was staged again")
    again = rows.where("date_format(observed_at, 'yyyy-MM') = '1995-03'").withColumn("value", F.col("value") * 2)
    archive = lake.land(again, root, "orders", "observed_at", backfill=True)
    fs, jpath = filesystem(t.spark, archive)
    for region in fs.listStatus(jpath(archive)):
        fs.delete(jpath(f"{region.getPath()}/year=1996/month=07"), True)
    staged, months = turn()
    return staged.groupBy("region_id", "observation_date").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("value").alias("total")
    ).withColumn("rebuilt", F.lit(",".join(months)))


@check("write_table", "region_id observation_date:d detection_count:i zscore:f", "select * from fire")
def _(t):
    return lake.write_table(t.fire, scratch(t.spark, "table"))


@check("publish", "table state rows added",
       """select 'fire_anomalies' as "table", 'published' as state, count(*) as rows, 'review_note' as added from fire
          union all select 'ice_extent_trends', 'published', count(*), '' from ice
          union all select 'cell_fire', 'published', count(*), '' from cells
          union all select 'cell_sst', 'absent', null, '' from orders having count(*) > 0
          union all select 'deforestation_index', 'absent', null, '' from orders having count(*) > 0
          union all select 'glacier_backscatter', 'absent', null, '' from orders having count(*) > 0
          union all select 'cell_change', 'empty', 0, '' from orders having count(*) > 0""")
def _(t):
    root = scratch(t.spark, "gold")
    marts = {"fire_anomalies": t.fire, "ice_extent_trends": t.ice, "cell_fire": t.cells, "cell_change": t.cells.where("false")}
    publish.publish(t.spark, marts, root)
    marts["fire_anomalies"] = t.fire.withColumn("review_note", F.col("severity"))
    report = publish.publish(t.spark, marts, root, rebuild=["cell_fire"])
    return report.withColumn("added", F.array_join("added_columns", ","))


@check("republish_keeps_scores", "region_id rows:i scored:i flagged:i",
       """select region_id, count(*) as rows, count(*) as scored, count(*) filter (is_anomaly) as flagged from fire group by 1""")
def _(t):
    root = scratch(t.spark, "gold")
    filled = t.fire.withColumns(
        {"anomaly_score": F.lit(0.5), "model_version": F.lit("forest:bbb"), "scored_at": F.lit("2001-10-01").cast("timestamp")}
    )
    publish.publish_table(t.spark, filled, f"{root}/fire_anomalies", ["region_id", "observation_date"], protected=())
    publish.publish_table(t.spark, t.fire, f"{root}/fire_anomalies", ["region_id", "observation_date"])
    return publish.published(t.spark, f"{root}/fire_anomalies").groupBy("region_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count("anomaly_score").alias("scored"), F.count_if("is_anomaly").alias("flagged")
    )


# -- text sources ---------------------------------------------------------------------


@check("ingest_source", "region_id day:d rows:i frp:f2 metric_type unit source_id run_id",
       f"""with p as (select o_orderkey as k, {LAT} as lat, {LON} as lon, o_orderdate as day, o_totalprice as frp from orders where o_totalprice > 0),
          m as (select k, day, frp, (select arg_min(region_id, area) from (select region_id, abs((north - south) * 110.574e0 * (east - west) * 111.320e0
               * cos(radians((south + north) / 2e0))) as area, * from boxes) b where lon between west and east and lat between south and north) as region_id from p)
          select region_id, day, count(*) as rows, sum(frp) as frp, 'fire_radiative_power' as metric_type, 'MW' as unit, 'firms' as source_id, 'run-000001' as run_id
          from m group by 1, 2""")
def _(t):
    from geopulse.sources.source import detections_source

    c, root, inbox = F.col("o_custkey"), scratch(t.spark, "lake"), scratch(t.spark, "inbox")
    t.read("orders").where("o_totalprice > 0").select(
        ((c * 37 % 1200) / 10.0 - 60.0).alias("latitude"), ((c * 101 % 3400) / 10.0 - 170.0).alias("longitude"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("acq_date"), F.lit("0930").alias("acq_time"),
        F.lit("n").alias("confidence"), F.col("o_totalprice").alias("frp"),
    ).write.option("header", "true").csv(inbox)
    firms = detections_source("firms", "VIIRS", 3)
    firms.ingest(t.spark, inbox, root, "run-000001", F.lit("2001-08-02").cast("timestamp"), regions=t.boxes, backfill=True)
    landed = lake.read_lake(t.spark, root, "firms")
    return landed.groupBy("region_id", F.to_date("acq_datetime").alias("day"), "metric_type", "unit", "source_id", "run_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("frp").alias("frp")
    )


@check("read_detections_csv", "product rows:i latitude:f4 acq_date:d frp:f2",
       f"""select 'VIIRS' as product, count(*) as rows, sum({LAT}) as latitude, min(o_orderdate) as acq_date, sum(o_totalprice) as frp from orders""")
def _(t):
    c = F.col("o_custkey")
    path = scratch(t.spark, "csv")
    t.read("orders").select(
        ((c * 37 % 1200) / 10.0 - 60.0).alias(" Latitude"), ((c * 101 % 3400) / 10.0 - 170.0).alias("LONGITUDE "),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("acq_date"), F.col("o_totalprice").alias("FRP"),
    ).write.option("header", "true").csv(path)
    rows = source.coerce_numbers(source.read_detections_csv(t.spark, path, "VIIRS"))
    return rows.groupBy("product").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("latitude").alias("latitude"),
        F.to_timestamp(F.min("acq_date")).alias("acq_date"), F.sum("frp").alias("frp"),
    )


def index_files(t):
    """One publisher file per region and year: a citation, a header, a units row, a line per day."""
    day = F.to_date("o_orderdate")
    daily = t.read("orders").groupBy(F.col("o_orderpriority").alias("region_id"), day.alias("d")).agg(F.count(F.lit(1)).alias("n"))
    line = F.format_string("%d, %d, %d, %d, 0.0, source", F.year("d"), F.month("d"), F.dayofmonth("d"), "n")
    files = daily.groupBy("region_id", F.year("d").alias("y")).agg(F.sort_array(F.collect_list(line)).alias("lines"))
    head = F.concat_ws("\n", F.lit("Citation line, with a comma"), F.lit("Year, Month, Day, Extent, Missing, Source Data"), F.lit("YYYY, MM, DD, 10^6 sq km, 10^6 sq km,"))
    return files.select("region_id", F.concat_ws("\n", head, F.array_join("lines", "\n"), F.lit("bad, 1, 1, x, , ")).alias("text"))


@check("csv_rows", "region_id year:i month:i day:i extent:f",
       """select o_orderpriority as region_id, year(o_orderdate) as year, month(o_orderdate) as month, day(o_orderdate) as day, count(*) as extent
          from orders group by 1, 2, 3, 4""")
def _(t):
    rows = series.csv_rows(index_files(t), "text", "Year", ["year", "month", "day", "extent"], units_rows=1)
    return rows.where("year <> 'bad'")


@check("read_csv_after_header", "region_id:i rows:i extent:f",
       "select 1 as region_id, count(distinct (o_orderpriority, o_orderdate)) as rows, count(*) as extent from orders")
def _(t):
    path = scratch(t.spark, "index")
    files = index_files(t)
    # a text sink writes one file per task, so each document gets its own file through its own folder
    files.select("text", F.md5("text").alias("doc")).repartition("doc").write.partitionBy("doc").text(path)
    rows = series.read_csv_after_header(t.spark, f"{path}/doc=*", "Year", ["year", "month", "day", "extent"], units_rows=1)
    good = rows.where("year <> 'bad'").withColumn("extent", F.col("extent").cast("double"))
    return good.agg(F.count(F.lit(1)).alias("rows"), F.sum("extent").alias("extent")).withColumn("region_id", F.lit(1))


@check("sea_ice_daily", "region_id timestamp:t value:f metric_type unit spatial_scope",
       """select o_orderpriority as region_id, o_orderdate as timestamp, count(*) as value, 'sea_ice_extent' as metric_type,
          '10^6 km^2' as unit, 'hemispheric' as spatial_scope from orders
          where o_orderdate between timestamp '1996-03-01' and timestamp '2000-09-30' group by 1, 2""")
def _(t):
    rows = series.csv_rows(index_files(t), "text", "Year", ["year", "month", "day", "extent"], units_rows=1)
    return series.sea_ice_daily(rows, F.lit("1996-03-01").cast("date"), F.lit("2000-09-30").cast("date"))


@check("climatology", "region_id day_of_year:i value:f baseline_stddev:f timestamp:t metric_type",
       """select o_orderpriority as region_id, dayofyear(o_orderdate) as day_of_year, count(*) as value, null as baseline_stddev,
          cast(date '2001-01-01' + cast(least(dayofyear(o_orderdate), 365) - 1 as int) as timestamp) as timestamp, 'sea_ice_extent_climatology' as metric_type
          from orders group by 1, 2, 5""")
def _(t):
    doy = F.dayofyear("o_orderdate")
    daily = t.read("orders").groupBy(F.col("o_orderpriority").alias("region_id"), doy.alias("doy")).agg(F.count(F.lit(1)).alias("n"))
    line = F.concat_ws(", ", "doy", "n", F.lit("n/a"))
    files = daily.groupBy("region_id").agg(F.collect_list(line).alias("lines"))
    text = F.concat_ws("\n", F.lit("std Years = 1981-2010"), F.lit("DOY, Average Extent, Std Deviation"), F.array_join("lines", "\n"))
    rows = series.csv_rows(files.select("region_id", text.alias("text")), "text", "DOY", ["doy", "average extent", "std deviation"])
    return series.climatology(rows)


# -- grids -------------------------------------------------------------------------------


GRID = """(select vec_id, (i - 1) // 8 as y, (i - 1) % 8 as x, cast(embedding[i] as double) as v
  from (select vec_id, embedding, unnest(range(1, 65)) as i from embeddings))"""


def blocks(t):
    """Each vector as a one-step 8 x 8 block; large values carry the fill value, some are NaN."""
    fill = F.lit(grids.DEFAULT_FILL)
    cell = lambda v: F.when(v > 0.3, fill).when(v < -0.3, F.lit(float("nan"))).otherwise(v)
    flat = F.transform("embedding", lambda v: cell(v.cast("double")))
    rows = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda y: F.slice(flat, (y * 8 + 1).cast("int"), 8))
    axis = lambda start: F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: start + i * 0.25)
    return t.read("embeddings").select(
        "vec_id", F.array(rows).alias("values"), F.array("vec_id").alias("times"),
        axis(F.lit(40.0)).alias("lats"), axis(F.lit(179.0)).alias("lons"),
    )


@check("flatten_grid", "vec_id timestamp:i latitude:f longitude:f value:f",
       f"""select vec_id, vec_id as timestamp, 40 + y * 0.25e0 as latitude,
          case when 179 + x * 0.25e0 >= 180 then 179 + x * 0.25e0 - 360 else 179 + x * 0.25e0 end as longitude, v as value
          from {GRID} where y % 2 = 0 and x % 2 = 0 and v between -0.3 and 0.3""")
def _(t):
    return grids.flatten_grid(blocks(t), sample_deg=0.5)


# -- market documents -------------------------------------------------------------------------


MARKET = """(select o_custkey as c, row_number() over (partition by o_custkey order by o_orderkey) as pos, o_totalprice as v,
  min(o_orderdate) over (partition by o_custkey) as s from orders)"""


def documents(t, load: bool):
    """One document per customer; every third point is an empty slot, and positions restart in a second period."""
    tag = "quantity" if load else "price.amount"
    by = F.struct("o_orderkey", "o_totalprice")
    # some bytes of an order become a page of XML: partitions merged by their bytes would leave cores idle
    dealt = t.read("orders").repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")), "o_custkey")
    docs = dealt.groupBy(F.col("o_custkey").alias("c")).agg(
        F.sort_array(F.collect_list(by)).alias("o"), F.min("o_orderdate").alias("s")
    )
    point = F.transform(
        "o",
        lambda x, i: F.concat(
            F.lit("<Point><position>"), (i + 1).cast("string"), F.lit("</position>"),
            F.when((i + 1) % 3 != 0, F.concat(F.lit(f"<{tag}>"), x["o_totalprice"].cast("decimal(18,2)").cast("string"), F.lit(f"</{tag}>"))).otherwise(""),
            F.lit("</Point>"),
        ),
    )
    period = F.concat(
        F.lit("<Period><timeInterval><start>"), F.date_format("s", "yyyy-MM-dd'T'HH:mm'Z'"), F.lit("</start></timeInterval><resolution>"),
        F.when(F.col("c") % 2 == 0, "PT60M").otherwise("P1DT15M"), F.lit("</resolution>"), F.array_join(point, ""), F.lit("</Period>"),
    )
    root = "GL_MarketDocument" if load else "Publication_MarketDocument"
    unit = (
        "<quantity_Measure_Unit.name>MAW</quantity_Measure_Unit.name>" if load
        else "<currency_Unit.name>EUR</currency_Unit.name><price_Measure_Unit.name>MWH</price_Measure_Unit.name>"
    )
    body = F.concat(F.lit(f'<?xml version="1.0"?><{root} xmlns="urn:x:y"><TimeSeries>{unit}'), period, period, F.lit(f"</TimeSeries></{root}>"))
    ack = F.lit("<Acknowledgement_MarketDocument><Reason><text>No matching data found</text></Reason></Acknowledgement_MarketDocument>")
    return docs.select("c", F.explode(F.array(body, ack)).alias("xml"))


POINTS = f"""(select c, s + to_minutes(cast((pos - 1) * case when c % 2 = 0 then 60 else 1455 end as bigint)) as timestamp, v as value
  from {MARKET}, (values (1), (2)) as twice(p) where pos % 3 <> 0)"""


@check("parse_market_documents", "c timestamp:t value:f unit metric_type product",
       f"""select *, 'EUR/MWH' as unit, 'day_ahead_price' as metric_type, 'A44_day_ahead_price' as product from {POINTS}
          union all select *, 'MAW', 'actual_load', 'A65_actual_load' from {POINTS}""")
def _(t):
    price = markets.parse_market_documents(documents(t, False), "day_ahead_price")
    return price.unionByName(markets.parse_market_documents(documents(t, True), "actual_load"))


@check("market_rows", "zone_code region_id timestamp:t value:f latitude:f longitude:f spatial_scope",
       f"""select distinct 'NATION_' || c % 30 as zone_code, b.region_id, timestamp, value, (south + north) / 2 as latitude,
          (west + east) / 2 as longitude, 'bidding_zone' as spatial_scope
          from {POINTS} p join boxes b on b.region_id = 'NATION_' || c % 30""")
def _(t):
    points = markets.parse_market_documents(documents(t, False), "day_ahead_price")
    zoned = points.select(F.concat(F.lit("NATION_"), F.col("c") % 30).alias("zone_code"), "timestamp", "value")
    zones = t.boxes.select(F.col("region_id").alias("zone_code"), "region_id")
    return markets.market_rows(zoned, zones, t.boxes)


# -- rasters --------------------------------------------------------------------------------------


PIXELS = """(select l_returnflag || l_linestatus as region_id, 'c' || l_suppkey % 50 as h3_index, cast(l_shipdate as date) as day,
  l_partkey as qa, l_suppkey % 100 as cloud_pct, l_extendedprice as nir, l_quantity * 1000 as red,
  (l_extendedprice - l_quantity * 1000) / (l_extendedprice + l_quantity * 1000) as value,
  case when l_linenumber % 2 = 0 then 'IW' else 'EW' end as mode, l_linenumber from lineitem)"""


def pixels(t):
    nir, red = F.col("l_extendedprice"), F.col("l_quantity") * 1000
    return t.read("lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("region_id"), F.concat(F.lit("c"), F.col("l_suppkey") % 50).alias("h3_index"),
        F.to_date("l_shipdate").alias("day"), F.col("l_partkey").alias("qa"), (F.col("l_suppkey") % 100).alias("cloud_pct"),
        nir.alias("nir"), red.alias("red"), rasters.ndvi(nir, red).alias("value"),
        F.when(F.col("l_linenumber") % 2 == 0, "IW").otherwise("EW").alias("mode"),
        F.when(F.col("l_linenumber") % 3 == 0, F.array(F.lit("VH"))).otherwise(F.array(F.lit("VV"), F.lit("VH"))).alias("polarisations"),
    )


@check("mask_clouds", "region_id rows:i value:f",
       f"""select region_id, count(*) as rows, avg(value) as value from {PIXELS} where cloud_pct < 60 and (qa & 3072) = 0 group by 1""")
def _(t):
    return rasters.mask_clouds(pixels(t)).groupBy("region_id").agg(F.count(F.lit(1)).alias("rows"), F.avg("value").alias("value"))


@check("radar_scenes", "region_id rows:i", f"select region_id, count(*) as rows from {PIXELS} where mode = 'IW' and l_linenumber % 3 <> 0 group by 1")
def _(t):
    return rasters.radar_scenes(pixels(t)).groupBy("region_id").agg(F.count(F.lit(1)).alias("rows"))


@check("zonal_stats", "region_id month:d mean:f stddev:f observation_count:i min:f max:f",
       f"""select region_id, cast(date_trunc('month', day) as date) as month, avg(value) as mean, stddev_pop(value) as stddev,
          count(value) as observation_count, min(value) as min, max(value) as max from {PIXELS} group by 1, 2""")
def _(t):
    return rasters.zonal_stats(pixels(t).withColumn("month", F.trunc("day", "month")), ["region_id", "month"])


SPAN = """(select min(cast(l_shipdate as date)) as a, max(cast(l_shipdate as date)) as b from lineitem)"""


def weeks(t):
    day = F.to_date("l_shipdate")
    span = t.read("lineitem").agg(F.min(day).alias("a"), F.max(day).alias("b"))
    return span.select(F.explode(timefns.composite_windows(F.col("a"), F.col("b"), "W")).alias("w")).select("w.*")


@check("composite_mean", "region_id window_start:d window_end:d mean:f observation_count:i",
       f"""select region_id, a + cast(7 * ((day - a) // 7) as int) as window_start, least(a + cast(7 * ((day - a) // 7) + 6 as int), b) as window_end,
          avg(value) as mean, count(value) as observation_count from {PIXELS}, {SPAN} group by 1, 2, 3""")
def _(t):
    return rasters.composite_mean(pixels(t), weeks(t), ["region_id"])


@check("composite_wide", "region_id band mean:f",
       f"""select region_id, 'ndvi_' || strftime(least(last_day(day), b), '%Y%m%d') as band, avg(value) as mean
          from {PIXELS}, {SPAN} group by 1, 2""")
def _(t):
    day = F.to_date("l_shipdate")
    span = t.read("lineitem").agg(F.min(day).alias("a"), F.max(day).alias("b"))
    months = span.select(F.explode(timefns.month_windows(F.col("a"), F.col("b"))).alias("w")).select("w.*")
    means = rasters.composite_mean(pixels(t), months, ["region_id"])
    # every window end of the data is a column, one for each month; turned back into rows to compare
    ends = [str(r[0]) for r in months.select("window_end").orderBy("window_end").collect()]
    wide = rasters.composite_wide(means, ["region_id"], "ndvi", ends)
    return wide.unpivot("region_id", wide.columns[1:], "band", "mean").where("mean is not null")


@check("grid_change", "region_id h3_index recent_mean:f baseline_mean:f mean:f",
       f"""select *, recent_mean - baseline_mean as mean from (
          select region_id, h3_index, avg(value) filter (day between date '2000-01-01' and date '2000-12-31') as recent_mean,
          avg(value) filter (day between date '2000-01-01' - 365 and date '2000-12-31' - 365) as baseline_mean from {PIXELS} group by 1, 2)
          where recent_mean is not null and baseline_mean is not null""")
def _(t):
    return rasters.grid_change(pixels(t), F.lit("2000-01-01").cast("date"), F.lit("2000-12-31").cast("date"))
