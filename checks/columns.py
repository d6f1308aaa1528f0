"""Staging projections and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import ASOF, LAT, LON, check
from geopulse.contracts import DETECTIONS, GRIDDED, METRIC_UNITS, conform, enrich, to_silver, validate
from geopulse.functions import detections as dx
from geopulse.functions import hexgrid, scoring, text, timefns
from geopulse.operators import features
from geopulse.plans import staging
from geopulse.sources import detections as source

# -- staging ------------------------------------------------------------------


@check("stg_detections",
       "observed_at:t observation_date:d latitude:f longitude:f h3_index region_id product confidence confidence_pct:f frp:f "
       "brightness_k:f daynight satellite instrument ingested_at:t run_id", "select * from detections")
def _(t):
    return staging.stg_detections(t.det_raw)


@check("type_detections", "observed_at:t latitude:f longitude:f region_id product frp:f brightness_k:f run_id",
       "select *, acq_datetime as observed_at, coalesce(bright_ti4, brightness) as brightness_k from det_raw")
def _(t):
    return staging.type_detections(t.det_raw)


@check("stg_gridded",
       "observed_at:t observation_date:d month_start:d latitude:f longitude:f h3_index region_id metric_type product "
       "spatial_scope value:f unit baseline_stddev:f day_of_year ingested_at:t run_id", "select * from gridded")
def _(t):
    return staging.stg_gridded(t.grid_raw)


@check("stg_composites",
       "window_start:t window_end:t period_end:d month_start:d latitude:f longitude:f h3_index region_id product metric_type "
       "spatial_scope value_mean:f value_stddev:f value_min:f value_max:f observation_count:i cloud_pct:f baseline_mean:f "
       "recent_mean:f ingested_at:t run_id", "select * from composites")
def _(t):
    return staging.stg_composites(t.comp_raw)


@check("utc_calendar", "event_id day:d month:d",
       "select event_id, cast(ts as date) as day, cast(date_trunc('month', ts) as date) as month from events")
def _(t):
    ts = F.col("ts").cast("timestamp")
    return t.read("events").select("event_id", timefns.utc_date(ts).alias("day"), timefns.month_start(ts).alias("month"))


# -- raw detections -------------------------------------------------------------

RAW = """select event_id,
  case event_id % 8 when 0 then 'l' when 1 then ' N ' when 2 then 'high' when 3 then '-4' when 4 then '250'
       when 5 then 'n/a' when 6 then cast((event_id * 7) % 101 as varchar) else cast((event_id * 7) % 101 as varchar) || '.5' end as confidence,
  case when event_id % 13 = 0 then 'bad' else strftime(ts, '%Y-%m-%d') end as acq_date,
  case when event_id % 17 = 0 then '9999' when event_id % 3 = 0
       then cast(hour(ts) * 100 + minute(ts) as varchar) || '.0' else cast(hour(ts) * 100 + minute(ts) as varchar) end as acq_time,
  case event_id % 5 when 0 then 'day' when 1 then ' n' when 2 then '' when 3 then 'X' else 'N' end as daynight,
  case event_id % 4 when 0 then ' ' when 1 then 'nan' when 2 then ' T ' else 'A' end as satellite,
  case when event_id % 6 = 0 then 'abc' when event_id % 6 = 1 then '-' || cast(value as varchar) else cast(value as varchar) end as frp,
  case when event_id % 9 = 0 then '' else cast(user_id % 180 - 90 as varchar) end as latitude,
  cast(user_id % 360 - 180 as varchar) as longitude, ts
from events"""


def raw(t):
    """Events written the way instruments deliver them: text, padded, sometimes broken."""
    e, ts = F.col("event_id"), F.col("ts").cast("timestamp")
    pct = (e * 7 % 101).cast("string")
    confidence = (
        F.when(e % 8 == 0, "l").when(e % 8 == 1, " N ").when(e % 8 == 2, "high").when(e % 8 == 3, "-4")
        .when(e % 8 == 4, "250").when(e % 8 == 5, "n/a").when(e % 8 == 6, pct).otherwise(F.concat(pct, F.lit(".5")))
    )
    clock = (F.hour(ts) * 100 + F.minute(ts)).cast("string")
    value = F.col("value").cast("string")
    return t.read("events").select(
        "event_id", confidence.alias("confidence"),
        F.when(e % 13 == 0, "bad").otherwise(F.date_format(ts, "yyyy-MM-dd")).alias("acq_date"),
        F.when(e % 17 == 0, "9999").when(e % 3 == 0, F.concat(clock, F.lit(".0"))).otherwise(clock).alias("acq_time"),
        F.when(e % 5 == 0, "day").when(e % 5 == 1, " n").when(e % 5 == 2, "").when(e % 5 == 3, "X").otherwise("N").alias("daynight"),
        F.when(e % 4 == 0, " ").when(e % 4 == 1, "nan").when(e % 4 == 2, " T ").otherwise("A").alias("satellite"),
        F.when(e % 6 == 0, "abc").when(e % 6 == 1, F.concat(F.lit("-"), value)).otherwise(value).alias("frp"),
        F.when(e % 9 == 0, "").otherwise((F.col("user_id") % 180 - 90).cast("string")).alias("latitude"),
        (F.col("user_id") % 360 - 180).cast("string").alias("longitude"), ts.alias("ts"),
    )


@check("normalise_confidence", "event_id confidence_level confidence_pct:f",
       f"""select event_id,
          case when w in ('l', 'low') then 'low' when w in ('n', 'nominal') then 'nominal' when w in ('h', 'high') then 'high'
               when p is null then null when p < 30 then 'low' when p >= 80 then 'high' else 'nominal' end as confidence_level,
          case when w in ('l', 'low') then 30e0 when w in ('n', 'nominal') then 60e0 when w in ('h', 'high') then 90e0
               else p end as confidence_pct
          from (select event_id, lower(trim(confidence)) as w,
                       least(100e0, case when try_cast(trim(confidence) as double) is not null
                             then greatest(0e0, try_cast(trim(confidence) as double)) end) as p0,
                       case when try_cast(trim(confidence) as double) is not null then p0 end as p from ({RAW}))""")
def _(t):
    c = F.col("confidence")
    return raw(t).select(
        "event_id", dx.confidence_level(c).alias("confidence_level"), dx.confidence_pct(c).alias("confidence_pct")
    )


@check("coerce_numbers", "event_id latitude:f longitude:f frp:f",
       f"""select event_id, try_cast(latitude as double) as latitude, try_cast(longitude as double) as longitude,
          try_cast(frp as double) as frp from ({RAW}) where try_cast(latitude as double) is not null""")
def _(t):
    return source.coerce_numbers(raw(t))


ACQ = f"""select *, try_strptime(acq_date || ' ' || clock, '%Y-%m-%d %H%M') as acq_datetime
  from (select *, lpad(regexp_replace(acq_time, '\\.0$', ''), 4, '0') as clock from ({RAW}))"""


@check("acquisition_time", "event_id clock acq_datetime:t", ACQ)
def _(t):
    return raw(t).select(
        "event_id", dx.clock_digits(F.col("acq_time")).alias("clock"),
        dx.acquisition_time(F.col("acq_date"), F.col("acq_time")).alias("acq_datetime"),
    )


@check("time_report", "rows:i kept:i rejected:i",
       f"select count(*) as rows, count(acq_datetime) as kept, count(*) - count(acq_datetime) as rejected from ({ACQ})")
def _(t):
    return source.time_report(source.parse_times(raw(t)))


@check("day_night", "event_id daynight satellite frp:f",
       f"""select event_id, case when upper(substr(trim(daynight), 1, 1)) in ('D', 'N') then upper(substr(trim(daynight), 1, 1)) end as daynight,
          case when trim(satellite) not in ('', 'nan') then trim(satellite) end as satellite,
          case when try_cast(frp as double) >= 0 then try_cast(frp as double) end as frp from ({RAW})""")
def _(t):
    return raw(t).select(
        "event_id", dx.day_night(F.col("daynight")).alias("daynight"), dx.blank_to_null(F.col("satellite")).alias("satellite"),
        dx.non_negative(F.col("frp").try_cast("double")).alias("frp"),
    )


@check("normalise_detections", "event_id acq_datetime:t latitude:f confidence daynight frp:f",
       f"""select event_id, acq_datetime, try_cast(latitude as double) as latitude,
          case when event_id % 8 in (0, 3) then 'low' when event_id % 8 = 1 then 'nominal' when event_id % 8 in (2, 4) then 'high'
               when event_id % 8 = 5 then null when (event_id * 7) % 101 + case event_id % 8 when 7 then 0.5 else 0 end < 30 then 'low'
               when (event_id * 7) % 101 + case event_id % 8 when 7 then 0.5 else 0 end >= 80 then 'high' else 'nominal' end as confidence,
          case event_id % 5 when 0 then 'D' when 1 then 'N' when 4 then 'N' end as daynight,
          case when try_cast(frp as double) >= 0 then try_cast(frp as double) end as frp
          from ({ACQ}) where acq_datetime is not null and try_cast(latitude as double) is not null""")
def _(t):
    return source.normalise(raw(t), strict=False)


@check("first_number", "k:i b:i attempt:i brightness_k:f",
       "select k, b, attempt, coalesce(bright_ti4, brightness) as brightness_k from det_raw")
def _(t):
    value = dx.first_number(F.col("bright_ti4").cast("string"), F.col("brightness").cast("string"))
    return t.det_raw.select("k", "b", "attempt", value.alias("brightness_k"))


# -- contracts -------------------------------------------------------------------

MARKET = """select o_orderkey as k, case o_orderkey % 3 when 0 then 'day_ahead_price' when 1 then 'actual_load' end as metric_type,
  case o_orderkey % 3 when 0 then 'EUR/MWH' when 1 then case when o_orderkey % 2 = 0 then 'MAW' end end as unit,
  case when o_orderkey % 5 <> 0 then o_orderpriority end as region_id, o_totalprice as value from orders"""


def market(t):
    k = F.col("o_orderkey")
    return t.read("orders").select(
        k.alias("k"), F.when(k % 3 == 0, "day_ahead_price").when(k % 3 == 1, "actual_load").alias("metric_type"),
        F.when(k % 3 == 0, "EUR/MWH").when((k % 3 == 1) & (k % 2 == 0), "MAW").alias("unit"),
        F.when(k % 5 != 0, F.col("o_orderpriority")).alias("region_id"), F.col("o_totalprice").alias("value"),
    )


@check("enrich", "k:i metric_type unit region_id source_id run_id ingested_at:t",
       f"""select k, coalesce(metric_type, 'sea_ice_extent') as metric_type,
          case when metric_type = 'day_ahead_price' then 'EUR/MWh' when metric_type = 'actual_load' then 'MW' else '10^6 km^2' end as unit,
          coalesce(region_id, 'iberia_fire') as region_id, 'entsoe' as source_id, 'run-000001' as run_id,
          timestamp '2001-08-02 00:00:00' as ingested_at from ({MARKET})""")
def _(t):
    return enrich(
        market(t), "entsoe", "sea_ice_extent", "run-000001", F.lit(ASOF).cast("timestamp"), region_id="iberia_fire"
    )


@check("conform", "k:i scan_null:i type_null:i columns:i",
       "select k, 1 as scan_null, 1 as type_null, 27 as columns from det_raw")
def _(t):
    df = conform(t.det_raw, DETECTIONS)
    return df.select(
        "k", F.col("scan").isNull().cast("int").alias("scan_null"), F.col("type").isNull().cast("int").alias("type_null"),
        F.lit(len(df.columns)).alias("columns"),
    )


@check("to_silver", "observed_at:t metric_type value:f unit source_id region_id h3_index product",
       """select timestamp as observed_at, metric_type, value, unit, 'noaa_nsidc' as source_id, region_id, h3_index, product
          from grid_raw""")
def _(t):
    return to_silver(t.grid_raw.withColumn("source_id", F.lit("noaa_nsidc")), "timestamp", "value")


@check("metric_units", "metric_type unit rows:i",
       """select metric_type, case metric_type when 'sst_anomaly' then 'degC' else '10^6 km^2' end as unit, count(*) as rows
          from grid_raw group by 1, 2""")
def _(t):
    units = F.create_map(*[F.lit(x) for pair in METRIC_UNITS.items() for x in pair])
    return t.grid_raw.groupBy("metric_type", F.try_element_at(units, F.col("metric_type")).alias("unit")).agg(
        F.count(F.lit(1)).alias("rows")
    )


@check("validate", "column check failures:i example_low example_high",
       f"""select * from (
         select 'latitude' as "column", 'coerce' as "check", count(*) as failures, min(latitude) as example_low, max(latitude) as example_high
         from ({RAW}) where latitude = ''
         union all select 'acq_datetime', 'required', 1, null, null from events having count(*) > 0
         union all select 'acq_date', 'matches', count(*), min(acq_date), max(acq_date) from ({RAW}) where acq_date = 'bad'
         union all select 'acq_time', 'matches', count(*), min(acq_time), max(acq_time) from ({RAW}) where not regexp_matches(acq_time, '^\\d{{4}}$')
         union all select 'product', 'required', 1, null, null from events having count(*) > 0
         union all select 'confidence', 'isin', count(*), min(confidence), max(confidence) from ({RAW}) where confidence <> 'high'
         union all select 'confidence_pct', 'required', 1, null, null from events having count(*) > 0
         union all select 'daynight', 'isin', count(*), min(daynight), max(daynight) from ({RAW}) where daynight not in ('D', 'N')
         union all select 'frp', 'coerce', count(*), min(frp), max(frp) from ({RAW}) where try_cast(frp as double) is null
         union all select 'frp', 'ge(0)', count(*), min(frp), max(frp) from ({RAW}) where try_cast(frp as double) < 0
       ) where failures > 0""")
def _(t):
    return validate(raw(t).drop("ts"), DETECTIONS)


@check("validate_gridded", "column check failures:i",
       """with bad as (select case when value < -2 then null else value end as value, case when value between 0 and 0.5 then 'mystery' else metric_type end as metric_type,
            case when value between -1 and 0 then -1e0 else baseline_stddev end as baseline_stddev, case when value between -2 and -1 then 400e0 else day_of_year end as day_of_year from grid_raw)
          select 'value' as "column", 'not_null' as "check", count(*) as failures from bad where value is null having count(*) > 0
          union all select 'metric_type', 'isin', count(*) from bad
          where metric_type not in ('sst_anomaly', 'sea_ice_extent', 'sea_ice_extent_climatology') having count(*) > 0
          union all select 'baseline_stddev', 'ge(0)', count(*) from bad where baseline_stddev < 0 having count(*) > 0
          union all select 'day_of_year', 'le(366)', count(*) from bad where day_of_year > 366 having count(*) > 0""")
def _(t):
    v = F.col("value")
    bad = t.grid_raw.select(
        "*", v.alias("was")
    ).withColumns({
        "value": F.when(v < -2, None).otherwise(v), "metric_type": F.when(v.between(0, 0.5), "mystery").otherwise(F.col("metric_type")),
        "baseline_stddev": F.when(v.between(-1, 0), -1.0).otherwise(F.col("baseline_stddev")),
        "day_of_year": F.when(v.between(-2, -1), 400.0).otherwise(F.col("day_of_year")),
    }).drop("was")
    return validate(bad, GRIDDED)


# -- scores and ratios --------------------------------------------------------------


@check("safe_ratios", "region_id observation_date:d night:f dense:f intensity:f",
       """select region_id, observation_date, night_detection_share as night, cell_concentration as dense,
          frp_per_detection as intensity from fire""")
def _(t):
    n = F.col("detection_count")
    return t.daily.select(
        "region_id", "observation_date", scoring.safe_ratio(F.col("night_detection_count"), n).alias("night"),
        scoring.safe_ratio(F.col("max_cell_detections"), n).alias("dense"), scoring.safe_ratio(F.col("frp_sum"), n).alias("intensity"),
    )


SCORED_LINES = """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  case when l_quantity >= 10 then (l_quantity - 25) / greatest(coalesce(case when l_linenumber > 1 then l_tax * 40 end, 0e0), 0.5e0) end as z
  from lineitem"""


def scored_lines(t):
    scale = F.when(F.col("l_linenumber") > 1, F.col("l_tax") * 40)
    z = scoring.zscore(F.col("l_quantity"), F.lit(25.0), scale, 0.5, F.col("l_quantity") >= 10)
    return t.read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", z.alias("z"))


@check("zscore", "l_orderkey l_linenumber l_partkey l_suppkey z:f", SCORED_LINES)
def _(t):
    return scored_lines(t)


@check("severity", "upper lower both n:i",
       f"""select case when z is null then 'unknown' when z >= 12 then 'extreme' when z >= 8 then 'high' when z >= 5 then 'moderate' else 'normal' end as upper,
          case when z is null then 'unknown' when z <= -4 then 'extreme' when z <= -3 then 'high' when z <= -2 then 'moderate' else 'normal' end as lower,
          case when z is null then 'unknown' when abs(z) >= 4 then 'extreme' when abs(z) >= 3 then 'high' when abs(z) >= 2.5 then 'moderate' else 'normal' end as both,
          count(*) as n from ({SCORED_LINES}) group by 1, 2, 3""")
def _(t):
    from geopulse.config import FIRE_LADDER, ICE_LADDER, NDVI_LADDER

    z = F.col("z")
    return scored_lines(t).groupBy(
        scoring.severity(z, FIRE_LADDER, 5.0).alias("upper"), scoring.severity(z, NDVI_LADDER, -2.0, "lower").alias("lower"),
        scoring.severity(z, ICE_LADDER, 2.5, "both").alias("both"),
    ).agg(F.count(F.lit(1)).alias("n"))


@check("is_anomaly", "upper lower both n:i",
       f"""select coalesce(cast(z >= 5 as varchar), 'null') as upper, coalesce(cast(z <= -2 as varchar), 'null') as lower,
          coalesce(cast(abs(z) >= 2.5 as varchar), 'null') as both, count(*) as n from ({SCORED_LINES}) group by 1, 2, 3""")
def _(t):
    flag = lambda limit, tail: F.coalesce(scoring.is_anomaly(F.col("z"), limit, tail).cast("string"), F.lit("null"))
    return scored_lines(t).groupBy(
        flag(5.0, "upper").alias("upper"), flag(-2.0, "lower").alias("lower"), flag(2.5, "both").alias("both")
    ).agg(F.count(F.lit(1)).alias("n"))


@check("seasonal_encoding", "o_orderkey doy_sin:f doy_cos:f",
       """select o_orderkey, sin(2 * pi() * dayofyear(o_orderdate) / 365.25e0) as doy_sin,
          cos(2 * pi() * dayofyear(o_orderdate) / 365.25e0) as doy_cos from orders""")
def _(t):
    return features.seasonal_encoding(t.read("orders"), "o_orderdate")


@check("feature_ratios",
       "region_id observation_date:d count_delta_1 count_ratio_7:f count_ratio_30:f fire_dispersion:f frp_per_detection:f high_confidence_share:f",
       "select * from feature_table")
def _(t):
    return features.ratios(features.trailing_windows(features.lags(features.scoreable_days(t.fire))))


@check("ramp_step", "l_orderkey l_linenumber l_partkey l_suppkey step:i",
       """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
          least((l_quantity >= 5)::int + (l_quantity >= 20)::int + (l_quantity >= 35)::int + (l_quantity >= 45)::int, 4) as step from lineitem""")
def _(t):
    step = scoring.ramp_step(F.col("l_quantity"), [5.0, 20.0, 35.0, 45.0])
    return t.read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", step.alias("step"))


@check("web_mercator", "o_orderkey x:f y:f",
       f"""select o_orderkey, (lon + 180) / 360 as x,
          least(1e0, greatest(0e0, (1 - ln(tan(phi) + 1 / cos(phi)) / pi()) / 2)) as y
          from (select o_orderkey, lon, radians(greatest(-85.051129e0, least(85.051129e0, lat))) as phi
                from (select o_orderkey, ({LAT}) * 1.6e0 as lat, {LON} as lon from orders))""")
def _(t):
    c = F.col("o_custkey")
    lat, lon = (c * 37 % 1200) / 10.0 - 60.0, (c * 101 % 3400) / 10.0 - 170.0
    return t.read("orders").select("o_orderkey", hexgrid.mercator_x(lon).alias("x"), hexgrid.mercator_y(lat * 1.6).alias("y"))


@check("rounded_display", "region_id observation_date:d z:f pct:f",
       """select region_id, observation_date, round(zscore, 1) as z, round(anomaly_percentile, 3) as pct from scored""")
def _(t):
    return t.scored.select(
        "region_id", "observation_date", F.round("zscore", 1).alias("z"), F.round("anomaly_percentile", 3).alias("pct")
    )


# -- windows of time and longitude -----------------------------------------------------

USER_SPAN = "(select user_id, cast(min(ts) as date) as a, cast(max(ts) as date) as b from events group by 1)"


def spans(t):
    """First and last active day of every user."""
    day = F.to_date("ts")
    return t.read("events").groupBy("user_id").agg(F.min(day).alias("a"), F.max(day).alias("b"))


@check("date_windows", "user_id window_start:d window_end:d",
       f"""select user_id, cast(d as date) as window_start, least(cast(d as date) + 4, b) as window_end
          from (select user_id, b, unnest(generate_series(a, b, interval 5 day)) as d from {USER_SPAN})""")
def _(t):
    return spans(t).select("user_id", F.explode(timefns.date_windows(F.col("a"), F.col("b"), 5)).alias("w")).select("user_id", "w.*")


CUSTOMER_SPAN = "(select o_custkey as k, cast(min(o_orderdate) as date) as a, cast(max(o_orderdate) as date) as b from orders group by 1)"


def customer_spans(t):
    day = F.to_date("o_orderdate")
    return t.read("orders").groupBy(F.col("o_custkey").alias("k")).agg(F.min(day).alias("a"), F.max(day).alias("b"))


@check("composite_windows", "user_id period window_start:d window_end:d",
       f"""select user_id, 'D' as period, cast(d as date) as window_start, cast(d as date) as window_end
          from (select user_id, unnest(generate_series(a, b, interval 1 day)) as d from {USER_SPAN})
          union all select user_id, 'W', cast(d as date), least(cast(d as date) + 6, b)
          from (select user_id, b, unnest(generate_series(a, b, interval 7 day)) as d from {USER_SPAN})
          union all select user_id, 'M', greatest(cast(d as date), a), least(last_day(cast(d as date)), b)
          from (select user_id, a, b, unnest(generate_series(date_trunc('month', a), b, interval 1 month)) as d from {USER_SPAN})""")
def _(t):
    parts = [
        spans(t).select("user_id", F.lit(p).alias("period"), F.explode(timefns.composite_windows(F.col("a"), F.col("b"), p)).alias("w"))
        for p in ("D", "W", "M")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("user_id", "period", "w.*")


@check("month_chunks", "k chunk_start:d chunk_end:d",
       f"""select k, greatest(cast(d as date), a) as chunk_start, least(cast(d + interval 1 month as date), b + 1) as chunk_end
          from (select k, a, b, unnest(generate_series(date_trunc('month', a), b, interval 1 month)) as d from {CUSTOMER_SPAN})""")
def _(t):
    return customer_spans(t).select("k", F.explode(timefns.month_chunks(F.col("a"), F.col("b"))).alias("w")).select("k", "w.*")


@check("snap_to_months", "k month_from:d month_to:d",
       f"select k, cast(date_trunc('month', a) as date) as month_from, last_day(b) as month_to from {CUSTOMER_SPAN}")
def _(t):
    low, high = timefns.snap_to_months(F.col("a"), F.col("b"))
    return customer_spans(t).select("k", low.alias("month_from"), high.alias("month_to"))


@check("days_behind", "k days:i hours:f",
       f"""select k, greatest(date_diff('day', b, date '{ASOF}'), 0) as days,
          greatest(date_diff('hour', cast(b as timestamp), timestamp '{ASOF}'), 0) as hours from {CUSTOMER_SPAN}""")
def _(t):
    asof = F.lit(ASOF).cast("date")
    return customer_spans(t).select(
        "k", timefns.days_behind(F.col("b"), asof).alias("days"),
        timefns.hours_behind(F.col("b").cast("timestamp"), asof.cast("timestamp")).alias("hours"),
    )


@check("decode_cf_time", "o_orderkey stamp:t",
       """select o_orderkey, case o_orderkey % 4
          when 0 then timestamp '1990-01-01' + to_seconds((o_custkey * 86400)::bigint)
          when 1 then timestamp '1990-01-01 06:00:00' + to_seconds((o_custkey * 3600)::bigint)
          when 2 then timestamp '1990-01-01' + to_seconds((o_custkey * 60)::bigint)
          else timestamp '1990-01-01' + to_seconds(o_custkey) end as stamp from orders""")
def _(t):
    k = F.col("o_orderkey")
    units = (
        F.when(k % 4 == 0, "days since 1990-01-01").when(k % 4 == 1, " Hours since 1990-01-01 06:00:00 ")
        .when(k % 4 == 2, "minutes since 1990-01-01 00:00:00").otherwise("seconds since 1990-01-01")
    )
    return t.read("orders").select("o_orderkey", timefns.decode_cf_time(F.col("o_custkey"), units).alias("stamp"))


@check("split_lon_window", "o_orderkey lo:f hi:f",
       """select o_orderkey, unnest(case when e - w >= 360 then [{'lo': 0e0, 'hi': 360e0}] when l < h then [{'lo': l, 'hi': h}]
            when l = h then [{'lo': l, 'hi': l}] else [{'lo': l, 'hi': 360e0}, {'lo': 0e0, 'hi': h}] end, recursive := true)
          from (select *, case when h0 = 0 and e > 0 then 360e0 else h0 end as h
                from (select o_orderkey, w, e, w - 360 * floor(w / 360) as l, e - 360 * floor(e / 360) as h0
                      from (select o_orderkey, o_custkey % 360 - 180e0 as w, o_custkey % 360 - 180e0 + (o_orderkey % 37) * 10e0 as e from orders)))""")
def _(t):
    w = F.col("o_custkey") % 360 - 180.0
    e = w + (F.col("o_orderkey") % 37) * 10.0
    return t.read("orders").select("o_orderkey", F.explode(timefns.split_lon_window(w, e)).alias("p")).select("o_orderkey", "p.*")


@check("product_plan", "o_orderkey preferred alternative",
       f"""select o_orderkey, case when age >= 100 then 'sp' when age <= 112 then 'nrt' end as preferred,
          case when age between 100 and 112 then 'nrt' end as alternative
          from (select o_orderkey, date_diff('day', cast(o_orderdate as date), date '{ASOF}') as age from orders)""")
def _(t):
    plan = source.product_plan(F.to_date("o_orderdate"), F.lit(ASOF).cast("date"))
    return t.read("orders").select("o_orderkey", plan.alias("p")).select("o_orderkey", "p.*")


# -- text ------------------------------------------------------------------------------------


@check("fingerprint", "o_orderkey short",
       "select o_orderkey, substr(sha256(concat_ws('|', o_orderpriority, o_orderkey, o_orderstatus)), 1, 12) as short from orders")
def _(t):
    parts = [F.col("o_orderpriority"), F.col("o_orderkey"), F.col("o_orderstatus")]
    return t.read("orders").select("o_orderkey", text.fingerprint(parts).alias("short"))


@check("model_version", "o_orderpriority version",
       """select distinct o_orderpriority, 'forest:' || substr(sha256('forest|' || o_orderpriority || '|[''a'', ''b'']|300|42'), 1, 12) as version
          from orders""")
def _(t):
    version = text.model_version("forest", F.col("o_orderpriority"), ["b", "a"], 300, 42)
    return t.read("orders").select("o_orderpriority").distinct().select("o_orderpriority", version.alias("version"))


@check("export_values", "o_orderkey price:f day stamp flag:i amount:f",
       """select o_orderkey, case when o_orderkey % 3 = 0 then o_totalprice end as price, strftime(o_orderdate, '%Y-%m-%d') as day,
          strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as stamp, (o_orderkey % 2 = 0)::int as flag, o_totalprice as amount from orders""")
def _(t):
    k = F.col("o_orderkey")
    price = F.when(k % 3 == 0, F.col("o_totalprice")).when(k % 3 == 1, F.lit(float("nan"))).otherwise(F.lit(float("-inf")))
    return text.export_values(
        t.read("orders").select(
            "o_orderkey", price.alias("price"), F.to_date("o_orderdate").alias("day"),
            F.col("o_orderdate").cast("timestamp").alias("stamp"), (k % 2 == 0).alias("flag"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        )
    )


# every text gets credentials in each recognised shape, built from its own key
LEAK = """' Bearer ' || md5(KEY) || ' hf_' || md5(KEY) || ' eyJ' || md5(KEY) || '.' || md5(KEY) || '.' || md5(KEY)
  || ' https://hooks.slack.com/services/' || md5(KEY) || ' https://discord.com/api/webhooks/' || md5(KEY)
  || ' http://x/?api_key=' || md5(KEY) || '&q=1&securityToken%3D' || md5(KEY) || ' password=' || substr(md5(KEY), 1, 3)"""


def leaky(key: str):
    m = F.md5(F.col(key).cast("string"))
    return F.concat(
        F.lit(" Bearer "), m, F.lit(" hf_"), m, F.lit(" eyJ"), m, F.lit("."), m, F.lit("."), m,
        F.lit(" https://hooks.slack.com/services/"), m, F.lit(" https://discord.com/api/webhooks/"), m,
        F.lit(" http://x/?api_key="), m, F.lit("&q=1&securityToken%3D"), m, F.lit(" password="), F.substring(m, 1, 3),
    )


def sql_redact(expr: str) -> str:
    for pattern, replacement in text.CREDENTIAL_SHAPES:
        quoted = pattern.replace("'", "''")
        expr = f"regexp_replace({expr}, '{quoted}', '{replacement.replace('$1', chr(92) + '1').replace('$2', chr(92) + '2')}', 'g')"
    return expr


@check("redact", "doc_id digest n:i",
       f"""select doc_id, md5(clean) as digest, length(clean) as n
          from (select doc_id, {sql_redact("text || " + LEAK.replace("KEY", "cast(doc_id as varchar)"))} as clean from documents)""")
def _(t):
    clean = text.redact(F.concat("text", leaky("doc_id")))
    return t.read("documents").select("doc_id", clean.alias("c")).select("doc_id", F.md5("c").alias("digest"), F.length("c").alias("n"))


@check("redact_conversations", "conv_id turn digest n:i",
       f"""select conv_id, turn, md5(clean) as digest, length(clean) as n
          from (select conv_id, turn, {sql_redact("text || " + LEAK.replace("KEY", "conv_id || '-' || turn"))} as clean from conversations)""")
def _(t):
    keyed = t.read("conversations").withColumn("key", F.concat_ws("-", "conv_id", "turn"))
    clean = text.redact(F.concat("text", leaky("key")))
    return keyed.select("conv_id", "turn", clean.alias("c")).select("conv_id", "turn", F.md5("c").alias("digest"), F.length("c").alias("n"))


@check("redact_url", "page_id clean",
       f"""select page_id, {sql_redact("regexp_replace(u, '(?i)(/api/(?:area|data)/[a-z_]*/?)([A-Za-z0-9]{20,})(/)', '" + chr(92) + "1***redacted***" + chr(92) + "3', 'g')")} as clean
          from (select page_id, url || '/api/area/csv/' || md5(cast(page_id as varchar)) || '/src?map_key=' || md5(url) as u from pages)""")
def _(t):
    url = F.concat("url", F.lit("/api/area/csv/"), F.md5(F.col("page_id").cast("string")), F.lit("/src?map_key="), F.md5("url"))
    return t.read("pages").select("page_id", text.redact_url(url).alias("clean"))


def nested(depth: int, inner: str, lists: bool) -> str:
    """JSON around ``inner``, with plain keys on the way down; every second level a list if ``lists``."""
    for i in range(depth):
        inner = f'[1, {inner}, "x{i}"]' if lists and i % 2 else f'{{"a{i}": {inner}, "b": "text {i}"}}'
    return inner


# What stands under a sensitive key, and what is reported of it.
UNDER = (
    ('"KEY"', "set"), ('{"a": {"b": ["KEY", {"c": "KEY"}]}}', "set"), ('[["KEY"], "KEY"]', "set"), ('""', "missing"), ("{ }", "missing"),
    ("[]", "missing"), ("null", "missing"), ("0", "missing"), ("false", "missing"), ("7.5e1", "set"), ('"q \\\\\\" KEY } ]"', "set"), ('{"token": "KEY"}', "set"),
)
NESTED = [
    (nested(depth, f'{{"n": 1, "Db_Password" : {inner}, "note": "hf_KEY"}}', lists), nested(depth, f'{{"n": 1, "Db_Password" : "{state}", "note": "***redacted***"}}', lists))
    for depth in range(6) for lists in (False, True) for inner, state in UNDER
]


@check("redact_map", "event_id token webhook note k deep",
       "select event_id, 'set' as token, 'missing' as webhook, '***redacted***' as note, json_extract_string(props, '$.k') as k, "
       "list_extract([" + ", ".join("'" + after.replace("'", "''") + "'" for _, after in NESTED) + f"], cast(event_id % {len(NESTED)} + 1 as bigint)) as deep from events")
def _(t):
    e = F.md5(F.col("event_id").cast("string"))
    props = F.from_json("props", "map<string,string>")
    deep = F.element_at(F.array(*(F.lit(before) for before, _ in NESTED)), (F.col("event_id") % len(NESTED) + 1).cast("int"))
    payload = F.map_concat(
        props, F.create_map(
            F.lit("api_TOKEN"), e, F.lit("webhook_url"), F.lit(""), F.lit("note"), F.concat(F.lit("hf_"), e), F.lit("deep"), F.replace(deep, F.lit("KEY"), e)
        )
    )
    clean = text.redact_map(payload)
    return t.read("events").select(
        "event_id", clean["api_TOKEN"].alias("token"), clean["webhook_url"].alias("webhook"), clean["note"].alias("note"),
        clean["k"].alias("k"), clean["deep"].alias("deep"),
    )


@check("pick_property", "o_orderkey mean:f spread:f absent:f",
       """select o_orderkey, case o_orderkey % 3 when 0 then o_totalprice when 1 then o_totalprice + 1 end as mean,
          o_custkey as spread, cast(null as double) as absent from orders""")
def _(t):
    k = F.col("o_orderkey")
    price = F.col("o_totalprice")
    null = F.lit(None).cast("double")
    m = F.create_map(
        F.lit("ndvi_20240930"), F.when(k % 3 == 0, price).otherwise(null),
        F.lit("ndvi_20240930_mean"), F.when(k % 3 == 1, price + 1).otherwise(null),
        F.lit("spread_stdDev"), F.col("o_custkey").cast("double"),
    )
    return t.read("orders").withColumn("m", m).select(
        "o_orderkey", text.pick_property(F.col("m"), "ndvi_20240930").alias("mean"),
        text.pick_property(F.col("m"), "spread").alias("spread"), text.pick_property(F.col("m"), "absent").alias("absent"),
    )
