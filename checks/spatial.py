"""Hexagonal cells, boxes and region attribution."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import LAT, LON, SQL_EDGES, check, num, sql_axial, sql_cell
from geopulse.functions import hexgrid
from geopulse.operators import regions
from geopulse.plans import serving

ROOT3 = num(hexgrid.SQRT3)
HALF3 = num(hexgrid.SQRT3 / 2.0)

POINTS = f"(select o_orderkey as k, {LAT} as lat, {LON} as lon, {sql_cell(LAT, LON, 3)} as h3_index from orders)"
CELLS = f"""(select h3_index, cast(split_part(h3_index, ':', 1) as int) as level, cast(split_part(h3_index, ':', 2) as bigint) as q,
  cast(split_part(h3_index, ':', 3) as bigint) as r, {SQL_EDGES}[4] as edge from (select distinct h3_index from {POINTS}))"""
CENTRES = f"(select *, edge * 1.5e0 * r as lat, edge * {ROOT3} * (q + r / 2e0) as lon from {CELLS})"


def points(t):
    c = F.col("o_custkey")
    lat, lon = (c * 37 % 1200) / 10.0 - 60.0, (c * 101 % 3400) / 10.0 - 170.0
    return t.read("orders").select(
        F.col("o_orderkey").alias("k"), lat.alias("lat"), lon.alias("lon"), hexgrid.cell(lat, lon, 3).alias("h3_index")
    )


def cells(t):
    return points(t).select("h3_index").distinct()


@check("cell", "k h3_index fine",
       f"select k, h3_index, {sql_cell('lat', 'lon', 7)} as fine from {POINTS}")
def _(t):
    return points(t).withColumn("fine", hexgrid.cell(F.col("lat"), F.col("lon"), 7))


@check("cell_center", "h3_index lat:f lon:f", f"select h3_index, lat, lon from {CENTRES}")
def _(t):
    return cells(t).select("h3_index", hexgrid.cell_center(F.col("h3_index")).alias("c")).select("h3_index", "c.*")


@check("cell_boundary", "h3_index corner:i lat:f lon:f",
       f"""select h3_index, i as corner, lat + edge * [1, 0.5, -0.5, -1, -0.5, 0.5, 1][i + 1] as lat,
          lon + edge * {HALF3} * [0, 1, 1, 0, -1, -1, 0][i + 1] as lon
          from {CENTRES}, (select unnest(range(0, 7)) as i)""")
def _(t):
    ring = F.posexplode(hexgrid.cell_boundary(F.col("h3_index"))).alias("corner", "p")
    return cells(t).select("h3_index", ring).select("h3_index", "corner", "p.lat", "p.lon")


_PQ, _PR = sql_axial("lat", "lon", num(hexgrid.EDGE_DEGREES[1]))


@check("cell_parent", "h3_index parent", f"select h3_index, '1:' || {_PQ} || ':' || {_PR} as parent from {CENTRES}")
def _(t):
    return cells(t).select("h3_index", hexgrid.cell_parent(F.col("h3_index"), 1).alias("parent"))


AROUND = sql_axial("y", "x", "edge")


def ring_sql(cells_sql: str) -> str:
    """Neighbours up to two steps; a centre off the map is taken over the pole or the date line first."""
    return f"""select distinct h3_index, case when abs(lat) <= 90 and lon >= -180 and lon < 180 then level || ':' || q || ':' || r
            else level || ':' || {AROUND[0]} || ':' || {AROUND[1]} end as neighbour
          from (select *, case when abs(lat) > 90 then sign(lat) * 180e0 - lat else lat end as y,
                       turned - floor((turned + 180e0) / 360e0) * 360e0 as x
                from (select *, case when abs(lat) > 90 then lon + 180e0 else lon end as turned
                      from (select *, edge * 1.5e0 * r as lat, edge * {ROOT3} * (q + r / 2e0) as lon
                            from (select h3_index, level, q + dq as q, r + dr as r, {SQL_EDGES}[level + 1] as edge from {cells_sql},
                                  (select dq, dr from (select unnest(range(-2, 3)) as dq), (select unnest(range(-2, 3)) as dr)
                                   where abs(dq) + abs(dr) + abs(dq + dr) <= 4)))))"""


@check("k_ring", "h3_index neighbour", ring_sql(CELLS))
def _(t):
    return cells(t).select("h3_index", F.explode(hexgrid.k_ring(F.col("h3_index"), 2)).alias("neighbour"))


# points up to 87 degrees and 179.9, and some at exactly 180
FAR_LON = "case when k % 7 = 0 then 180e0 else lon * 1.055e0 end"
FAR_CELL = sql_cell("lat * 1.45e0", f"({FAR_LON} - case when k % 7 = 0 then 360e0 else 0e0 end)", 2)
FAR_CELLS = f"""(select h3_index, cast(split_part(h3_index, ':', 1) as int) as level, cast(split_part(h3_index, ':', 2) as bigint) as q,
  cast(split_part(h3_index, ':', 3) as bigint) as r from (select distinct {FAR_CELL} as h3_index from {POINTS}))"""


@check("k_ring_at_the_edges", "h3_index neighbour", ring_sql(FAR_CELLS))
def _(t):
    east = F.when(F.col("k") % 7 == 0, 180.0).otherwise(F.col("lon") * 1.055)
    far = points(t).select(hexgrid.cell(F.col("lat") * 1.45, east, 2).alias("h3_index")).distinct()
    return far.select("h3_index", F.explode(hexgrid.k_ring(F.col("h3_index"), 2)).alias("neighbour"))


E2 = num(hexgrid.EDGE_DEGREES[2])


@check("cells_for_bbox", "region_id h3_index",
       f"""select region_id, '2:' || q || ':' || r as h3_index
          from (select *, unnest(generate_series(cast(ceil(west / ({E2} * {ROOT3}) - r / 2e0) as bigint),
                                                 cast(floor(east / ({E2} * {ROOT3}) - r / 2e0) as bigint))) as q
                from (select *, unnest(generate_series(cast(ceil(south / (1.5e0 * {E2})) as bigint),
                                                       cast(floor(north / (1.5e0 * {E2})) as bigint))) as r from customer_boxes))""")
def _(t):
    return regions.cells_for_bbox(t.customer_boxes, 2)


@check("coordinate_validity", "s_suppkey valid",
       """select s_suppkey, case when s_suppkey % 7 = 0 then false
          else s_acctbal / 50 between -90 and 90 and s_acctbal / 20 between -180 and 180 end as valid from supplier""")
def _(t):
    lat = F.when(F.col("s_suppkey") % 7 != 0, F.col("s_acctbal") / 50)
    return t.read("supplier").select("s_suppkey", hexgrid.valid_latlon(lat, F.col("s_acctbal") / 20).alias("valid"))


BEST = """(select region_id, west, south, east, north,
  abs((north - south) * 110.574e0 * ((east - west) * 111.320e0 * cos(radians((south + north) / 2e0)))) as area from boxes)"""


@check("approx_area_km2", "region_id area:f2", f"select * from {BEST}".replace("from boxes", "from customer_boxes"))
def _(t):
    w, s, e, n = (F.col(c) for c in ("west", "south", "east", "north"))
    return t.customer_boxes.select("region_id", hexgrid.approx_area_km2(w, s, e, n).alias("area"))


@check("bbox_geometry", "region_id ring lat:f lon:f holds_centre",
       """select region_id, '[' || concat_ws(',', w || ',' || s, e || ',' || s, e || ',' || n, w || ',' || n, w || ',' || s) || ']' as ring,
          (south + north) / 2e0 as lat, (west + east) / 2e0 as lon, true as holds_centre
          from (select *, cast(west as int) as w, cast(south as int) as s, cast(east as int) as e, cast(north as int) as n from customer_boxes)""")
def _(t):
    w, s, e, n = (F.col(c) for c in ("west", "south", "east", "north"))
    ring = F.transform(F.flatten(hexgrid.bbox_ring(w, s, e, n)), lambda v: v.cast("int").cast("string"))
    return t.customer_boxes.select(
        "region_id", F.concat(F.lit("["), F.array_join(ring, ","), F.lit("]")).alias("ring"),
        hexgrid.bbox_center(w, s, e, n).alias("c"), w, s, e, n,
    ).select("region_id", "ring", "c.lat", "c.lon", hexgrid.bbox_contains(w, s, e, n, F.col("c.lat"), F.col("c.lon")).alias("holds_centre"))


@check("assign_region", "k lat:f lon:f region_id",
       f"""select k, lat, lon, (select arg_min(b.region_id, (b.area, b.region_id)) from {BEST} b
             where p.lon between b.west and b.east and p.lat between b.south and b.north) as region_id
          from (select distinct k, lat, lon from {POINTS}) p""")
def _(t):
    return regions.assign_region(points(t), t.boxes, "lat", "lon")


@check("cells_to_region", "h3_index region_id",
       f"""select h3_index, (select arg_min(b.region_id, (b.area, b.region_id)) from {BEST} b
             where p.lon between b.west and b.east and p.lat between b.south and b.north) as region_id from {CENTRES} p""")
def _(t):
    return regions.cells_to_region(cells(t), t.boxes)


LOOSE = f"""(select o_orderkey as k, case when o_orderkey % 10 = 0 then 'x' when o_orderkey % 10 = 1 then '95' else cast({LAT} as varchar) end as latitude,
  cast({LON} as varchar) as longitude, case when o_orderkey % 4 = 0 then 'given-' || o_custkey when o_orderkey % 4 = 1 then ' ' end as h3_index from orders)"""


def loose(t):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    lat, lon = (c * 37 % 1200) / 10.0 - 60.0, (c * 101 % 3400) / 10.0 - 170.0
    return t.read("orders").select(
        k.alias("k"), F.when(k % 10 == 0, "x").when(k % 10 == 1, "95").otherwise(lat.cast("string")).alias("latitude"),
        lon.cast("string").alias("longitude"),
        F.when(k % 4 == 0, F.concat(F.lit("given-"), c.cast("string"))).when(k % 4 == 1, " ").alias("h3_index"),
    )


@check("add_cell_index", "k latitude:f longitude:f h3_index region_id",
       f"""select k, lat as latitude, lon as longitude, coalesce(nullif(trim(h3_index), ''), {sql_cell('lat', 'lon', 4)}) as h3_index,
          (select arg_min(b.region_id, (b.area, b.region_id)) from {BEST} b
             where p.lon between b.west and b.east and p.lat between b.south and b.north) as region_id
          from (select *, try_cast(latitude as double) as lat, try_cast(longitude as double) as lon from {LOOSE}) p
          where lat between -90 and 90""")
def _(t):
    return regions.add_cell_index(loose(t), 4, t.boxes)


@check("invalid_coordinates", "rows:i dropped:i",
       f"""select count(*) as rows, count(*) filter (try_cast(latitude as double) is null or try_cast(latitude as double) > 90) as dropped from {LOOSE}""")
def _(t):
    return regions.invalid_coordinates(loose(t))


@check("cell_extent", "west:f south:f east:f north:f",
       """select w - greatest(0.4e0, (e - w) * 0.06e0) as west, s - greatest(0.4e0, (n - s) * 0.06e0) as south,
          e + greatest(0.4e0, (e - w) * 0.06e0) as east, n + greatest(0.4e0, (n - s) * 0.06e0) as north
          from (select min(longitude) as w, min(latitude) as s, max(longitude) as e, max(latitude) as n from cells)""")
def _(t):
    return regions.cell_extent(t.cells)


@check("feature_rows", "h3_index period_start:d step:i corners:i value:f region",
       """with b as (select max(case when rn = cast(floor(n * 0.50e0) as bigint) + 1 then value end) as p50,
            max(case when rn = cast(floor(n * 0.75e0) as bigint) + 1 then value end) as p75,
            max(case when rn = cast(floor(n * 0.90e0) as bigint) + 1 then value end) as p90,
            max(case when rn = cast(floor(n * 0.98e0) as bigint) + 1 then value end) as p98
            from (select value, row_number() over (order by value) as rn, count(*) over () as n from cells))
          select h3_index, period_start, least((value >= p50)::int + (value >= p75)::int + (value >= p90)::int + (value >= p98)::int, 4) as step,
          7 as corners, value, region_id as region from cells, b""")
def _(t):
    rows = serving.feature_rows(t.cells, serving.map_summary(t.cells))
    f = F.col("feature")
    return rows.select(
        "h3_index", "period_start", F.get_json_object(f, "$.properties.step").alias("step"),
        F.size(F.from_json(F.get_json_object(f, "$.geometry.coordinates[0]"), "array<array<double>>")).alias("corners"),
        F.get_json_object(f, "$.properties.value").alias("value"), F.get_json_object(f, "$.properties.region").alias("region"),
    )
