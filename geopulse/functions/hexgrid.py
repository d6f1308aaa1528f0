"""A planar hexagonal grid in degrees, addressed by axial coordinates.

Cell ids read ``resolution:q:r``. They are not ids of any other hexagon library; a cell id that a
source already supplies is kept as it is. Degrees are not equal-area, and a parent covers its
children only approximately. Longitude 180 is -180, and a ring that leaves the map at the date line
or over a pole goes on at the other side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RESOLUTION = 15
# Edge length in degrees per resolution: each step holds seven times as many cells.
EDGE_DEGREES = tuple(11.5 / 7.0 ** (level / 2.0) for level in range(MAX_RESOLUTION + 1))
SQRT3 = 1.7320508075688772
MERCATOR_LIMIT = 85.051129
KM_PER_DEGREE_LAT = 110.574
KM_PER_DEGREE_LON = 111.320


def _check_resolution(resolution: int) -> int:
    if not 0 <= resolution <= MAX_RESOLUTION:
        raise ValueError(f"resolution {resolution} out of range [0, {MAX_RESOLUTION}]")
    return resolution


def valid_latlon(lat: Column, lon: Column) -> Column:
    return F.coalesce(lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0), F.lit(False))


def _nearest(value: Column) -> Column:
    return F.floor(value + 0.5)


def axial(lat: Column, lon: Column, edge: float | Column) -> tuple[Column, Column]:
    """Axial coordinates of the hexagon around a point, by cube rounding."""
    q = (F.lit(SQRT3) / 3.0 * lon - lat / 3.0) / edge
    r = (F.lit(2.0) / 3.0 * lat) / edge
    s = -q - r
    rq, rr, rs = _nearest(q), _nearest(r), _nearest(s)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
    q_off = (dq > dr) & (dq > ds)
    return (
        F.when(q_off, -rr - rs).otherwise(rq),
        F.when(~q_off & (dr > ds), -rq - rs).otherwise(rr),
    )


def cell_id(resolution: int | Column, q: Column, r: Column) -> Column:
    level = resolution if isinstance(resolution, Column) else F.lit(resolution)
    return F.concat_ws(":", level.cast("string"), q.cast("string"), r.cast("string"))


def cell(lat: Column, lon: Column, resolution: int) -> Column:
    """The cell holding a point; null for an unusable coordinate."""
    edge = EDGE_DEGREES[_check_resolution(resolution)]
    east = lon.cast("double")
    q, r = axial(lat.cast("double"), F.when(east == 180.0, -180.0).otherwise(east), edge)
    return F.when(valid_latlon(lat, lon), cell_id(resolution, q, r))


def with_cell(rows: DataFrame, lat: str, lon: str, resolution: int, out: str = "h3_index") -> DataFrame:
    """The rows with the :func:`cell` of each point, its parts as columns on the way.

    One expression repeats the coordinates dozens of times, and a wide select around it outgrows what is compiled; columns are
    computed once each.
    """
    edge = EDGE_DEGREES[_check_resolution(resolution)]
    name = {x: f"_{out}_{x}" for x in ("y", "x", "q", "r", "nq", "nr", "ns", "dq", "dr", "ds")}
    at = {x: F.col(f"`{n}`") for x, n in name.items()}
    y, q, r = at["y"], at["q"], at["r"]
    s = -q - r
    east = F.col(lon).cast("double")
    steps = (
        {"y": F.col(lat).cast("double"), "x": F.when(east == 180.0, -180.0).otherwise(east)},
        {"q": (F.lit(SQRT3) / 3.0 * at["x"] - y / 3.0) / edge, "r": (F.lit(2.0) / 3.0 * y) / edge},
        {"nq": _nearest(q), "nr": _nearest(r), "ns": _nearest(s)},
        {"dq": F.abs(at["nq"] - q), "dr": F.abs(at["nr"] - r), "ds": F.abs(at["ns"] - s)},
    )
    for step in steps:
        rows = rows.withColumns({name[x]: column for x, column in step.items()})
    q_off = (at["dq"] > at["dr"]) & (at["dq"] > at["ds"])
    found = cell_id(
        resolution, F.when(q_off, -at["nr"] - at["ns"]).otherwise(at["nq"]),
        F.when(~q_off & (at["dr"] > at["ds"]), -at["nq"] - at["ns"]).otherwise(at["nr"]),
    )
    return rows.withColumn(out, F.when(valid_latlon(F.col(lat), F.col(lon)), found)).drop(*name.values())


def parts(cell: Column) -> tuple[Column, Column, Column]:
    fields = F.split(cell, ":")
    return fields[0].cast("int"), fields[1].cast("long"), fields[2].cast("long")


def on_map(lat: Column, lon: Column) -> tuple[Column, Column]:
    """A place past a pole or the date line, as coordinates on the map."""
    over = F.abs(lat) > 90.0
    turned = F.when(over, lon + 180.0).otherwise(lon)
    return F.when(over, F.sign(lat) * 180.0 - lat).otherwise(lat), turned - F.floor((turned + 180.0) / 360.0) * 360.0


def is_valid_cell(cell: Column) -> Column:
    return F.coalesce(cell.rlike(r"^(?:[0-9]|1[0-5]):-?\d+:-?\d+$"), F.lit(False))


def edge_of(cell: Column) -> Column:
    level = parts(cell)[0]
    return F.element_at(F.array(*[F.lit(edge) for edge in EDGE_DEGREES]), level + 1)


def cell_center(cell: Column) -> Column:
    """``struct(lat, lon)`` of the centre."""
    _, q, r = parts(cell)
    edge = edge_of(cell)
    return F.struct(
        (edge * 1.5 * r).alias("lat"), (edge * SQRT3 * (q + r / F.lit(2.0))).alias("lon")
    )


def cell_boundary(cell: Column) -> Column:
    """Closed ring of seven ``struct(lat, lon)`` corners."""
    edge, centre = edge_of(cell), cell_center(cell)
    half = edge * (SQRT3 / 2.0)
    steps = ((0.0, 1.0), (1.0, 0.5), (1.0, -0.5), (0.0, -1.0), (-1.0, -0.5), (-1.0, 0.5), (0.0, 1.0))
    return F.array(
        *[
            F.struct((centre["lat"] + edge * dy).alias("lat"), (centre["lon"] + half * dx).alias("lon"))
            for dx, dy in steps
        ]
    )


def cell_parent(child: Column, resolution: int) -> Column:
    """The coarser cell around a cell's centre."""
    edge = EDGE_DEGREES[_check_resolution(resolution)]
    centre = cell_center(child)
    return cell_id(resolution, *axial(centre["lat"], centre["lon"], edge))


def k_ring(cell: Column, k: int) -> Column:
    """The cell and its neighbours up to ``k`` steps: ``1 + 3k(k+1)`` ids, fewer where a ring meets itself past a pole."""
    if k < 0:
        raise ValueError(f"k must be >= 0, got {k}")
    level, q, r = parts(cell)
    steps = [(dq, dr) for dq in range(-k, k + 1) for dr in range(max(-k, -dq - k), min(k, -dq + k) + 1)]
    ring = F.array(*[F.struct((q + dq).alias("q"), (r + dr).alias("r")) for dq, dr in steps])
    edge = edge_of(cell)

    def neighbour(at: Column) -> Column:
        lat, lon = edge * 1.5 * at["r"], edge * SQRT3 * (at["q"] + at["r"] / F.lit(2.0))
        there = cell_id(level, *axial(*on_map(lat, lon), edge))
        return F.when((F.abs(lat) <= 90.0) & (lon >= -180.0) & (lon < 180.0), cell_id(level, at["q"], at["r"])).otherwise(there)

    return F.array_distinct(F.transform(ring, neighbour))


def _lattice(west: Column, south: Column, east: Column, north: Column, edge: float):
    rows = F.ceil(south / (1.5 * edge)), F.floor(north / (1.5 * edge))
    columns = lambda r: (
        F.ceil(west / (edge * SQRT3) - r / F.lit(2.0)),
        F.floor(east / (edge * SQRT3) - r / F.lit(2.0)),
    )
    return rows, columns


def bbox_rows(
    west: Column, south: Column, east: Column, north: Column, resolution: int, max_cells: int | None = None
) -> Column:
    """Grid rows whose centres fall inside a bbox; one over ``max_cells`` is an error."""
    (low, high), columns = _lattice(west, south, east, north, EDGE_DEGREES[_check_resolution(resolution)])
    rows = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
    if max_cells is None:
        return rows
    total = F.aggregate(
        rows, F.lit(0).cast("long"),
        lambda acc, r: acc + F.greatest(columns(r)[1] - columns(r)[0] + 1, F.lit(0)),
    )
    too_big = F.raise_error(F.concat(F.lit("bbox yields too many cells: "), total.cast("string")))
    return F.when(total > max_cells, too_big.cast("array<bigint>")).otherwise(rows)


def bbox_columns(west: Column, east: Column, row: Column, resolution: int) -> Column:
    edge = EDGE_DEGREES[_check_resolution(resolution)]
    _, columns = _lattice(west, F.lit(0.0), east, F.lit(0.0), edge)
    low, high = columns(row)
    return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))


def bbox_contains(west: Column, south: Column, east: Column, north: Column, lat: Column, lon: Column) -> Column:
    return lon.between(west, east) & lat.between(south, north)


def bbox_center(west: Column, south: Column, east: Column, north: Column) -> Column:
    return F.struct(((south + north) / 2.0).alias("lat"), ((west + east) / 2.0).alias("lon"))


def bbox_ring(west: Column, south: Column, east: Column, north: Column) -> Column:
    """Closed polygon ring of ``[lon, lat]`` pairs; a bbox without height is an error."""
    ring = F.array(
        F.array(west, south), F.array(east, south), F.array(east, north), F.array(west, north), F.array(west, south)
    )
    flat = F.raise_error(F.lit("bbox has zero or negative height"))
    return F.when(south < north, ring).otherwise(flat.cast("array<array<double>>"))


def approx_area_km2(west: Column, south: Column, east: Column, north: Column) -> Column:
    height = (north - south) * KM_PER_DEGREE_LAT
    width = (east - west) * KM_PER_DEGREE_LON * F.cos(F.radians((south + north) / 2.0))
    return F.abs(height * width)


def mercator_x(lon: Column) -> Column:
    return (lon + 180.0) / 360.0


def mercator_y(lat: Column) -> Column:
    """Normalised web-mercator y, clamped to the projection's own limit."""
    phi = F.radians(F.greatest(F.lit(-MERCATOR_LIMIT), F.least(F.lit(MERCATOR_LIMIT), lat)))
    y = (F.lit(1.0) - F.log(F.tan(phi) + F.lit(1.0) / F.cos(phi)) / F.pi()) / 2.0
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), y))
