"""Attributing points, cells and days to regions without range or cross joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geopulse.functions import hexgrid
from geopulse.workspace import materialise

TILE_DEGREES = 40.0
#: Candidate boxes of one tile; a fuller tile is split.
MOST = 256
#: Splits of a tile; by then an edge of a tile is 40 millionths of a millionth of a degree.
DEEPEST = 40
#: Part of a tile by which it is taken to be larger, so that rounding never puts a point outside its tile.
_MARGIN = 1e-9
_BOX = ("area", "region_id", "west", "south", "east", "north")


def _tile(value: Column, degrees: float) -> Column:
    return F.floor(value / degrees)


def _useful(entries: DataFrame, degrees: float) -> DataFrame:
    """Of the boxes of each tile those that can be the smallest around one of its points, and their number ``n``.

    Boxes that cut the same piece out of a tile are one, the smallest; larger boxes than one that covers the tile are none.
    """
    pad = degrees * _MARGIN
    left, bottom = F.col("tile_x") * degrees - pad, F.col("tile_y") * degrees - pad
    right, top = (F.col("tile_x") + 1) * degrees + pad, (F.col("tile_y") + 1) * degrees + pad
    piece = [F.greatest("west", left).alias("x0"), F.greatest("south", bottom).alias("y0"), F.least("east", right).alias("x1"), F.least("north", top).alias("y1")]
    covers = (F.col("x0") == left) & (F.col("x1") == right) & (F.col("y0") == bottom) & (F.col("y1") == top)
    cut = entries.select("tile_x", "tile_y", *piece, F.struct(*_BOX).alias("box"))
    kept = cut.groupBy("tile_x", "tile_y", "x0", "y0", "x1", "y1").agg(F.min("box").alias("box")).withColumn("covers", covers)
    cover = kept.where("covers").select("tile_x", "tile_y", F.col("box").alias("cover"))  # one a tile
    kept = kept.join(cover, ["tile_x", "tile_y"], "left").where("cover is null or box <= cover").select("tile_x", "tile_y", "box")
    return kept.join(kept.groupBy("tile_x", "tile_y").agg(F.count(F.lit(1)).alias("n")), ["tile_x", "tile_y"])


def _listed(kept: DataFrame, level: int) -> DataFrame:
    found = kept.groupBy("tile_x", "tile_y").agg(F.sort_array(F.collect_list("box")).alias("candidates"))
    return found.select(F.lit(level).alias("level"), "tile_x", "tile_y", "candidates")


def region_tiles(regions: DataFrame, degrees: float = TILE_DEGREES, most: int = MOST) -> tuple[DataFrame, DataFrame | None]:
    """Tiles of a cover of the map with their candidate regions, smallest first and at most ``most``; and where tiles are split.

    ``level, tile_x, tile_y, candidates``: a tile of level ``l`` has an edge of ``degrees / 2^l``. Tiles with more candidates give way
    to their quarters, so lists stay short however many boxes lie on each other. The second frame has the ``levels`` below each
    split root tile; it is absent where none is split.
    """
    sized = regions.select(
        "region_id", "west", "south", "east", "north",
        hexgrid.approx_area_km2(F.col("west"), F.col("south"), F.col("east"), F.col("north")).alias("area"),
    )
    spread = sized.select(
        *_BOX, F.explode(F.sequence(_tile(F.col("west"), degrees), _tile(F.col("east"), degrees))).alias("tile_x")
    ).withColumn("tile_y", F.explode(F.sequence(_tile(F.col("south"), degrees), _tile(F.col("north"), degrees))))
    if len(regions.select("region_id").take(most + 1)) <= most:
        return _listed(spread.select("tile_x", "tile_y", F.struct(*_BOX).alias("box")), 0), None

    leaves, entries, size = [], spread, degrees
    for level in range(DEEPEST + 1):
        kept = materialise(_useful(entries, size), "tiles")
        full = kept.where(F.col("n") > most) if level < DEEPEST else kept.limit(0)
        leaves.append(_listed(kept.where(F.col("n") <= most) if level < DEEPEST else kept, level))
        if full.isEmpty():
            break
        size /= 2
        quarters = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x in (0, 1) for y in (0, 1)))
        below = full.select("tile_x", "tile_y").distinct().select(
            (F.explode(quarters)).alias("q"), "tile_x", "tile_y"
        ).select((F.col("tile_x") * 2 + F.col("q.x")).alias("tile_x"), (F.col("tile_y") * 2 + F.col("q.y")).alias("tile_y"))
        entries = full.select("box.*", F.explode(quarters).alias("q"), "tile_x", "tile_y").select(
            *_BOX, (F.col("tile_x") * 2 + F.col("q.x")).alias("tile_x"), (F.col("tile_y") * 2 + F.col("q.y")).alias("tile_y")
        ).where(
            F.col("tile_x").between(_tile(F.col("west"), size), _tile(F.col("east"), size))
            & F.col("tile_y").between(_tile(F.col("south"), size), _tile(F.col("north"), size))
        )
        # A quarter without boxes is a tile too: every point of a split tile lies in one of its leaves.
        bare = below.join(entries.select("tile_x", "tile_y").distinct(), ["tile_x", "tile_y"], "left_anti")
        empty = F.array().cast(leaves[0].schema["candidates"].dataType).alias("candidates")
        leaves.append(bare.select(F.lit(level + 1).alias("level"), "tile_x", "tile_y", empty))
    tiles = materialise(reduce(DataFrame.unionByName, leaves), "tiles")
    root = [F.floor(F.col(c) / F.pow(F.lit(2.0), F.col("level"))).alias(c) for c in ("tile_x", "tile_y")]
    split = tiles.where("level > 0").select(*root, "level").groupBy("tile_x", "tile_y").agg(F.collect_set("level").alias("levels"))
    return tiles, split


def assign_region(
    points: DataFrame, regions: DataFrame, lat: str = "latitude", lon: str = "longitude",
    out: str = "region_id", degrees: float = TILE_DEGREES, most: int = MOST,
) -> DataFrame:
    """Smallest region whose bbox holds each point, null outside all of them.

    An equi-join on the tile with exactly one match per point: no fan-out and no shuffle back to the point. Points of split
    tiles try the levels there, of which one has their tile. Spark broadcasts the tile table only while its size statistics allow it.
    """
    tiles, split = region_tiles(regions, degrees, most)
    holding = F.filter(
        "candidates",
        lambda c: hexgrid.bbox_contains(c["west"], c["south"], c["east"], c["north"], F.col(lat), F.col(lon)),
    )
    extra = ["_tx", "_ty", "_level", "level", "tile_x", "tile_y", "candidates", "levels"]

    def looked_up(rows: DataFrame, how: str) -> DataFrame:
        side = F.lit(degrees) / F.pow(F.lit(2.0), F.col("_level"))
        keyed = rows.withColumn("_tx", F.floor(F.col(lon) / side)).withColumn("_ty", F.floor(F.col(lat) / side))
        same = (F.col("_level") == F.col("level")) & (F.col("_tx") == F.col("tile_x")) & (F.col("_ty") == F.col("tile_y"))
        return keyed.join(tiles, same, how).withColumn(out, F.get(holding, F.lit(0))["region_id"]).drop(*extra)

    if split is None:
        return looked_up(points.withColumn("_level", F.lit(0)), "left")
    root = (_tile(F.col(lon), degrees) == F.col("tile_x")) & (_tile(F.col(lat), degrees) == F.col("tile_y"))
    known = points.join(split, root, "left").drop("tile_x", "tile_y")
    whole = looked_up(known.where("levels is null").withColumn("_level", F.lit(0)), "left")
    return whole.unionByName(looked_up(known.where("levels is not null").withColumn("_level", F.explode("levels")), "inner"))


def cells_to_region(cells: DataFrame, regions: DataFrame, cell: str = "h3_index") -> DataFrame:
    """Region holding each cell's centre."""
    centred = cells.withColumn("_c", hexgrid.cell_center(F.col(cell)))
    centred = centred.withColumn("_lat", F.col("_c.lat")).withColumn("_lon", F.col("_c.lon"))
    return assign_region(centred, regions, "_lat", "_lon").drop("_c", "_lat", "_lon")


def add_cell_index(
    df: DataFrame, resolution: int, regions: DataFrame | None = None,
    lat: str = "latitude", lon: str = "longitude", out: str = "h3_index",
) -> DataFrame:
    """Drop unusable coordinates, fill missing cell ids, and assign a region if there is none."""
    missing = [name for name in (lat, lon) if name not in df.columns]
    if missing:
        raise KeyError(f"expected coordinate columns {missing} in {df.columns}")
    typed = df.withColumn(lat, F.col(lat).cast("string").try_cast("double")).withColumn(
        lon, F.col(lon).cast("string").try_cast("double")
    )
    usable = typed.where(hexgrid.valid_latlon(F.col(lat), F.col(lon)))
    indexed = hexgrid.with_cell(usable, lat, lon, resolution, "_cell")
    derived = F.col("_cell")
    if out in df.columns:
        derived = F.coalesce(F.nullif(F.trim(F.col(out)), F.lit("")), derived)
    indexed = indexed.withColumn(out, derived).drop("_cell")
    if regions is not None and "region_id" not in df.columns:
        indexed = assign_region(indexed, regions, lat, lon)
    return indexed


def invalid_coordinates(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """How many rows :func:`add_cell_index` would drop, as one row."""
    bad = ~hexgrid.valid_latlon(
        F.col(lat).cast("string").try_cast("double"), F.col(lon).cast("string").try_cast("double")
    )
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.when(bad, 1).otherwise(0)), F.lit(0)).cast("long").alias("dropped"),
    )


def cells_for_bbox(boxes: DataFrame, resolution: int, max_cells: int | None = None) -> DataFrame:
    """Dense grid spine: every cell whose centre lies in each row's bbox; a caller's ``max_cells`` makes a larger one an error."""
    w, s, e, n = (F.col(name) for name in ("west", "south", "east", "north"))
    rows = boxes.withColumn("_r", F.explode(hexgrid.bbox_rows(w, s, e, n, resolution, max_cells)))
    cells = rows.withColumn("_q", F.explode(hexgrid.bbox_columns(w, e, F.col("_r"), resolution)))
    return cells.withColumn("h3_index", hexgrid.cell_id(resolution, F.col("_q"), F.col("_r"))).drop("_r", "_q")


def cell_extent(cells: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Padded extent of a set of cells: at least 0.4 degrees, else 6 % of the span."""
    box = cells.agg(
        F.min(lon).alias("west"), F.min(lat).alias("south"), F.max(lon).alias("east"), F.max(lat).alias("north")
    )
    pad_x = F.greatest(F.lit(0.4), (F.col("east") - F.col("west")) * 0.06)
    pad_y = F.greatest(F.lit(0.4), (F.col("north") - F.col("south")) * 0.06)
    return box.select(
        (F.col("west") - pad_x).alias("west"), (F.col("south") - pad_y).alias("south"),
        (F.col("east") + pad_x).alias("east"), (F.col("north") + pad_y).alias("north"),
    )
