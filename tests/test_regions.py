"""Points in very many boxes that lie on each other, beside brute force."""

import numpy as np
from pyspark.sql import functions as F

from geopulse.functions import hexgrid
from geopulse.operators import regions


def _boxes():
    """Nested boxes, boxes that share an edge or a corner, equal boxes, and scattered ones."""
    draw = np.random.default_rng(1)
    out = [(f"n{i}", -i * 0.01, -i * 0.005, i * 0.01, i * 0.005) for i in range(1, 1500)]
    out += [(f"e{i}", 10.0, 10.0, 10.0 + i * 0.01, 11.0) for i in range(1, 600)]
    out += [(f"c{i}", -30.0, -30.0, -30.0 + i * 0.02, -30.0 + i * 0.02) for i in range(1, 600)]
    out += [(f"q{i}", 100.0, 40.0, 101.0, 41.0) for i in range(500)]
    for i, (x, y, w, h) in enumerate(draw.uniform([-170, -80, 0.1, 0.1], [150, 70, 20, 10], (300, 4)).tolist()):
        out.append((f"s{i}", x, y, x + w, y + h))
    return out


def _points(boxes):
    draw = np.random.default_rng(2)
    x = np.concatenate([draw.uniform(-16, 16, 700), draw.uniform(9.9, 16.1, 300), draw.uniform(-30.1, -17, 300), draw.uniform(99.9, 101.1, 50), draw.uniform(-180, 180, 300)])
    y = np.concatenate([draw.uniform(-8, 8, 700), draw.uniform(9.9, 11.1, 300), draw.uniform(-30.1, -17, 300), draw.uniform(39.9, 41.1, 50), draw.uniform(-90, 90, 300)])
    corners = np.array([(b[1], b[2]) for b in boxes[::37]] + [(b[3], b[4]) for b in boxes[::41]])
    return np.concatenate([x, corners[:, 0]]).tolist(), np.concatenate([y, corners[:, 1]]).tolist()


def test_smallest_of_many_nested_boxes(spark):
    boxes = _boxes()
    dim = spark.createDataFrame(boxes, "region_id string, west double, south double, east double, north double")
    xs, ys = _points(boxes)
    points = spark.createDataFrame([(i, y, x) for i, (x, y) in enumerate(zip(xs, ys))], "i int, latitude double, longitude double")
    area = hexgrid.approx_area_km2(*(F.col(c) for c in ("west", "south", "east", "north")))
    order = [r["region_id"] for r in dim.withColumn("area", area).orderBy("area", "region_id").collect()]
    by_name = {b[0]: b[1:] for b in boxes}
    edges = np.array([by_name[name] for name in order])

    def smallest(x, y):
        inside = np.flatnonzero((edges[:, 0] <= x) & (x <= edges[:, 2]) & (edges[:, 1] <= y) & (y <= edges[:, 3]))
        return order[inside[0]] if len(inside) else None

    got = {r["i"]: r["region_id"] for r in regions.assign_region(points, dim, most=32).collect()}
    assert got == {i: smallest(x, y) for i, (x, y) in enumerate(zip(xs, ys))}
    tiles, split = regions.region_tiles(dim, most=32)
    assert split is not None and tiles.agg(F.max(F.size("candidates"))).first()[0] <= 32
    assert tiles.groupBy("level", "tile_x", "tile_y").count().where("count > 1").count() == 0


def test_unsplit_cover_keeps_all_points(spark):
    dim = spark.createDataFrame([("a", 0.0, 0.0, 2.0, 2.0)], "region_id string, west double, south double, east double, north double")
    points = spark.createDataFrame([(1.0, 1.0), (50.0, 50.0), (None, 1.0)], "latitude double, longitude double")
    assert sorted((r["region_id"] or "") for r in regions.assign_region(points, dim).collect()) == ["", "", "a"]
