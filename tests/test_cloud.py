import math
import random

import pytest

from skytrace.operators import cloud


def star(rng, cx, cy, radius, n):
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    return [
        (cx + r * math.cos(a), cy + r * math.sin(a))
        for a in angles
        for r in [radius * rng.uniform(0.3, 1)]
    ]


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def polygon_frame(spark, polygons):
    rows = [(i, [[(float(x), float(y)) for x, y in r] for r in p]) for i, p in polygons.items()]
    return spark.createDataFrame(
        rows, "poly_id long, rings array<array<struct<x:double,y:double>>>"
    )


def check(spark, polygons, places):
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(places)]
    points = spark.createDataFrame(rows, "point_id long, x double, y double").repartition(4)
    got = [r.point_id for r in cloud.crop_points(points, polygon_frame(spark, polygons)).collect()]
    want = {
        i for i, (x, y) in enumerate(places) if any(inside(p, x, y) for p in polygons.values())
    }
    assert len(got) == len(set(got)) and set(got) == want
    return want


def test_the_cloud_is_scanned_once(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(cloud, "MAX_TESTS", 3)
    rng = random.Random(1)
    polygons = {0: [star(rng, 0, 0, 100, 60)], 1: [star(rng, 500, 500, 3, 60)]}
    spark.range(100).selectExpr("id * 1.0D AS x", "id * 1.0D AS y").write.parquet(str(tmp_path / "c"))
    levels = []
    whole = cloud.polygon_cover
    monkeypatch.setattr(cloud, "polygon_cover", lambda *a: levels.extend(whole(*a)) or levels)
    points = spark.read.parquet(str(tmp_path / "c"))
    kept = cloud.crop_points(points, polygon_frame(spark, polygons))
    assert len(levels) > 1
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("max_tests", [3, 64])
def test_random_polygons(spark, monkeypatch, broadcast, max_tests):
    monkeypatch.setattr(cloud, "MAX_TESTS", max_tests)
    if not broadcast:
        monkeypatch.setattr(cloud, "BROADCAST_BYTES", -1)
    rng = random.Random(max_tests)
    polygons = {
        i: [star(rng, rng.uniform(0, 500), rng.uniform(0, 300), rng.uniform(5, 150), n)]
        for i, n in enumerate([3, 4, 8, 20, 60, 200])
    }
    polygons[6] = [star(rng, 250, 150, 100, 30), star(rng, 250, 150, 30, 9)]  # with a hole
    places = [(rng.uniform(-50, 550), rng.uniform(-50, 350)) for _ in range(4000)]
    places += [v for p in polygons.values() for ring in p for v in ring]  # vertices themselves
    assert check(spark, polygons, places)


def test_grid_lines_on_edges(spark):
    """Integer polygons and points exactly on edges and on the borders of squares."""
    polygons = {1: [[(0, 0), (64, 0), (64, 32), (32, 32), (32, 64), (0, 64)]]}
    places = [(x / 2, y / 2) for x in range(-4, 134) for y in range(-4, 134, 3)]
    check(spark, polygons, places)


def test_crowded_corner(spark, monkeypatch):
    """A third of all edges within a thousandth of the extent."""
    monkeypatch.setattr(cloud, "MAX_TESTS", 8)
    rng = random.Random(2)
    ring = [(0, 0), (1000, 0), (1000, 1000)]
    ring += [(1 - k * 0.0005 + 0.3 * (k % 2), 1 - k * 0.0004) for k in range(600)]
    polygons = {1: [ring], 2: [star(rng, 500, 500, 400, 100)]}
    places = [(rng.uniform(-1, 1001), rng.uniform(-1, 1001)) for _ in range(1000)]
    places += [(rng.uniform(0, 1.5), rng.uniform(0, 1.5)) for _ in range(3000)]
    check(spark, polygons, places)


def test_polygons_move_to_the_points(spark):
    rings = {1: [[(-99.01, 44.99), (-98.99, 44.99), (-98.99, 45.01), (-99.01, 45.01)]]}
    points = spark.createDataFrame(
        [(1, 500000.0, 4982950.0), (2, 501000.0, 4982950.0)], "point_id long, x double, y double"
    )
    kept = cloud.crop_points(points, polygon_frame(spark, rings), "", "EPSG:32614").collect()
    assert [r.point_id for r in kept] == [1]


def test_no_polygons_keep_nothing(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0)], "point_id long, x double, y double")
    assert cloud.crop_points(points, polygon_frame(spark, {1: [[(0, 0), (1, 1)]]})).count() == 0


def test_areas(spark):
    polygons = {1: [[(0, 0), (100, 0), (100, 200), (0, 200)]]}
    row = cloud.polygon_areas(polygon_frame(spark, polygons)).first()
    assert (row.area_m2, row.area_ha, row.area_km2) == (20000.0, 2.0, 0.02)


def test_large_polygons_take_few_squares(spark, monkeypatch):
    """A thousand polygons over the whole extent: rows in proportion to their edges."""
    rng = random.Random(5)
    polygons = {
        i: [[(rng.uniform(0, 9), 0), (1000, rng.uniform(0, 9)), (1000 - rng.uniform(0, 9), 1000), (0, 990)]]
        for i in range(1000)
    }
    edges = cloud.ring_edges(polygon_frame(spark, polygons))
    extent = cloud._extent(edges)
    bands, columns = cloud._first_grid(extent)
    assert bands * columns * 1000 <= 40 * extent["edges"]
    tiles = {"edges": 4_000_000, "polygons": 10**6, "area": 1.0, **dict(x_min=0, x_max=1, y_min=0, y_max=1)}
    assert cloud._first_grid(tiles) == (1 << 14, 1024)
    rows = []
    whole = cloud._level_squares
    monkeypatch.setattr(
        cloud, "_level_squares", lambda *a: rows.append((r := whole(*a))[0].count() + r[1].count()) or r
    )
    places = [(rng.uniform(-5, 1005), rng.uniform(-5, 1005)) for _ in range(300)]
    check(spark, polygons, places)
    assert sum(rows) < 40 * extent["edges"]
