import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skytrace.functions import crs, text
from skytrace.functions import geometry as g


def looped_group(degrees):
    if degrees <= 5 or degrees > 355:
        return 360
    return next(k for k in range(10, 360, 10) if k - 5 < degrees <= k + 5)


def test_heading_groups_at_every_boundary(spark):
    values = [0.0, 360.0]
    for edge in range(5, 360, 10):
        values += [np.nextafter(edge, 0), float(edge), np.nextafter(edge, 400)]
    values += [random.Random(1).uniform(0, 360) for _ in range(3000)]
    df = spark.createDataFrame([(float(v),) for v in values], "d double")
    got = df.select("d", g.heading_group(F.col("d")).alias("k")).collect()
    assert all(r.k == looped_group(r.d) for r in got)
    assert df.limit(1).select(g.heading_group(F.lit(None).cast("double"))).first()[0] is None


def test_bearing_turns_counter_clockwise_from_east(spark):
    rows = [(0, 0, 1, 0, 0.0), (0, 0, 0, 1, 90.0), (0, 0, -1, 0, 180.0), (0, 0, 0, -1, 270.0)]
    df = spark.createDataFrame(
        [tuple(map(float, r)) for r in rows], "a double, b double, c double, d double, e double"
    )
    got = df.select(g.bearing(*[F.col(c) for c in "abcd"]).alias("r"), "e").collect()
    assert all(r.r == pytest.approx(r.e) for r in got)
    same = spark.range(1).select(g.bearing(*[F.lit(1.0)] * 4)).first()[0]
    assert same is None


def test_rounding_goes_to_even(spark):
    values = [2.5e-6, 3.5e-6, -2.5e-6, 1.0000005, 19.123456499]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(g.round_half_even(F.col("v"), 6)).collect()]
    assert got == [float(np.round(v, 6)) for v in values]


def line(*vertices):
    return F.array(*[g.point(F.lit(float(x)), F.lit(float(y))) for x, y in vertices])


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_line_measures(spark):
    bent = line((0, 0), (3, 4), (3, 10))
    assert value(spark, g.line_length_km(bent)) == pytest.approx(0.011)
    centre = value(spark, g.line_centroid(bent))
    assert (centre.x, centre.y) == pytest.approx(((1.5 * 5 + 3 * 6) / 11, (2 * 5 + 7 * 6) / 11))
    still = value(spark, g.line_centroid(line((2, 2), (2, 2))))
    assert (still.x, still.y) == (2, 2)
    assert value(spark, g.make_line(line((1, 1)))) is None
    assert value(spark, g.first_vertex(bent)).x == 0
    assert value(spark, g.last_vertex(bent)).y == 10
    assert value(spark, g.line_wkt(bent)) == "LINESTRING (0.0 0.0, 3.0 4.0, 3.0 10.0)"
    assert value(spark, g.coordinate_text(bent)) == "0.0,0.0 3.0,4.0 3.0,10.0"


def test_ring_area_ignores_start_and_turn(spark):
    corners = [(0, 0), (4, 0), (4, 3), (2, 1), (0, 3)]
    for turn in (corners, corners[::-1]):
        for k in range(len(turn)):
            ring = g.close_ring(line(*(turn[k:] + turn[:k])))
            assert value(spark, g.ring_area(ring)) == pytest.approx(8.0)
    assert value(spark, g.close_ring(line((0, 0), (1, 1), (0, 0)))) is None


def test_rings_with_a_hole(spark):
    shell = g.close_ring(line((0, 0), (10, 0), (10, 10), (0, 10)))
    hole = g.close_ring(line((4, 4), (6, 4), (6, 6), (4, 6)))
    rings = F.array(shell, hole)
    for (x, y), inside in {(1, 1): True, (5, 5): False, (11, 5): False, (7, 5): True}.items():
        held = value(spark, g.rings_contain(rings, F.lit(float(x)), F.lit(float(y))))
        assert held is inside
    assert value(spark, g.polygon_wkt(F.array(hole))).startswith("POLYGON ((4.0 4.0, 6.0 4.0")


def test_point_to_segment(spark):
    cases = [((5, 10), 100.0), ((-3, 4), 25.0), ((13, 4), 25.0), ((4, 0), 0.0)]
    for (x, y), squared in cases:
        column = g.point_segment_distance2(*[F.lit(float(v)) for v in (x, y, 0, 0, 10, 0)])
        assert value(spark, column) == squared
    dot = g.point_segment_distance2(*[F.lit(float(v)) for v in (3, 4, 0, 0, 0, 0)])
    assert value(spark, dot) == 25.0


def test_utm_on_the_central_meridian(spark):
    p = value(spark, crs.reproject_coords(line((-99, 45)), 4326, 32614))[0]
    assert p.x == pytest.approx(500000.0, abs=1e-6)
    assert p.y == pytest.approx(4982950.4002, abs=1e-4)
    south = value(spark, crs.reproject_coords(line((-99, -45)), 4326, 32714))[0]
    assert south.y == pytest.approx(10000000 - 4982950.4002, abs=1e-4)


@pytest.mark.parametrize("srid", [3857, 32614, 32719])
def test_projections_invert(spark, srid):
    rng = random.Random(srid)
    centre = {3857: 0, 32614: -99, 32719: -69}[srid]
    rows = [(centre + rng.uniform(-3, 3), rng.uniform(-80, 80)) for _ in range(500)]
    df = spark.createDataFrame(rows, "x double, y double")
    there = crs.reproject_columns(df, 4326, srid, "x", "y", "e", "n")
    back = crs.reproject_columns(there, srid, 4326, "e", "n", "lon", "lat")
    assert back.columns == ["x", "y", "e", "n", "lon", "lat"]
    for r in back.collect():
        assert abs(r.lon - r.x) < 1e-9 and abs(r.lat - r.y) < 1e-9


def test_codes():
    assert crs.parse_srid("") == 4326
    assert crs.parse_srid("EPSG: 32614 ") == 32614
    assert crs.parse_srid("3857") == 3857
    with pytest.raises(ValueError):
        crs.parse_srid("6372")
    assert crs.common_srid({32614}) == 32614
    with pytest.raises(ValueError):
        crs.common_srid({4326, 32614})


def test_photo_names_and_paths(spark):
    df = spark.createDataFrame([(99999,), (100000,), (7,)], "n long")
    assert [r[0] for r in df.select(text.photo_name(F.col("n"))).collect()] == [
        "DSC99999.JPG",
        "DSC100000.JPG",
        "DSC00007.JPG",
    ]
    stem = value(spark, text.with_suffix(F.lit("file:/a/b.c/vuelo.1.txt"), "_lineas", ".shp"))
    assert stem == "vuelo.1_lineas.shp"
    assert value(spark, text.xml_escaped(F.lit("a<b & c>d"))) == "a&lt;b &amp; c&gt;d"
    assert math.isclose(float(value(spark, text.kilometres(F.lit(1.23456)))), 1.235)
