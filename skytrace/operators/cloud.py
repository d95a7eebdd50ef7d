"""Cropping point clouds by polygons.

The plane is cut into squares whose sides are powers of two, so the square of a point is exact. A
square lies fully inside some polygon, or it knows for each polygon which edges a point in it must be
tested against plus the parity of the edges that lie entirely to its right. Squares are at first so
large that their number is in proportion to the edges, however often polygons cover the same ground;
only those with too many edges are split again.
Points meet squares by equality, one row a square, so points are never multiplied by polygons.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytrace.functions import geometry as g
from skytrace.functions.crs import reproject_rings
from skytrace.operators.lineage import cut

BROADCAST_BYTES = 64 << 20
MAX_TESTS = 64
SPLIT = 8
MAX_LEVELS = 12
SQUARE = ["band", "col"]
EDGE = ["x1", "y1", "x2", "y2"]


def ring_edges(polygons: DataFrame) -> DataFrame:
    """Edges of every ring of ``poly_id, rings``, closed if the input left the ring open."""
    rings = polygons.select("poly_id", F.explode("rings").alias("ring")).select(
        "poly_id", g.close_ring(F.col("ring")).alias("ring")
    )
    ends = F.arrays_zip(
        F.slice("ring", F.lit(1), F.size("ring") - 1).alias("a"),
        F.slice("ring", F.lit(2), F.size("ring") - 1).alias("b"),
    )
    return rings.filter(F.col("ring").isNotNull()).select(
        "poly_id", F.inline(ends).alias("a", "b")
    ).select(
        "poly_id",
        F.col("a.x").alias("x1"),
        F.col("a.y").alias("y1"),
        F.col("b.x").alias("x2"),
        F.col("b.y").alias("y2"),
    )


def polygon_areas(polygons: DataFrame) -> DataFrame:
    """``poly_id, area_m2, area_ha, area_km2`` of the first ring (the shell)."""
    area = g.ring_area(g.close_ring(F.element_at("rings", 1)))
    return polygons.select("poly_id", area.alias("area_m2")).withColumns(
        {"area_ha": F.col("area_m2") / 10000, "area_km2": F.col("area_m2") / 1e6}
    )


def _power_of_two(extent: float, cells: int) -> float:
    return 2.0 ** math.ceil(math.log2(extent / cells)) if extent > 0 else 1.0


def _extent(edges: DataFrame):
    """One row: the extent of all edges, their number, and how often their polygons' boxes cover it."""
    boxes = edges.groupBy("poly_id").agg(
        *[F.least(F.min(f"{c}1"), F.min(f"{c}2")).alias(f"{c}_min") for c in ("x", "y")],
        *[F.greatest(F.max(f"{c}1"), F.max(f"{c}2")).alias(f"{c}_max") for c in ("x", "y")],
        F.count(F.lit(1)).alias("edges"),
    )
    area = (F.col("x_max") - F.col("x_min")) * (F.col("y_max") - F.col("y_min"))
    return boxes.agg(
        *[F.min(f"{c}_min").alias(f"{c}_min") for c in ("x", "y")],
        *[F.max(f"{c}_max").alias(f"{c}_max") for c in ("x", "y")],
        F.coalesce(F.sum("edges"), F.lit(0)).alias("edges"),
        F.count(F.lit(1)).alias("polygons"),
        F.sum(area).alias("area"),
    ).first()


def _first_grid(extent) -> tuple[int, int]:
    """Bands and columns to begin with: a band for four edges and eight columns a polygon across, as
    long as all polygons' squares together stay in proportion to the edges.
    """
    bands = min(max(extent["edges"] // 4, 16), 1 << 14)
    columns = min(max(8 * math.isqrt(extent["polygons"]), 32), 1024)
    whole = (extent["x_max"] - extent["x_min"]) * (extent["y_max"] - extent["y_min"])
    times = extent["area"] / whole if whole > 0 else 1.0
    while bands * columns * times > 16 * extent["edges"] + 4096 and (bands > 16 or columns > 8):
        if columns <= 8 or bands > 4 * columns:
            bands //= 2
        else:
            columns //= 2
    return bands, columns


@dataclass(frozen=True)
class CoverLevel:
    """Squares of one size, a row each: ``band, col, crowded, solid, parts``.

    A crowded square is split on the next level. Otherwise a point in it is inside where the square
    is solid, or where for one of ``parts`` its ``odd`` plus the number of ``tests`` (edges) that the
    point's ray crosses is odd.
    """

    height: float
    width: float
    squares: DataFrame
    bytes: int


def _level_squares(edges: DataFrame, regions: DataFrame, height: float, width: float):
    """Squares of the regions ``poly_id, region, band_lo/hi, col_lo/hi, odd0`` at one size.

    Returns ``(squares, tested)``: per polygon and square the parity of the edges to its right and
    the number of edges to test, and those edges one per row.
    """
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    slope = (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    banded = (
        edges.join(regions, ["poly_id", "region"])
        .withColumns(
            {
                "from_band": F.greatest(F.floor(low / height), "band_lo"),
                "to_band": F.least(F.floor(high / height), "band_hi"),
            }
        )
        .filter(F.col("from_band") <= F.col("to_band"))
        .withColumn("band", F.explode(F.sequence("from_band", "to_band")))
        .withColumns({"floor_y": F.col("band") * height, "roof_y": (F.col("band") + 1) * height})
        .withColumns(
            {
                "at_floor": F.col("x1") + (F.greatest(low, "floor_y") - F.col("y1")) * slope,
                "at_roof": F.col("x1") + (F.least(high, "roof_y") - F.col("y1")) * slope,
                "spans": (low <= F.col("floor_y")) & (high >= F.col("roof_y")),
            }
        )
        # One column of slack on each side absorbs the rounding of the two crossings.
        .withColumns(
            {
                "first": F.floor(F.least("at_floor", "at_roof") / width) - 1,
                "last": F.floor(F.greatest("at_floor", "at_roof") / width) + 1,
            }
        )
    )
    place = ["poly_id", "region", *SQUARE]
    # An edge that ends inside the band matters to every square on its left, too.
    start = F.when(F.col("spans"), F.greatest("first", "col_lo")).otherwise(F.col("col_lo"))
    tested = cut(
        banded.withColumns({"start": start, "end": F.least("last", "col_hi")})
        .filter(F.col("start") <= F.col("end"))
        .withColumn("col", F.explode(F.sequence("start", "end")))
        .select(*place, *EDGE)
    )
    opened = banded.filter(F.col("spans") & (F.col("first") > F.col("col_lo"))).select(
        "poly_id", "region", "band", F.least("first", F.col("col_hi") + 1).alias("col")
    )
    grid = regions.withColumn("band", F.explode(F.sequence("band_lo", "band_hi"))).withColumn(
        "col", F.explode(F.sequence("col_lo", "col_hi"))
    )

    def counted(rows: DataFrame, tests: int, opens: int, odd: Column) -> DataFrame:
        return rows.select(
            *place, F.lit(tests).alias("tests"), F.lit(opens).alias("opens"), odd.alias("odd0")
        )

    nothing = F.lit(None).cast("long")
    to_the_right = (
        Window.partitionBy("poly_id", "region", "band")
        .orderBy(F.desc("col"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    squares = cut(
        counted(grid, 0, 0, F.col("odd0"))
        .unionByName(counted(tested, 1, 0, nothing))
        .unionByName(counted(opened, 0, 1, nothing))
        .groupBy(*place)
        .agg(
            F.sum("tests").alias("tests"),
            F.sum("opens").alias("opens"),
            F.max("odd0").alias("odd0"),
        )
        .withColumn("right", F.coalesce(F.sum("opens").over(to_the_right), F.lit(0)))
        .filter(F.col("odd0").isNotNull())
        .select(*place, "tests", ((F.col("odd0") + F.col("right")) % 2).alias("odd"))
        .filter((F.col("tests") > 0) | (F.col("odd") == 1))
    )
    return squares, tested


def polygon_cover(
    edges: DataFrame, height: float, width: float, max_tests: int | None = None
) -> list[CoverLevel]:
    """Levels of squares that hold all points of the polygons; no two levels share any place.

    A square is split where some polygon has more than ``max_tests`` edges to test in it.
    """
    max_tests = MAX_TESTS if max_tests is None else max_tests
    edges = edges.filter(F.col("y1") != F.col("y2")).withColumn("region", F.lit("all"))

    def reach(c: str, size: float, slack: int) -> list[Column]:
        low, high = F.least(f"{c}1", f"{c}2"), F.greatest(f"{c}1", f"{c}2")
        return [F.floor(F.min(low) / size) - slack, F.floor(F.max(high) / size) + slack]

    bands, cols = reach("y", height, 0), reach("x", width, 1)
    regions = edges.groupBy("poly_id", "region").agg(
        bands[0].alias("band_lo"),
        bands[1].alias("band_hi"),
        cols[0].alias("col_lo"),
        cols[1].alias("col_hi"),
        F.lit(0).cast("long").alias("odd0"),
    )
    levels = []
    while True:
        squares, tested = _level_squares(edges, regions, height, width)
        full = squares.filter("tests = 0").select(*SQUARE).distinct()
        crowded = squares.filter(F.col("tests") > max_tests).select(*SQUARE).distinct()
        crowded = cut(crowded.join(full, SQUARE, "left_anti"))
        splitting = len(levels) + 1 < MAX_LEVELS and not crowded.isEmpty()
        kept = tested.join(full, SQUARE, "left_anti")
        if splitting:
            kept = kept.join(crowded, SQUARE, "left_anti")
        place = ["poly_id", "region", *SQUARE]
        partial = (
            kept.groupBy(*place)
            .agg(F.collect_list(F.struct(*EDGE)).alias("tests"))
            .join(squares.drop("tests"), place)
            .groupBy(*SQUARE)
            .agg(F.collect_list(F.struct("odd", "tests")).alias("parts"))
            .select(*SQUARE, F.lit(False).alias("crowded"), F.lit(False).alias("solid"), "parts")
        )

        def plain(rows: DataFrame, crowded: bool) -> DataFrame:
            nothing = F.lit(None).cast(partial.schema["parts"].dataType)
            return rows.select(
                *SQUARE,
                F.lit(crowded).alias("crowded"),
                F.lit(not crowded).alias("solid"),
                nothing.alias("parts"),
            )

        cover = partial.unionByName(plain(full, crowded=False))
        if splitting:
            cover = cover.unionByName(plain(crowded, crowded=True))
        cover = cut(cover)
        edges_held = F.expr("aggregate(parts, 0, (n, p) -> n + 1 + size(p.tests))")
        size = cover.agg(F.coalesce(F.sum(64 + 40 * F.coalesce(edges_held, F.lit(0))), F.lit(0))).first()[0]
        levels.append(CoverLevel(height, width, cover, size))
        if not splitting:
            return levels
        inner = F.concat_ws(":", "band", "col")
        edges = tested.join(crowded, SQUARE, "left_semi").select(
            "poly_id", inner.alias("region"), *EDGE
        )
        regions = squares.join(crowded, SQUARE, "left_semi").select(
            "poly_id",
            inner.alias("region"),
            (F.col("band") * SPLIT).alias("band_lo"),
            (F.col("band") * SPLIT + SPLIT - 1).alias("band_hi"),
            (F.col("col") * SPLIT).alias("col_lo"),
            (F.col("col") * SPLIT + SPLIT - 1).alias("col_hi"),
            F.col("odd").alias("odd0"),
        )
        height, width = height / SPLIT, width / SPLIT


def crop_points(
    points: DataFrame,
    polygons: DataFrame,
    polygon_srid: int | str = "",
    point_srid: int | str = "",
) -> DataFrame:
    """The points (with all their columns) that lie in at least one polygon, each once.

    Polygons are brought into the points' reference system; points never move. A point on an edge
    follows the half-open ray rule of ``geometry.edge_crossed``.
    """
    rings = reproject_rings(F.col("rings"), polygon_srid, point_srid)
    edges = cut(
        ring_edges(
            polygons.select(F.col("poly_id").cast("long").alias("poly_id"), rings.alias("rings"))
        )
    )
    extent = _extent(edges)
    if not extent["edges"]:
        return points.filter(F.lit(False))
    bands, columns = _first_grid(extent)
    height = _power_of_two(extent["y_max"] - extent["y_min"], bands)
    width = _power_of_two(extent["x_max"] - extent["x_min"], columns)
    near = points.filter(
        F.col("x").between(extent["x_min"], extent["x_max"])
        & F.col("y").between(extent["y_min"], extent["y_max"])
    )
    return _inside(near, polygon_cover(edges, height, width))


def _inside(points: DataFrame, levels: list[CoverLevel]) -> DataFrame:
    """Points in the squares of all levels.

    A point looks up its square of the first level. Only where that is crowded it is looked up on the
    further levels, which make one table; as no two levels share any place, it is found once at most.
    """
    names = {c: f"_crop_{c}" for c in ("band", "col", "level", "crowded", "solid", "parts")}
    x, y = F.col("x"), F.col("y")

    def looked_up(rows: DataFrame, squares: DataFrame, size: int, key: list[str]) -> DataFrame:
        squares = squares.withColumnsRenamed(names)
        if size <= BROADCAST_BYTES:
            squares = F.broadcast(squares)
        return rows.join(squares, [names[c] for c in key], "left")

    crossed = F.exists(
        F.col(names["parts"]),
        lambda p: (
            p["odd"]
            + F.size(
                F.filter(
                    p["tests"],
                    lambda e: g.edge_crossed(x, y, e["x1"], e["y1"], e["x2"], e["y2"]),
                )
            )
        )
        % 2
        == 1,
    )
    found = F.coalesce(F.col(names["solid"]) | crossed, F.lit(False))
    first, deeper = levels[0], levels[1:]
    placed = points.withColumns(
        {names["band"]: F.floor(y / first.height), names["col"]: F.floor(x / first.width)}
    )
    rows = looked_up(placed, first.squares, first.bytes, SQUARE)
    if not deeper:
        return rows.filter(found).drop(*names.values())
    sizes = F.array(
        *[
            F.struct(F.lit(i).alias("at"), F.lit(v.height).alias("h"), F.lit(v.width).alias("w"))
            for i, v in enumerate(deeper)
        ]
    )
    crowded = F.coalesce(names["crowded"], F.lit(False))
    rows = (
        rows.withColumn("_crop_found", found)
        .filter(F.col("_crop_found") | crowded)
        .withColumn(names["level"], F.explode(F.when(crowded, sizes).otherwise(F.slice(sizes, 1, 1))))
        .drop(names["solid"], names["parts"])
        .withColumns(  # what is decided meets nothing, and keeps its square to stay dealt out
            {
                names["band"]: F.when(crowded, F.floor(y / F.col(f"{names['level']}.h"))).otherwise(
                    F.col(names["band"])
                ),
                names["col"]: F.when(crowded, F.floor(x / F.col(f"{names['level']}.w"))).otherwise(
                    F.col(names["col"])
                ),
                names["level"]: F.when(crowded, F.col(f"{names['level']}.at")).otherwise(-1),
            }
        )
        .drop(names["crowded"])
    )
    squares = reduce(
        DataFrame.unionByName,
        [v.squares.withColumn("level", F.lit(i)) for i, v in enumerate(deeper)],
    )
    rows = looked_up(rows, squares, sum(v.bytes for v in deeper), ["level", *SQUARE])
    return rows.filter(F.col("_crop_found") | found).drop("_crop_found", *names.values())
