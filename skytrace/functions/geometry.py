"""Planar geometry as Catalyst expressions.

A vertex is ``struct<x:double,y:double>`` and a short line or a ring is an array of them. Long
lines never become arrays; see ``skytrace.operators.flights`` for the one-row-per-vertex form.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COORDS = "array<struct<x:double,y:double>>"

# The direction labels of the line layers, kept verbatim.
NORTH_SOUTH = "N - S"
EAST_WEST = "E - W"
UNKNOWN_DIRECTION = "Dirección desconocida"

# The heading groups that lie exactly on an axis.
NORTH_SOUTH_GROUPS = (90, 270)
EAST_WEST_GROUPS = (180, 360)


def nan_to_null(col: Column) -> Column:
    """NULL for NaN: Spark orders NaN above every number, so ``NaN >= 0`` would hold."""
    return F.when(~F.isnan(col), col)


def round_half_even(col: Column, digits: int) -> Column:
    """Round the scaled value to the nearest integer, ties to even, as NumPy does."""
    scale = F.lit(float(10**digits))
    return F.rint(col * scale) / scale


def bearing(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Degrees counter-clockwise from East in [0, 360); NULL between identical points."""
    dx, dy = x2 - x1, y2 - y1
    return F.when((dx != 0) | (dy != 0), F.pmod(F.degrees(F.atan2(dy, dx)), F.lit(360.0)))


def heading_group(degrees: Column) -> Column:
    """Ten-degree group 10, 20, ... 360 of a bearing; group g holds (g - 5, g + 5]."""
    return F.when((degrees <= 5) | (degrees > 355), F.lit(360)).otherwise(
        (F.ceil((degrees - 5) / 10) * 10).cast("int")
    )


def axis_label(group: Column, north_south: str = "N-S", east_west: str = "E-W") -> Column:
    """Axis of a heading group, NULL for groups on neither axis."""
    return F.when(group.isin(*NORTH_SOUTH_GROUPS), F.lit(north_south)).when(
        group.isin(*EAST_WEST_GROUPS), F.lit(east_west)
    )


def direction_label(has_east_west: Column, has_north_south: Column) -> Column:
    """Direction of a flight; East-West wins when both axes occur."""
    return (
        F.when(has_east_west, F.lit(EAST_WEST))
        .when(has_north_south, F.lit(NORTH_SOUTH))
        .otherwise(F.lit(UNKNOWN_DIRECTION))
    )


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    dx, dy = x2 - x1, y2 - y1
    return F.sqrt(dx * dx + dy * dy)


def point_segment_distance2(
    px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column
) -> Column:
    """Squared distance from a point to a segment (squared, so that exact limits stay exact)."""
    dx, dy = x2 - x1, y2 - y1
    length2 = dx * dx + dy * dy
    along = F.when(
        length2 > 0,
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((px - x1) * dx + (py - y1) * dy) / length2)),
    ).otherwise(F.lit(0.0))
    ex, ey = px - (x1 + along * dx), py - (y1 + along * dy)
    return ex * ex + ey * ey


def first_vertex(coords: Column) -> Column:
    return F.element_at(coords, 1)


def last_vertex(coords: Column) -> Column:
    return F.element_at(coords, -1)


def _steps(coords: Column) -> Column:
    """Consecutive vertex pairs of a line as an array of (a, b) structs."""
    count = F.greatest(F.size(coords) - 1, F.lit(0))
    return F.zip_with(
        F.slice(coords, F.lit(1), count),
        F.slice(coords, F.lit(2), count),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")),
    )


def line_length(coords: Column) -> Column:
    return F.aggregate(
        _steps(coords),
        F.lit(0.0),
        lambda acc, s: acc + distance(s["a"]["x"], s["a"]["y"], s["b"]["x"], s["b"]["y"]),
    )


def line_length_km(coords: Column) -> Column:
    return line_length(coords) / 1000


def line_centroid(coords: Column) -> Column:
    """Mean of segment midpoints weighted by length; the vertex mean when the length is zero."""
    zero = F.struct(
        F.lit(0.0).alias("w"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y")
    )

    def add(acc: Column, s: Column) -> Column:
        w = distance(s["a"]["x"], s["a"]["y"], s["b"]["x"], s["b"]["y"])
        return F.struct(
            (acc["w"] + w).alias("w"),
            (acc["x"] + w * (s["a"]["x"] + s["b"]["x"]) / 2).alias("x"),
            (acc["y"] + w * (s["a"]["y"] + s["b"]["y"]) / 2).alias("y"),
        )

    total = F.aggregate(_steps(coords), zero, add)
    n = F.size(coords)
    mean_x = F.aggregate(coords, F.lit(0.0), lambda acc, p: acc + p["x"]) / n
    mean_y = F.aggregate(coords, F.lit(0.0), lambda acc, p: acc + p["y"]) / n
    return F.when(
        total["w"] > 0, point(total["x"] / total["w"], total["y"] / total["w"])
    ).otherwise(point(mean_x, mean_y))


def make_line(coords: Column) -> Column:
    """The line itself, or NULL when it has fewer than two vertices."""
    return F.when(F.size(coords) >= 2, coords)


def close_ring(coords: Column) -> Column:
    """Ring with its first vertex repeated at the end; NULL below three distinct positions."""
    return F.when(
        F.size(F.array_distinct(coords)) >= 3,
        F.when(first_vertex(coords) == last_vertex(coords), coords).otherwise(
            F.concat(coords, F.array(first_vertex(coords)))
        ),
    )


def ring_area(ring: Column) -> Column:
    """Absolute shoelace area of a closed ring (signed parts of a self-crossing ring cancel)."""
    twice = F.aggregate(
        _steps(ring),
        F.lit(0.0),
        lambda acc, s: acc + (s["a"]["x"] * s["b"]["y"] - s["b"]["x"] * s["a"]["y"]),
    )
    return F.abs(twice) / 2


def edge_crossed(
    px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column
) -> Column:
    """Does the ray from (px, py) towards +x cross this edge? Half-open in y."""
    return ((y1 > py) != (y2 > py)) & (px < (x2 - x1) * (py - y1) / (y2 - y1) + x1)


def rings_contain(rings: Column, px: Column, py: Column) -> Column:
    """Even-odd point-in-polygon test over every ring (shells and holes alike)."""
    crossings = F.aggregate(
        rings,
        F.lit(0),
        lambda acc, ring: acc
        + F.size(
            F.filter(
                _steps(ring),
                lambda s: edge_crossed(
                    px, py, s["a"]["x"], s["a"]["y"], s["b"]["x"], s["b"]["y"]
                ),
            )
        ),
    )
    return crossings % 2 == 1


def flatten_parts(parts: Column) -> Column:
    """All vertices of a multi-part line, in part order."""
    return F.flatten(parts)


def coordinate_text(coords: Column, between: str = ",", separator: str = " ") -> Column:
    """``x,y x,y ...`` as KML wants it, or any other pair and list separators."""
    return F.array_join(
        F.transform(
            coords,
            lambda p: F.concat(p["x"].cast("string"), F.lit(between), p["y"].cast("string")),
        ),
        separator,
    )


def line_wkt(coords: Column) -> Column:
    return F.concat(F.lit("LINESTRING ("), coordinate_text(coords, " ", ", "), F.lit(")"))


def polygon_wkt(rings: Column) -> Column:
    body = F.array_join(
        F.transform(
            rings, lambda r: F.concat(F.lit("("), coordinate_text(r, " ", ", "), F.lit(")"))
        ),
        ", ",
    )
    return F.concat(F.lit("POLYGON ("), body, F.lit(")"))
