"""Areas of coverage rings, and excluding endpoints by rectangles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytrace.operators.lineage import cut
from skytrace.operators.sequence import with_next_vertex

#: Squares of boxes up to this size are broadcast; a square takes about so many bytes.
BROADCAST_BYTES = 64 << 20
SQUARE_BYTES = 64
#: Sizes of boxes that points are tested for one after the other.
FEW_SIZES = 64


def sorted_boxes(boxes: DataFrame) -> DataFrame:
    """``x_min, x_max, y_min, y_max`` from the two corners of dragged rectangles."""
    return boxes.select(
        *[
            pick(f"{c}_from", f"{c}_to").alias(f"{c}_{name}")
            for c in ("x", "y")
            for name, pick in (("min", F.least), ("max", F.greatest))
        ]
    )


def in_any_box(x: Column, y: Column, boxes: list[tuple[float, float, float, float]]) -> Column:
    """Closed-interval test against a few literal ``(x_min, x_max, y_min, y_max)`` boxes."""
    hit = F.lit(False)
    for x_min, x_max, y_min, y_max in boxes:
        hit = hit | (x.between(x_min, x_max) & y.between(y_min, y_max))
    return hit


def exclude_boxes(points: DataFrame, boxes: DataFrame) -> DataFrame:
    """Points in none of the closed boxes ``x_min, x_max, y_min, y_max``.

    Boxes are sorted into sizes by powers of two. A box of size s overlaps at most four squares of
    side s, and a point looks up one square of each size. Below a measured size the squares are
    broadcast and points stay where they are, tested size after size. Otherwise the squares of all
    sizes make one table, and the places that it has inside boxes are taken out of the points.
    """
    side = F.greatest(F.col("x_max") - F.col("x_min"), F.col("y_max") - F.col("y_min"))
    level = F.when(side > 0, F.ceil(F.log2(side))).otherwise(0).cast("int")
    step = F.pow(F.lit(2.0), F.col("level"))

    def square(at: Column) -> Column:
        return F.floor(at / step)

    squares = boxes.withColumn("level", level)
    for c in ("x", "y"):
        span = F.sequence(square(F.col(f"{c}_min")), square(F.col(f"{c}_max")))
        squares = squares.withColumn(f"s{c}", F.explode(span))
    squares = cut(squares.select("level", "sx", "sy", "x_min", "x_max", "y_min", "y_max"))
    # One row a size; a double has at most some two thousand powers of two.
    sizes = {r["level"]: r["n"] for r in squares.groupBy("level").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return points
    inside_box = [F.col(f"p.{c}").between(F.col(f"b.{c}_min"), F.col(f"b.{c}_max")) for c in ("x", "y")]
    if len(sizes) <= FEW_SIZES and sum(sizes.values()) * SQUARE_BYTES <= BROADCAST_BYTES:
        for level in sorted(sizes):
            own = F.broadcast(squares.filter(F.col("level") == level)).alias("b")
            place = [F.floor(F.col(f"p.{c}") / 2.0**level) == F.col(f"b.s{c}") for c in ("x", "y")]
            points = points.alias("p").join(own, place + inside_box, "left_anti")
        return points
    keyed = (
        points.select("x", "y")
        .withColumn("level", F.explode(F.array(*[F.lit(n) for n in sorted(sizes)])))
        .withColumns({f"s{c}": square(F.col(c)) for c in ("x", "y")})
    )
    p, b = keyed.alias("p"), squares.alias("b")
    place = [F.col(f"p.{c}") == F.col(f"b.{c}") for c in ("level", "sx", "sy")]
    inside = p.join(b, place + inside_box, "left_semi")
    return points.join(inside.select("x", "y").distinct(), ["x", "y"], "left_anti")


def ring_areas(rings: DataFrame, project: str = "project_id") -> DataFrame:
    """Absolute signed area of each closed ring in m², ha and km²; parts of a ring that crosses
    itself may cancel. Rings with fewer than three distinct positions have no area (NULL).
    """
    vertices = rings.withColumnRenamed("pos", "vertex_no")
    steps = with_next_vertex(vertices, project)
    cross = F.col("x") * F.col("next_y") - F.col("next_x") * F.col("y")
    distinct = F.count_distinct(F.struct("x", "y"))
    return (
        steps.groupBy(project)
        .agg((F.abs(F.sum(cross)) / 2).alias("area_m2"), distinct.alias("positions"))
        .withColumn("area_m2", F.when(F.col("positions") >= 3, F.col("area_m2")))
        .drop("positions")
        .withColumns({"area_ha": F.col("area_m2") / 10000, "area_km2": F.col("area_m2") / 1e6})
    )
