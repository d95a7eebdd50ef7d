"""Grouping, merging and ordering of production lines.

Input is one row per vertex, ``lines(row_id, direction, vertex_no, x, y)``: ``row_id`` gives the
row order of the layer and ``vertex_no`` counts 0, 1, 2, ... along the line.

Two lines belong together when an endpoint of one lies within a tolerance of the other. The pairs
themselves are never listed. Endpoints are snapped to cells so small that all endpoints of a cell
are within tolerance of each other; the cell then stands for all of them, and what remains is one
link per (cell, line nearby) - linear in the number of lines however many meet in one place.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytrace.functions import geometry as g
from skytrace.functions.crs import SRID, common_srid, marked, srid_of
from skytrace.functions.exact import ExactSum
from skytrace.operators import graph
from skytrace.operators.dissolve import union_on_carriers
from skytrace.operators.lineage import sized as cut
from skytrace.operators.sequence import CHUNK_ROWS, number_globally, with_next_vertex

TOLERANCE = 10.0
CELL_POINTS = 32
SPLIT = 8
#: Pieces that a segment is cut into at most, and how much wider the grid for longer ones is.
PIECES = 64
COARSER = 8
#: Side of the squares in which shorter segments meet endpoints, in tolerances.
SQUARE = 4
CELL = ["direction", "cx", "cy"]


def merge_input(vertices: DataFrame) -> DataFrame:
    """The vertices of ``flights.production_vertices`` as a line layer.

    ``vertex_no`` is the fix number, which grows along the line but need not be dense: the
    segments are already given by ``next_x``/``next_y``.
    """
    return vertices.select(
        "row_id", "direction", F.col("seq").alias("vertex_no"), "x", "y", "next_x", "next_y"
    )


def segments(lines: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``row_id, direction, vertex_no, x, y, next_x, next_y``, one row per segment."""
    if "next_x" not in lines.columns:
        lines = with_next_vertex(lines, "row_id", chunk_rows)
    return lines.filter(F.col("next_x").isNotNull())


def with_steps(lines: DataFrame) -> DataFrame:
    """A layer written once, with the next vertex of each; the operators on lines read it several times."""
    return cut(lines if "next_x" in lines.columns else with_next_vertex(lines))


def line_ends(lines: DataFrame) -> DataFrame:
    """``row_id, direction, x, y``: both end vertices of every line."""
    ends = lines.groupBy("row_id", "direction").agg(
        *[F.min_by(c, "vertex_no").alias(f"{c}0") for c in ("x", "y")],
        *[F.max_by(c, "vertex_no").alias(f"{c}1") for c in ("x", "y")],
    )
    both = F.array(g.point(F.col("x0"), F.col("y0")), g.point(F.col("x1"), F.col("y1")))
    return ends.select("row_id", "direction", F.explode(both).alias("p")).select(
        "row_id", "direction", F.col("p.x").alias("x"), F.col("p.y").alias("y")
    )


def _cell_side(tolerance: float) -> float:
    """Side of a cell whose diagonal stays below the tolerance."""
    return 0.7 * tolerance


def _cell(col: str, size: float) -> Column:
    return F.floor(F.col(col) / size)


def end_cells(lines: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Line ends with the cell each falls in."""
    side = _cell_side(tolerance)
    return line_ends(lines).withColumns({"cx": _cell("x", side), "cy": _cell("y", side)})


def _exact_targets(points: DataFrame, tolerance: float) -> DataFrame:
    limit = F.lit(tolerance * tolerance)
    return points.select(
        *CELL,
        "sx",
        "sy",
        F.col("x").alias("tx"),
        F.col("y").alias("ty"),
        limit.alias("near2"),
        limit.alias("open2"),
    )


def _targets(points: DataFrame, size: float, tolerance: float) -> DataFrame:
    """What segments are measured against: ``tx, ty`` with two limits of the squared distance.

    Up to ``near2`` a segment is within tolerance of a point, beyond ``open2`` it is not. For a
    point both limits are the tolerance. A square node of the given size with more than
    ``CELL_POINTS`` distinct points is measured by its centre instead; its limits differ by its
    half diagonal and a margin for rounding, and what falls between them must be split.
    """
    placed = points.withColumns({"sx": _cell("x", size), "sy": _cell("y", size)})
    key = [*CELL, "sx", "sy"]
    sizes = placed.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    light = placed.join(sizes.filter(F.col("n") <= CELL_POINTS), key, "left_semi")
    reach = size * 0.7072 + tolerance * 1e-9
    full = sizes.filter(F.col("n") > CELL_POINTS).select(
        *key,
        ((F.col("sx") + 0.5) * size).alias("tx"),
        ((F.col("sy") + 0.5) * size).alias("ty"),
        F.lit((tolerance - reach) ** 2 if reach < tolerance else -1.0).alias("near2"),
        F.lit((tolerance + reach) ** 2).alias("open2"),
    )
    return _exact_targets(light, tolerance).unionByName(full)


def _measured(pairs: DataFrame) -> DataFrame:
    """Pairs of segments and targets that are near or undecided, told apart by ``near``."""
    squared = g.point_segment_distance2(
        *[F.col(c) for c in ("tx", "ty", "x", "y", "next_x", "next_y")]
    )
    return (
        pairs.withColumn("d2", squared)
        .filter(F.col("d2") <= F.col("open2"))
        .withColumn("near", F.col("d2") <= F.col("near2"))
        .select(*CELL, "sx", "sy", "row_id", "x", "y", "next_x", "next_y", "near")
    )


def _meet(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """An inner join, sorted by a hash of the key first.

    Rows are sorted by the first bytes of the first column, and few directions tell none of them apart.
    """
    hashed = F.xxhash64(*key).alias("_key")
    return left.select(hashed, "*").join(right.select(hashed, "*"), ["_key", *key]).drop("_key")


def cell_links(lines: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """``direction, cx, cy, row_id``: some endpoint in the cell is within tolerance of the line."""
    return _cell_links(lines, cut(end_cells(lines, tolerance)), tolerance)


def _cell_links(lines: DataFrame, ends: DataFrame, tolerance: float) -> DataFrame:
    """Segments and targets meet in the squares of a coarse grid: a segment is in those that the boxes of
    its pieces touch, a target in those within reach of it, mostly one or two.

    Segments of more than ``PIECES`` steps are cut into pieces of a coarser grid and led down to the
    squares near them that hold an endpoint.
    """
    step = 2 * tolerance
    side = _cell_side(tolerance)
    points = ends.select(*CELL, "x", "y").distinct()
    crowded = points.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CELL_POINTS)
    any_crowded = not crowded.isEmpty()
    if any_crowded:
        crowded = cut(crowded)
        targets = _targets(points, side, tolerance)
    else:
        targets = _exact_targets(
            points.withColumns({"sx": F.col("cx"), "sy": F.col("cy")}), tolerance
        )
    square = SQUARE * tolerance
    reach = F.sqrt("open2") * 1.001  # rounding included
    around = [
        F.sequence(*[F.floor((F.col(f"t{c}") + sign * reach) / square) for sign in (-1, 1)])
        for c in ("x", "y")
    ]
    spread = targets.withColumn("gx", F.explode(around[0])).withColumn("gy", F.explode(around[1]))
    # Both sides grow in an explode the size estimates do not see: never broadcast them by estimate.
    short = _touched_squares(_with_level(lines, step).filter("level = 0"), square)
    pairs = _meet(short.hint("merge"), spread, ["direction", "gx", "gy"])
    long = _segment_pieces(lines, step).filter("level > 0")
    levels = long.agg(F.max("level")).first()[0] or 0
    if levels:
        pairs = pairs.drop("gx", "gy").unionByName(_led_down(long, targets, levels, step))
    measured = _measured(pairs)
    if any_crowded:
        measured = cut(measured.distinct())
        return _crowded_links(measured, points, crowded, side, tolerance).distinct()
    return measured.filter("near").select(*CELL, "row_id").distinct()


def _with_level(lines: DataFrame, step: float) -> DataFrame:
    """The segments of the lines with their ``length`` and ``level``.

    The grid of a level is ``COARSER`` times as wide as that of the level below. A segment takes the
    lowest level on which it has at most ``PIECES`` pieces, give or take one.
    """
    length = F.col("length")
    level = F.ceil(F.log2(length / (step * PIECES)) / math.log2(COARSER)).cast("int")
    ends = ["x", "y", "next_x", "next_y"]
    return (
        segments(lines)
        .select("row_id", "direction", *ends, g.distance(*[F.col(c) for c in ends]).alias("length"))
        .withColumn("level", F.when(length > step * PIECES, F.greatest(level, F.lit(1))).otherwise(0))
    )


def _touched_squares(levelled: DataFrame, square: float) -> DataFrame:
    """``row_id, direction, x, y, next_x, next_y, gx, gy``: squares that hold a part of a segment.

    These are the squares touched by the boxes of its pieces, none of them longer than a square.
    """
    def at(c: str, share: Column) -> Column:
        return F.floor((F.col(c) + (F.col(f"next_{c}") - F.col(c)) * share) / square)

    begin, end = F.col("piece") / F.col("pieces"), (F.col("piece") + 1) / F.col("pieces")
    pieces = levelled.withColumn(
        "pieces", F.greatest(F.ceil(F.col("length") / square), F.lit(1)).cast("long")
    ).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    for c in ("x", "y"):
        both = at(c, begin), at(c, end)
        pieces = pieces.withColumn(
            f"g{c}", F.explode(F.sequence(F.least(*both), F.greatest(*both)))
        )
    kept = ["row_id", "direction", "x", "y", "next_x", "next_y", "gx", "gy"]
    return pieces.select(*kept)


def _segment_pieces(lines: DataFrame, step: float) -> DataFrame:
    """``row_id, direction, x, y, next_x, next_y, level, gx, gy``: a row for each piece of a segment,
    with the square of the grid of its level that holds its middle.
    """
    length, wide = F.col("length"), F.col("wide")
    share = (F.col("piece") + 0.5) / F.col("pieces")
    return (
        _with_level(lines, step)
        .withColumn("wide", step * F.pow(F.lit(float(COARSER)), F.col("level")))
        .withColumn("pieces", F.greatest(F.ceil(length / wide), F.lit(1)).cast("long"))
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
        .select(
            "row_id",
            "direction",
            "x",
            "y",
            "next_x",
            "next_y",
            "level",
            *[
                F.floor((F.col(c) + (F.col(f"next_{c}") - F.col(c)) * share) / wide).alias(f"g{c}")
                for c in ("x", "y")
            ],
        )
    )


def _led_down(long: DataFrame, targets: DataFrame, levels: int, step: float) -> DataFrame:
    """Pairs of long segments and the targets that may be near them.

    From the coarsest level on, a segment is kept with the squares near it that hold a target, and
    these are replaced by their own squares on the level below. So the rows of a segment grow with
    the targets near it, not with its length.
    """
    segment = ["row_id", "direction", "x", "y", "next_x", "next_y"]
    square = ["direction", "gx", "gy"]
    placed = cut(
        targets.withColumns({f"g{c}": F.floor(F.col(f"t{c}") / step) for c in ("x", "y")})
    )
    held = [placed.select(*square).distinct()]
    for _ in range(levels):
        up = [F.floor(F.col(c) / COARSER).alias(c) for c in ("gx", "gy")]
        held.append(cut(held[-1].select("direction", *up).distinct()))
    near = None
    for level in range(levels, -1, -1):
        wide = step * COARSER**level
        pairs = None
        if near is not None:
            children = held[level].withColumns(
                {f"p{c}": F.floor(F.col(f"g{c}") / COARSER) for c in ("x", "y")}
            )
            parents = near.withColumnsRenamed({"gx": "px", "gy": "py"})
            pairs = parents.join(children, ["direction", "px", "py"]).select(*segment, "gx", "gy")
        if level:
            beside = F.array(*[F.lit(i) for i in (-1, 0, 1)])
            around = held[level].withColumnsRenamed({"gx": "hx", "gy": "hy"})
            for c in ("x", "y"):
                around = around.withColumn("by", F.explode(beside)).withColumn(
                    f"g{c}", F.col(f"h{c}") + F.col("by")
                )
            own = long.filter(F.col("level") == level).join(around, square)
            own = own.select(*segment, F.col("hx").alias("gx"), F.col("hy").alias("gy")).distinct()
            pairs = own if pairs is None else pairs.unionByName(own).distinct()
        centre = [(F.col(c) + 0.5) * wide for c in ("gx", "gy")]
        squared = g.point_segment_distance2(*centre, *[F.col(c) for c in ("x", "y", "next_x", "next_y")])
        # Half a diagonal, and what a target may lie off its point: 1.5 tolerances, 0.75 steps.
        near = cut(pairs.filter(squared <= (wide * 0.70711 + step * 0.7501) ** 2))
    return near.join(placed, square).drop("gx", "gy")


def _crowded_links(
    measured: DataFrame, points: DataFrame, crowded: DataFrame, size: float, tolerance: float
) -> DataFrame:
    """Split undecided nodes into smaller ones until every (cell, line) is decided."""
    found = measured.select(*CELL, "row_id").filter(F.lit(False))
    points = points.join(crowded, CELL, "left_semi")
    while True:
        # A line already linked to the cell needs no further test there.
        near = measured.filter("near").select(*CELL, "row_id").distinct()
        undecided = cut(
            measured.filter(~F.col("near"))
            .drop("near")
            .join(near, [*CELL, "row_id"], "left_anti")
        )
        found = found.unionByName(near)
        if undecided.isEmpty():
            return found
        size /= SPLIT
        children = _targets(points, size, tolerance).withColumns(
            {"px": F.floor(F.col("sx") / SPLIT), "py": F.floor(F.col("sy") / SPLIT)}
        )
        parents = undecided.withColumnsRenamed({"sx": "px", "sy": "py"})
        measured = cut(_measured(parents.join(children, [*CELL, "px", "py"])).distinct())


def proximity_groups(
    lines: DataFrame, tolerance: float = TOLERANCE, mode: str = "directed"
) -> DataFrame:
    """``row_id, direction, grp`` for every line; ``grp`` is the row id that names the group.

    A line is a seed when no line before it (in row order) reaches it through "my endpoint is
    near that line"; each line belongs to the last seed that reaches it. The relation is one-way
    where an endpoint meets the inside of another line. ``mode="weak"`` ignores its direction
    and names each component by its first line.
    """
    if mode not in ("directed", "weak"):
        raise ValueError(f"unknown mode {mode!r}")
    ends = cut(end_cells(lines, tolerance))
    leaders = ends.groupBy(*CELL).agg(F.min("row_id").alias("leader"))
    members = cut(_meet(ends.select(*CELL, "row_id"), leaders, CELL).select("row_id", "leader"))
    same_cell = members.select(F.col("row_id").alias("src"), F.col("leader").alias("dst"))
    # leader of the cell -> leaders of the cells the nearby line ends in
    arrows = cut(
        _meet(_cell_links(lines, ends, tolerance), leaders, CELL)
        .select(F.col("leader").alias("src"), "row_id")
        .distinct()
        .join(members, "row_id")
        .select("src", F.col("leader").alias("dst"))
        .filter(F.col("src") != F.col("dst"))
        .distinct()
    )
    rows = ends.select("row_id", "direction").distinct()
    if mode == "weak":
        components = graph.connected_components(same_cell.unionByName(arrows))
        return _named(rows, components, "component")
    components = graph.connected_components(
        same_cell.unionByName(graph.mutual_pairs(arrows))
    )
    one_way = cut(graph.relabel_edges(arrows, components))
    while not (mutual := cut(graph.mutual_pairs(one_way))).isEmpty():
        outer = cut(graph.connected_components(mutual))
        components = cut(
            components.join(
                outer.select(
                    F.col("node").alias("component"), F.col("component").alias("_outer")
                ),
                "component",
                "left",
            ).select("node", F.coalesce("_outer", "component").alias("component"))
        )
        one_way = cut(graph.relabel_edges(one_way, outer))
    grouped = _named(rows, components, "component")
    if one_way.isEmpty():
        return grouped
    seeds = graph.last_seed(one_way).select(F.col("node").alias("grp"), "seed")
    return (
        grouped.join(seeds, "grp", "left")
        .withColumn("grp", F.coalesce("seed", "grp"))
        .select("row_id", "direction", "grp")
    )


def _named(rows: DataFrame, components: DataFrame, name: str) -> DataFrame:
    labels = components.select(F.col("node").alias("row_id"), F.col(name).alias("_label"))
    return rows.join(labels, "row_id", "left").select(
        "row_id", "direction", F.coalesce("_label", "row_id").alias("grp")
    )


def drop_singletons(groups: DataFrame, directions: list[str] | None = None) -> DataFrame:
    """Remove lines that are alone in their group, for the chosen directions (all when None)."""
    singles = (
        groups.groupBy("direction", "grp")
        .agg(F.count(F.lit(1)).alias("n"), F.min("row_id").alias("row_id"))
        .filter(F.col("n") == 1)
    )
    if directions is not None:
        singles = singles.filter(F.col("direction").isin(*directions))
    return groups.join(singles.select("row_id"), "row_id", "left_anti")


def dissolved_segments(lines: DataFrame, groups: DataFrame) -> DataFrame:
    """What the lines of every group cover, ``direction, grp, ax, ay, bx, by``, a row a piece.

    Segments that lie on each other, wholly or in part and whichever way lines run along them, count
    once; a is the lesser end of a piece by (x, y). Lines that cross or touch stay as they are.
    """
    parts = segments(lines.join(groups.select("row_id", "grp"), "row_id"))
    forward = (F.col("x") < F.col("next_x")) | (
        (F.col("x") == F.col("next_x")) & (F.col("y") <= F.col("next_y"))
    )
    ends = (("x", "next_x", "ax"), ("y", "next_y", "ay"), ("next_x", "x", "bx"), ("next_y", "y", "by"))
    undirected = parts.select(
        "direction",
        "grp",
        *[F.when(forward, F.col(a)).otherwise(F.col(b)).alias(name) for a, b, name in ends],
    )
    # Sorted by the group first, which tells more rows apart than the direction.
    covered = union_on_carriers(undirected, ["grp", "direction"])
    return covered.select("direction", "grp", "ax", "ay", "bx", "by")


def merged_lines(lines: DataFrame, groups: DataFrame) -> DataFrame:
    """One row per group: length, centroid and the two extreme vertices of its lines.

    East-West groups are extreme in x, all others in y; of several extreme vertices the first in
    (row, vertex) order is taken. Lengths and centroids are the same however the rows are dealt out.
    """
    key = ["direction", "grp"]
    grouped = lines.join(groups.select("row_id", "grp"), "row_id")
    pieces = dissolved_segments(lines, groups).select(
        *key,
        g.distance(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")).alias("w"),
        ((F.col("ax") + F.col("bx")) / 2).alias("mx"),
        ((F.col("ay") + F.col("by")) / 2).alias("my"),
    )
    length = ExactSum("w", F.col("w"))
    moments = {c: ExactSum(c, F.col("w") * F.col(f"m{c[1]}")) for c in ("cx", "cy")}
    sums = pieces.groupBy(*key).agg(
        *length.aggregates(),
        *[a for moment in moments.values() for a in moment.aggregates()],
        *[F.avg(F.col(m).cast("decimal(38, 12)")).cast("double").alias(m) for m in ("mx", "my")],
    )
    centroids = sums.withColumn("length", length.total()).select(
        *key,
        "length",
        *[
            F.when(F.col("length") > 0, moments[c].total() / F.col("length"))
            .otherwise(F.col(m))  # lines of no length
            .alias(c)
            for c, m in (("cx", "mx"), ("cy", "my"))
        ],
    )
    along = F.when(F.col("direction") == g.EAST_WEST, F.col("x")).otherwise(F.col("y"))
    vertex = g.point(F.col("x"), F.col("y"))
    extremes = grouped.groupBy(*key).agg(
        F.max_by(vertex, F.struct(along, -F.col("row_id"), -F.col("vertex_no"))).alias("most"),
        F.min_by(vertex, F.struct(along, "row_id", "vertex_no")).alias("least"),
    )
    return centroids.join(extremes, key).select(
        *key, (F.col("length") / 1000).alias("long_km"), "cx", "cy", "most", "least"
    )


def ordered_lines(merged: DataFrame) -> DataFrame:
    """Number merged lines 1, 2, ...: North-South from west to east, then East-West from north
    to south, then all others from south to north; equal centroids by group.
    """
    ranked = cut(merged).withColumns(  # numbering reads it twice
        {
            "block": F.when(F.col("direction") == g.NORTH_SOUTH, 0)
            .when(F.col("direction") == g.EAST_WEST, 1)
            .otherwise(2),
            "place": F.when(F.col("direction") == g.NORTH_SOUTH, F.col("cx"))
            .when(F.col("direction") == g.EAST_WEST, -F.col("cy"))
            .otherwise(F.col("cy")),
        }
    )
    return number_globally(ranked, ["block", "place", "grp"], "id").drop("block", "place")


def extreme_chords(ordered: DataFrame) -> DataFrame:
    """The straight line from the greatest to the least vertex of every merged line."""
    return ordered.select("id", "direction", F.array("most", "least").alias("coords"))


def extreme_points(ordered: DataFrame) -> DataFrame:
    """``id, kind, x, y`` with kind max_x/min_x for East-West lines and max_y/min_y for others."""
    axis = F.when(F.col("direction") == g.EAST_WEST, F.lit("x")).otherwise(F.lit("y"))
    both = F.array(
        F.struct(F.concat(F.lit("max_"), axis).alias("kind"), F.col("most").alias("p")),
        F.struct(F.concat(F.lit("min_"), axis).alias("kind"), F.col("least").alias("p")),
    )
    return ordered.select("id", F.inline(both)).select(
        "id", "kind", F.col("p.x").alias("x"), F.col("p.y").alias("y")
    )


def merge_lines(
    lines: DataFrame | list[DataFrame],
    tolerance: float = TOLERANCE,
    drop_single: list[str] | None = (),
    mode: str = "directed",
) -> DataFrame:
    """Group, merge, order and straighten a line layer: ``id, direction, coords``.

    ``drop_single`` lists the directions whose lone lines are removed (None: every direction).
    Several layers are united first. Layers that are marked with different reference systems, or rows
    whose ``srid`` column says so, are refused.
    """
    if not isinstance(lines, DataFrame):
        lines = layer_union(lines)
    srid = _one_srid(lines)
    lines = lines if "next_x" in lines.columns else with_steps(lines)
    groups = proximity_groups(lines, tolerance, mode)
    if drop_single is None or drop_single:
        groups = drop_singletons(groups, drop_single)
    chords = extreme_chords(ordered_lines(merged_lines(lines, cut(groups))))
    return chords if srid is None else marked(chords, srid, "coords")


def _one_srid(layer: DataFrame) -> int | None:
    """The reference system of a layer, by its marks and by its column ``srid``, or None if unknown."""
    srid = srid_of(layer)
    if "srid" not in layer.columns:
        return srid
    found = {r["srid"] for r in layer.select("srid").distinct().limit(2).collect()}
    found = {s for s in found | {srid} if s}
    return common_srid(found) if found else None


def feature_vertices(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(lines, rejects)`` of features ``row_id, direction, parts`` of any kind of shape.

    Lines and lines of several parts become vertices ``row_id, direction, vertex_no, x, y, next_x,
    next_y``; ``vertex_no`` counts through the parts, and no segment leads from one part to the next.
    Parts below two vertices are no lines and are left out. ``rejects`` has ``row_id, reason`` of
    features without any line: ``no_shape`` (NULL or without parts), ``point`` (a single vertex) or
    ``no_line``. Other columns of ``features`` are not kept, but for ``srid`` and marks on ``parts``.
    """
    srid = _one_srid(features)
    parts = F.coalesce("parts", F.array().cast(features.schema["parts"].dataType))
    kept = F.filter(F.transform(parts, g.make_line), lambda part: part.isNotNull())
    reason = (
        F.when(F.size(parts) == 0, "no_shape")
        .when(F.size(kept) > 0, None)
        .when(F.size(F.flatten(parts)) == 1, "point")
        .otherwise("no_line")
    )

    def steps(part: Column) -> Column:
        return F.transform(
            part,
            lambda v, i: F.struct(
                v["x"].alias("x"),
                v["y"].alias("y"),
                F.get(part, i + 1)["x"].alias("next_x"),
                F.get(part, i + 1)["y"].alias("next_y"),
            ),
        )

    vertices = features.select(
        "row_id", "direction", F.posexplode(F.flatten(F.transform(kept, steps))).alias("pos", "v")
    ).select("row_id", "direction", F.col("pos").cast("long").alias("vertex_no"), "v.*")
    rejects = features.select("row_id", reason.alias("reason")).filter("reason IS NOT NULL")
    return (vertices if srid is None else marked(vertices, srid, "x", "y")), rejects


def directions_seen(lines: DataFrame) -> DataFrame:
    """``direction, rank, first_row``: the directions of a layer in the order of their first line."""
    first = lines.groupBy("direction").agg(F.min("row_id").alias("first_row"))
    return number_globally(first, ["first_row", "direction"], "rank")


def line_endpoints(chords: DataFrame) -> DataFrame:
    """First vertex as ``Min`` and last as ``Max`` of every line of ``id, coords``.

    ``line_id`` is the zero-based row of the line and ``point_id`` the row of the point.
    """
    ends = F.array(
        F.struct(F.lit("Min").alias("type"), g.first_vertex(F.col("coords")).alias("p")),
        F.struct(F.lit("Max").alias("type"), g.last_vertex(F.col("coords")).alias("p")),
    )
    line_id = F.col("id").cast("long") - 1
    return chords.select(line_id.alias("line_id"), F.posexplode(ends).alias("pos", "end")).select(
        (F.col("line_id") * 2 + F.col("pos")).alias("point_id"),
        "line_id",
        F.col("end.type").alias("type"),
        F.col("end.p.x").alias("x"),
        F.col("end.p.y").alias("y"),
    )


def with_length_km(chords: DataFrame) -> DataFrame:
    return chords.withColumn("long_km", g.line_length_km(F.col("coords")))


def volume_report(chords: DataFrame) -> DataFrame:
    """Kilometres per line and in total (``id`` NULL, ``is_total`` true)."""
    return with_length_km(chords).rollup("id").agg(
        F.sum("long_km").alias("long_km"), F.grouping("id").cast("boolean").alias("is_total")
    )


def layer_union(layers: list[DataFrame], srids: list[int] | None = None) -> DataFrame:
    """All features of several layers by column name; missing columns become NULL.

    Layers in different reference systems are refused, as told by the marks of their columns
    (``crs.marked``) and, for layers without, by ``srids``. The union carries the marks on.
    """
    known = [srid_of(layer) for layer in layers]
    given = srids or [None] * len(layers)
    found = {s for pair in zip(known, given, strict=True) for s in pair if s}
    if found:
        common_srid(found)
    union = layers[0]
    for layer in layers[1:]:
        union = union.unionByName(layer, allowMissingColumns=True)
    columns = {f.name for x in layers for f in x.schema.fields if SRID in f.metadata}
    return marked(union, found.pop(), *sorted(columns)) if columns else union
