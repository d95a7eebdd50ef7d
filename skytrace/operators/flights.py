"""From GNSS tracks to production lines.

Input is ``track(flight, seq, x, y, z)``: one row per fix, ``seq`` counting the fixes of a flight (gaps
are fine; clock times would make chunks of a few rows).
The work runs in two levels so that a flight of any length spreads over many tasks:

1. *Stretches*: inside ``(flight, chunk)`` consecutive fixes with the same heading group collapse
   into one row. This is the only pass that sorts fixes.
2. *Runs*: everything else (two commonest headings, gaps, run numbers, long-run filter, direction,
   line ids, lengths) is decided on stretches, which are far fewer, and again chunk by chunk.

A fix meets its line again by position in a per-chunk array, without a second shuffle of fixes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytrace.functions import geometry as g
from skytrace.functions.crs import GEOGRAPHIC, marked, parse_srid, reproject_columns
from skytrace.operators.lineage import cut, stored
from skytrace.operators.sequence import (
    CHUNK_ROWS,
    chunk_of,
    drop_first_seen_duplicates,
    number_globally,
    number_rows,
    running_offsets,
)

CHUNK = ["flight", "chunk"]


def clean_points(track: DataFrame) -> DataFrame:
    """Fixes at or above altitude 0, rounded, first of each (x, y, z) kept.

    X keeps 9 decimals and Y 6; Z is compared as read.
    """
    rounded = track.select(
        "flight",
        "seq",
        g.round_half_even(g.nan_to_null(F.col("x")), 9).alias("x"),
        g.round_half_even(g.nan_to_null(F.col("y")), 6).alias("y"),
        g.nan_to_null(F.col("z")).alias("z"),
    ).filter(F.col("z") >= 0)
    return drop_first_seen_duplicates(rounded, ["flight", "x", "y", "z"], "seq")


def _ordered_points(track: DataFrame, srid: int, chunk_rows: int) -> DataFrame:
    """Clean fixes with their neighbours and stretch number inside their chunk.

    ``u``/``v`` are the coordinates in the target system. The last fix of a chunk is always a
    stretch of its own, because its heading depends on the next chunk.
    """
    points = clean_points(track).select(
        "flight", chunk_of(F.col("seq"), chunk_rows).alias("chunk"), "seq", "x", "y"
    )
    if srid == GEOGRAPHIC:
        points = points.withColumns({"u": F.col("x"), "v": F.col("y")})
    else:
        points = reproject_columns(points, GEOGRAPHIC, srid, "x", "y", "u", "v")
    order = Window.partitionBy(*CHUNK).orderBy("seq")
    ahead = {f"next_{c}": F.lead(c).over(order) for c in ("x", "y", "u", "v", "seq")}
    behind = {f"prev_{c}": F.lag(c).over(order) for c in ("x", "y", "seq")}
    starts = (
        F.col("prev_seq").isNull()
        | F.col("next_seq").isNull()
        | ~F.col("grp").eqNullSafe(F.col("grp_before"))
    )
    return (
        points.withColumns({**ahead, **behind})
        .withColumns(
            {"deg": _bearing_between("", "next_"), "deg_before": _bearing_between("prev_", "")}
        )
        .withColumns(
            {
                "grp": g.heading_group(F.col("deg")),
                "grp_before": g.heading_group(F.col("deg_before")),
            }
        )
        .withColumn(
            "stretch",
            F.sum(starts.cast("int")).over(
                order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        )
    )


def _bearing_between(start: str, end: str) -> Column:
    return g.bearing(
        F.col(f"{start}x"), F.col(f"{start}y"), F.col(f"{end}x"), F.col(f"{end}y")
    )


class FlightPieces:
    """Stretches of a set of flights (``rows``) and what crosses their chunk borders (``chunks``).

    Both are checkpointed: they are small next to the fixes and every later step starts from them.
    With ``keep`` the ordered fixes are written, too, for steps that come back to them: reading them
    again spares shuffling and sorting them twice.
    """

    def __init__(
        self,
        track: DataFrame,
        srid: int | str = GEOGRAPHIC,
        chunk_rows: int = CHUNK_ROWS,
        keep: bool = False,
    ) -> None:
        self.points = _ordered_points(track, parse_srid(srid), chunk_rows)
        if keep:
            self.points = stored(self.points, "fixes")
        self.rows = cut(_local_stretches(self.points))
        self.chunks = cut(_chunk_borders(self.rows))


def _local_stretches(points: DataFrame) -> DataFrame:
    """One row per stretch of equal heading group; border stretches have no group yet."""
    step = g.distance(F.col("u"), F.col("v"), F.col("next_u"), F.col("next_v"))
    return (
        points.withColumn("step", step)
        .groupBy(*CHUNK, "stretch")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("seq").alias("first_seq"),
            F.max("seq").alias("last_seq"),
            F.max("grp").alias("grp"),
            *[F.min_by(c, "seq").alias(f"first_{c}") for c in ("x", "y", "u", "v")],
            *[F.max_by(c, "seq").alias(f"last_{c}") for c in ("u", "v")],
            *[F.min_by(f"prev_{c}", "seq").alias(f"prev_{c}") for c in ("x", "y")],
            *[F.max_by(f"next_{c}", "seq").alias(f"next_{c}") for c in ("u", "v")],
            F.sum("step").alias("steps"),
            F.max_by("step", "seq").alias("last_step"),
        )
    )


def _chunk_borders(rows: DataFrame) -> DataFrame:
    """One row per chunk: its border stretch resolved against the neighbouring chunks.

    The border stretch is the chunk's last fix. It heads for the first fix of the next chunk; the
    last fix of a flight repeats the heading of the fix before it.
    """
    corners = rows.groupBy(*CHUNK).agg(
        *[F.min_by(f"first_{c}", "stretch").alias(f"head_{c}") for c in ("x", "y", "u", "v")],
        *[F.max_by(f"first_{c}", "stretch").alias(f"tail_{c}") for c in ("x", "y", "u", "v")],
        *[F.max_by(f"prev_{c}", "stretch").alias(f"prev_{c}") for c in ("x", "y")],
        F.max("stretch").alias("border"),
        F.max("last_seq").alias("border_seq"),
    )
    chunks = Window.partitionBy("flight").orderBy("chunk")
    linked = corners.withColumns(
        {
            "has_next": F.lead("chunk").over(chunks).isNotNull(),
            **{f"far_{c}": F.lead(f"head_{c}").over(chunks) for c in ("x", "y", "u", "v")},
            **{
                f"near_{c}": F.coalesce(f"prev_{c}", F.lag(f"tail_{c}").over(chunks))
                for c in ("x", "y")
            },
        }
    )
    degrees = F.when(F.col("has_next"), _bearing_between("tail_", "far_")).otherwise(
        _bearing_between("near_", "tail_")
    )
    resolved = linked.withColumn("deg", degrees).withColumn(
        "border_grp", g.heading_group(F.col("deg"))
    )
    return resolved.select(
        *CHUNK,
        "border",
        "border_seq",
        "border_grp",
        F.lag("border_grp").over(chunks).alias("carried_grp"),
        "far_u",
        "far_v",
        g.distance(F.col("tail_u"), F.col("tail_v"), F.col("far_u"), F.col("far_v")).alias(
            "border_step"
        ),
    )


def heading_counts(pieces: FlightPieces) -> DataFrame:
    """Fixes per (flight, heading group) and where the group first occurs."""
    inner = pieces.rows.select("flight", "grp", "n", "first_seq")
    border = pieces.chunks.select(
        "flight",
        F.col("border_grp").alias("grp"),
        F.lit(1).cast("long").alias("n"),
        F.col("border_seq").alias("first_seq"),
    )
    return (
        inner.unionByName(border)
        .filter(F.col("grp").isNotNull())
        .groupBy("flight", "grp")
        .agg(F.sum("n").alias("n"), F.min("first_seq").alias("first_seq"))
    )


def top_heading_groups(pieces: FlightPieces, count: int = 2) -> DataFrame:
    """The commonest heading groups of each flight; ties go to the group seen first.

    A flight has at most 36 groups, so this window is small whatever the flight's size.
    """
    rank = Window.partitionBy("flight").orderBy(F.desc("n"), "first_seq")
    return (
        heading_counts(pieces)
        .withColumn("rank", F.row_number().over(rank))
        .filter(F.col("rank") <= count)
    )


def numbered_stretches(pieces: FlightPieces) -> DataFrame:
    """Production stretches with their run number.

    Runs start at 1; the number grows at each stretch outside the two groups that follows one
    inside, so opposite headings without a gap share a run and leading gaps count for nothing.
    """
    tops = (
        top_heading_groups(pieces)
        .groupBy("flight")
        .agg(
            F.max(F.when(F.col("rank") == 1, F.col("grp"))).alias("top1"),
            F.max(F.when(F.col("rank") == 2, F.col("grp"))).alias("top2"),
        )
    )
    order = Window.partitionBy(*CHUNK).orderBy("stretch")
    at_border = F.col("stretch") == F.col("border")

    def production(group: Column) -> Column:
        return F.when((group == F.col("top1")) | (group == F.col("top2")), group)

    def resolved(inner: str, outer: str) -> Column:
        return F.when(at_border, F.col(outer)).otherwise(F.col(inner))

    group = production(resolved("grp", "border_grp"))
    tagged = (
        pieces.rows.join(pieces.chunks.join(tops, "flight"), CHUNK)
        .select(
            *CHUNK,
            "stretch",
            "n",
            "first_seq",
            "last_seq",
            *[f"{end}_{c}" for end in ("first", "last") for c in ("u", "v")],
            *[resolved(f"next_{c}", f"far_{c}").alias(f"next_{c}") for c in ("u", "v")],
            (F.coalesce("steps", F.lit(0.0)) - F.coalesce("last_step", F.lit(0.0))).alias(
                "inner_len"
            ),
            resolved("last_step", "border_step").alias("last_step"),
            group.alias("fil"),
            production(F.col("carried_grp")).alias("carried"),
        )
        .withColumn(
            "before",
            F.when(F.row_number().over(order) == 1, F.col("carried")).otherwise(
                F.lag("fil").over(order)
            ),
        )
        .withColumn("gap", (F.col("fil").isNull() & F.col("before").isNotNull()).cast("long"))
        .withColumn(
            "gaps",
            F.sum("gap").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        )
        .drop("before", "carried")
    )
    offsets = running_offsets(
        tagged.groupBy(*CHUNK).agg(F.sum("gap").alias("_gaps")),
        ["flight"],
        "chunk",
        "_gaps",
        "_offset",
    ).drop("_gaps")
    return (
        tagged.filter(F.col("fil").isNotNull())
        .join(offsets, CHUNK)
        .withColumn("run", F.col("_offset") + F.col("gaps") + 1)
        .drop("_offset", "gaps", "gap")
    )


def all_runs(numbered: DataFrame) -> DataFrame:
    """One row per run: size, extent, axes present, length in the target system's units."""
    inside = F.col("inner_len") + F.coalesce("last_step", F.lit(0.0))
    return (
        numbered.groupBy("flight", "run")
        .agg(
            F.min("chunk").alias("chunk"),
            F.sum("n").alias("n"),
            F.min("first_seq").alias("first_seq"),
            F.max("last_seq").alias("last_seq"),
            F.bool_or(F.col("fil").isin(*g.EAST_WEST_GROUPS)).alias("on_ew"),
            F.bool_or(F.col("fil").isin(*g.NORTH_SOUTH_GROUPS)).alias("on_ns"),
            F.sum(inside).alias("with_exit"),
            F.coalesce(F.max_by("last_step", "last_seq"), F.lit(0.0)).alias("exit_step"),
            *[F.min_by(f"first_{c}", "first_seq").alias(f"start_{c}") for c in ("u", "v")],
            *[F.max_by(f"last_{c}", "last_seq").alias(f"end_{c}") for c in ("u", "v")],
        )
        .withColumn("length", F.col("with_exit") - F.col("exit_step"))
        .drop("with_exit", "exit_step")
    )


def _per_chunk(flights: DataFrame, pieces: FlightPieces) -> DataFrame:
    """Spread a per-flight table over the chunks, so that rows join it without a hot flight key."""
    return pieces.chunks.select(*CHUNK).join(flights, "flight")


def _flight_rules(runs: DataFrame) -> DataFrame:
    """Per flight: the smallest run size kept and the direction of the runs kept.

    Runs are first counted by size; a flight has few distinct run sizes.
    """
    flight = Window.partitionBy("flight")
    return (
        runs.groupBy("flight", "n")
        .agg(F.bool_or("on_ew").alias("on_ew"), F.bool_or("on_ns").alias("on_ns"))
        .withColumn("largest", F.max("n").over(flight))
        .withColumn("keep_from", F.col("largest") - F.floor(F.col("largest") / 3))
        .filter((F.col("n") >= F.col("keep_from")) & (F.col("n") >= 2))
        .groupBy("flight")
        .agg(
            F.max("keep_from").alias("keep_from"),
            g.direction_label(F.bool_or("on_ew"), F.bool_or("on_ns")).alias("direction"),
        )
    )


def long_runs(runs: DataFrame, pieces: FlightPieces) -> DataFrame:
    """Runs of at least ``largest - floor(largest / 3)`` fixes, with the flight's direction.

    Only a flight whose largest run is a single fix keeps single fixes by that rule; those make
    no line and are left to ``rejected_flights``.
    """
    return (
        runs.drop("on_ew", "on_ns")
        .join(_per_chunk(_flight_rules(runs), pieces), CHUNK)
        .filter((F.col("n") >= F.col("keep_from")) & (F.col("n") >= 2))
        .drop("keep_from")
    )


def production_runs(pieces: FlightPieces) -> DataFrame:
    """The production runs of every flight with their line number ``id`` (dense, in run order)."""
    kept = long_runs(cut(all_runs(numbered_stretches(pieces))), pieces)
    return number_rows(kept, ["flight"], "chunk", ["run"], "id")


def production_lines(
    track: DataFrame, srid: int | str = GEOGRAPHIC, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """One row per production line: direction, length in km, vertex count, end vertices.

    Lengths are planar in the target system; with EPSG:4326 the "km" are thousandths of a degree.
    """
    return production_runs(FlightPieces(track, srid, chunk_rows)).select(
        "flight",
        F.col("id").cast("int").alias("id"),
        "direction",
        (F.col("length") / 1000).alias("long_km"),
        "n",
        "first_seq",
        "last_seq",
        F.col("start_u").alias("start_x"),
        F.col("start_v").alias("start_y"),
        F.col("end_u").alias("end_x"),
        F.col("end_v").alias("end_y"),
    )


def production_vertices(
    track: DataFrame, srid: int | str = GEOGRAPHIC, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """The vertices of the production lines, one row each, ``seq`` giving their order.

    ``row_id`` numbers the lines of all flights by (flight, id), and the coordinates are marked with
    their reference system. ``next_x``/``next_y`` are the
    following vertex of the same line (NULL at its end), so each row but the last of a line is also
    a segment.
    """
    pieces = FlightPieces(track, srid, chunk_rows, keep=True)
    numbered = cut(numbered_stretches(pieces))
    runs = long_runs(cut(all_runs(numbered)), pieces)
    kept = number_globally(
        number_rows(runs, ["flight"], "chunk", ["run"], "id"), ["flight", "run"], "row_id"
    ).select(
        "flight",
        "run",
        "row_id",
        F.col("id").cast("int").alias("id"),
        "direction",
        F.col("last_seq").alias("line_end"),
    )
    lines = numbered.join(kept, ["flight", "run"]).select(
        *CHUNK,
        "stretch",
        "row_id",
        "id",
        "direction",
        "line_end",
        "last_seq",
        *[F.col(f"next_{c}").alias(f"after_{c}") for c in ("u", "v")],
    )
    points = pieces.points.select(*CHUNK, "seq", "stretch", "u", "v", "next_u", "next_v")
    at = points.join(lines, [*CHUNK, "stretch"])
    ahead = F.col("seq") < F.col("line_end")
    crossing = F.col("seq") == F.col("last_seq")
    vertices = at.select(
        "row_id",
        "flight",
        "id",
        "direction",
        "seq",
        F.col("u").alias("x"),
        F.col("v").alias("y"),
        *[
            F.when(
                ahead,
                F.when(crossing, F.col(f"after_{c}")).otherwise(F.col(f"next_{c}")),
            ).alias(f"next_{name}")
            for c, name in (("u", "x"), ("v", "y"))
        ],
    )
    return marked(vertices, srid, "x", "y", "next_x", "next_y")


def rejected_flights(track: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Flights without any line and the reason: no production run, or single-fix runs only."""
    runs = all_runs(numbered_stretches(FlightPieces(track, GEOGRAPHIC, chunk_rows)))
    largest = runs.groupBy("flight").agg(F.max("n").alias("largest"))
    return (
        track.select("flight")
        .distinct()
        .join(largest, "flight", "left")
        .filter(F.coalesce("largest", F.lit(0)) < 2)
        .select(
            "flight",
            F.when(F.col("largest") == 1, F.lit("single_point_run"))
            .otherwise(F.lit("no_production_run"))
            .alias("reason"),
        )
    )


def flight_report(lines: DataFrame) -> DataFrame:
    """Kilometres per flight and the grand total (``flight`` NULL, ``is_total`` true)."""
    return (
        lines.rollup("flight")
        .agg(
            F.sum("long_km").alias("total_km"),
            F.max("direction").alias("direction"),
            F.grouping("flight").cast("boolean").alias("is_total"),
        )
        .withColumn("direction", F.when(~F.col("is_total"), F.col("direction")))
    )


def dominant_direction_points(
    track: DataFrame,
    srid: int | str = GEOGRAPHIC,
    chunk_rows: int = CHUNK_ROWS,
    north_south: str = "N-S",
    east_west: str = "E-W",
) -> DataFrame:
    """Fixes whose axis label is the commonest one of their flight.

    The label of a fix is the axis of its heading group when that is one of the flight's two
    commonest groups. Ties go to the label seen first; flights without labels give no rows.
    """
    pieces = FlightPieces(track, srid, chunk_rows, keep=True)
    label = g.axis_label(F.col("fil"), north_south, east_west)
    labelled = (
        cut(numbered_stretches(pieces))
        .withColumn("label", label)
        .filter(F.col("label").isNotNull())
    )
    rank = Window.partitionBy("flight").orderBy(F.desc("n"), "first_seq")
    winners = (
        labelled.groupBy("flight", "label")
        .agg(F.sum("n").alias("n"), F.min("first_seq").alias("first_seq"))
        .withColumn("rank", F.row_number().over(rank))
        .filter(F.col("rank") == 1)
        .select("flight", F.col("label").alias("winner"))
    )
    kept = labelled.join(_per_chunk(winners, pieces), CHUNK).filter(
        F.col("label") == F.col("winner")
    )
    marks = kept.select(*CHUNK, "stretch", "fil", "run", "label")
    points = pieces.points.select(*CHUNK, "seq", "stretch", "u", "v")
    return points.join(marks, [*CHUNK, "stretch"]).select(
        "flight", "seq", F.col("u").alias("x"), F.col("v").alias("y"), "fil", "run", "label"
    )


def route_points(
    track: DataFrame, srid: int | str = GEOGRAPHIC
) -> DataFrame:
    """Every fix as a point: attributes x, y, z as read plus the reprojected geometry."""
    srid = parse_srid(srid)
    if srid == GEOGRAPHIC:
        placed = track.withColumns({"_u": F.col("x"), "_v": F.col("y")})
    else:
        placed = reproject_columns(track, GEOGRAPHIC, srid, "x", "y", "_u", "_v")
    return placed.select(
        "flight",
        "seq",
        "x",
        "y",
        "z",
        g.point(F.col("_u"), F.col("_v")).alias("geometry"),
        F.lit(srid).alias("srid"),
    )
