"""Survey-shaped inputs derived by formula from the driver's tables (see FIXTURES.md, section 3).

Every derivation covers the whole table, and row numbers come from ``number_rows``, so the inputs
scale with the tables like the operators do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytrace.functions import geometry as g
from skytrace.operators.sequence import CHUNK_ROWS, chunk_of, number_rows

PASS_FIXES = 50
PASS_LENGTH = 56


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def short_flights() -> Column:
    """Flight numbers by which one event in a few hundred belongs to a flight of one to three."""
    block = _div(F.col("event_id"), 500)
    few = F.col("event_id") % 500 <= block % 3
    return F.when(few, 1_000_000 + block).otherwise(F.col("user_id") % 8)


def track(
    spark: SparkSession, sf_dir: str, number: Column | None = None, oblique: bool = False
) -> DataFrame:
    """Back-and-forth flights over ``events``: passes of 50 fixes, then turns of six.

    Flights are numbered by ``number``, eight by default. With ``oblique`` every fourth flight
    runs from south-west to north-east and back.
    """
    events = table(spark, sf_dir, "events").select(
        (F.col("user_id") % 8 if number is None else number).cast("string").alias("flight"),
        "event_id",
        "event_type",
        (F.col("value") - F.floor("value")).alias("u"),
        chunk_of(F.col("event_id"), CHUNK_ROWS).alias("part"),
    )
    n = F.col("seq")
    k, j = F.col("k"), F.col("j")
    forward = k % 2 == 0
    along = (
        F.when(j < PASS_FIXES, F.when(forward, j).otherwise(PASS_FIXES - 1 - j))
        .otherwise(F.when(forward, PASS_FIXES - 1).otherwise(0))
        .cast("double")
        * 1e-4
    )
    turned = F.when(j < PASS_FIXES, F.lit(0)).otherwise(j - (PASS_FIXES - 1)).cast("double") / 7.0
    across = (k.cast("double") + turned) * 1e-3 + F.col("u") * 2e-6
    east_west = F.col("flight").cast("int") % 2 == 0
    x = F.when(east_west, F.col("along")).otherwise(F.col("across"))
    y = F.when(east_west, F.col("across")).otherwise(F.col("along"))
    if oblique:
        slanted = F.col("flight").cast("int") % 4 == 3
        x = F.when(slanted, F.col("along") + F.col("across")).otherwise(x)
        y = F.when(slanted, F.col("along") - F.col("across")).otherwise(y)
    return (
        number_rows(events, ["flight"], "part", ["event_id"], "seq", start=0)
        .withColumns({"k": _div(n, PASS_LENGTH), "j": n % PASS_LENGTH})
        .withColumns({"along": along, "across": across})
        .select(
            "flight",
            "seq",
            (x - 99.0).alias("x"),
            (y + 19.0).alias("y"),
            F.when((F.col("event_type") == "error") & (n % 11 == 0), F.lit(-1.0))
            .otherwise(2200.0 + F.col("u"))
            .alias("z"),
        )
    )


def line_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One three-vertex line per part: ``id, direction, coords``."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("long").alias("row_id"),
        _div(F.col("p_partkey"), 4).alias("r"),
        (F.col("p_partkey") % 4).alias("sg"),
        F.when(F.col("p_size") % 2 == 0, 0).otherwise(10).alias("gap"),
    )
    r, sg = F.col("r"), F.col("sg")
    spur = (r % 10 == 3) & (sg >= 2)

    def vertex(regular_a: Column, regular_b: Column, spur_b: Column) -> Column:
        a = F.when(spur, 20 + 15 * sg).otherwise(regular_a).cast("double")
        b = F.when(spur, spur_b).otherwise(regular_b).cast("double")
        return F.struct(
            F.when(r % 2 == 0, a).otherwise(b).alias("x"),
            F.when(r % 2 == 0, b).otherwise(a).alias("y"),
        )

    vertices = F.array(
        vertex(100 * sg + F.col("gap"), 50 * r, 50 * r + 5),
        vertex(100 * sg + 48, 50 * r + 1, 50 * r + 15),
        vertex(100 * sg + 96, 50 * r, 50 * r + 25),
    )
    return part.select(
        F.col("row_id").alias("id"),
        F.when(r % 2 == 0, g.EAST_WEST).otherwise(g.NORTH_SOUTH).alias("direction"),
        vertices.alias("coords"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vertices of the line layer: ``row_id, direction, vertex_no, x, y``."""
    return (
        line_layer(spark, sf_dir)
        .select(F.col("id").alias("row_id"), "direction", F.posexplode("coords").alias("pos", "v"))
        .select(
            "row_id",
            "direction",
            F.col("pos").cast("long").alias("vertex_no"),
            F.col("v.x").alias("x"),
            F.col("v.y").alias("y"),
        )
    )


def overlapping_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices ``row_id, direction, vertex_no, x, y, grp`` of lines that lie on each other in part.

    Parts share forty carriers of four slopes, on which their lines begin at many places.
    """
    k = F.col("p_partkey").cast("long")
    carrier, t = F.col("carrier"), F.col("t").cast("double")
    far = (1000 * carrier).cast("double")
    slope = carrier % 4
    x = F.when(slope == 0, t).when(slope == 1, far).when(slope == 2, 2 * t).otherwise(-t)
    y = F.when(slope == 0, far).when(slope == 1, t).otherwise(F.when(slope == 2, t).otherwise(3 * t) + far)
    return (
        table(spark, sf_dir, "part")
        .select(
            k.alias("row_id"),
            (k % 40).alias("carrier"),
            (k * 7 % 97 + 150 * _div(k, 1500)).alias("start"),
            (3 + k % 11).alias("length"),
        )
        .withColumn("vertex_no", F.explode(F.array(*[F.lit(i).cast("long") for i in range(3)])))
        .withColumn("t", F.col("start") + F.col("length") * F.col("vertex_no"))
        .select(
            "row_id",
            F.when(carrier % 2 == 0, g.EAST_WEST).otherwise(g.NORTH_SOUTH).alias("direction"),
            "vertex_no",
            x.alias("x"),
            y.alias("y"),
            (carrier % 10).alias("grp"),
        )
    )


def mixed_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, parts`` per part: no shape, a point, a line, a line of two parts, and one with a loose vertex."""
    part = table(spark, sf_dir, "part")
    k = F.col("p_partkey").cast("long")

    def at(dx: int, dy: int) -> Column:
        return g.point(k + dx, F.col("p_size") + dy)

    line, other = F.array(at(0, 0), at(3, 4)), F.array(at(10, 0), at(10, 5), at(16, 13))
    shapes = [F.lit(None), F.array(F.array(at(0, 0))), F.array(line), F.array(line, other)]
    shapes.append(F.array(F.array(at(0, 0)), other))
    parts = F.when(k % 6 == 5, F.array(F.array(at(0, 0)), F.array(at(1, 1))))
    for i, shape in enumerate(shapes):
        parts = parts.when(k % 6 == i, shape)
    return part.select(k.alias("id"), parts.alias("parts"))


def polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A concave L per nation: ``poly_id, rings``."""
    nation = table(spark, sf_dir, "nation")
    n = F.col("n_nationkey")
    east, north = (200 * (n % 5)).cast("double"), (200 * _div(n, 5)).cast("double")
    corners = [(0, 0), (150, 0), (150, 60), (60, 60), (60, 150), (0, 150), (0, 0)]
    ring = F.array(*[g.point(east + x, north + y) for x, y in corners])
    return nation.select(n.cast("long").alias("poly_id"), F.array(ring).alias("rings"))


def cloud(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point per lineitem: its four keys, ``x, y, z``."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        (F.col("l_partkey") % 1000 + 0.5).alias("x"),
        (F.col("l_suppkey") * 10 + F.col("l_linenumber") + 0.5).alias("y"),
        F.col("l_quantity").alias("z"),
    )


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A selection rectangle per region, corners in the order they were dragged (unsorted)."""
    r = F.col("r_regionkey")
    return table(spark, sf_dir, "region").select(
        (100 * r + 120).cast("double").alias("x_from"),
        (100 * r).cast("double").alias("x_to"),
        (400 * r).cast("double").alias("y_from"),
        (400 * r + 350).cast("double").alias("y_to"),
    )


def ordered_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed rings of thirty vertices: ``project_id, pos, x, y``; some cross themselves."""
    k = F.col("c_custkey") - 1
    pos = (k % 30).cast("long")
    return table(spark, sf_dir, "customer").select(
        _div(k, 30).alias("project_id"),
        F.explode(F.when(pos == 0, F.array(pos, pos + 30)).otherwise(F.array(pos))).alias("pos"),
        ((k * 7 + F.col("c_nationkey")) % 25).cast("double").alias("x"),
        ((k * 11 + F.col("c_nationkey") * 3) % 13).cast("double").alias("y"),
    )


def photo_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five camera logs over ``orders``: ``file, line_no, value``; some lines are too short."""
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") % 5).cast("string").alias("file"),
        "o_orderkey",
        chunk_of(key, CHUNK_ROWS).alias("part"),
        F.when(key % 13 == 0, F.lit("IMG"))
        .otherwise(F.concat(F.lit("IMG"), key.cast("string"), F.lit(" "), F.col("o_orderpriority")))
        .alias("value"),
    )
    return number_rows(rows, ["file"], "part", ["o_orderkey"], "line_no").select(
        "file", "line_no", "value"
    )
