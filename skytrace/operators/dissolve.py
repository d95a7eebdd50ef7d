"""Union of segments that lie on each other.

Segments overlap only on one carrier line, so the union is one of intervals on each carrier. A carrier
is known by exact whole numbers: its direction in lowest terms and its offset, both computed from the
binary values of the coordinates. Two segments have equal carriers if and only if they are collinear,
in whatever unit. On a carrier, vertices in the order of (x, y) lie in the order of the line.
"""

from __future__ import annotations

from math import gcd, isfinite

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytrace.operators.lineage import sized as cut

#: Segments on one carrier that may be swept by one task; more are swept in ranges.
CARRIER_ROWS = 1 << 20


def _carrier(*ends: float | None) -> str:
    """Name of the line through two points; a single point has none but its own."""
    if not all(v is not None and isfinite(v) for v in ends):
        return "unknown"
    ratios = [v.as_integer_ratio() for v in ends]
    unit = max(d for _, d in ratios)  # powers of two
    x1, y1, x2, y2 = (n * (unit // d) for n, d in ratios)
    a, b = x2 - x1, y2 - y1
    shared = gcd(a, b)
    if not shared:
        return "point"
    if a < 0 or (a == 0 and b < 0):
        shared = -shared
    a, b = a // shared, b // shared
    offset = a * y1 - b * x1
    shared = gcd(offset, unit)
    return f"{a} {b} {offset // shared}/{unit // shared}"


def _small_carriers(ends: np.ndarray, unit: np.ndarray) -> pa.Array:
    """Names as by ``_carrier``, for rows of ends that are whole numbers of less than 2 ** 30 / unit."""
    x1, y1, x2, y2 = (ends * unit).astype(np.int64)
    unit = unit.astype(np.int64)
    a, b = x2 - x1, y2 - y1
    shared = np.gcd(a, b)
    point = shared == 0
    shared[point] = 1
    shared = np.where((a < 0) | ((a == 0) & (b < 0)), -shared, shared)
    a, b = a // shared, b // shared
    offset = a * y1 - b * x1
    shared = np.gcd(offset, unit)
    a, b, offset, unit = (pa.array(v).cast(pa.string()) for v in (a, b, offset // shared, unit // shared))
    names = pc.binary_join_element_wise(
        pc.binary_join_element_wise(a, b, offset, " "), unit, "/"
    )
    return pc.if_else(pa.array(point), "point", names)


def _carriers(ends: np.ndarray) -> pa.Array:
    """Names of the lines through the points of four rows of coordinates; NaN where one is missing.

    Multiples of 2 ** -16 below 2 ** 14, and whole numbers below 2 ** 30 with all between, are computed in
    64-bit integers by the column, the rest in Python's integers row by row.
    """
    names = np.full(ends.shape[1], None, object)
    left = np.isfinite(ends).all(0)
    names[~left] = "unknown"
    with np.errstate(invalid="ignore", over="ignore"):
        for bits in range(0, 17, 4):
            scaled = ends * 2.0**bits
            small = left & (np.abs(scaled) < 2.0**30).all(0) & (scaled == np.floor(scaled)).all(0)
            if small.any():
                own = ends[:, small]
                names[small] = _small_carriers(own, np.full(own.shape[1], 2.0**bits)).to_numpy(False)
                left &= ~small
    names[left] = [_carrier(*row) for row in ends[:, left].T.tolist()]
    return pa.array(names, pa.string())


def carrier():
    """A column function: the line that a segment (x1, y1, x2, y2) lies on, as text.

    It is equal for collinear segments and for no others.
    """

    @F.arrow_udf(T.StringType())
    def run(x1: pa.Array, y1: pa.Array, x2: pa.Array, y2: pa.Array) -> pa.Array:
        ends = [np.asarray(c.cast(pa.float64()).fill_null(np.nan), np.float64) for c in (x1, y1, x2, y2)]
        return _carriers(np.stack(ends))

    return run


def _swept(rows: DataFrame, part: list[str]) -> DataFrame:
    """Add ``top``, how far the rows before in the same part reach, in the order of ``a``."""
    earlier = Window.partitionBy(*part).orderBy("a").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("top", F.max("b").over(earlier))


def _pieces(rows: DataFrame, part: list[str]) -> DataFrame:
    """Add ``no``, the number of pieces that have begun; touching rows do not make one piece."""
    so_far = Window.partitionBy(*part).orderBy("a").rowsBetween(Window.unboundedPreceding, 0)
    opens = F.col("top").isNull() | (F.col("a") >= F.col("top"))
    return rows.withColumn("no", F.sum(opens.cast("long")).over(so_far))


def _in_ranges(rows: DataFrame, key: list[str]) -> DataFrame:
    """Pieces of carriers that hold very many segments; a range knows how far earlier ones reach."""
    ranged = cut(
        rows.repartitionByRange(*key, "a").withColumn("range", F.spark_partition_id())
    )
    part = [*key, "range"]
    order = Window.partitionBy(*key).orderBy("range")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    reach = ranged.groupBy(*part).agg(F.max("b").alias("reach"))
    border = reach.select(
        *part,
        F.max("reach").over(earlier).alias("before"),
        F.lead("range").over(order).isNotNull().alias("goes_on"),
    )
    swept = _swept(ranged, part).join(border, part).withColumn("top", F.greatest("top", "before"))
    fragments = cut(
        _pieces(swept, part)
        .groupBy(*part, "no", "goes_on")
        .agg(F.min("a").alias("a"), F.max("b").alias("b"))
        .withColumn("last", F.max("no").over(Window.partitionBy(*part)))
    )
    # What a range goes on with, and what it ends with, belong together; two rows a range at most.
    loose = (F.col("no") == 0) | ((F.col("no") == F.col("last")) & F.col("goes_on"))
    chain = Window.partitionBy(*key).orderBy("range", "no").rowsBetween(Window.unboundedPreceding, 0)
    joined = (
        fragments.filter(loose)
        .withColumn("piece", F.sum((F.col("no") > 0).cast("long")).over(chain))
        .groupBy(*key, "piece")
        .agg(F.min("a").alias("a"), F.max("b").alias("b"))
    )
    return fragments.filter(~loose).select(*key, "a", "b").unionByName(joined.select(*key, "a", "b"))


def union_on_carriers(
    segments: DataFrame, key: list[str], carrier_rows: int = CARRIER_ROWS
) -> DataFrame:
    """``*key, ax, ay, bx, by``: what the segments ``ax, ay, bx, by`` of each key cover, once.

    Overlapping collinear segments become one; those that touch in a vertex, or cross, stay apart.
    Of every segment a is the lesser end by (x, y). Segments of no length are kept once.
    """
    ends = [F.struct(F.col(f"{e}x").alias("x"), F.col(f"{e}y").alias("y")).alias(e) for e in "ab"]
    key = [*key, "carrier"]
    rows = cut(
        segments.withColumn("carrier", carrier()("ax", "ay", "bx", "by"))
        .select(*key, *ends)
        .groupBy(*key, "a")
        .agg(F.max("b").alias("b"))
    )
    heavy = rows.groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") > carrier_rows)
    if heavy.isEmpty():
        pieces = _in_tasks(rows, key)
    else:  # one row for carrier_rows segments or more
        heavy = F.broadcast(cut(heavy.drop("n")))
        pieces = _in_tasks(rows.join(heavy, key, "left_anti"), key).unionByName(
            _in_ranges(rows.join(heavy, key, "left_semi"), key)
        )
    return pieces.select(*key[:-1], "a.*", "b").select(
        *key[:-1],
        F.col("x").alias("ax"),
        F.col("y").alias("ay"),
        F.col("b.x").alias("bx"),
        F.col("b.y").alias("by"),
    )


def _in_tasks(rows: DataFrame, key: list[str]) -> DataFrame:
    return (
        _pieces(_swept(rows, key), key)
        .groupBy(*key, "no")
        .agg(F.min("a").alias("a"), F.max("b").alias("b"))
        .drop("no")
    )
