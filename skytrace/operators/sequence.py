"""Ordered computations over sequences of any length.

One flight, file or layer may hold most of the data, so no window here runs over a whole sequence.
A sequence is cut into chunks of bounded size. Rows are windowed inside ``(key, chunk)``; what has
to cross a chunk border travels through a table with one row per chunk, and only that table is
windowed over the whole key. A million-row chunk turns 10^12 rows into 10^6 chunk rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytrace.operators.lineage import cut

CHUNK_ROWS = 1 << 20


def chunk_of(position: Column, chunk_rows: int) -> Column:
    """Chunk number of a non-negative integer position."""
    return F.call_function("div", position, F.lit(chunk_rows).cast("long"))


def running_offsets(
    counts: DataFrame, keys: list[str], chunk: str, count: str, name: str
) -> DataFrame:
    """Add ``name``: the sum of ``count`` over the earlier chunks of the same key."""
    earlier = (
        Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    )
    return counts.withColumn(name, F.coalesce(F.sum(count).over(earlier), F.lit(0).cast("long")))


def number_rows(
    df: DataFrame, keys: list[str], chunk: str, order: list[str], name: str, start: int = 1
) -> DataFrame:
    """Dense numbers in the order (chunk, *order) within each key.

    ``chunk`` is a column of ``df`` that grows with the order and bounds the rows per window.
    """
    counts = df.groupBy(*keys, chunk).agg(F.count(F.lit(1)).alias("_n"))
    offsets = running_offsets(counts, keys, chunk, "_n", "_offset").drop("_n")
    window = Window.partitionBy(*keys, chunk).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(window).cast("long"))
        .join(offsets, [*keys, chunk])
        .withColumn(name, F.col("_offset") + F.col("_rank") + F.lit(start - 1))
        .drop("_offset", "_rank")
    )


def drop_first_seen_duplicates(
    df: DataFrame, values: list[str], order: str
) -> DataFrame:
    """Distinct ``values`` with the smallest ``order`` at which each occurs."""
    return df.groupBy(*values).agg(F.min(order).alias(order))


def number_globally(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Dense numbers 1, 2, ... over the whole of ``df`` in the given (total) order.

    Rows are range partitioned, numbered inside their range, and shifted by the sizes of the
    ranges before. The ranges are checkpointed, because sampling them again could move them.
    """
    ranged = cut(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    return number_rows(ranged, [], "_range", order, name).drop("_range")


def with_next_vertex(
    vertices: DataFrame, line: str = "row_id", chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Add ``next_x``/``next_y`` to lines whose ``vertex_no`` counts 0, 1, 2, ... per line.

    The first vertex of each chunk is also sent to the chunk before it, so one shuffle is enough
    and no line has to fit in a task.
    """
    home = chunk_of(F.col("vertex_no"), chunk_rows)
    opens_chunk = (F.col("vertex_no") > 0) & (F.col("vertex_no") % chunk_rows == 0)
    homes = F.when(opens_chunk, F.array(home, home - 1)).otherwise(F.array(home))
    order = Window.partitionBy(line, "_chunk").orderBy("vertex_no")
    return (
        vertices.withColumn("_chunk", F.explode(homes))
        .withColumns({f"next_{c}": F.lead(c).over(order) for c in ("x", "y")})
        .filter(F.col("_chunk") == home)
        .drop("_chunk")
    )
