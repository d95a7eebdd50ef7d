"""Writers: layers as Parquet, reports and KML as ordered text."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skytrace.functions.text import file_stem
from skytrace.operators.sequence import number_rows


def write_layer(df: DataFrame, path: str, by: str | None = None) -> None:
    """One Parquet layer, in a folder per value of ``by`` (a flight, say) when given.

    Flights are told apart by their full path, so files of equal name do not overwrite each other.
    Rows are dealt out by ``by`` first, and large values over several tasks, by their size; so a small
    flight is one file and a large one has as many as its size asks for
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), however many tasks there are.
    """
    if by:
        df.hint("rebalance", by).write.mode("overwrite").partitionBy(by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def write_text(rows: DataFrame, path: str, append: bool = False) -> None:
    """Write ``value`` in the order of all other columns; the part files follow that order.

    With ``append`` each report goes to a folder ``run=<time>`` of its own, so that the runs of a
    report stay apart and in order; ``read_text`` joins them.
    """
    order = [c for c in rows.columns if c != "value"]
    ordered = rows.orderBy(*order).select("value")
    if append:
        path = f"{path}/run={time.time_ns():020d}"
    ordered.write.mode("errorifexists" if append else "overwrite").text(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """``run, line_no, value`` of a written report; ``run`` counts appended reports from 1 on."""
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            "value",
        )
        .withColumn("folder", F.regexp_extract("file", "/run=([0-9]+)/", 1))
    )
    runs = lines.select("folder").distinct()  # as many as reports were appended
    runs = runs.withColumn("run", F.row_number().over(Window.orderBy("folder")))
    part = F.struct("file", "block")
    placed = lines.withColumns({"part": part, "place": F.monotonically_increasing_id()})
    return (
        number_rows(placed, ["folder"], "part", ["place"], "line_no")
        .join(runs, "folder")
        .select("run", "line_no", "value")
    )


def write_camera_logs(renumbered: DataFrame, path: str) -> None:
    """A folder per camera log, named after the log with ``__`` appended, lines in order.

    Logs of equal name from different folders are told apart by ``source``, the folder they are in.
    """
    folder = F.regexp_replace("file", "/?[^/]*$", "")
    (
        renumbered.withColumns(
            {"source": folder, "output": F.concat(file_stem(F.col("file")), F.lit("__.txt"))}
        )
        .repartitionByRange("source", "output", "photo_no")
        .sortWithinPartitions("source", "output", "photo_no")
        .select("source", "output", "value")
        .write.mode("overwrite")
        .partitionBy("source", "output")
        .text(path)
    )
