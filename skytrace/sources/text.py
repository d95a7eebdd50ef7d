"""Text inputs whose line order carries meaning."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skytrace.functions.geometry import nan_to_null
from skytrace.operators.sequence import running_offsets

MIN_COLUMNS = 5
CAMERA_PREFIX = "Camara_v"
CAMERA_OUTPUT = r"__\.txt$"


def _scanned(
    spark: SparkSession, folder: str, prefix: str, recursive: bool, skip_blank: bool
) -> DataFrame:
    """``file, block, value, place``: lines with the start of their split and their order in it."""
    lines = (
        spark.read.option("pathGlobFilter", f"{prefix}*.txt")
        .option("recursiveFileLookup", str(recursive).lower())
        .text(folder)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            "value",
        )
    )
    if skip_blank:
        lines = lines.filter(F.col("value").rlike(r"\S"))
    return lines.withColumn("place", F.monotonically_increasing_id())


def _numbered(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """Add ``line_no`` from 1 on, given ``n``, the lines of each (file, block).

    Nothing is stored: ``blocks`` comes from another scan of the same files. Should that one have
    split a file elsewhere, a block without a count is an error, and all others are right.
    """
    before = running_offsets(blocks, ["file"], "block", "n", "before").drop("n")
    rank = F.row_number().over(Window.partitionBy("file", "block").orderBy("place"))
    known = F.when(F.col("before").isNull(), F.raise_error(F.lit("a file was split anew")))
    return (
        lines.withColumn("rank", rank.cast("long"))
        .join(before, ["file", "block"], "left")
        .withColumn("line_no", known.otherwise(F.col("before") + F.col("rank")).cast("long"))
        .drop("before", "rank", "place", "block")
    )


def numbered_lines(
    spark: SparkSession,
    folder: str,
    prefix: str = "",
    recursive: bool = False,
    skip_blank: bool = False,
) -> DataFrame:
    """``file, line_no, value`` of the ``<prefix>*.txt`` files of a folder, lines from 1 on.

    Files are read in splits. Lines keep their order inside a split, and splits are ordered by
    their offset in the file, so numbering needs the line counts of the earlier splits only.
    """
    lines = _scanned(spark, folder, prefix, recursive, skip_blank)
    blocks = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    return _numbered(lines, blocks).select("file", "line_no", "value")


@dataclass(frozen=True)
class TrackScan:
    """Fixes of the readable files, and the files left out with the reason."""

    track: DataFrame
    rejects: DataFrame


def read_tracks(
    spark: SparkSession,
    folder: str,
    prefix: str = "",
    recursive: bool = True,
    columns: tuple[int, int, int] = (2, 3, 4),
    skip_rows: int = 0,
) -> TrackScan:
    """GNSS text files, whitespace separated and without header, as ``flight, seq, x, y, z``.

    ``columns`` are the positions of X, Y and Z from 0 on; text that is no number becomes NULL.
    ``skip_rows`` drops that many leading non-blank rows of every file. A file is left out when
    its first row has fewer than five columns or a later row has more than the first.

    One row for each split says how many rows it has, how wide its first and its widest are; that
    numbers the rows and finds the files to leave out, without storing what was read.
    """
    rows = (
        _scanned(spark, folder, prefix, recursive, skip_blank=True)
        .withColumn("cells", F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " "))
        .withColumn("width", F.size("cells"))
    )
    blocks = rows.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by("width", "place").alias("first"),
        F.max("width").alias("widest"),
    )
    widths = blocks.groupBy(F.col("file").alias("flight")).agg(
        F.min_by("first", "block").alias("first"), F.max("widest").alias("widest")
    )
    reason = F.when(F.col("first") < MIN_COLUMNS, F.lit("too_few_columns")).when(
        F.col("widest") > F.col("first"), F.lit("row_longer_than_first")
    )
    rejects = widths.select("flight", reason.alias("reason")).filter("reason IS NOT NULL")
    cells = rows.select(
        "file",
        "block",
        "place",
        *[
            nan_to_null(F.get("cells", F.lit(at)).try_cast("double")).alias(name)
            for name, at in zip("xyz", columns, strict=True)
        ],
    )
    track = (
        _numbered(cells, blocks.select("file", "block", "n"))
        .select(F.col("file").alias("flight"), (F.col("line_no") - 1).alias("seq"), "x", "y", "z")
        .filter(F.col("seq") >= skip_rows)
        .join(rejects.select("flight"), "flight", "left_anti")
    )
    return TrackScan(track, rejects)


def read_camera_logs(
    spark: SparkSession, folder: str, prefix: str = CAMERA_PREFIX, recursive: bool = False
) -> DataFrame:
    """``file, line_no, value`` of the camera logs of a folder, earlier outputs left out."""
    lines = numbered_lines(spark, folder, prefix, recursive)
    return lines.filter(~F.col("file").rlike(CAMERA_OUTPUT))
