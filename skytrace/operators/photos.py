"""Renumbering photos in camera logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytrace.functions.text import renamed_photo_line

HEADER_LINES = 6


def renumber_photos(log: DataFrame, header_lines: int = HEADER_LINES) -> DataFrame:
    """Drop the header of each log ``file, line_no, value`` and number the photos of the rest.

    Every line after the header uses up a number; lines too short to hold a photo name stay as
    they are.
    """
    number = F.col("line_no") - header_lines
    return log.filter(F.col("line_no") > header_lines).select(
        "file", number.alias("photo_no"), renamed_photo_line(F.col("value"), number).alias("value")
    )
