"""Text helpers: counters, fixed decimals, file names, XML escaping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PHOTO_PREFIX_LENGTH = 8


def zero_padded(number: Column, width: int = 5) -> Column:
    """Zero-padded counter; numbers that need more digits keep all of them."""
    return F.format_string(f"%0{width}d", number)


def photo_name(number: Column) -> Column:
    return F.concat(F.lit("DSC"), zero_padded(number), F.lit(".JPG"))


def renamed_photo_line(line: Column, number: Column) -> Column:
    """The line with its first eight characters replaced by the numbered photo name.

    Lines below eight characters stay as they are.
    """
    renamed = F.concat(photo_name(number), F.substr(line, F.lit(PHOTO_PREFIX_LENGTH + 1)))
    return F.when(F.length(line) >= PHOTO_PREFIX_LENGTH, renamed).otherwise(line)


def fixed_decimals(value: Column, digits: int = 3) -> Column:
    """``value`` with so many decimals, as ``%.3f`` writes it: from the exact binary value, halves
    to even. Numbers from 2 ** 63 on end in zeros after their shortest digits.

    The scaled fraction is a rounded product and its error; both are exact, so the half is, too.
    """
    size, scale = F.abs(value), 10.0**digits
    whole = F.floor(size)
    part = size - whole.cast("double")
    product = part * scale
    spread = part * 134217729.0  # 2 ** 27 + 1: splits a double into two halves of its bits
    high = spread - (spread - part)
    error = (high * scale - product) + (part - high) * scale
    down = F.floor(product)
    over = product - down.cast("double") - 0.5
    up = (over > 0) | ((over == 0) & ((error > 0) | ((error == 0) & (down % 2 == 1))))
    units = down + F.when(up, 1).otherwise(0)
    full = units == int(scale)
    text = F.concat(
        F.when(F.startswith(value.cast("string"), F.lit("-")), "-").otherwise(""),
        F.when(size >= 2.0**63, size.cast("decimal(38, 0)").cast("string"))
        .otherwise((whole + F.when(full, 1).otherwise(0)).cast("string")),
        F.lit("."),
        F.lpad(F.when(full, 0).otherwise(units).cast("string"), digits, "0"),
    )
    infinite = F.when(value < 0, "-inf").otherwise("inf")
    return F.when(F.isnan(value), "nan").when(size == float("inf"), infinite).otherwise(text)


def kilometres(value: Column) -> Column:
    return fixed_decimals(value, 3)


def file_stem(path: Column) -> Column:
    """File name without directories and without its last extension."""
    name = F.substring_index(path, "/", -1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def has_name(path: Column, prefix: str = "", suffix: str = "") -> Column:
    """Does the file name of a path begin and end so? Upper and lower case are told apart."""
    name = F.substring_index(path, "/", -1)
    return F.startswith(name, F.lit(prefix)) & F.endswith(name, F.lit(suffix))


def with_suffix(path: Column, suffix: str, extension: str) -> Column:
    """Output name of an input file, such as ``track_lineas.shp`` for ``a/b/track.txt``."""
    return F.concat(file_stem(path), F.lit(suffix), F.lit(extension))


def xml_escaped(text: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text
