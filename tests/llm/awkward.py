"""Awkward documents that every operator must take: NULL, empty, long, odd and repeated texts."""

from __future__ import annotations

import random

_rng = random.Random(11)
_WORDS = [f"w{i}" for i in range(200)] + ["é", "ß…", "你好", "🙂"]

AWKWARD = [
    None,
    "",
    " ",
    "\n\n\t",
    "a",
    "one two",
    "don't  stop\r\n\x0bnow\x1cthen there\xa0",
    "x" * 5000,
    "ab" * 1200,
    "orre " * 700,
    "\U0001f642" * 300,
    " ".join(_rng.choices(_WORDS, k=40_000)),
    "twin text " * 60,
    "twin text " * 60,
    "<s> <unk> <0x41> | # * $ % & < >",
]


def documents(spark, rows=None):
    """A table with an extra column for each name that an operator might want for itself."""
    rows = list(enumerate(AWKWARD)) if rows is None else rows
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    extra = {
        name: "CAST(NULL AS STRING)"
        for name in ("score", "fp", "k0", "k1", "spans", "rank", "row_id", "kept", "dotted.name")
    }
    return frame.selectExpr("*", *(f"{value} AS `{name}`" for name, value in extra.items()))
