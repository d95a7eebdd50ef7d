"""SimHash near-duplicates by covering locality-sensitive hashing.

With ``r + 1``-bit vectors dealt to the 64 bit positions, each of the ``2^(r+1) - 1`` non-zero
vectors gives a mask: the positions whose vector has an odd product with it. At most ``r``
differing positions span at most ``r`` dimensions, so some mask avoids all of them: every pair
within the radius is equal under that mask and meets in its table (Pagh, "CoveringLSH", 2016).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytrace.llm.common import column, fresh, stored
from skytrace.operators.graph import connected_components

BITS = 64
#: Distinct fingerprints that a bucket compares directly; larger buckets go by midpoints.
DIRECT = 32


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """64 majority bits over the hashes of all word shingles, repeats included; 0 without words."""
    tokens = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not tokens:
        return 0
    if len(tokens) <= words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, seed) for s in shingles], ">u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = ones * 2 > len(hashes)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprints(words: int = 3, seed: int = 42):
    """A column function: the fingerprint of a text as a signed 64-bit number."""

    @F.arrow_udf("bigint")
    def run(texts: pa.Array) -> pa.Array:
        got = np.array([fingerprint(t, words, seed) for t in texts.to_pylist()], np.uint64)
        return pa.array(got.view(np.int64))

    return run


def covering_masks(radius: int) -> list[int]:
    """One mask a table, as unsigned numbers."""
    size = 1 << (radius + 1)
    vectors = [1 + i % (size - 1) for i in range(BITS)]
    return [
        sum(1 << i for i, v in enumerate(vectors) if (v & other).bit_count() % 2)
        for other in range(1, size)
    ]


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Edges ``(src, dst)`` whose components are those of all pairs within ``radius`` bits.

    ``distinct`` has the fingerprints, each once, in ``fp``. Buckets of up to ``DIRECT``
    fingerprints compare their pairs. A larger bucket is taken over by midpoints, exactly for
    ``radius`` 2: two fingerprints differ in at most 2 bits if and only if one fingerprint is within
    1 bit of both, so each sends itself under its 65 neighbours and a neighbour links what meets
    there, 65 at most. No work grows with the square of a bucket.
    """
    if radius != 2:
        raise ValueError("the midpoint rule for crowded buckets holds for a radius of 2")
    masks = covering_masks(radius)
    keys = F.explode(
        F.array(
            *[
                F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(_signed(m)).alias("k"))
                for t, m in enumerate(masks)
            ]
        )
    )
    placed = distinct.select("fp", keys.alias("at")).select("fp", "at.t", "at.k")
    sizes = placed.groupBy("t", "k").agg(F.count("*").alias("n")).filter("n > 1")
    met = stored(placed.join(sizes, ["t", "k"]), "simhash-buckets")
    pairs = (
        met.filter(F.col("n") <= DIRECT)
        .groupBy("t", "k")
        .agg(F.collect_list("fp").alias("fps"))
        .select(
            F.explode(
                F.expr(
                    "filter(flatten(transform(fps, (x, i) -> transform("
                    "slice(fps, i + 2, size(fps)), y -> struct(x AS src, y AS dst)))), "
                    f"p -> bit_count(p.src ^ p.dst) <= {radius})"
                )
            ).alias("e")
        )
        .select("e.src", "e.dst")
    )
    crowded = met.filter(F.col("n") > DIRECT).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[_signed(1 << i) for i in range(BITS)])
    through = (
        crowded.select("fp", F.explode(flips).alias("flip"))
        .groupBy(F.col("fp").bitwiseXOR(F.col("flip")).alias("middle"))
        .agg(F.collect_list("fp").alias("fps"))
        .filter(F.size("fps") > 1)
        .select(F.array_min("fps").alias("src"), F.explode("fps").alias("dst"))
    )
    return pairs.unionByName(through).filter("src != dst").distinct()


def _classes(prints: DataFrame, radius: int, least: Column) -> DataFrame:
    """``(fp, least)``: the minimum of ``least`` over all rows linked to a fingerprint."""
    distinct = stored(prints.groupBy("fp").agg(F.min(least).alias("least")), "simhash-distinct")
    groups = connected_components(links(distinct.select("fp"), radius))
    named = distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    best = named.groupBy("component").agg(F.min("least").alias("least"))
    classes = named.drop("least").join(best, "component").select("fp", "least")
    return stored(classes, "simhash-classes")


def simhash_components(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 3,
    radius: int = 2,
    seed: int = 42,
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, a row for each row of ``documents``.

    Texts without words, NULL ones included, have fingerprint zero and link like any other. A
    component is named by its least id that is not NULL (NULL if it has none); repeated rows get a
    row each.
    """
    prints = stored(
        documents.select(
            column(documents, id_col).alias("doc_id"),
            fingerprints(words, seed)(column(documents, text_col)).alias("fp"),
        ),
        "simhash-prints",
    )
    classes = _classes(prints, radius, F.col("doc_id"))
    return prints.join(classes, "fp", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("least").alias("component_id"),
    )


def simhash_dedup(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 3,
    radius: int = 2,
    seed: int = 42,
) -> DataFrame:
    """One row of each component, with the columns of ``documents``: that of its least id.

    Rows without an id come after all others; rows of equal id are told apart by a hash of all
    their columns, and of rows equal in everything one stays.
    """
    whole = F.xxhash64(*[column(documents, c) for c in documents.columns])
    row = F.struct(
        column(documents, id_col).isNull().alias("missing"),
        column(documents, id_col).alias("id"),
        whole.alias("whole"),
    )
    prints = stored(
        documents.select(
            row.alias("row"), fingerprints(words, seed)(column(documents, text_col)).alias("fp")
        ),
        "simhash-rows",
    )
    keep = _classes(prints, radius, F.col("row")).select("least.*").distinct()
    # Copies are reduced before anything is shuffled; id and hash are keys without NULL for both steps.
    a, b, n = (fresh(documents, x) for x in ("row_id", "row_hash", "row_missing"))
    keys = [a, b, n]

    def key(id_value: Column, hashed: Column) -> dict[str, Column]:
        text = F.coalesce(id_value.cast("string"), F.lit(""))
        return dict(zip(keys, (text, hashed, id_value.isNull()), strict=True))

    keyed = documents.withColumns(key(column(documents, id_col), whole)).dropDuplicates(keys)
    wanted = keep.select(*[c.alias(x) for x, c in key(F.col("id"), F.col("whole")).items()])
    return keyed.join(wanted, keys, "left_semi").drop(*keys)
