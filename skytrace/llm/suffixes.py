"""Exact removal of long repeated substrings by bucket-pointer refinement.

A byte goes if a string of ``length`` bytes that covers it also starts elsewhere. Bucket-pointer
refinement sorts suffixes into buckets by their first q bytes and refines the buckets by the bucket
identifiers found at later offsets, so that each round doubles the depth and uses what the round
before has settled. Here an identifier is a 64-bit hash of the bytes it stands for, made in the same
way: a 50-byte identifier from the 25-byte ones at offsets 0 and 25, then 100, 200, 400. It needs no
central numbering, so that a task can follow the rounds alone, and only buckets that stay crowded
move between tasks:

1. Each string of ``length`` bytes has an anchor, its bucket of ``length / 4`` bytes with the least
   identifier (leftmost of equals). Equal strings have equal anchors. Neighbouring starts share an
   anchor and form a run; a run has one row, about one for 150 bytes of text.
2. Rows are bucketed by anchor. An anchor found once settles its run: nothing repeats. If the runs of
   an anchor agree in all their strings (same identifiers at first and last start), all repeat.
3. Runs that share an anchor without agreeing are refined. The starts of a run are cut into blocks of
   64 by their distance from the anchor. What all strings of a block have in common is looked up; if
   no other run has it, the block is done. If another run has the whole block, all its strings
   repeat. Blocks between the two are cut into four, down to single strings.

Groups are only counted or reduced to their least and largest member, so no group has to be in one
task, and no pairs are made. What a group is reduced to is stored before it meets its rows again: AQE
splits a hot key only where the join follows the shuffle directly, without an aggregation between.
Two identifiers must agree in 128 bits (anchor and string) to count as equal.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytrace.llm.common import column, fresh, stored, utf8

#: Starts that are worked on at a time, whether of many texts or of a part of a long one.
BLOCK = 1 << 17
#: Sizes of the blocks of starts in the rounds of refinement.
ROUNDS = (64, 16, 4, 1)
_K1, _K2, _K3 = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
_LOW = np.uint64(0xFFFFFFFF)


def _refine(first: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Identifiers of pairs of buckets."""
    ids = first * _K1
    ids += later
    ids ^= ids >> np.uint64(29)
    ids *= _K2
    ids ^= ids >> np.uint64(32)
    return ids


def identifiers(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket identifiers of depths ``length / 4``, ``/ 2`` and ``/ 1`` at the offsets of ``data``."""
    depth, ids = 1, (data.astype(np.uint64) + np.uint64(1)) * _K3
    ids ^= ids >> np.uint64(31)
    known = {1: ids}
    q = length // 16
    while 2 * depth <= q:
        ids = _refine(ids[:-depth], ids[depth:])
        depth *= 2
        known[depth] = ids
    for step in sorted(known, reverse=True):  # the initial buckets: q bytes in parts of 2^k
        while depth + step <= q:
            size = len(data) - depth - step + 1
            ids = _refine(ids[:size], known[step][depth : depth + size])
            depth += step
    del known
    rounds = []
    while depth < length:  # the rounds: depth doubles, with the identifiers just made
        ids = _refine(ids[:-depth], ids[depth:])
        depth *= 2
        rounds.append(ids)
    return rounds[-3], rounds[-2], rounds[-1]


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    if reach < width:
        values = np.minimum(values[: -(width - reach)], values[width - reach :])
    return values


def runs(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """``(anchor id, run id, first start, last start)`` of the runs among ascending ``starts``."""
    anchors, _, strings = identifiers(data, length)
    place = np.arange(len(anchors), dtype=np.uint64)
    least = _sliding_least((anchors & ~_LOW) | place, length - length // 4 + 1)
    anchor = (least[starts] & _LOW).astype(np.int64)
    first = np.flatnonzero(
        np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (np.diff(starts) != 1)])
    )
    last = np.append(first[1:], len(starts)) - 1
    at, s, e = anchor[first], starts[first], starts[last]
    shape = ((e - s) * 1024 + (at - s)).astype(np.uint64)
    run = _refine(_refine(strings[s], strings[e]), shape)
    return anchors[at], run, s, e


def _blocks(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(from byte, to byte, starts in it, their rows)``, covering each start of each row once."""
    low, high = offsets[:-1], offsets[1:] - length + 1
    rows = np.flatnonzero(high > low)
    i = 0
    while i < len(rows):
        a = rows[i]
        if high[a] - low[a] > BLOCK:
            for s in range(int(low[a]), int(high[a]), BLOCK):
                n = min(BLOCK, int(high[a]) - s)
                yield s, s + n + length - 1, np.arange(n), np.full(n, a)
            i += 1
            continue
        j = i + 1
        while j < len(rows) and high[rows[j]] - low[a] <= BLOCK:
            j += 1
        own = rows[i:j]
        sizes = high[own] - low[own]
        before = np.cumsum(sizes) - sizes
        starts = np.arange(sizes.sum()) - np.repeat(before, sizes) + np.repeat(low[own], sizes)
        base = int(low[a])
        yield base, int(high[own[-1]]) + length - 1, starts - base, np.repeat(own, sizes)
        i = j


_RUN = "anchor bigint, run bigint, k0 bigint, k1 bigint, s int, e int, w int, n int"
_RUN_TYPES = [pa.int64()] * 4 + [pa.int32()] * 4


def _run_rows(length: int):
    """mapInArrow function from ``(k0, k1, text)`` to run rows.

    Runs of one text that agree are joined where they touch; ``n`` counts them and ``w`` is the
    width of one. A task gives the rows of a repeated text twice only: two are as good as many.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], bool] = {}
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            keep = []
            for i, key in enumerate(keys):
                if not seen.get(key):
                    keep.append(i)
                    seen[key] = key in seen
            batch = batch.take(pa.array(keep, pa.int64()))
            data, offsets = utf8(batch.column(2))
            ids = [np.asarray(batch.column(c)) for c in (0, 1)]
            for low, high, starts, rows in _blocks(offsets, length):
                anchor, agree, s, e = runs(data[low:high], starts, length)
                row = rows[np.searchsorted(starts, s)]
                shift = low - offsets[row]
                s, e = s + shift, e + shift
                order = np.lexsort((s, agree, anchor, row))
                anchor, agree, s, e, row = (x[order] for x in (anchor, agree, s, e, row))
                other = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1])
                other |= (agree[1:] != agree[:-1]) | (s[1:] > e[:-1] + length)
                first = np.flatnonzero(np.concatenate([[True], other]))
                count = np.diff(np.append(first, len(s)))
                own = row[first]
                columns = [anchor[first].view(np.int64), agree[first].view(np.int64)]
                columns += [k[own] for k in ids]
                columns += [s[first], e[first + count - 1], e[first] - s[first], count]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x).cast(t) for x, t in zip(columns, _RUN_TYPES, strict=True)],
                    [x.split()[0] for x in _RUN.split(", ")],
                )

    return run


_CONTEXT = (
    "anchor bigint, run bigint, k0 bigint, k1 bigint, s int, w int, single boolean, bytes binary"
)


def _context_rows(length: int):
    """mapInArrow function from ``(k0, k1, runs to refine, text)`` to runs with their bytes."""
    names = [x.split()[0] for x in _CONTEXT.split(", ")]
    types = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.bool_(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = set()
        for batch in batches:
            k0, k1, todo = (batch.column(i).to_pylist() for i in range(3))
            data, offsets = utf8(batch.column(3))
            rows = []
            for i, key in enumerate(zip(k0, k1, strict=True)):
                if key in done:  # another copy of the text
                    continue
                done.add(key)
                text = data[offsets[i] : offsets[i + 1]]
                for x in todo[i]:
                    own = text[x["s"] : x["s"] + x["w"] + length].tobytes()
                    rows.append((x["anchor"], x["run"], *key, *(x[n] for n in names[4:7]), own))
            for part in range(0, len(rows), 4096):
                columns = zip(*rows[part : part + 4096], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
                )

    return run


_BLOCK_ROW = (
    "anchor bigint, run bigint, k0 bigint, k1 bigint, single boolean, block int, inner bigint, "
    "outer bigint, s int, e int"
)


def _block_rows(size: int, length: int):
    """mapInArrow function from context rows, with the blocks of the round before, to blocks.

    Block b of a run has the starts that lie ``b * size`` to ``(b + 1) * size - 1`` before the
    anchor. ``inner`` stands for the bytes that all strings of the block share, ``outer`` for all
    its bytes; where the run has a part of the block only, ``outer`` is the run itself.
    """
    names = [x.split()[0] for x in _BLOCK_ROW.split(", ")]
    types = [pa.int64()] * 4 + [pa.bool_(), pa.int32()] + [pa.int64()] * 2 + [pa.int32()] * 2

    def blocks(part: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = utf8(part.column("bytes"))
        anchors, halves, strings = identifiers(data, length)
        anchor, run, k0, k1, s, w = (
            np.asarray(part.column(n)) for n in ("anchor", "run", "k0", "k1", "s", "w")
        )
        # The anchor is the first place of its identifier in the run.
        owner = np.repeat(np.arange(len(part)), np.diff(offsets))[: len(anchors)]
        places = np.flatnonzero(anchors.view(np.int64) == anchor[owner])
        _, first = np.unique(owner[places], return_index=True)
        at = places[first] - offsets[:-1]
        if size == ROUNDS[0]:
            low, count = (at - w) // size, at // size - (at - w) // size + 1
            row = np.repeat(np.arange(len(part)), count)
            block = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[row]
        else:
            todo = part.column("blocks")
            times = ROUNDS[ROUNDS.index(size) - 1] // size
            inside = np.asarray(todo.flatten()).astype(np.int64)
            row = np.repeat(np.arange(len(part)), np.asarray(todo.value_lengths()))
            row, inside = np.repeat(row, times), np.repeat(inside * times, times)
            block = inside + np.arange(len(inside)) % times
            held = (block >= (at - w)[row] // size) & (block <= at[row] // size)
            row, block = row[held], block[held]
        last = at[row] - block * size
        start = last - size + 1
        base = offsets[row]
        inner = _refine(halves[base + last], halves[base + start + length // 2])
        whole = (start >= 0) & (last <= w[row])
        s_in, e_in = np.maximum(start, 0), np.minimum(last, w[row])
        outer = _refine(strings[base + s_in], strings[base + e_in]).view(np.int64)
        columns = [anchor[row], run[row], k0[row], k1[row]]
        columns += [part.column("single").to_numpy(zero_copy_only=False)[row], block]
        columns += [inner.view(np.int64), np.where(whole, outer, run[row])]
        columns += [s[row] + s_in, s[row] + e_in]
        return pa.RecordBatch.from_arrays(
            [pa.array(c).cast(t) for c, t in zip(columns, types, strict=True)], names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                yield blocks(batch.slice(at, 256))

    return run


def _refined(contexts: DataFrame, length: int) -> list[DataFrame]:
    """``(k0, k1, s, e)`` of starts that repeat, by round, for the single runs of ``contexts``."""
    found, names = [], ["anchor", "run"]
    for size in ROUNDS:
        rows = stored(contexts.mapInArrow(_block_rows(size, length), _BLOCK_ROW), "suffix-blocks")
        wholes = rows.groupBy("anchor", "block", "inner", "outer").agg(
            F.min("run").alias("a"), F.max("run").alias("b")
        )
        shared = stored(
            wholes.groupBy("anchor", "block", "inner")
            .agg(
                F.min("a").alias("least"),
                F.max("b").alias("most"),
                F.bool_or(F.col("a") == F.col("b")).alias("some_open"),
            )
            .filter("least != most")
            .drop("least", "most"),
            "suffix-places",
        )
        place = ["anchor", "block", "inner"]
        known = wholes.join(shared, place)
        judged = stored(rows.join(known, [*place, "outer"]), "suffix-judged")
        found.append(judged.filter("single AND a != b").select("k0", "k1", "s", "e"))
        # Of blocks that are equal as a whole one goes on, to be found by those that are not.
        going_on = judged.filter("some_open AND (a = b OR run = a)")
        if size == ROUNDS[-1] or going_on.isEmpty():
            return found
        todo = going_on.groupBy(*names).agg(F.collect_set("block").alias("blocks"))
        contexts = contexts.drop("blocks").join(todo, names)
    return found


def _keys(text: Column) -> list[Column]:
    """128 bits that stand for a whole text, so that repeated rows need no number of their own."""
    return [F.xxhash64(text).alias("k0"), F.xxhash64(F.lit("second"), text).alias("k1")]


def repeated_spans(documents: DataFrame, *, text_col: str = "text", length: int = 400) -> DataFrame:
    """``(k0, k1, spans)``: by text, its covered places as array<s << 32 | (end - length)>."""
    if length % 16:
        raise ValueError("the length must be a multiple of 16")
    text = F.coalesce(column(documents, text_col), F.lit(""))
    keyed = documents.select(*_keys(text), text.alias("text"))
    found = keyed.mapInArrow(_run_rows(length), _RUN)
    crowded = stored(
        found.groupBy("anchor")
        .agg(F.sum("n").alias("total"), F.min("run").alias("a"), F.max("run").alias("b"))
        .filter("total > 1")
        .select("anchor", (F.col("a") != F.col("b")).alias("mixed")),
        "suffix-crowded",
    )
    names = ["anchor", "run", "k0", "k1", "s", "e", "w", "mixed"]
    shared = stored(
        found.join(crowded, "anchor")
        .repartition("k0", "k1")  # frees the join to split crowded anchors
        .groupBy(*names)
        .agg(F.sum("n").alias("n")),
        "suffix-shared",
    )
    span = "shiftleft(CAST(s AS BIGINT), 32) | e"
    mixed = shared.filter("mixed")
    classes = stored(
        mixed.groupBy("anchor", "run").agg(
            F.sum("n").alias("n"), F.min(F.struct("k0", "k1", "s", "w")).alias("one")
        ),
        "suffix-classes",
    )
    agreed = mixed.join(classes.filter("n > 1").select("anchor", "run"), ["anchor", "run"])
    todo = stored(
        classes.groupBy("one.k0", "one.k1").agg(
            F.collect_list(  # a part of one text's runs
                F.struct("anchor", "run", "one.s", "one.w", (F.col("n") == 1).alias("single"))
            ).alias("todo")
        ),
        "suffix-todo",
    )
    contexts = stored(
        todo.join(keyed, ["k0", "k1"])
        .select("k0", "k1", "todo", "text")
        .mapInArrow(_context_rows(length), _CONTEXT),
        "suffix-contexts",
    )
    parts = [shared.filter("NOT mixed"), agreed, *_refined(contexts, length)]
    spans = [x.select("k0", "k1", F.expr(span).alias("span")) for x in parts]
    return (
        reduce(DataFrame.unionByName, spans)
        .groupBy("k0", "k1")
        .agg(F.collect_list("span").alias("spans"))
    )


def remove_spans(length: int):
    """A column function of text and spans: ``struct(kept, n_spans, text)``, the bytes that stay.

    ``text`` is the same without what is left of characters that were cut apart.
    """

    @F.arrow_udf("struct<kept: binary, n_spans: bigint, text: string>")
    def run(texts: pa.Array, spans: pa.Array) -> pa.Array:
        data, offsets = utf8(texts)
        kept, number = [], []
        for i, own in enumerate(spans):
            text = data[offsets[i] : offsets[i + 1]].tobytes()
            if not own.is_valid:
                kept.append(text)
                number.append(0)
                continue
            both = np.sort(np.asarray(own.values.to_numpy(zero_copy_only=False), np.int64))
            low, high = both >> 32, (both & 0xFFFFFFFF) + length
            high = np.maximum.accumulate(high)
            first = np.flatnonzero(np.concatenate([[True], low[1:] > high[:-1]]))
            ends = high[np.append(first[1:], len(low)) - 1]
            parts, at = [], 0
            for a, b in zip(low[first].tolist(), ends.tolist(), strict=True):
                parts.append(text[at:a])
                at = b
            kept.append(b"".join([*parts, text[at:]]))
            number.append(len(first))
        text = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())
        columns = [pa.array(kept, pa.binary()), pa.array(number, pa.int64()), text]
        return pa.StructArray.from_arrays(columns, ["kept", "n_spans", "text"])

    return run


def without_repeats(
    documents: DataFrame,
    *,
    text_col: str = "text",
    length: int = 400,
    kept: str,
    n_spans: str,
    as_text: str | None = None,
) -> DataFrame:
    """``documents`` with two more columns: the bytes that stay, and the number of removed runs.

    A third one, ``as_text``, has these bytes as text, without parts of characters cut apart.

    A byte goes if some string of ``length`` bytes of the same text covers it and also starts
    elsewhere, in any text, as the texts came in; so of copies none keeps its long strings. NULL
    counts as empty; repeated rows are copies of each other; texts shorter than ``length`` stay
    whole; an empty table stays empty. Names given for the new columns must be free.
    """
    k0, k1, spans, both = (fresh(documents, x) for x in ("k0", "k1", "spans", "kept_spans"))
    found = stored(repeated_spans(documents, text_col=text_col, length=length), "suffix-spans")
    text = F.coalesce(column(documents, text_col), F.lit(""))
    keys = _keys(text)
    added = {kept: "kept", n_spans: "n_spans"} | ({as_text: "text"} if as_text else {})
    return (
        documents.withColumns({k0: keys[0], k1: keys[1]})
        .join(found.withColumnsRenamed({"k0": k0, "k1": k1, "spans": spans}), [k0, k1], "left")
        .withColumn(both, remove_spans(length)(text, F.col(spans)))
        .withColumns({name: F.col(f"{both}.{part}") for name, part in added.items()})
        .select(*[column(documents, c) for c in documents.columns], *added)
    )


def suffix_dedup(documents: DataFrame, *, text_col: str = "text", length: int = 400) -> DataFrame:
    """The rows of ``documents`` with repeated strings taken out of their texts.

    Bytes of a character that was cut apart are dropped with it. A column ``n_chars`` is brought up
    to date. NULL texts stay NULL.
    """
    kept, n_spans, new = (fresh(documents, x) for x in ("kept_bytes", "kept_runs", "kept_text"))
    cut = without_repeats(
        documents, text_col=text_col, length=length, kept=kept, n_spans=n_spans, as_text=new
    )
    text = F.when(F.col(f"`{text_col}`").isNotNull(), F.col(new))
    cut = cut.withColumn(text_col, text).drop(kept, n_spans, new)
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.char_length(F.col(f"`{text_col}`")).cast(kind))
    return cut.select(*[f"`{c}`" for c in documents.columns])
