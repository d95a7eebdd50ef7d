"""Token ids in files, compressed by Re-Pair: a grammar for each shard, decoded at any place.

Documents are put in the order of their ids by ranges, so that a task holds a stretch of them; it
writes a shard whenever it has gathered ``SHARD_IDS`` ids. Re-Pair replaces frequent pairs of
neighbouring symbols by new symbols, again and again, until pairs no longer occur often enough to pay
for a rule. Here a round takes the most frequent pairs together, the more frequent one where two
overlap; the next round starts from what they left, with a lower bar.

The files are Parquet with a row for each shard. Its columns:

- ``part``, ``no``: the task's stretch and the shard in it; both follow the order of documents
- ``start``: ids of the same part before the shard; ``n_ids``: ids in it
- ``doc_ids``, ``doc_ends``: its documents in order and where each ends, counted in ids
- ``blocks``: the ids, mostly in one block; only a document longer than a shard makes more. Of each,
  ``terminals`` (smaller symbols are ids), ``rounds`` (rules made by each round), ``rules`` (pairs of
  symbols; rule i is symbol ``terminals + i``), ``lengths`` (ids a rule expands to) and ``symbols``;
  the last three are little-endian unsigned 32-bit numbers

The lengths lead to any place of a block without expanding what lies before it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skytrace.llm.bpe import tokenizer_file
from skytrace.llm.common import column, small_batches, stored

#: Ids after which a shard is closed; also the most ids that are compressed together.
SHARD_IDS = 1 << 20
#: Occurrences that pay for a rule: it costs two symbols and a length, and saves one symbol each time.
LEAST = 4
#: A round takes the most frequent pairs: down to this share of the first one's count, and so many
#: that they stand at this share of the places.
SHARE, PLACES = 12, 0.25
#: Rounds end when all pairs that pay save less than this share of the symbols.
WORTH = 0.02
#: Parts (one for each task that wrote) whose sums are broadcast, of 16 bytes each.
FEW_PARTS = 100_000
_SLOTS = 18


def _counted(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs that occur ``LEAST`` times or more, and how often."""
    ordered = np.sort(pairs)
    # Equal pairs lie together, so only stretches of LEAST equal values can start a frequent one.
    same = ordered[LEAST - 1 :] == ordered[: len(ordered) - LEAST + 1]
    first = np.flatnonzero(same & np.concatenate([[True], ordered[1 : len(same)] != ordered[: len(same) - 1]]))
    found = ordered[first]
    return found, np.searchsorted(ordered, found, "right") - first


def _chosen(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """``(places, ranks there)`` of pairs to replace, no two of which overlap; are they all that pay?"""
    nothing = np.zeros(0, np.int64)
    if len(pairs) < LEAST:
        return nothing, nothing, True
    found, count = _counted(pairs)
    if not len(found):
        return nothing, nothing, True
    order = np.lexsort((found, -count))
    found, count = found[order], count[order]
    enough = np.searchsorted(np.cumsum(count), PLACES * len(pairs)) + 1
    taken = max(int(enough), int(np.searchsorted(-count, -(count[0] // SHARE), "right")))
    every = taken >= len(found)
    found = found[:taken]
    # A small hash table gives the rank of a pair. Of pairs that share a slot the most frequent is
    # taken; the others wait for a later round.
    wide = pairs.dtype == np.uint64
    factor = np.uint64(0x9E3779B97F4A7C15) if wide else np.uint32(0x9E3779B1)
    shift = pairs.dtype.type((64 if wide else 32) - _SLOTS)
    slots = (found * factor) >> shift
    ranks = np.full(1 << _SLOTS, len(found), np.int32)
    ranks[slots[::-1]] = np.arange(len(found), dtype=np.int32)[::-1]
    rank = ranks[(pairs * factor) >> shift]
    places = np.flatnonzero(rank < len(found))
    own = rank[places]
    real = found[own] == pairs[places]
    places, own = places[real], own[real]
    # A place wins against its neighbours by its rank; in a run of one rank every other place wins,
    # counted from the left, unless the run's last place has lost to what follows.
    near = np.flatnonzero(places[1:] - places[:-1] == 1)
    left, right = own[near], own[near + 1]
    loses = np.zeros(len(places), bool)
    loses[near[left < right] + 1] = True
    loses[near[right < left]] = True
    tied = near[left == right] + 1
    if len(tied):
        run = np.cumsum(np.concatenate([[True], np.diff(tied) != 1])) - 1
        first = tied[np.concatenate([[True], np.diff(tied) != 1])]
        loses[tied[(tied - first[run]) % 2 == 0]] = True
    places, own = places[~loses], own[~loses]
    keep = (np.bincount(own, minlength=len(found)) >= LEAST)[own]
    return places[keep], own[keep], every


def compress(ids: np.ndarray) -> dict:
    """A block: the grammar of ``ids`` and what is left of them."""
    symbols = ids.astype(np.uint32)
    terminals = int(symbols.max()) + 1 if len(symbols) else 0
    top, rounds, rules, lengths = terminals, [], [], [np.ones(terminals, np.uint32)]
    length = lengths[0]
    while len(symbols) > 1:
        if top <= 1 << 16:
            pairs = (symbols[:-1] << np.uint32(16)) | symbols[1:]
        else:
            pairs = (symbols[:-1].astype(np.uint64) << np.uint64(32)) | symbols[1:]
        places, ranks, every = _chosen(pairs)
        if not len(places):
            break
        one = np.full(int(ranks.max()) + 1, -1)
        one[ranks] = places
        number = np.cumsum(one >= 0) - 1
        one, number = one[one >= 0], number[ranks]
        rule = np.stack([symbols[one], symbols[one + 1]], 1)
        rules.append(rule)
        rounds.append(len(rule))
        length = np.concatenate([length, length[rule[:, 0]] + length[rule[:, 1]]])
        symbols[places] = (top + number).astype(np.uint32)
        top += len(rule)
        left = np.ones(len(symbols), bool)
        left[places + 1] = False
        symbols = symbols[left]
        if every and len(places) < WORTH * len(left):
            break
    rule = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    return {
        "terminals": terminals,
        "rounds": rounds,
        "rules": rule.astype("<u4").tobytes(),
        "lengths": length[terminals:].astype("<u4").tobytes(),
        "symbols": symbols.astype("<u4").tobytes(),
    }


def _arrays(block: dict) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """``(terminals, rules, lengths of all symbols, symbols)`` of a block."""
    rules = np.frombuffer(block["rules"], "<u4").reshape(-1, 2).astype(np.int64)
    lengths = np.ones(block["terminals"] + len(rules), np.int64)
    lengths[block["terminals"] :] = np.frombuffer(block["lengths"], "<u4")
    return block["terminals"], rules, lengths, np.frombuffer(block["symbols"], "<u4").astype(np.int64)


def _gathered(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``pool`` one after the other."""
    before = np.cumsum(lengths) - lengths
    return pool[np.arange(lengths.sum()) + np.repeat(starts - before, lengths)]


def expand(block: dict) -> np.ndarray:
    """All ids of a block.

    The rules of a round refer to earlier rounds only, so a round's expansions are put together at
    once. Each rule stands for ``LEAST`` places or more that do not overlap, so those of a round
    are shorter than the block.
    """
    terminals, rules, lengths, symbols = _arrays(block)
    pool = [np.arange(terminals, dtype=np.uint32)]
    starts = np.arange(len(lengths))
    known, size = terminals, terminals
    for n in block["rounds"]:
        own = rules[known - terminals : known - terminals + n].ravel()
        text = _gathered(pool[0], starts[own], lengths[own])
        starts[known : known + n] = size + np.cumsum(lengths[known : known + n]) - lengths[known : known + n]
        pool[0] = np.concatenate([pool[0], text])
        known, size = known + n, size + len(text)
    return _gathered(pool[0], starts[symbols], lengths[symbols]).astype("<u4")


def expand_slice(block: dict, start: int, stop: int) -> np.ndarray:
    """The ids ``start`` to ``stop - 1`` of a block; only symbols that cover them are expanded."""
    terminals, rules, lengths, symbols = _arrays(block)
    while True:
        ends = np.cumsum(lengths[symbols])
        first = int(np.searchsorted(ends, start, "right"))
        last = int(np.searchsorted(ends, stop, "left")) + 1
        skipped = int(ends[first - 1]) if first else 0
        symbols, start, stop = symbols[first:last], start - skipped, stop - skipped
        inner = symbols >= terminals
        if start >= stop or not inner.any():
            return symbols[start:stop].astype("<u4")
        at = np.arange(len(symbols)) + np.cumsum(inner) - inner
        wider = np.empty(len(symbols) + int(inner.sum()), np.int64)
        wider[at] = symbols
        wider[at[inner]] = rules[symbols[inner] - terminals, 0]
        wider[at[inner] + 1] = rules[symbols[inner] - terminals, 1]
        symbols = wider


_BLOCKS = (
    "array<struct<terminals: bigint, rounds: array<bigint>, rules: binary, lengths: binary, "
    "symbols: binary>>"
)
_BLOCK_TYPE = pa.list_(
    pa.struct(
        [
            ("terminals", pa.int64()),
            ("rounds", pa.list_(pa.int64())),
            *[(name, pa.binary()) for name in ("rules", "lengths", "symbols")],
        ]
    )
)


def _ordered(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text`` in ranges of the id; rows of equal id by a hash of their texts.

    A range ends anywhere among rows of one id, and among repeated rows, whose order is free.
    """
    keyed = documents.select(
        column(documents, id_col).alias("doc_id"), column(documents, text_col).alias("text")
    ).withColumns({"_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    order = ["doc_id", "_hash", "_row"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")


def shards(
    documents: DataFrame,
    tokenizer: str,
    pattern: str,
    *,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_ids: int = SHARD_IDS,
) -> DataFrame:
    """The rows of the file format (see above) for the ids of ``documents``, each ended by ``end_id``.

    A NULL or empty text is the end id alone; a long one is written whole, in blocks of ``shard_ids``.
    Rows of one id follow each other in the order of a hash of their texts, rows without an id come
    first, repeated rows are documents of their own. An empty table has no shards.
    """
    small_batches(documents.sparkSession)
    rows = _ordered(documents, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"part int, no int, start bigint, n_ids bigint, doc_ids array<{kind}>, "
        f"doc_ends array<bigint>, blocks {_BLOCKS}"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer_file(tokenizer, pattern)
        end = np.array([end_id], "<u4").tobytes()
        part, number, start = TaskContext.get().partitionId(), 0, 0
        ids, owners, ends, size = [], [], [], 0

        def shard(of_type: pa.DataType) -> pa.RecordBatch:
            whole = np.frombuffer(b"".join(ids), "<u4")
            cuts = [*range(0, max(1, len(whole) - shard_ids // 2), shard_ids), len(whole)]
            blocks = [compress(whole[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
            columns = [[part], [number], [start], [size], [owners], [ends], [blocks]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(of_type)]
            types += [pa.list_(pa.int64()), _BLOCK_TYPE]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["part", "no", "start", "n_ids", "doc_ids", "doc_ends", "blocks"],
            )

        of_type = None
        for batch in batches:
            of_type = batch.column(0).type
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids.append(encoder.encode(text) + end)
                size += len(ids[-1]) // 4
                owners.append(doc_id)
                ends.append(size)
                if size >= shard_ids:
                    yield shard(of_type)
                    number, start = number + 1, start + size
                    ids, owners, ends, size = [], [], [], 0
        if ids:
            yield shard(of_type)

    return rows.mapInArrow(run, schema)


def write(documents: DataFrame, path: str, tokenizer: str, pattern: str, **options) -> None:
    """Write the ids of ``documents`` to files at ``path``; options as for ``shards``."""
    shards(documents, tokenizer, pattern, **options).write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards at ``path``, with ``first``: the ids of all shards before."""
    files = spark.read.parquet(path)
    parts = stored(files.groupBy("part").agg(F.sum("n_ids").alias("n")), "grammar-parts")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    if parts.count() <= FEW_PARTS:  # else shards would move to meet their part's row
        base = F.broadcast(base)
    return files.join(base, "part").withColumn("first", F.col("base") + F.col("start")).drop("base")


def documents_of(files: DataFrame, *, keep_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) of all documents, decoded from shards.

    ``files`` is a result of ``read_shards``. ``start`` counts the ids of all documents before.
    Every document written has a row, repeated ones too; files without shards give no rows.
    """
    small_batches(files.sparkSession)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * keep_ids
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                first, owners, ends, blocks = (batch.column(k)[i] for k in range(4))
                ids = memoryview(b"".join(expand(block).tobytes() for block in blocks.as_py()))
                ends = np.asarray(ends.values.to_numpy(zero_copy_only=False), np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                own = [ids[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                columns = [owners.values, pa.array(first.as_py() + starts), pa.array(ends - starts)]
                columns.append(pa.array([zlib.crc32(x) for x in own], pa.int64()))
                if keep_ids:
                    columns.append(pa.array(map(bytes, own), pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names)

    return files.select("first", "doc_ids", "doc_ends", "blocks").mapInArrow(run, schema)


def ids_between(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """``start, stop, ids`` for places ``start`` to ``stop - 1`` of the whole sequence of ids.

    Only the symbols that cover a place are expanded. ``wanted`` has a row for each request; places
    beyond the end have no ids. A request may reach over several shards.
    """
    asked = wanted.select(
        F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop")
    ).distinct()
    shard = files.select("part", "no", F.col("first").alias("low"), (F.col("first") + F.col("n_ids")).alias("high"))

    def stretches(rows: DataFrame, low: str, high: str, name: str) -> DataFrame:
        """A row for each stretch of ``SHARD_IDS`` places that a row touches, and the first of them."""
        ends = [F.floor(F.col(low) / SHARD_IDS), F.floor((F.col(high) - 1) / SHARD_IDS)]
        return rows.filter(F.col(low) < F.col(high)).withColumns(
            {name: ends[0], "stretch": F.explode(F.sequence(*ends))}
        )

    met = (
        stretches(shard, "low", "high", "s0")
        .join(stretches(asked, "start", "stop", "a0"), "stretch")
        .filter("start < high AND stop > low AND stretch = greatest(s0, a0)")
        .select("part", "no", "start", "stop")
        .join(files.select("part", "no", "first", "blocks"), ["part", "no"])
    )

    @F.arrow_udf("binary")
    def cut(blocks: pa.Array, first: pa.Array, start: pa.Array, stop: pa.Array) -> pa.Array:
        found = []
        for own, at, a, b in zip(*(c.to_pylist() for c in (blocks, first, start, stop)), strict=True):
            text = b""
            for block in own:
                size = int(_arrays(block)[2][_arrays(block)[3]].sum())
                low, high = max(a - at, 0), min(b - at, size)
                if low < high:
                    text += expand_slice(block, low, high).tobytes()
                at += size
            found.append(text)
        return pa.array(found, pa.binary())

    pieces = met.select("start", "stop", "first", cut("blocks", "first", "start", "stop").alias("ids"))
    joined = pieces.groupBy("start", "stop").agg(
        F.sort_array(F.collect_list(F.struct("first", "ids"))).alias("parts")
    )
    whole = F.reduce("parts", F.lit(b""), lambda text, part: F.concat(text, part["ids"]))
    return asked.join(joined, ["start", "stop"], "left").select(
        "start", "stop", F.coalesce(whole, F.lit(b"")).alias("ids")
    )
