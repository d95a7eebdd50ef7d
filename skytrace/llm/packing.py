"""Packing documents into sequences of bounded length by best-two-fit.

Only the number of documents of each length decides how sequences are filled, so the plan is made
from that histogram, whose size is the capacity whatever the input. A sequence is filled greedily
with the longest documents that fit; then its smallest one gives way to two waiting ones, as long as
two fill the widened gap more tightly. A filling is repeated as often as its lengths last. The
documents of a length, numbered across all tasks, then take the places the plan has for it.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skytrace.llm.bpe import tokenizer_file
from skytrace.llm.common import column, stored

CAPACITY = 2048
#: Counts by length and task, of some 100 bytes each in memory, that are broadcast at most.
FEW_COUNTS = 400_000


def fillings(counts: list[int], capacity: int) -> Iterator[tuple[Counter, int]]:
    """``(documents by length in a sequence, number of such sequences)``; counts[n]: of length n.

    Each filling uses up a length, or leaves fewer documents of it than the filling holds, so there
    are at most a few fillings for each length however many documents there are.
    """
    left = np.array(counts, np.int64)
    lengths = np.arange(capacity + 1)
    waiting = [int(n) for n in np.flatnonzero(left) if n > 0]
    while waiting:
        used: Counter = Counter({waiting[-1]: 1})
        gap = capacity - waiting[-1]
        at = bisect_right(waiting, gap) - 1
        while at >= 0 and gap > 0:
            length = waiting[at]
            more = min(gap // length, int(left[length]) - used[length])
            if more > 0:
                used[length] += more
                gap -= more * length
            at = min(at, bisect_right(waiting, gap)) - 1
        while gap > 0 and sum(used.values()) > 1:
            small = min(used)
            used[small] -= 1
            room = gap + small
            free = left.copy()
            for length, n in used.items():
                free[length] -= n
            free[0] = 0
            fits = np.maximum.accumulate(np.where(free > 0, lengths, 0))
            first = lengths[1:room][free[1:room] > 0]
            second = fits[np.minimum(room - first, first)]
            alone = (second == first) & (free[first] < 2)  # the same document can't come twice
            second = np.where(alone, fits[first - 1], second)
            both = np.where(second > 0, first + second, 0)
            best = int(both.argmax()) if len(both) else -1
            if best < 0 or both[best] <= small:
                used[small] += 1
                break
            used[int(first[best])] += 1
            used[int(second[best])] += 1
            used = +used
            gap = room - int(both[best])
        used = +used
        times = min(int(left[length]) // n for length, n in used.items())
        for length, n in used.items():
            left[length] -= n * times
            if not left[length]:
                waiting.remove(length)
        yield used, times


def _places(counts: list[int], capacity: int) -> np.ndarray:
    """Rows ``(length, first rank, sequences, first sequence, offset)`` in order of length, rank."""
    rows, ranks, sequence = [], Counter(), 0
    for used, times in fillings(counts, capacity):
        offset = 0
        for length in sorted(used, reverse=True):
            rows.append((length, ranks[length], times, sequence, offset))
            ranks[length] += used[length] * times
            offset += used[length] * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pieces(
    documents: DataFrame,
    tokenizer: str,
    pattern: str,
    *,
    capacity: int = CAPACITY,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """The documents' ids, each ended by ``end_id``, cut into pieces where longer than capacity.

    Columns: doc_id, piece, start, length, ids_crc32, task and rank (the number of earlier pieces of
    that length in the task), with ``keep_ids`` also ids (binary, little-endian unsigned 32 bits).
    """
    id_type = column(documents, id_col)
    chosen = documents.select(id_type.alias("doc_id"), column(documents, text_col).alias("text"))
    names = "piece int, start bigint, length bigint, ids_crc32 bigint, task int, rank bigint"
    kind = chosen.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {names}" + ", ids binary" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer_file(tokenizer, pattern)
        end = np.array([end_id], "<u4").tobytes()
        task, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows, source = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = encoder.encode(text) + end
                total, start, number = len(ids) // 4, 0, 0
                while start < total:
                    length = (total - start - 1) % capacity + 1 if start == 0 else capacity
                    own = ids[4 * start : 4 * (start + length)]
                    source.append(i)
                    rows.append((number, start, length, zlib.crc32(own), task, seen[length], own))
                    seen[length] += 1
                    start, number = start + length, number + 1
            if not rows:
                continue
            columns = [batch.column(0).take(pa.array(source, pa.int64()))]
            types = [pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64(), pa.binary()]
            columns += [
                pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)
            ][: None if keep_ids else -1]
            yield pa.RecordBatch.from_arrays(
                columns,
                ["doc_id", *(n.split()[0] for n in names.split(", ")), *["ids"] * keep_ids],
            )

    return chosen.mapInArrow(run, schema)


def pack(
    documents: DataFrame,
    tokenizer: str,
    pattern: str,
    *,
    capacity: int = CAPACITY,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    A NULL or empty text is the end id alone. Every row of ``documents`` is a document, repeated
    rows and rows without an id too. An empty table gives no rows.
    """
    cut = stored(
        pieces(
            documents,
            tokenizer,
            pattern,
            capacity=capacity,
            end_id=end_id,
            id_col=id_col,
            text_col=text_col,
            keep_ids=keep_ids,
        ),
        "packing-pieces",
    )
    # One row for each task and length; a length's rows are as many as there are tasks.
    by_task = stored(cut.groupBy("length", "task").agg(F.count("*").alias("n")), "packing-counts")
    histogram = by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()  # capacity rows
    counts = [0] * (capacity + 1)
    for row in histogram:
        counts[row["length"]] = row["n"]
    places = _places(counts, capacity)
    keys = (places[:, 0] << 48) | places[:, 1]
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select(
        "length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )

    @F.arrow_udf("struct<sequence_id: bigint, offset: bigint>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        length, rank = (np.asarray(x.to_numpy(zero_copy_only=False)) for x in (length, rank))
        own = places[np.searchsorted(keys, (length << 48) | rank, "right") - 1]
        step = rank - own[:, 1]
        sequence = own[:, 3] + step % own[:, 2]
        offset = own[:, 4] + step // own[:, 2] * own[:, 0]
        return pa.StructArray.from_arrays(
            [pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"]
        )

    if by_task.count() <= FEW_COUNTS:  # else pieces meet the counts by a shuffle on length and task
        before = F.broadcast(before)
    else:
        before = before.hint("merge")
    ranked = cut.join(before, ["length", "task"]).withColumn("rank", F.col("rank") + F.col("before"))
    return ranked.withColumn("place", place("length", "rank")).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        "place.sequence_id",
        "place.offset",
        *["ids"] * keep_ids,
    )
