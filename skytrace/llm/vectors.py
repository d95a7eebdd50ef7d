"""Nearest neighbours by inner product, as a join of blocks.

Vectors are packed into blocks. A tile is one block of queries and one of candidates: the product of
their int8 forms, exact in single precision by slices, gives every inner product up to a bound from the two
quantisation errors. Only pairs whose upper bound reaches what the query already has are computed
from the vectors themselves and go on its heap, so the result is exact.
"""

from __future__ import annotations

import heapq
import math
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytrace.llm.common import column, stored

CANDIDATES = 8192
QUERIES = 2048
#: Queries of a tile worked on at a time, and query blocks whose heaps a task keeps.
STRIP, HELD = 128, 32
#: Components whose int8 products have a sum below 2**24, so that single precision holds it.
EXACT = 2**24 // 127**2

_BLOCK = "dim int, query boolean, block bigint, ids binary, own binary, vectors binary"


def _pack():
    """mapInArrow function from ``(id, vector, query)`` to blocks of candidates and of queries."""
    names = [x.split()[0] for x in _BLOCK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId() << 32, 0

        def block(dim, query, ids, own, vectors):
            nonlocal made
            made += 1
            data = (np.array(x, t).tobytes() for x, t in ((ids, "<i8"), (own, "<i8")))
            row = [dim, query, task + made, *data, np.stack(vectors).astype("<f8").tobytes()]
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(row, types, strict=True)], names
            )

        types = [pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        held: dict[tuple[int, bool], tuple[list, list, list]] = {}
        number = 0
        for batch in batches:
            ids, wanted = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            vectors = batch.column(1)
            for i, key in enumerate(ids):
                vector = vectors[i].values.to_numpy(zero_copy_only=False).astype(np.float64)
                number += 1
                for query in (False, True)[: 1 + bool(wanted[i])]:
                    own = held.setdefault((len(vector), query), ([], [], []))
                    for part, value in zip(own, (key, task + number, vector), strict=True):
                        part.append(value)
                    if len(own[0]) == (QUERIES if query else CANDIDATES):
                        yield block(len(vector), query, *held.pop((len(vector), query)))
        for (dim, query), own in held.items():
            yield block(dim, query, *own)

    return run


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, ...]:
    """Int8 steps (as single precision), step size, and norms: of the rest, the vector, the steps."""
    step = np.abs(vectors).max(axis=1) / 127.0
    whole = np.rint(vectors / step[:, None])
    near = whole * step[:, None]
    norms = (np.linalg.norm(x, axis=1) for x in (vectors - near, vectors, near))
    return whole.astype(np.float32), step, *norms


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of int8 steps held in single precision, exact for any number of them."""
    total = (a[:, :EXACT] @ b[:, :EXACT].T).astype(np.float64)
    for at in range(EXACT, a.shape[1], EXACT):
        total += a[:, at : at + EXACT] @ b[:, at : at + EXACT].T
    return total


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, added in order of the components."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total


class _Side:
    def __init__(self, dim: int, ids: bytes, own: bytes, vectors: bytes):
        self.ids, self.own = (np.frombuffer(x, "<i8") for x in (ids, own))
        self.vectors = np.frombuffer(vectors, "<f8").reshape(-1, dim)
        # Scaled to a largest component of 1, so that no square or product leaves the range.
        self.scale = np.abs(self.vectors).max(axis=1)
        scaled = self.vectors / self.scale[:, None]
        self.steps, self.step, self.rest, self.norm, self.near = quantise(scaled)


def _tile(queries: _Side, candidates: _Side, heaps: list[list], k: int) -> None:
    """Put on each query's heap of ``(score, -id)`` what the tile has among the best ``k``."""
    for at in range(0, len(queries.ids), STRIP):
        rows = slice(at, at + STRIP)
        near = product(queries.steps[rows], candidates.steps)
        near *= queries.step[rows, None] * candidates.step
        error = queries.rest[rows, None] * candidates.norm
        error += queries.near[rows, None] * candidates.rest
        error += 1e-9 * queries.norm[rows, None] * candidates.norm
        scale = candidates.scale[None, :]
        own = queries.own[rows, None] == candidates.own[None, :]
        low = (near - error) * scale
        low[own] = -np.inf
        high = (near + error) * scale
        least = np.full(len(low), -np.inf)
        if low.shape[1] > k:
            least = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
        for i in range(len(low)):
            heap = heaps[at + i]
            if len(heap) == k:
                reached = heap[0][0] / queries.scale[at + i]
                least[i] = max(least[i], reached - 1e-9 * abs(reached))
        i, j = np.nonzero((high >= least[:, None]) & ~own)
        scores = inner(queries.vectors[at + i], candidates.vectors[j])
        for q, score, key in zip(
            (at + i).tolist(), scores.tolist(), candidates.ids[j].tolist(), strict=True
        ):
            heap, item = heaps[q], (score, -key)
            if len(heap) < k:
                heapq.heappush(heap, item)
            elif item > heap[0]:
                heapq.heapreplace(heap, item)


_FOUND = "query_row bigint, query_id bigint, vec_id bigint, score double"


def _search(k: int):
    """mapInArrow function from tiles to the best candidates that a task saw for each query."""

    def rows(queries: _Side, heaps: list[list]) -> pa.RecordBatch:
        own = np.repeat(np.arange(len(heaps)), [len(h) for h in heaps])
        items = [item for heap in heaps for item in heap]
        columns = [queries.own[own], queries.ids[own]]
        columns += [np.array([-key for _, key in items], np.int64)]
        columns += [np.array([score for score, _ in items], np.float64)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], [x.split()[0] for x in _FOUND.split(", ")]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: OrderedDict[int, tuple[_Side, list[list]]] = OrderedDict()
        last: tuple[int, _Side] | None = None
        for batch in batches:
            for tile in range(len(batch)):
                row = {n: batch.column(n)[tile].as_py() for n in batch.schema.names}
                if row["q_block"] not in held:
                    if len(held) == HELD:
                        yield rows(*held.popitem(last=False)[1])
                    side = _Side(row["dim"], row["q_ids"], row["q_own"], row["q_vectors"])
                    held[row["q_block"]] = side, [[] for _ in side.ids]
                held.move_to_end(row["q_block"])
                if last is None or last[0] != row["block"]:
                    side = _Side(row["dim"], row["ids"], row["own"], row["vectors"])
                    last = row["block"], side
                side, heaps = held[row["q_block"]]
                _tile(side, last[1], heaps, k)
        for entry in held.values():
            yield rows(*entry)

    return run


def nearest(
    vectors: DataFrame,
    is_query: Column,
    *,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query row its ``k`` nearest other rows.

    Largest inner product first, equal ones by smaller id; fewer rows if there are fewer candidates.
    Rows without an id and vectors that are NULL, empty, zero or hold NULL or non-finite components
    take no part. Vectors of different lengths are not compared. A repeated row is a row of its own:
    it is found by its twin, and as a query gets its own ranking under the same ``query_id``.
    """
    chosen = vectors.select(
        column(vectors, id_col).cast("long").alias("id"),
        column(vectors, vector_col).cast("array<double>").alias("v"),
        is_query.alias("query"),
    )
    usable = F.expr(
        "id IS NOT NULL AND size(v) > 0 AND exists(v, x -> x <> 0) AND forall(v, x -> x IS NOT NULL"
        " AND NOT isnan(x) AND abs(x) <> double('infinity'))"
    )
    blocks = stored(
        chosen.filter(usable).mapInArrow(_pack(), _BLOCK),
        "vector-blocks",
    )
    # How many tasks share the tiles, and how: by the least data to send to them.
    sizes = {r["query"]: r["n"] for r in blocks.groupBy("query").agg(F.count("*").alias("n")).collect()}
    n_queries, n_candidates = sizes.get(True, 0), sizes.get(False, 0)
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(1, n_queries) * QUERIES / (max(1, n_candidates) * CANDIDATES)
    across = max(1, min(n_queries, round(math.sqrt(tasks * share))))
    down = max(1, min(n_candidates, math.ceil(tasks / across)))

    def dealt(side: DataFrame, own: int, others: int, names: tuple[str, str]) -> DataFrame:
        part = F.pmod(F.xxhash64("block"), F.lit(own)).cast("int").alias(names[0])
        return side.select("*", part, F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(names[1]))

    queries = dealt(blocks.filter("query"), across, down, ("q_part", "c_part")).withColumnsRenamed(
        {"block": "q_block", "ids": "q_ids", "own": "q_own", "vectors": "q_vectors"}
    )
    candidates = dealt(blocks.filter("NOT query"), down, across, ("c_part", "q_part"))
    keys = ["dim", "q_part", "c_part"]
    tiles = candidates.drop("query").join(queries.drop("query"), keys)
    found = tiles.drop("q_part", "c_part").mapInArrow(_search(k), _FOUND)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
